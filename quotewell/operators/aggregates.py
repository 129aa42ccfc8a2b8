"""Counts, coverage, monthly means, state summaries and calendar roll-ups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from quotewell.functions.calendar import month_of, year_of

TRADING_DAYS_PER_MONTH = 21  # fixed value


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row (tabela, registros) per table."""
    counts = [df.agg(F.count("*").alias("registros")).select(F.lit(name).alias("tabela"), "registros") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def coverage(fact: DataFrame, key: str, day: str, rows: str, first: str, last: str) -> DataFrame:
    """Rows, first and last day per key. Counted on the fact's own key, before any name is joined."""
    return fact.groupBy(key).agg(F.count("*").alias(rows), F.min(day).alias(first), F.max(day).alias(last))


def exact_mean(value: Column | str) -> Column:
    """Mean as sum over count, NULL over no rows. On decimal input it is exact to 15 digits or more.

    A decimal sum does not depend on the order in which tasks finish, unlike a sum of doubles, so a rounded
    mean is the same on every run and cluster.
    """
    return F.try_divide(F.sum(value), F.count(value))


def monthly_mean(fact: DataFrame, value: str, out: str, day: str = "id_data", factor: int = 1) -> DataFrame:
    """Exact mean of `value` per (nr_ano, nr_mes) times `factor`, over rows where it is known."""
    return (
        fact.filter(F.col(value).isNotNull())
        .groupBy(year_of(F.col(day)).alias("nr_ano"), month_of(F.col(day)).alias("nr_mes"))
        .agg(F.try_divide(F.sum(value) * factor, F.count(value)).alias(out))
    )


def state_summary(staging: DataFrame, table: str, state: str = "fl_processado") -> DataFrame:
    """Total, pending, done and failed rows; on an empty table the total is 0 and the rest NULL."""

    def in_state(code: int) -> Column:
        return F.sum(F.when(F.col(state) == code, 1).otherwise(0))

    return staging.agg(
        F.count("*").alias("total"),
        in_state(0).alias("pendentes"),
        in_state(1).alias("processados"),
        in_state(2).alias("com_erro"),
    ).select(F.lit(table).alias("tabela"), "total", "pendentes", "processados", "com_erro")


def state_summaries(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [state_summary(df, name) for name, df in tables.items()])


def by_grain(fact: DataFrame, calendar: DataFrame, grain: list[str], value: str) -> DataFrame:
    """Rows, sum, mean, minimum and maximum of `value` at any calendar grain.

    The fact is folded to one row per day first, so the calendar join and the second fold are tiny.
    """
    per_day = fact.groupBy("id_data").agg(
        F.count(value).alias("_n"), F.sum(value).alias("_s"), F.min(value).alias("_lo"), F.max(value).alias("_hi")
    )
    return (
        per_day.join(calendar.select("id_data", *grain), "id_data")
        .groupBy(*grain)
        .agg(
            F.sum("_n").alias("linhas"),
            F.sum("_s").alias("soma"),
            F.try_divide(F.sum("_s"), F.sum("_n")).alias("media"),
            F.min("_lo").alias("minimo"),
            F.max("_hi").alias("maximo"),
        )
    )


def pivot_measures(
    rows: DataFrame, by: list[str], code: str, value: str, measures: dict[str, list[str]], decimal: str
) -> DataFrame:
    """Account rows to one row per `by` with a column per measure; accounts outside `measures` are left out.

    Conditional sums over a fixed code list: one aggregation with map-side combine and no scan for the codes.
    """
    wanted = sorted({c for codes in measures.values() for c in codes})
    sums = [F.sum(F.when(F.col(code).isin(codes), F.col(value))).cast(decimal).alias(name) for name, codes in measures.items()]
    return rows.filter(F.col(code).isin(wanted)).groupBy(*by).agg(*sums)


def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first n rows in `order`; give a tie-breaking column last. Runs as a per-task heap, not a full sort."""
    return df.orderBy(*order).limit(n)
