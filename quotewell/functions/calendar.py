"""Integer date keys and the calendar dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quotewell.schemas import TABLES

# Weekday names from Sunday = 1, month names from January = 1.
WEEKDAYS = [
    "Domingo", "Segunda-feira", "Terça-feira", "Quarta-feira", "Quinta-feira", "Sexta-feira", "Sábado",
]
MONTHS = [
    "Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho",
    "Julho", "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro",
]


def date_key(day: Column) -> Column:
    """A date as the integer YYYYMMDD."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def date_of(key: Column) -> Column:
    """The date behind a YYYYMMDD key."""
    return F.make_date(year_of(key), month_of(key), key % 100)


def year_of(key: Column) -> Column:
    return F.call_function("div", key, F.lit(10000)).cast("int")


def month_of(key: Column) -> Column:
    return F.call_function("div", key, F.lit(100)).cast("int") % 100


def key_literal(day: date | str) -> int:
    """YYYYMMDD of a Python date or ISO text, so that date filters reach the scan as integer bounds."""
    if isinstance(day, str):
        day = date.fromisoformat(day)
    return day.year * 10000 + day.month * 100 + day.day


def between_days(key: Column, first: date | str, last: date | str) -> Column:
    """Both ends included, stated on the key column itself and so pushed down to the files."""
    return key.between(key_literal(first), key_literal(last))


def calendar_columns(days: DataFrame, holidays: DataFrame | None = None, day: str = "dt_data") -> DataFrame:
    """All calendar attributes for a column of distinct dates; `holidays` has one column `dt_data`."""
    d = F.col(day)
    if holidays is None:
        days = days.withColumn("fl_feriado", F.lit(False))
    else:
        marked = holidays.select(F.col("dt_data").alias(day)).distinct().withColumn("fl_feriado", F.lit(True))
        days = days.join(marked, day, "left").withColumn("fl_feriado", F.coalesce("fl_feriado", F.lit(False)))
    weekday = F.dayofweek(d)
    month = F.month(d)
    names = F.array(*[F.lit(n) for n in WEEKDAYS])
    months = F.array(*[F.lit(n) for n in MONTHS])
    out = days.select(
        date_key(d).alias("id_data"),
        d.alias("dt_data"),
        F.year(d).alias("nr_ano"),
        month.alias("nr_mes"),
        F.dayofmonth(d).alias("nr_dia"),
        F.quarter(d).alias("nr_trimestre"),
        F.when(month <= 6, 1).otherwise(2).alias("nr_semestre"),
        F.element_at(names, weekday).alias("ds_dia_semana"),
        weekday.alias("nr_dia_semana"),
        "fl_feriado",
        (weekday.between(2, 6) & ~F.col("fl_feriado")).alias("fl_dia_util"),
        F.element_at(months, month).alias("ds_mes"),
    )
    return out.select(*TABLES["dim_data"].fieldNames())


def build_calendar(
    spark: SparkSession,
    first: date | str = "2000-01-01",
    last: date | str = "2024-12-31",
    holidays: DataFrame | None = None,
) -> DataFrame:
    """One row per day from `first` to `last`."""
    bounds = spark.range(1).select(F.lit(str(first)).cast("date").alias("a"), F.lit(str(last)).cast("date").alias("b"))
    return calendar_columns(bounds.select(F.explode(F.sequence("a", "b")).alias("dt_data")), holidays)
