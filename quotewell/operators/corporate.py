"""Splits, dividends, adjusted prices and trailing dividends."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, WindowSpec, functions as F

from quotewell.functions.calendar import date_key, date_of
from quotewell.operators.returns import history


FACTOR_SCALE = 12


def backward(key: str, day: str) -> WindowSpec:
    return W.partitionBy(key).orderBy(F.desc(day))


def split_events(splits: DataFrame, key: str = "id_acao", day: str = "id_data") -> DataFrame:
    """One factor per share and day; several events on one day multiply. Factors must be above zero."""
    return (
        splits.filter("vl_fator > 0")
        .groupBy(key, day)
        .agg(F.product(F.col("vl_fator").cast("double")).alias("_split"))
    )


def dividend_events(dividends: DataFrame, key: str = "id_acao") -> DataFrame:
    """One amount per share and last day with the right (`dt_ex`); rows without that date are left out."""
    return (
        dividends.filter("dt_ex IS NOT NULL AND vl_dividendo > 0")
        .groupBy(key, date_key(F.col("dt_ex")).alias("id_data"))
        .agg(F.sum("vl_dividendo").cast("double").alias("_dividend"))
    )


def with_adjustment(
    quotes: DataFrame,
    splits: DataFrame | None = None,
    dividends: DataFrame | None = None,
    close: str = "vl_fechamento",
    key: str = "id_acao",
    day: str = "id_data",
) -> DataFrame:
    """Quotes with `fator_ajuste`, by which a close is multiplied to compare with today's.

    A split divides the closes before its date. A dividend D multiplies closes up to `dt_ex` by (P - D)/P,
    P being the last close by then; a factor not above zero is ignored. Events join the quotes as rows of
    the same history, so one shuffle by share serves every window, and an event on a day without a session
    needs no special case. Products run from the latest day back, so they hold only events still to come.
    """
    kept = [c for c in quotes.columns if c not in (key, day)]
    rows = quotes.select(key, day, F.struct(*kept).alias("_quote"), F.col(close).cast("double").alias("_close"))
    for events in (
        split_events(splits, key, day) if splits is not None else None,
        dividend_events(dividends, key) if dividends is not None else None,
    ):
        if events is not None:
            rows = rows.unionByName(events, allowMissingColumns=True)
    latest_first = backward(key, day)
    factor = F.lit(1.0)
    if dividends is not None:
        price = F.last("_close", ignorenulls=True).over(history(key, day))
        kept_share = F.try_divide(price - F.col("_dividend"), price)
        rows = rows.withColumn("_kept", F.when(F.col("_dividend").isNotNull() & (kept_share > 0), kept_share))
        from_here_on = latest_first.rangeBetween(W.unboundedPreceding, 0)
        factor = factor * F.coalesce(F.product("_kept").over(from_here_on), F.lit(1.0))
    if splits is not None:
        after_here = latest_first.rangeBetween(W.unboundedPreceding, -1)
        factor = F.try_divide(factor, F.coalesce(F.product("_split").over(after_here), F.lit(1.0)))
    # Products of doubles differ in their last digits by the order of events: the factor has a fixed scale.
    return (
        rows.withColumn("fator_ajuste", F.round(factor, FACTOR_SCALE))
        .filter(F.col("_quote").isNotNull())
        .select(key, day, "_quote.*", "fator_ajuste")
    )


def adjusted_prices(
    quotes: DataFrame,
    splits: DataFrame | None,
    dividends: DataFrame | None,
    close: str = "vl_fechamento",
    key: str = "id_acao",
    day: str = "id_data",
) -> DataFrame:
    """Adjusted close and the return on it, one row per share and session.

    Between sessions with the same factor the adjusted return is the plain one, and as exact. Other figures are rounded
    at the tenth or twelfth digit first, so one half way between two of the stored digits rounds up for sure. Sessions
    stay in the descending order of the adjustment, where the session before is the next row.
    """
    over = backward(key, day)
    rows = with_adjustment(quotes.select(key, day, close), splits, dividends, close, key, day)
    rows = rows.withColumn("_plain", F.try_divide(F.col(close), F.lead(close).over(over)) - 1)
    step = F.try_divide(F.col("fator_ajuste"), F.lead("fator_ajuste").over(over))
    adjusted = (1 + F.col("_plain").cast("double")) * step - 1
    return rows.select(
        key,
        day,
        (F.col(close).cast("double") * F.col("fator_ajuste")).try_cast("decimal(28,10)").try_cast("decimal(18,4)").alias("vl_fechamento_aj"),
        F.when(step == 1, F.col("_plain").try_cast("decimal(10,6)"))
        .otherwise(adjusted.try_cast("decimal(22,12)").try_cast("decimal(10,6)"))
        .alias("vl_retorno_aj"),
    )


def trailing_flows(
    dividends: DataFrame, days: int = 365, key: str = "id_acao", paid_on: str = "id_data", amount: str = "vl_dividendo"
) -> DataFrame:
    """Each dividend as +amount on its day and -amount once it leaves the trailing span; one row per share and day."""
    paid = F.unix_date(date_of(F.col(paid_on)))
    steps = F.array(
        F.struct(paid.alias("_day"), F.col(amount).alias("_flow")),
        F.struct((paid + days).alias("_day"), (-F.col(amount)).alias("_flow")),
    )
    return (
        dividends.select(key, F.explode(steps).alias("_step"))
        .groupBy(key, F.col("_step._day").alias("_day"))
        .agg(F.sum("_step._flow").alias("_flow"))
    )


def with_trailing_dividends(
    quotes: DataFrame,
    dividends: DataFrame,
    days: int = 365,
    key: str = "id_acao",
    day: str = "id_data",
    paid_on: str = "id_data",
    out: str = "vl_dividendos_12m",
) -> DataFrame:
    """Dividends per share paid in the last `days` days, the quote's day included; zero when there were none.

    A running sum of in and out flows gives the moving total in one linear pass, exact in decimals.
    To keep kinds of proceeds apart, pass the dividends of one `ds_tipo` at a time.
    """
    kept = [c for c in quotes.columns if c != key]
    rows = quotes.select(key, F.unix_date(date_of(F.col(day))).alias("_day"), F.struct(*kept).alias("_quote"))
    rows = rows.unionByName(trailing_flows(dividends, days, key, paid_on), allowMissingColumns=True)
    running = W.partitionBy(key).orderBy("_day").rangeBetween(W.unboundedPreceding, 0)
    total = F.coalesce(F.sum("_flow").over(running), F.lit(0)).cast("decimal(18,6)")
    return rows.withColumn(out, total).filter(F.col("_quote").isNotNull()).select(key, "_quote.*", out)
