"""Daily returns, rolling risk and cumulative returns."""

from __future__ import annotations

from datetime import date
from functools import reduce
from math import sqrt

from pyspark.sql import Column, DataFrame, Window as W, WindowSpec, functions as F

from quotewell.functions.calendar import between_days

SESSIONS_PER_YEAR = 252  # fixed value


def history(key: str = "id_acao", day: str = "id_data") -> WindowSpec:
    return W.partitionBy(key).orderBy(day)


def change_on_previous(value: str, over: WindowSpec) -> Column:
    """value / previous value - 1; NULL on the first row and after a zero.

    Decimal prices are divided as decimals, so that a return half way between two millionths rounds up for sure.
    """
    return F.try_divide(F.col(value), F.lag(value).over(over)) - 1


def with_daily_return(
    quotes: DataFrame,
    close: str = "vl_fechamento",
    out: str = "vl_retorno_diario",
    key: str = "id_acao",
    day: str = "id_data",
) -> DataFrame:
    """Return on the previous session as decimal(10,6); NULL on a share's first session."""
    return quotes.withColumn(out, change_on_previous(close, history(key, day)).try_cast("decimal(10,6)"))


def returns_out_of_range(
    quotes: DataFrame, close: str = "vl_fechamento", key: str = "id_acao", day: str = "id_data"
) -> DataFrame:
    """Rows whose return does not fit decimal(10,6), with it as `_retorno`: to be recorded, as their return is NULL."""
    change = change_on_previous(close, history(key, day))
    rows = quotes.withColumn("_retorno", change)
    return rows.filter(F.col("_retorno").isNotNull() & F.col("_retorno").try_cast("decimal(10,6)").isNull())


def with_amplitude(quotes: DataFrame) -> DataFrame:
    """Day's high minus low."""
    return quotes.withColumn("vl_amplitude", (F.col("vl_maximo") - F.col("vl_minimo")).cast("decimal(18,4)"))


def with_rolling_risk(
    quotes: DataFrame,
    window: int = SESSIONS_PER_YEAR,
    min_returns: int | None = None,
    returns: str = "vl_retorno_diario",
    rate: str | None = None,
    key: str = "id_acao",
    day: str = "id_data",
) -> DataFrame:
    """Annualised volatility over the last `window` sessions and, given a daily `rate` in percent, the Sharpe ratio.

    NULL until the window holds `min_returns` returns (by default `window`). Window sums are differences of
    running sums, so the cost is linear in the history instead of rows x window. Returns enter as whole
    millionths, their running sums as bigint and those of their squares as decimal(38,0): exact whatever came before.
    """
    need = window if min_returns is None else min_returns
    over = history(key, day)
    running = over.rowsBetween(W.unboundedPreceding, 0)
    r = F.col(returns).cast("double")
    micro = F.round(r * 1_000_000).cast("bigint")
    square = (micro.cast("decimal(19,0)") * micro.cast("decimal(19,0)")).cast("decimal(28,0)")
    sums = {"_n": F.when(r.isNotNull(), 1.0), "_s": micro, "_q": square}
    if rate:
        excess = r - F.col(rate).cast("double") / 100
        sums |= {"_xn": F.when(excess.isNotNull(), 1.0), "_x": excess}
    out = quotes.withColumns({name: F.coalesce(F.sum(v).over(running), F.lit(0)) for name, v in sums.items()})
    out = out.withColumns({name: F.col(name) - F.coalesce(F.lag(name, window).over(over), F.lit(0)) for name in sums})

    n, s, q = F.col("_n"), F.col("_s").cast("double"), F.col("_q").cast("double")
    variance = F.greatest(F.try_divide(q - F.try_divide(s * s, n), n - 1), F.lit(0.0))
    volatility = F.sqrt(variance) / 1_000_000 * sqrt(SESSIONS_PER_YEAR)
    out = out.withColumn("_vol", F.when((n >= need) & (n > 1), volatility))
    out = out.withColumn("vl_volatilidade", F.col("_vol").try_cast("decimal(10,6)"))
    if rate:
        mean = F.try_divide(F.col("_x"), F.col("_xn"))
        sharpe = F.when(F.col("_xn") >= need, F.try_divide(mean * SESSIONS_PER_YEAR, F.col("_vol")))
        out = out.withColumn("vl_sharpe", sharpe.try_cast("decimal(10,6)"))
    return out.drop("_vol", *sums)


def cumulative_returns(
    quotes: DataFrame,
    windows: dict[str, tuple[date | str, date | str]],
    returns: str = "vl_retorno_diario",
    key: str = "id_acao",
    day: str = "id_data",
    decimal: str | None = "decimal(18,6)",
) -> DataFrame:
    """Compound return of every share in each closed window, as a fraction; NULL without data.

    All windows come from one scan and one aggregation. NULL returns are skipped.
    """
    inside = {name: between_days(F.col(day), *bounds) for name, bounds in windows.items()}
    growth = 1 + F.col(returns).cast("double")
    totals = []
    for name, here in inside.items():
        total = F.product(F.when(here, growth)) - 1
        totals.append((total.try_cast(decimal) if decimal else total).alias(name))
    return quotes.filter(reduce(Column.__or__, inside.values())).groupBy(key).agg(*totals)


def growth_to_date(quotes: DataFrame, returns: str = "vl_retorno_diario", key: str = "id_acao", day: str = "id_data") -> DataFrame:
    """(key, day, log_acumulado, perdas_totais, retornos): running sums from which the return of any window follows.

    The logarithms of 1 + return are summed without total losses (-1), which are counted; NULL returns add nothing.
    """
    r = F.col(returns).cast("double")
    so_far = history(key, day).rowsBetween(W.unboundedPreceding, 0)
    return quotes.select(
        key,
        day,
        F.coalesce(F.sum(F.when(r > -1, F.log1p(r))).over(so_far), F.lit(0.0)).alias("log_acumulado"),
        F.count(F.when(r <= -1, 1)).over(so_far).alias("perdas_totais"),
        F.count(r).over(so_far).alias("retornos"),
    )


def window_returns(
    windows: DataFrame, growth: DataFrame, first: str, last: str, out: str = "vl_retorno", key: str = "id_acao", day: str = "id_data"
) -> DataFrame:
    """Compound return of the window's share over its days `first` to `last`, both included; NULL without a return in it.

    Two lookups in `growth_to_date` a window and no range of quotes. The distinct ends of all windows enter the share's own
    history as rows, so a share's group is no longer than twice the calendar, however many windows it has; the windows then meet their
    ends in plain joins, which Spark may split. The windows keep their columns; ends are days of the same kind as `day`.
    """
    facts = F.struct("log_acumulado", "perdas_totais", "retornos")
    none = F.struct(F.lit(0.0).alias("log_acumulado"), F.lit(0).cast("bigint").alias("perdas_totais"), F.lit(0).cast("bigint").alias("retornos"))
    # On one day: what was known before it (0), the day's own row (1), what is known with it (2).
    ends = windows.select(key, F.col(first).alias(day), F.lit(0).alias("_side")).unionByName(windows.select(key, F.col(last).alias(day), F.lit(2).alias("_side"))).distinct()
    rows = growth.select(key, day, F.lit(1).alias("_side"), facts.alias("_sums")).unionByName(ends, allowMissingColumns=True)
    until = F.last("_sums", ignorenulls=True).over(W.partitionBy(key).orderBy(day, "_side"))
    found = rows.withColumn("_known", F.coalesce(until, none)).filter("_side <> 1").select(key, day, "_side", "_known")

    def end(column: str, side: int, name: str) -> DataFrame:
        return found.filter(F.col("_side") == side).select(F.col(key), F.col(day).alias(column), F.col("_known").alias(name))

    both = windows.join(end(first, 0, "_before"), [key, first], "left").join(end(last, 2, "_through"), [key, last], "left")
    more = lambda c: F.col(f"_through.{c}") - F.col(f"_before.{c}")
    value = F.when(more("perdas_totais") > 0, F.lit(-1.0)).otherwise(F.expm1(more("log_acumulado")))
    return both.withColumn(out, F.when((F.col(first) <= F.col(last)) & (more("retornos") > 0), value)).select(*windows.columns, out)


def endpoint_returns(
    quotes: DataFrame,
    windows: dict[str, tuple[date | str, date | str]],
    close: str = "vl_fechamento",
    key: str = "id_acao",
    day: str = "id_data",
) -> DataFrame:
    """Last close over first close minus 1 in each window: the same figure when only prices are kept."""
    inside = {name: between_days(F.col(day), *bounds) for name, bounds in windows.items()}
    price = F.col(close).cast("double")
    totals = [
        (
            F.try_divide(
                F.max_by(F.when(here, price), F.when(here, F.col(day))),
                F.min_by(F.when(here, price), F.when(here, F.col(day))),
            )
            - 1
        ).alias(name)
        for name, here in inside.items()
    ]
    return quotes.filter(reduce(Column.__or__, inside.values())).groupBy(key).agg(*totals)
