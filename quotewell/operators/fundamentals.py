"""Company statements and the monthly indicator fact."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from quotewell.functions import valuation
from quotewell.functions.calendar import date_of, month_of, year_of
from quotewell.operators.aggregates import pivot_measures
from quotewell.operators.corporate import trailing_flows
from quotewell.operators.joins import keep_first
from quotewell.operators.returns import SESSIONS_PER_YEAR, with_rolling_risk

# Measure columns and the account codes (public chart of accounts) summed into each.
ACCOUNTS = {
    "vl_receita_liquida": ["3.01"],
    "vl_lucro_liquido": ["3.11"],
    "vl_ebitda": ["3.05"],
    "vl_divida_bruta": ["2.01.04", "2.02.01"],
    "vl_patrimonio_liq": ["2.03"],
    "vl_ativo_total": ["1"],
}

MEASURES = list(ACCOUNTS)


def latest_versions(rows: DataFrame, keys: list[str], version: str, *tie_break: Column) -> DataFrame:
    """Of a restated statement only the highest version."""
    return keep_first(rows, keys, [F.desc(version), *tie_break])


ACCOUNT = ["id_empresa", "id_data", "ds_tipo_dem", "ds_quadro", "cd_conta"]


def known_versions(history: DataFrame, day: date | str | None = None, account: list[str] | None = None) -> DataFrame:
    """Each account as known on a day: the highest version delivered by then, whatever the order of delivery.

    `history` has a row per account and version with `dt_entrega`; without `day` all deliveries count. Folded map-side.
    """
    rows = history if day is None else history.filter(F.col("dt_entrega") <= F.lit(str(day)).cast("date"))
    by = [c for c in [*(account or ACCOUNT), "nr_ano"] if c in history.columns]
    rest = [c for c in history.columns if c not in by]
    last = rows.groupBy(*by).agg(F.max_by(F.struct(*rest), "nr_versao").alias("_last"))
    return last.select(*by, "_last.*")


def validity(history: DataFrame, account: list[str] | None = None) -> DataFrame:
    """The versions that were ever the known one, with `dt_inicio` and `dt_fim`: known from the one day to before the other.

    A version delivered after a higher one was never known, and of several on one day only the highest; `dt_fim` is NULL
    while a version stands. A group of the window has as many rows as an account has versions.
    """
    by = [c for c in (account or ACCOUNT) if c in history.columns]
    order = W.partitionBy(*by).orderBy("dt_entrega", F.desc("nr_versao"))
    before = F.max("nr_versao").over(order.rowsBetween(W.unboundedPreceding, -1))
    known = history.withColumn("_before", before).filter("_before IS NULL OR nr_versao > _before").drop("_before")
    until = F.lead("dt_entrega").over(W.partitionBy(*by).orderBy("dt_entrega"))
    return known.withColumns({"dt_inicio": F.col("dt_entrega"), "dt_fim": until})


def statement_measures(
    rows: DataFrame, by: list[str], accounts: dict[str, list[str]] | None = None, code: str = "cd_conta", value: str = "vl_conta"
) -> DataFrame:
    """One row per company and reference date with the measure columns, signs kept."""
    return pivot_measures(rows, by, code, value, accounts or ACCOUNTS, "decimal(20,2)")


def indicator_fact(
    quotes: DataFrame,
    shares: DataFrame,
    statements: DataFrame,
    dividends: DataFrame,
    rate: DataFrame,
    window: int = SESSIONS_PER_YEAR,
    lag_days: int = 0,
    dividend_days: int = 365,
    min_returns: int | None = None,
) -> DataFrame:
    """P/L, ROE, DY, EV/EBITDA, Sharpe, volatility and market cap on each share's last session of a month.

    `quotes` is (id_acao, id_data, vl_fechamento, vl_retorno_diario), `shares` maps id_acao to id_empresa and
    nr_total_acoes, `statements` is one row per (id_empresa, id_data) with the measures, `dividends` is
    (id_acao, id_data, vl_dividendo), `rate` is (id_data, vl_taxa) in percent a day.

    Statements and dividend flows enter as extra rows of the share's own history. All windows share the one
    partitioning by share, so the quotes are shuffled once.
    """
    history = quotes.join(rate, "id_data", "left").select(
        "id_acao",
        F.unix_date(date_of(F.col("id_data"))).alias("_day"),
        F.struct("id_data", "vl_fechamento", "vl_retorno_diario", "vl_taxa").alias("_quote"),
    )
    filed = (
        statements.groupBy("id_empresa", "id_data")
        .agg(F.max(F.struct(*MEASURES)).alias("_filed"))
        .join(shares.select("id_empresa", "id_acao"), "id_empresa")
        .select(
            "id_acao",
            (F.unix_date(date_of(F.col("id_data"))) + lag_days).alias("_day"),
            "_filed",
        )
    )
    rows = history.unionByName(filed, allowMissingColumns=True).unionByName(
        trailing_flows(dividends, dividend_days), allowMissingColumns=True
    )
    past = W.partitionBy("id_acao").orderBy("_day").rangeBetween(W.unboundedPreceding, 0)
    rows = (
        rows.withColumn("_filed", F.last("_filed", ignorenulls=True).over(past))
        .withColumn("_paid", F.coalesce(F.sum("_flow").over(past), F.lit(0)))
        .filter(F.col("_quote").isNotNull())
        .select("id_acao", "_day", "_quote.*", "_filed", "_paid")
    )
    rows = with_rolling_risk(rows, window=window, min_returns=min_returns, rate="vl_taxa", day="_day")
    next_day = F.lead("id_data").over(W.partitionBy("id_acao").orderBy("_day"))
    month = year_of(F.col("id_data")) * 100 + month_of(F.col("id_data"))
    last_of_month = next_day.isNull() | (year_of(next_day) * 100 + month_of(next_day) != month)
    rows = rows.withColumn("_last", last_of_month).filter("_last").select("*", "_filed.*")

    issued = shares.select("id_acao", "nr_total_acoes")
    rows = rows.join(issued, "id_acao").withColumn(
        "vl_market_cap", valuation.market_cap(F.col("nr_total_acoes"), F.col("vl_fechamento"))
    )
    cap = F.col("vl_market_cap")
    return rows.select(
        "id_acao",
        "id_data",
        valuation.price_earnings(cap, F.col("vl_lucro_liquido")).alias("vl_pl"),
        valuation.return_on_equity(F.col("vl_lucro_liquido"), F.col("vl_patrimonio_liq")).alias("vl_roe"),
        valuation.dividend_yield(F.col("_paid"), F.col("vl_fechamento")).alias("vl_dy"),
        valuation.ev_ebitda(cap, F.col("vl_divida_bruta"), F.col("vl_ebitda")).alias("vl_ev_ebitda"),
        "vl_sharpe",
        "vl_volatilidade",
        "vl_market_cap",
    )
