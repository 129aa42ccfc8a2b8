"""The two market procedures and the questions around them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from quotewell.functions.calendar import between_days, date_of
from quotewell.functions.labels import resilience_class
from quotewell.operators.aggregates import TRADING_DAYS_PER_MONTH, exact_mean, monthly_mean
from quotewell.operators.joins import share_dimensions, tag_periods
from quotewell.operators.returns import change_on_previous, cumulative_returns

Day = date | str


def series_values(macro: DataFrame, indicators: DataFrame, code: str) -> DataFrame:
    """Values of one macro series by its code."""
    wanted = indicators.filter(F.col("cd_indicador") == code).select("id_indicador")
    return macro.join(wanted, "id_indicador").select("id_data", "vl_indicador")


def rate_against_sector(
    quotes: DataFrame,
    acao: DataFrame,
    empresa: DataFrame,
    setor: DataFrame,
    macro: DataFrame,
    indicators: DataFrame,
    first: Day = "2018-01-01",
    last: Day = "2023-12-31",
    sector: str = "FIN",
    indicator: str = "SELIC",
    compound_rate: bool = False,
) -> DataFrame:
    """Monthly mean return of a sector's shares in percent, mean rate, and their difference; months with both.

    The daily mean return is scaled by 21 to a month while the rate stays a daily mean; `compound_rate=True`
    scales the rate as well. The date bounds are stated on the facts' own key, so they prune files, and the
    sector's shares are found in the dimensions before they meet the fact. Means and rounding are decimal.
    """
    shares = share_dimensions(acao, empresa, setor, [], keep=F.col("s.cd_setor") == sector)
    bars = quotes.filter(between_days(F.col("id_data"), first, last)).select("id_acao", "id_data", "vl_retorno_diario")
    bars = bars.join(shares, "id_acao")
    monthly = monthly_mean(bars, "vl_retorno_diario", "_return", factor=TRADING_DAYS_PER_MONTH)

    rates = series_values(macro.filter(between_days(F.col("id_data"), first, last)), indicators, indicator)
    scale = TRADING_DAYS_PER_MONTH if compound_rate else 1
    monthly_rate = monthly_mean(rates, "vl_indicador", "_rate", factor=scale)

    percent = F.col("_return") * 100
    return monthly.join(monthly_rate, ["nr_ano", "nr_mes"]).select(
        "nr_ano",
        "nr_mes",
        F.round(percent, 4).alias("retorno_acoes_pct"),
        F.round("_rate", 4).alias("selic_pct"),
        F.round(percent - F.col("_rate"), 4).alias("diferenca"),
    )


def rising_rate_months(macro: DataFrame, indicators: DataFrame, indicator: str = "SELIC") -> DataFrame:
    """Months whose mean rate rose on the month before. The one window group has a row per month."""
    months = monthly_mean(series_values(macro, indicators, indicator), "vl_indicador", "media")
    before = F.lag("media").over(W.partitionBy(F.lit(1)).orderBy("nr_ano", "nr_mes"))
    return months.withColumn("anterior", before).filter("media > anterior")


def two_period_returns(
    quotes: DataFrame, base: tuple[Day, Day] = ("2019-01-01", "2019-12-31"), crisis: tuple[Day, Day] = ("2020-01-01", "2020-12-31")
) -> DataFrame:
    """Returns of every share in the base and in the crisis window, both known; one scan for the two."""
    totals = cumulative_returns(quotes, {"ret_base": base, "ret_crise": crisis})
    return totals.filter("ret_base IS NOT NULL AND ret_crise IS NOT NULL")


def period_name(window: tuple[Day, Day], otherwise: str) -> str:
    """The year of a window that lies within one, else a general name."""
    first, last = (str(d)[:4] for d in window)
    return first if first == last else otherwise


def resilience(
    quotes: DataFrame,
    acao: DataFrame,
    empresa: DataFrame,
    setor: DataFrame,
    base: tuple[Day, Day] = ("2019-01-01", "2019-12-31"),
    crisis: tuple[Day, Day] = ("2020-01-01", "2020-12-31"),
) -> DataFrame:
    """Active shares with both returns in percent, the change in points and the class.

    The return columns carry the windows' years: retorno_2019_pct, retorno_2020_pct.
    """
    names = [period_name(base, "base"), period_name(crisis, "crise")]
    if names[0] == names[1]:
        names = ["base", "crise"]
    shares = share_dimensions(acao, empresa, setor, ["cd_ticker", "s.ds_setor"], keep=F.col("a.fl_ativa"))
    returns = two_period_returns(quotes, base, crisis).join(shares, "id_acao")
    before, during = F.col("ret_base"), F.col("ret_crise")
    return returns.select(
        "cd_ticker",
        "ds_setor",
        F.round(before * 100, 2).alias(f"retorno_{names[0]}_pct"),
        F.round(during * 100, 2).alias(f"retorno_{names[1]}_pct"),
        F.round((during - before) * 100, 2).alias("variacao"),
        resilience_class(before, during).alias("classificacao"),
    )


def sector_resilience(classified: DataFrame) -> DataFrame:
    """Shares and mean change per sector and class."""
    return classified.groupBy("ds_setor", "classificacao").agg(
        F.count("*").alias("acoes"), F.round(exact_mean("variacao"), 4).alias("variacao_media")
    )


def register_return_function(spark: SparkSession, quotes_view: str, name: str = "fn_retorno_acumulado") -> None:
    """SQL function `name(ticker, d1, d2)`: compound return over a view with cd_ticker, dt_data, vl_retorno_diario.

    It keeps the call form for single tickers. For whole tables use `cumulative_returns`, one pass for all.
    The sum of logarithms stands in for the product, which SQL does not have; a day of total loss makes it -1.
    """
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(p_ticker STRING, p_first DATE, p_last DATE)
        RETURNS DOUBLE
        RETURN SELECT CASE WHEN count_if(q.vl_retorno_diario = -1) > 0 THEN -1D
                           ELSE exp(sum(ln(1 + CAST(q.vl_retorno_diario AS DOUBLE)))) - 1 END
               FROM {quotes_view} q
               WHERE q.cd_ticker = p_ticker AND q.dt_data BETWEEN p_first AND p_last
    """)


# ---- risk, liquidity and exchange-rate questions --------------------------------------------------


def share_liquidity(quotes: DataFrame) -> DataFrame:
    """Mean volume and return volatility per share."""
    r = F.col("vl_retorno_diario").cast("double")
    return quotes.groupBy("id_acao").agg(
        F.avg(F.col("vl_volume").cast("double")).alias("volume_medio"), F.stddev_samp(r).alias("volatilidade")
    )


def volume_against_volatility(quotes: DataFrame, shares: DataFrame) -> DataFrame:
    """Per sector: mean volume, mean volatility and their correlation over its shares. `shares` maps id_acao to cd_setor."""
    return (
        share_liquidity(quotes)
        .join(shares.select("id_acao", "cd_setor"), "id_acao")
        .groupBy("cd_setor")
        .agg(
            F.count("*").alias("acoes"),
            F.avg("volume_medio").alias("volume_medio"),
            F.avg("volatilidade").alias("volatilidade_media"),
            F.corr("volume_medio", "volatilidade").alias("correlacao"),
        )
    )


def correlation_across_sectors(sectors: DataFrame) -> DataFrame:
    """One row: correlation of mean volume and mean volatility over the sectors."""
    return sectors.agg(F.corr("volume_medio", "volatilidade_media").alias("correlacao_setores"))


def exchange_sensitivity(quotes: DataFrame, exporters: DataFrame, exchange: DataFrame) -> DataFrame:
    """Per exporter: correlation of daily returns with the exchange rate's, and the share of its up-days among the rate's.

    `exporters` has id_acao; `exchange` has (id_data, vl_indicador), one row per day: its one window group is
    no longer than the calendar.
    """
    fx = exchange.select(
        "id_data", change_on_previous("vl_indicador", W.partitionBy(F.lit(1)).orderBy("id_data")).alias("r_fx")
    ).filter("r_fx IS NOT NULL")
    r = F.col("vl_retorno_diario").cast("double")
    paired = (
        quotes.filter("vl_retorno_diario IS NOT NULL")
        .join(exporters.select("id_acao"), "id_acao", "left_semi")
        .join(fx, "id_data")
    )
    return paired.groupBy("id_acao").agg(
        F.count("*").alias("pregoes"),
        F.corr(r, "r_fx").alias("correlacao"),
        F.avg(F.when(F.col("r_fx") > 0, (r > 0).cast("int"))).alias("altas_com_cambio"),
    )


def sharpe_by_segment(risk: DataFrame, shares: DataFrame) -> DataFrame:
    """Shares, mean daily return, volatility and Sharpe per listing segment. `shares` maps id_acao to cd_segmento."""
    per_share = risk.groupBy("id_acao").agg(
        *[
            part.alias(name)
            for c, total, n in [
                ("vl_retorno_diario", "_r", "_rn"),
                ("vl_volatilidade", "_v", "_vn"),
                ("vl_sharpe", "_s", "_sn"),
            ]
            for part, name in [(F.sum(F.col(c).cast("double")), total), (F.count(c), n)]
        ]
    )
    return (
        per_share.join(shares.select("id_acao", "cd_segmento"), "id_acao")
        .groupBy("cd_segmento")
        .agg(
            F.count("*").alias("acoes"),
            F.try_divide(F.sum("_r"), F.sum("_rn")).alias("retorno_medio"),
            F.try_divide(F.sum("_v"), F.sum("_vn")).alias("volatilidade_media"),
            F.try_divide(F.sum("_s"), F.sum("_sn")).alias("sharpe_medio"),
        )
    )


# ---- crises ---------------------------------------------------------------------------------------


def crisis_phases(periods: DataFrame) -> DataFrame:
    """Each period as three: as long before, during, as long after."""
    length = F.datediff("dt_fim", "dt_inicio") + 1
    phases = F.array(
        F.struct(F.lit("antes").alias("fase"), F.date_sub("dt_inicio", length).alias("a"), F.date_sub("dt_inicio", 1).alias("b")),
        F.struct(F.lit("durante").alias("fase"), F.col("dt_inicio").alias("a"), F.col("dt_fim").alias("b")),
        F.struct(F.lit("depois").alias("fase"), F.date_add("dt_fim", 1).alias("a"), F.date_add("dt_fim", length).alias("b")),
    )
    return periods.select("ds_crise", F.explode(phases).alias("p")).select(
        "ds_crise", F.col("p.fase").alias("fase"), F.col("p.a").alias("dt_inicio"), F.col("p.b").alias("dt_fim")
    )


def crisis_study(quotes: DataFrame, periods: DataFrame, key: str = "id_acao") -> DataFrame:
    """Compound return and volatility of every share before, during and after every crisis.

    Quotes that have `nr_ano`, as the stored fact has, are read in the folders of the phases' years only.
    """
    year = ["nr_ano"] if "nr_ano" in quotes.columns else []
    days = quotes.select(key, date_of(F.col("id_data")).alias("dt_data"), F.col("vl_retorno_diario").cast("double").alias("r"), *year)
    tagged = tag_periods(days.filter("r IS NOT NULL"), crisis_phases(periods), "dt_data", ["ds_crise", "fase"], how="inner", year=year[0] if year else None)
    return tagged.groupBy(key, "ds_crise", "fase").agg(
        F.count("*").alias("pregoes"),
        (F.product(1 + F.col("r")) - 1).alias("retorno"),
        F.stddev_samp("r").alias("volatilidade"),
    )
