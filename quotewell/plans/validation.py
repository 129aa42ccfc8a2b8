"""Checks to run after a load."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from quotewell.functions.calendar import date_of
from quotewell.functions.labels import volume_status
from quotewell.operators.aggregates import coverage, table_counts, top
from quotewell.operators.joins import left_chain_counts
from quotewell.session import with_checkpoint_dir

COUNTED = [
    "dim_setor", "dim_empresa", "dim_acao", "dim_data", "dim_indicador_macro",
    "fato_cotacao", "fato_indicador_macro", "fato_dem_financeira",
]


def sessions_per_share(quotes: DataFrame) -> DataFrame:
    """Sessions, first and last day per share: all that the checks below need of the quotes."""
    return coverage(quotes, "id_acao", "id_data", "pregoes", "_first", "_last")


def busiest_tickers(per_share: DataFrame, acao: DataFrame, n: int = 20) -> DataFrame:
    """Tickers with the most sessions."""
    named = per_share.join(acao.select("id_acao", "cd_ticker"), "id_acao").select(
        "cd_ticker",
        "pregoes",
        date_of(F.col("_first")).alias("primeiro_pregao"),
        date_of(F.col("_last")).alias("ultimo_pregao"),
    )
    return top(named, n, F.desc("pregoes"), F.col("cd_ticker"))


def indicator_coverage(macro: DataFrame, indicators: DataFrame) -> DataFrame:
    seen = coverage(macro, "id_indicador", "id_data", "total_registros", "_first", "_last")
    return seen.join(indicators, "id_indicador").select(
        "cd_indicador",
        "ds_indicador",
        "total_registros",
        date_of(F.col("_first")).alias("data_mais_antiga"),
        date_of(F.col("_last")).alias("data_mais_recente"),
    )


def sector_distribution(per_share: DataFrame, acao: DataFrame, empresa: DataFrame, setor: DataFrame) -> DataFrame:
    return left_chain_counts(setor, empresa, acao, per_share)


def latest_errors(log: DataFrame, n: int = 20) -> DataFrame:
    return top(log, n, F.desc("dt_erro"), F.desc("id_erro"))


def report(tables: dict[str, DataFrame], minimum: int = 200_000) -> DataFrame:
    """All checks as (verificacao, item, valor): counts, volume, the busiest tickers and all indicators with their first
    and last days, shares and quotes per sector, and the latest 20 errors. A missing table is an error, not a gap.

    Quotes and series are each read once: their counts per share and per indicator are checkpointed, and every
    check starts from those small tables.
    """
    absent = [name for name in [*COUNTED, "etl_log_erros"] if name not in tables]
    if absent:
        raise ValueError(f"not given: {', '.join(absent)}")
    with_checkpoint_dir(tables["fato_cotacao"].sparkSession)
    per_share = sessions_per_share(tables["fato_cotacao"]).checkpoint()
    indicators = indicator_coverage(tables["fato_indicador_macro"], tables["dim_indicador_macro"]).checkpoint()
    acao, empresa, setor = tables["dim_acao"], tables["dim_empresa"], tables["dim_setor"]

    def total(counts: DataFrame, rows: str, table: str) -> DataFrame:
        rows_sum = F.coalesce(F.sum(rows), F.lit(0)).alias("registros")
        return counts.agg(rows_sum).select(F.lit(table).alias("tabela"), "registros")

    def lines(df: DataFrame, check: str, item: str, value: str) -> DataFrame:
        return df.select(F.lit(check).alias("verificacao"), F.col(item).alias("item"), F.col(value).cast("string").alias("valor"))

    quotes = total(per_share, "pregoes", "fato_cotacao")
    others = {name: tables[name] for name in COUNTED if name not in ("fato_cotacao", "fato_indicador_macro")}
    busiest = busiest_tickers(per_share, acao)
    sectors = sector_distribution(per_share, acao, empresa, setor)
    errors = latest_errors(tables["etl_log_erros"]).withColumn("erro", F.col("id_erro").cast("string"))
    parts = [
        lines(table_counts(others), "contagem", "tabela", "registros"),
        lines(quotes, "contagem", "tabela", "registros"),
        lines(total(indicators, "total_registros", "fato_indicador_macro"), "contagem", "tabela", "registros"),
        lines(quotes.withColumn("status", volume_status(F.col("registros"), minimum)), "volume", "tabela", "status"),
        lines(busiest, "pregoes", "cd_ticker", "pregoes"),
        lines(busiest, "primeiro pregao", "cd_ticker", "primeiro_pregao"),
        lines(busiest, "ultimo pregao", "cd_ticker", "ultimo_pregao"),
        lines(indicators, "indicadores", "cd_indicador", "total_registros"),
        lines(indicators, "primeiro valor", "cd_indicador", "data_mais_antiga"),
        lines(indicators, "ultimo valor", "cd_indicador", "data_mais_recente"),
        lines(sectors, "setores", "cd_setor", "total_cotacoes"),
        lines(sectors, "acoes por setor", "cd_setor", "total_acoes"),
        lines(errors, "erros", "erro", "ds_erro"),
    ]
    return reduce(DataFrame.unionByName, parts)
