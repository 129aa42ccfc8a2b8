"""The stored tables and the monitoring views under their SQL names."""

from __future__ import annotations

from pyspark.sql import functions as F

from quotewell.operators.aggregates import state_summaries
from quotewell.schemas import STAGING_TABLES, TABLES
from quotewell.sources.loading import latest_parameters, load_summary, recent_errors
from quotewell.sources.store import Store


def register_views(store: Store) -> None:
    """Temporary views over a store: each table by its name, and

    - vw_etl_resumo_cargas: loads with duration,
    - vw_etl_staging_pendentes: rows per state of every staging table,
    - vw_etl_erros_recentes: the latest 100 errors with their file,
    - log_erros_etl: the error log in its short form.
    """
    for table in TABLES:
        store.read(table).createOrReplaceTempView(table)
    latest_parameters(store).createOrReplaceTempView("parametros_sistema")
    control, log = store.read("etl_controle_carga"), store.read("etl_log_erros")
    load_summary(control).createOrReplaceTempView("vw_etl_resumo_cargas")
    state_summaries({t: store.read(t) for t in STAGING_TABLES}).createOrReplaceTempView("vw_etl_staging_pendentes")
    recent_errors(log, control).createOrReplaceTempView("vw_etl_erros_recentes")
    log.select("id_erro", "ds_procedure", "ds_erro", "ds_dados", F.col("dt_erro")).createOrReplaceTempView("log_erros_etl")
