"""Files in and out, load control, streaming arrival and the whole run.

Each query writes the mapped rows to a new folder in the dialect of the source, then reads them with the library.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.base import query, sql
from quotewell.operators import typed
from quotewell.operators.aggregates import table_counts
from quotewell.plans.warehouse import run_all
from quotewell.seeds import seed_table
from quotewell.session import shared_dir
from quotewell.sources import loading
from quotewell.sources.csv_files import (
    DIVIDENDS,
    FULL_LOAD,
    QUOTES,
    REGISTRY,
    SPLITS,
    read_staging,
    series_source,
    statement_source,
    write_csv,
)
from quotewell.sources.store import Store
from quotewell.streaming.arrivals import load_arrivals

SELIC = series_source("SELIC", "11")


def comma(column):
    return F.translate(F.col(column).cast("string"), ".", ",")


def quote_lines(m):
    return m.bars.select(
        F.concat(F.lit("T"), F.col("id_acao")).alias("ticker"),
        F.date_format("dt_data", "yyyy-MM-dd").alias("date"),
        F.col("vl_abertura").cast("string").alias("open"),
        comma("vl_fechamento").alias("close"),
        F.col("vl_maximo").cast("string").alias("high"),
        comma("vl_minimo").alias("low"),
        F.col("vl_volume").cast("string").alias("volume"),
    )


def series_lines(series):
    return series.select(F.date_format("dt_data", "dd/MM/yyyy").alias("data"), comma("vl_indicador").alias("valor"))


def statement_lines(m):
    """Events as filed accounts: the event type is the account, odd events are last year's column."""
    event = F.col("event_id")
    return m.table("events").select(
        F.lit("00.000.000/0001-00").alias("CNPJ_CIA"),
        F.date_format("ts", "yyyy-MM-dd").alias("DT_REFER"),
        F.lit("1").alias("VERSAO"),
        F.lit("Companhia Ação").alias("DENOM_CIA"),
        F.when(event % 50 == 0, " ").otherwise(F.col("user_id").cast("string")).alias("CD_CVM"),
        F.lit("DF Consolidado").alias("GRUPO_DFP"),
        F.lit("REAL").alias("MOEDA"),
        F.lit("MIL").alias("ESCALA_MOEDA"),
        F.when(event % 2 == 0, "ÚLTIMO").otherwise("PENÚLTIMO").alias("ORDEM_EXERC"),
        F.lit("2024-01-01").alias("DT_INI_EXERC"),
        F.lit("2024-12-31").alias("DT_FIM_EXERC"),
        F.col("event_type").alias("CD_CONTA"),
        F.concat(F.lit("Descrição de "), F.col("event_type")).alias("DS_CONTA"),
        F.col("value").cast("decimal(18,2)").cast("string").alias("VL_CONTA"),
        F.lit("S").alias("ST_CONTA_FIXA"),
    )


# The eight columns of the company registry that are read, among made-up ones up to the 45 of the file.
REGISTRY_HEADER = [*REGISTRY.columns, *[f"OUTRA_{i:02d}" for i in range(45 - len(REGISTRY.columns))]]


def registry_lines(m):
    key = F.col("c_custkey")
    filled = {
        "CNPJ_CIA": F.concat(F.lit("CNPJ "), key),
        "DT_REG": F.lit("2000-07-25"),
        "DT_CONST": F.lit("03/10/1953"),
        "SIT": F.when(key % 4 == 0, "CANCELADA").otherwise("ATIVO"),
        "CD_CVM": F.when(key % 11 == 0, "").otherwise(key.cast("string")),
        "SETOR_ATIV": F.concat(F.lit("Emp. Adm. Part. - "), F.col("c_mktsegment")),
        "DENOM_SOCIAL": F.concat(F.col("c_name"), F.lit(" PARTICIPAÇÕES S.A.")),
        "DENOM_COMERC": F.col("c_name"),
    }
    return m.table("customer").select(*[filled.get(c, F.lit("x")).alias(c) for c in REGISTRY_HEADER])


def dividend_lines(m):
    day = F.date_format("dt_data", "dd/MM/yyyy")
    return m.dividends.select(
        F.concat(F.lit("T"), F.col("id_acao")).alias("ticker"),
        F.col("id_acao").cast("string").alias("cd_cvm"),
        day.alias("dt_aprovacao"),
        comma("vl_dividendo").alias("valor"),
        F.lit("JCP").alias("tipo"),
        day.alias("dt_ex"),
        F.lit("").alias("dt_pagamento"),
    )


def split_lines(m):
    return m.splits.select(
        F.concat(F.lit("T"), F.col("id_acao")).alias("ticker"),
        F.date_format("dt_data", "yyyy-MM-dd").alias("data"),
        F.lit("bonificacao").alias("tipo"),
        F.col("vl_fator").cast("string").alias("fator"),
        F.lit("10% em ações; bônus").alias("descricao"),
    )


def delivered(m, lines, source):
    path = shared_dir(m.spark, source.table)
    write_csv(lines, path, source)
    return path


def typed_file(m, lines, source, typing):
    path = delivered(m, lines, source)
    return typed.passed(typed.apply_typing(read_staging(m.spark, path, source), typing))


@query(
    "src1_quotes_csv",
    sql("bars", """SELECT 'T' || id_acao AS cd_ticker, CAST(dt_data AS VARCHAR) AS dt_data, CAST(vl_abertura AS DOUBLE) AS vl_abertura,
        CAST(vl_fechamento AS DOUBLE) AS vl_fechamento, CAST(vl_maximo AS DOUBLE) AS vl_maximo, CAST(vl_minimo AS DOUBLE) AS vl_minimo, vl_volume FROM bars"""),
)
def src1(m):
    return typed_file(m, quote_lines(m), QUOTES, typed.QUOTES)


@query(
    "src2_series_csv",
    sql("selic", "SELECT 'SELIC' AS cd_indicador, '11' AS cd_serie_bcb, CAST(dt_data AS VARCHAR) AS dt_data, CAST(vl_indicador AS DOUBLE) AS vl_indicador FROM selic WHERE day(dt_data) <> 1"),
)
def src2(m):
    lines = series_lines(m.series(1)).withColumn("data", F.when(~F.col("data").startswith("01/"), F.col("data")).otherwise(" "))
    return typed_file(m, lines, SELIC, typed.SERIES)


@query(
    "src3_statement_csv",
    """SELECT CAST(user_id AS VARCHAR) AS cd_cvm, strftime(ts, '%Y-%m-%d') AS dt_data, event_type AS cd_conta, 'Descrição de ' || event_type AS ds_conta,
       CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS vl_conta, 'DRE' AS ds_tipo_dem, 1 AS nr_versao FROM events WHERE event_id % 2 = 0 AND event_id % 50 <> 0""",
)
def src3(m):
    return typed_file(m, statement_lines(m), statement_source("DRE"), typed.STATEMENTS).drop("ds_escala")


@query(
    "src4_registry_csv",
    """SELECT CAST(c_custkey AS VARCHAR) AS cd_cvm, 'CNPJ ' || c_custkey AS nr_cnpj, c_name || ' PARTICIPAÇÕES S.A.' AS ds_razao_social,
       c_name AS ds_nome_pregao, 'Emp. Adm. Part. - ' || c_mktsegment AS ds_setor_atividade, c_custkey % 4 <> 0 AS fl_ativa,
       '2000-07-25' AS dt_listagem, '1953-10-03' AS dt_constituicao FROM customer WHERE c_custkey % 11 <> 0""",
)
def src4(m):
    return typed_file(m, registry_lines(m), REGISTRY, typed.REGISTRY)


@query(
    "src5_dividends_csv",
    sql("dividends", """SELECT 'T' || id_acao AS cd_ticker, CAST(id_acao AS VARCHAR) AS cd_cvm, CAST(dt_data AS VARCHAR) AS dt_data,
        CAST(vl_dividendo AS DOUBLE) AS vl_dividendo, 'JCP' AS ds_tipo, CAST(dt_data AS VARCHAR) AS dt_ex, CAST(NULL AS VARCHAR) AS dt_pagamento FROM dividends"""),
)
def src5(m):
    return typed_file(m, dividend_lines(m), DIVIDENDS, typed.DIVIDENDS)


@query(
    "src6_splits_csv",
    sql("splits", """SELECT 'T' || id_acao AS cd_ticker, CAST(dt_data AS VARCHAR) AS dt_data, 'BONIFICACAO' AS ds_tipo, CAST(vl_fator AS DOUBLE) AS vl_fator,
        '10% em ações; bônus' AS ds_descricao FROM splits"""),
)
def src6(m):
    return typed_file(m, split_lines(m), SPLITS, typed.SPLITS)


def all_deliveries(m):
    """A folder per stage of the full load; the exchange-rate file is missing."""
    statements = delivered(m, statement_lines(m), statement_source("DRE"))
    paths = {
        "COTACOES": delivered(m, quote_lines(m), QUOTES),
        "CVM_CADASTRO": delivered(m, registry_lines(m), REGISTRY),
        "DIVIDENDOS": delivered(m, dividend_lines(m), DIVIDENDS),
        "DESDOBRAMENTOS": delivered(m, split_lines(m), SPLITS),
        "BCB_CAMBIO": shared_dir(m.spark, "missing"),
    }
    for number, code in [(1, "SELIC"), (2, "IPCA"), (4, "CDI")]:
        paths[f"BCB_{code}"] = delivered(m, series_lines(m.series(number)), SELIC)
    return paths | {f"CVM_DFP_{kind}": statements for kind in ("DRE", "BPA", "BPP")}


FILED = "(SELECT count(*) FROM events WHERE event_id % 2 = 0 AND event_id % 50 <> 0)"


@query(
    "src7_full_extract",
    sql("bars macro splits dividends", f"""SELECT * FROM (VALUES ('COTACOES', 'KAGGLE_COTACAO', (SELECT count(*) FROM bars), 'SUCESSO'),
        ('BCB_SELIC', 'BCB_SELIC', (SELECT count(*) FROM macro WHERE id_indicador = 1), 'SUCESSO'),
        ('BCB_IPCA', 'BCB_IPCA', (SELECT count(*) FROM macro WHERE id_indicador = 2), 'SUCESSO'),
        ('BCB_CAMBIO', 'BCB_CAMBIO', 0, 'ERRO'),
        ('BCB_CDI', 'BCB_CDI', (SELECT count(*) FROM macro WHERE id_indicador = 4), 'SUCESSO'),
        ('CVM_CADASTRO', 'CVM_CADASTRO', (SELECT count(*) FROM customer WHERE c_custkey % 11 <> 0), 'SUCESSO'),
        ('CVM_DFP_DRE', 'CVM_DFP_DRE', {FILED}, 'SUCESSO'), ('CVM_DFP_BPA', 'CVM_DFP_BPA', {FILED}, 'SUCESSO'), ('CVM_DFP_BPP', 'CVM_DFP_BPP', {FILED}, 'SUCESSO'),
        ('DIVIDENDOS', 'DIVIDENDOS', (SELECT count(*) FROM dividends), 'SUCESSO'),
        ('DESDOBRAMENTOS', 'DESDOBRAMENTOS', (SELECT count(*) FROM splits), 'SUCESSO')) AS t(etapa, fonte, registros_carregados, status)"""),
)
def src7(m):
    return loading.full_extract(Store(m.spark, shared_dir(m.spark, "store")), all_deliveries(m), FULL_LOAD)


@query(
    "src8_idempotent_reload",
    sql("macro indicators", """SELECT cd_indicador, CASE id_indicador WHEN 4 THEN 1 ELSE 0 END AS fl_processado, count(*) AS linhas
        FROM macro JOIN indicators USING (id_indicador) GROUP BY 1, 2"""),
)
def src8(m):
    store = Store(m.spark, shared_dir(m.spark, "store"))
    sources = {n: series_source(code, str(n)) for n, code in [(1, "SELIC"), (2, "IPCA"), (3, "CAMBIO"), (4, "CDI"), (5, "OUTRO")]}
    paths = {n: delivered(m, series_lines(m.series(n)), source) for n, source in sources.items()}
    loading.load_source(store, sources[4], paths[4])
    pending = store.read("stg_indicadores_macro").filter("ds_fonte = 'BCB_CDI'")
    store.settle(pending.withColumn("fl_processado", F.lit(1)), "stg_indicadores_macro", "BCB_CDI")
    for n in (1, 2, 3, 1, 5, 1):  # the repeats replace what is still pending of the same series only
        loading.load_source(store, sources[n], paths[n])
    return store.read("stg_indicadores_macro").groupBy("cd_indicador", "fl_processado").agg(F.count("*").alias("linhas"))


@query(
    "src9_append_batch",
    "SELECT o_orderstatus, count(*) AS linhas, count(*) AS com_data, CAST(0 AS BIGINT) AS com_erro, 0 AS fl_processado FROM orders GROUP BY 1",
)
def src9(m):
    store = shared_dir(m.spark, "staging")
    loading.as_batch(m.table("orders").select("o_orderkey", "o_orderstatus")).write.mode("append").parquet(store)
    rows = m.spark.read.parquet(store)
    return rows.groupBy("o_orderstatus", "fl_processado").agg(
        F.count("*").alias("linhas"), F.count("dt_carga").alias("com_data"), F.count("ds_erro").alias("com_erro")
    )


def broken_delivery(m):
    """Order rows as series lines; every 97th lacks its second field."""
    line = F.concat_ws(";", F.date_format("o_orderdate", "dd/MM/yyyy"), F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
    lines = m.table("orders").select(F.when(F.col("o_orderkey") % 97 != 0, line).otherwise("2001-01-01").alias("data;valor"))
    path = shared_dir(m.spark, "broken")
    lines.write.options(header=True, sep="\t", quote="").csv(path)
    return path


def broken_load(m):
    store = Store(m.spark, shared_dir(m.spark, "store"))
    return store, loading.load_source(store, SELIC, broken_delivery(m))


@query(
    "src10_load_control",
    """SELECT 'BCB_SELIC' AS ds_fonte, 'stg_indicadores_macro' AS ds_tabela_destino, 'PARCIAL' AS ds_status, count(*) AS nr_registros_lidos,
       count(*) FILTER (WHERE o_orderkey % 97 <> 0) AS nr_registros_carga, count(*) FILTER (WHERE o_orderkey % 97 = 0) AS nr_registros_erro,
       true AS fechada FROM orders""",
)
def src10(m):
    store, _ = broken_load(m)
    return store.read("etl_controle_carga").select(
        "ds_fonte",
        "ds_tabela_destino",
        "ds_status",
        "nr_registros_lidos",
        "nr_registros_carga",
        "nr_registros_erro",
        (F.col("dt_fim_carga") >= F.col("dt_inicio_carga")).alias("fechada"),
    )


@query(
    "src11_load_metrics",
    """SELECT count(*) AS lidos, count(*) FILTER (WHERE o_orderkey % 97 <> 0) AS carregados, count(*) FILTER (WHERE o_orderkey % 97 = 0) AS com_erro,
       count(*) FILTER (WHERE o_orderkey % 97 <> 0) AS em_staging, count(*) FILTER (WHERE o_orderkey % 97 = 0) AS em_log FROM orders""",
)
def src11(m):
    store, _ = broken_load(m)
    staged = store.read("stg_indicadores_macro").count()
    logged = store.read("etl_log_erros").count()
    return store.read("etl_controle_carga").select(
        F.col("nr_registros_lidos").alias("lidos"),
        F.col("nr_registros_carga").alias("carregados"),
        F.col("nr_registros_erro").alias("com_erro"),
        F.lit(staged).cast("bigint").alias("em_staging"),
        F.lit(logged).cast("bigint").alias("em_log"),
    )


@query(
    "src12_file_checksum",
    """WITH l AS (SELECT o_orderstatus AS s, o_orderkey || ';' || o_custkey AS v FROM orders),
       h AS (SELECT s, sha256(v) AS x FROM l),
       d AS (SELECT s, count(*) AS linhas, sum(CAST(CAST('0x' || substr(x, 1, 16) AS UBIGINT) AS DECIMAL(38,0))) || ':'
             || sum(CAST(CAST('0x' || substr(x, 17, 16) AS UBIGINT) AS DECIMAL(38,0))) || ':' || sum(CAST(CAST('0x' || substr(x, 33, 16) AS UBIGINT) AS DECIMAL(38,0))) || ':'
             || sum(CAST(CAST('0x' || substr(x, 49, 16) AS UBIGINT) AS DECIMAL(38,0))) AS t FROM h GROUP BY s)
       SELECT CASE s WHEN 'F' THEN 'dia2/a' ELSE 'dia2/b' END AS entrega, linhas, sha256(linhas || ':' || t) AS ds_checksum, s = 'P' AS nova
       FROM d WHERE s IN ('F', 'P')""",
)
def src12(m):
    """Day 1 brings states F and O, day 2 brings F again and P."""
    root = shared_dir(m.spark, "deliveries")
    lines = m.table("orders").select("o_orderstatus", F.concat_ws(";", "o_orderkey", "o_custkey").alias("value"))
    for folder, state in [("dia1/a", "F"), ("dia1/b", "O"), ("dia2/a", "F"), ("dia2/b", "P")]:
        lines.filter(F.col("o_orderstatus") == state).select("value").write.text(f"{root}/{folder}")
    first = loading.delivery_digests(m.spark, f"{root}/dia1").withColumn("ds_status", F.lit(loading.DONE))
    second = loading.delivery_digests(m.spark, f"{root}/dia2")
    new = loading.unseen_files(second, first).select("ds_arquivo", F.lit(True).alias("_new"))
    return second.join(new, "ds_arquivo", "left").select(
        F.regexp_extract("ds_arquivo", "(dia2/.)$", 1).alias("entrega"),
        "linhas",
        "ds_checksum",
        F.coalesce("_new", F.lit(False)).alias("nova"),
    )


@query(
    "src13_load_report",
    "SELECT 'BCB_SELIC' AS fonte, count(*) FILTER (WHERE o_orderkey % 97 <> 0) AS registros_carregados, 'PARCIAL' AS status FROM orders",
)
def src13(m):
    return broken_load(m)[1].select("fonte", "registros_carregados", "status")


@query(
    "src14_seeds",
    sql("macro indicators", """SELECT s.cd_indicador, s.ds_unidade, s.cd_serie_bcb, count(m.id_data) AS valores FROM (VALUES ('SELIC', '% ao dia', '11'), ('IPCA', '% ao mês', '433'),
        ('CAMBIO', 'R$/USD', '1'), ('CDI', '% ao dia', '12')) AS s(cd_indicador, ds_unidade, cd_serie_bcb)
        LEFT JOIN indicators i ON i.cd_indicador = s.cd_indicador LEFT JOIN macro m ON m.id_indicador = i.id_indicador GROUP BY 1, 2, 3"""),
)
def src14(m):
    seeds = seed_table(m.spark, "dim_indicador_macro").select("cd_indicador", "ds_unidade", "cd_serie_bcb")
    counts = m.macro.groupBy("id_indicador").agg(F.count("*").alias("valores"))
    named = m.indicators.join(counts, "id_indicador").select("cd_indicador", "valores")
    return seeds.join(named, "cd_indicador", "left").withColumn("valores", F.coalesce("valores", F.lit(0)))


@query(
    "src15_high_water_mark",
    """SELECT count(*) AS linhas, CAST(min(CAST(o_orderdate AS DATE)) AS VARCHAR) AS primeira, CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS nova_marca
       FROM orders WHERE CAST(o_orderdate AS DATE) > DATE '1999-12-31'""",
)
def src15(m):
    """A first load up to 1999 sets the mark, the second takes only what is later and moves it."""
    store = Store(m.spark, shared_dir(m.spark, "store"))
    days = m.table("orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("dt_data"))
    loading.advance_mark(store, "ULTIMA_CARGA_MACRO", m.spark.sql("SELECT DATE '1999-12-31' AS d"), "d")
    late = loading.after_mark(days, "dt_data", loading.read_mark(store, "ULTIMA_CARGA_MACRO"))
    loading.advance_mark(store, "ULTIMA_CARGA_MACRO", late, "dt_data")
    mark = loading.read_mark(store, "ULTIMA_CARGA_MACRO")
    return late.agg(F.count("*").alias("linhas"), F.min("dt_data").alias("primeira")).withColumn("nova_marca", F.lit(mark))


def logged_rejects(m):
    store = Store(m.spark, shared_dir(m.spark, "store"))
    rejects = typed.rejected(typed.apply_typing(m.texts, typed.SERIES)).select("ds_erro", "ds_dados")
    loading.log_errors(
        store, rejects, id_carga=7, ds_etapa="TRANSFORM", ds_fonte="BCB_SELIC", ds_procedure="apply_typing"
    )
    return store


@query(
    "src16_error_log",
    """SELECT ds_erro, CAST(7 AS BIGINT) AS id_carga, 'TRANSFORM' AS ds_etapa, count(*) AS linhas FROM (
         SELECT CASE WHEN o_orderkey % 97 = 0 AND o_orderkey % 89 = 0 THEN 'dt_referencia missing; vl_indicador invalid'
                     WHEN o_orderkey % 97 = 0 THEN 'dt_referencia missing' ELSE 'vl_indicador invalid' END AS ds_erro
         FROM orders WHERE o_orderkey % 97 = 0 OR o_orderkey % 89 = 0) GROUP BY 1""",
)
def src16(m):
    return logged_rejects(m).read("etl_log_erros").groupBy("ds_erro", "id_carga", "ds_etapa").agg(F.count("*").alias("linhas"))


@query(
    "src17_retention",
    sql("states", "SELECT id_carga, fl_processado, count(*) AS linhas FROM states WHERE NOT (fl_processado = 1 AND id_carga <= 3) GROUP BY 1, 2"),
)
def src17(m):
    return loading.retained(m.states, keep=2).groupBy("id_carga", "fl_processado").agg(F.count("*").alias("linhas"))


@query(
    "src18_reprocess_failed",
    """SELECT '2000-01-01' AS dt_data, count(*) AS linhas, CAST(sum(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(18,6))) AS DOUBLE) AS total
       FROM orders WHERE o_orderkey % 97 = 0 AND o_orderkey % 89 <> 0""",
)
def src18(m):
    """Blank dates are repaired, unreadable values fail again."""
    log = logged_rejects(m).read("etl_log_erros")
    rows = loading.failed_rows(log, ["cd_indicador", "dt_referencia", "vl_indicador"], load_id=7)
    fixed = rows.withColumn("dt_referencia", F.when(F.col("dt_referencia") == "", "01/01/2000").otherwise(F.col("dt_referencia")))
    again = typed.passed(typed.apply_typing(fixed, typed.SERIES))
    return again.groupBy("dt_data").agg(F.count("*").alias("linhas"), F.sum("vl_indicador").alias("total"))


@query(
    "st1_available_now",
    sql("selic", "SELECT 'SELIC' AS cd_indicador, CAST(dt_data AS VARCHAR) AS dt_data, CAST(vl_indicador AS DOUBLE) AS vl_indicador FROM selic"),
)
def st1(m):
    """Three deliveries, the third repeating the first; a second run finds nothing new."""
    root = shared_dir(m.spark, "arrivals")
    rows = m.series(1)
    early = F.col("dt_data") < F.lit("1998-01-01").cast("date")
    for name, part in [("a", rows.filter(early)), ("b", rows.filter(~early)), ("c", rows.filter(early))]:
        write_csv(series_lines(part), f"{root}/in/{name}", SELIC)
    for _ in range(2):
        load_arrivals(
            m.spark, f"{root}/in", SELIC, typed.SERIES, f"{root}/out", ["cd_indicador", "dt_data"], f"{root}/checkpoint",
        ).awaitTermination()
    return m.spark.read.parquet(f"{root}/out").drop("nr_ano")


@query(
    "an10_full_run",
    sql("bars selic dividends splits", """SELECT * FROM (VALUES
        ('dim_acao', (SELECT count(*) FROM supplier WHERE s_suppkey % 9 <> 4 AND s_suppkey % 11 <> 0 AND s_suppkey IN (SELECT c_custkey FROM customer))),
        ('dim_empresa', (SELECT count(*) FROM customer WHERE c_custkey % 11 <> 0)),
        ('fato_cotacao', (SELECT count(*) FROM bars WHERE id_acao % 9 <> 4 AND id_acao % 11 <> 0)),
        ('fato_cotacao sem retorno', (SELECT count(DISTINCT id_acao) FROM bars WHERE id_acao % 9 <> 4 AND id_acao % 11 <> 0)),
        ('fato_indicador_macro', (SELECT count(*) FROM selic)),
        ('hist_dividendos', (SELECT count(*) FROM (SELECT DISTINCT id_acao, dt_data, vl_dividendo FROM dividends) WHERE id_acao % 9 <> 4 AND id_acao % 11 <> 0)),
        ('hist_preco_ajustado', (SELECT count(*) FROM bars WHERE id_acao % 9 <> 4 AND id_acao % 11 <> 0)),
        ('etl_log_erros', (SELECT count(*) FROM bars WHERE id_acao % 9 = 4 OR id_acao % 11 = 0) + (SELECT count(*) FROM dividends WHERE id_acao % 9 = 4 OR id_acao % 11 = 0)
          + (SELECT count(*) FROM supplier WHERE s_suppkey % 9 <> 4 AND s_suppkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 11 <> 0)))
        ) AS t(tabela, linhas)"""),
)
def an10(m):
    """Quotes, one series, the registry and dividends from files to the star schema; unknown tickers and companies are logged."""
    store = Store(m.spark, shared_dir(m.spark, "store"))
    paths = {
        "COTACOES": delivered(m, quote_lines(m), QUOTES),
        "BCB_SELIC": delivered(m, series_lines(m.series(1)), SELIC),
        "CVM_CADASTRO": delivered(m, registry_lines(m), REGISTRY),
        "DIVIDENDOS": delivered(m, dividend_lines(m), DIVIDENDS),
    }
    tickers = m.acao.filter("id_acao % 9 <> 4").select(
        "cd_ticker", F.col("id_acao").cast("string").alias("cd_cvm"), "nr_total_acoes"
    )
    run_all(store, paths, tickers, [step for step in FULL_LOAD if step[0] in paths], first="1995-01-01", last="2001-12-31", window=60)
    tables = ["dim_acao", "dim_empresa", "fato_cotacao", "fato_indicador_macro", "hist_dividendos", "hist_preco_ajustado", "etl_log_erros"]
    counts = {t: store.read(t) for t in tables}
    counts["fato_cotacao sem retorno"] = store.read("fato_cotacao").filter("vl_retorno_diario IS NULL")
    return table_counts(counts).withColumnRenamed("registros", "linhas")
