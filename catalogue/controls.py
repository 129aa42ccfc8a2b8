"""Data quality, keys, audit, monitoring views and the validation report."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.base import nullable_counts, query, sql
from catalogue.relational import state_sql, states_of
from quotewell.operators import keys, quality
from quotewell.operators.audit import audit_changes
from quotewell.plans import validation
from quotewell.sources import loading


def untidy_orders(m):
    key = F.col("o_orderkey")
    return m.table("orders").select(
        key,
        F.when(key % 13 != 0, F.col("o_custkey")).alias("o_custkey"),
        F.when(key % 17 == 0, "X").when(key % 19 != 0, F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(key % 23 == 0, -F.col("o_totalprice")).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderpriority",
    )


def violations(*rules: tuple[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS regra, count(*) FILTER (WHERE {bad}) AS violacoes FROM orders" for name, bad in rules)


@query("dq1_required", violations(("o_custkey is required", "o_orderkey % 13 = 0"), ("o_orderstatus is required", "o_orderkey % 19 = 0 AND o_orderkey % 17 <> 0")))
def dq1(m):
    return quality.count_violations(untidy_orders(m), quality.required_rules(["o_custkey", "o_orderstatus"]))


@query("dq2_unique", "SELECT l_orderkey, l_linenumber, count(*) AS linhas FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def dq2(m):
    return quality.duplicate_keys(m.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query("dq3_row_checks", violations(("price not negative", "o_orderkey % 23 = 0 AND o_totalprice > 0"), ("client below 100", "o_orderkey % 13 <> 0 AND o_custkey >= 100")))
def dq3(m):
    rules = {"price not negative": "o_totalprice >= 0", "client below 100": "o_custkey < 100"}
    return quality.count_violations(untidy_orders(m), quality.row_rules(rules))


@query("dq4_allowed_values", violations(("o_orderstatus in list", "o_orderkey % 17 = 0")))
def dq4(m):
    return quality.count_violations(untidy_orders(m), quality.allowed_rules({"o_orderstatus": ["F", "O", "P"]}))


@query(
    "dq5_minimum_volume",
    "SELECT 'lineitem' AS tabela, count(*) AS total_registros, CASE WHEN count(*) >= 200000 THEN 'OK' ELSE '*** ABAIXO DO MINIMO — verificar carga do CSV de cotacoes ***' END AS status FROM lineitem",
)
def dq5(m):
    return quality.minimum_rows(m.table("lineitem"), 200_000, "lineitem")


@query(
    "dq6_width",
    violations(("o_orderpriority at most 8", "length(o_orderpriority) > 8"), ("o_totalprice fits decimal(7,2)", "abs(o_totalprice) >= 99999.995")),
)
def dq6(m):
    rules = quality.width_rules({"o_orderpriority": 8}) | quality.precision_rules({"o_totalprice": "decimal(7,2)"})
    return quality.count_violations(untidy_orders(m), rules)


@query("u1_dense_keys", "SELECT min(k) AS menor, max(k) AS maior, count(*) AS linhas, count(DISTINCT k) AS distintas, CAST(sum(k * (o_orderkey % 1000)) AS DOUBLE) AS conferencia FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS k FROM orders)")
def u1(m):
    numbered = keys.with_dense_keys(m.table("orders").select("o_orderkey"), ["o_orderkey"], "k")
    weighted = F.sum(F.col("k").cast("decimal(20,0)") * (F.col("o_orderkey") % 1000))
    return numbered.agg(
        F.min("k").alias("menor"),
        F.max("k").alias("maior"),
        F.count("*").alias("linhas"),
        F.count_distinct("k").alias("distintas"),
        weighted.cast("double").alias("conferencia"),
    )


@query(
    "u2_audit_diff",
    """WITH old AS (SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_custkey % 10 <> 3),
            new AS (SELECT c_custkey, c_name, CASE WHEN c_custkey % 10 = 1 THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer WHERE c_custkey % 10 <> 2)
       SELECT c_custkey, 'customer' AS ds_tabela, CASE c_custkey % 10 WHEN 1 THEN 'UPDATE' WHEN 2 THEN 'DELETE' ELSE 'INSERT' END AS ds_operacao,
              CASE WHEN o.c_name IS NOT NULL THEN CAST(json_object('c_custkey', c_custkey, 'c_name', o.c_name, 'c_mktsegment', o.c_mktsegment) AS VARCHAR) END AS ds_dados_antes,
              CASE WHEN n.c_name IS NOT NULL THEN CAST(json_object('c_custkey', c_custkey, 'c_name', n.c_name, 'c_mktsegment', n.c_mktsegment) AS VARCHAR) END AS ds_dados_depois
       FROM old o FULL JOIN new n USING (c_custkey) WHERE c_custkey % 10 IN (1, 2, 3)""",
)
def u2(m):
    clients = m.table("customer").select("c_custkey", "c_name", "c_mktsegment")
    before = clients.filter("c_custkey % 10 <> 3")
    changed = F.when(F.col("c_custkey") % 10 != 1, F.col("c_mktsegment"))
    after = clients.filter("c_custkey % 10 <> 2").withColumn("c_mktsegment", changed)
    return audit_changes(before, after, ["c_custkey"], "customer").drop("ds_usuario", "dt_operacao")


@query(
    "an3_load_summary",
    sql("control", """SELECT ds_fonte, ds_tabela_destino, ds_status, nr_registros_carga, nr_registros_erro, strftime(dt_inicio_carga, '%Y-%m-%d %H:%M:%S') AS dt_inicio_carga,
        strftime(dt_fim_carga, '%Y-%m-%d %H:%M:%S') AS dt_fim_carga, CAST(date_diff('second', dt_inicio_carga, dt_fim_carga) AS DOUBLE) AS duracao_segundos
        FROM control ORDER BY control.dt_inicio_carga DESC"""),
)
def an3(m):
    return nullable_counts(loading.load_summary(m.control), "duracao_segundos").orderBy(F.desc("dt_inicio_carga"))


STAGING = ["stg_cotacao", "stg_indicadores_macro", "stg_dem_financeira", "stg_cadastro_empresa", "stg_dividendos", "stg_desdobramento"]


@query("an4_staging_states", sql("states", " UNION ALL ".join(state_sql(t, f"id_carga = {k}") for k, t in enumerate(STAGING, start=1))))
def an4(m):
    return states_of({t: m.states.filter(F.col("id_carga") == k) for k, t in enumerate(STAGING, start=1)})


@query(
    "an5_recent_errors",
    sql("errorlog control", """SELECT e.id_erro, e.ds_etapa, e.ds_fonte, e.ds_procedure, e.ds_erro, strftime(e.dt_erro, '%Y-%m-%d %H:%M:%S') AS dt_erro, c.ds_arquivo
        FROM (SELECT * FROM errorlog ORDER BY dt_erro DESC, id_erro DESC LIMIT 100) e LEFT JOIN control c USING (id_carga)"""),
)
def an5(m):
    return loading.recent_errors(m.errors, m.control)


@query(
    "an6_validation_report",
    sql("bars macro indicators calendar shares statements errorlog", """WITH busy AS (SELECT cd_ticker, count(*) AS n, min(dt_data) AS a, max(dt_data) AS b
            FROM bars JOIN acao USING (id_acao) GROUP BY 1 ORDER BY n DESC, cd_ticker LIMIT 20)
        SELECT 'contagem' AS verificacao, t AS item, CAST(n AS VARCHAR) AS valor FROM (
          SELECT 'dim_setor' AS t, count(*) AS n FROM setor UNION ALL SELECT 'dim_empresa', count(*) FROM empresa UNION ALL SELECT 'dim_acao', count(*) FROM acao
          UNION ALL SELECT 'dim_data', count(*) FROM calendar UNION ALL SELECT 'dim_indicador_macro', count(*) FROM indicators
          UNION ALL SELECT 'fato_cotacao', count(*) FROM bars UNION ALL SELECT 'fato_indicador_macro', count(*) FROM macro
          UNION ALL SELECT 'fato_dem_financeira', count(*) FROM statements)
        UNION ALL SELECT 'volume', 'fato_cotacao', CASE WHEN count(*) >= 200000 THEN 'OK' ELSE '*** ABAIXO DO MINIMO — verificar carga do CSV de cotacoes ***' END FROM bars
        UNION ALL SELECT 'pregoes', cd_ticker, CAST(n AS VARCHAR) FROM busy UNION ALL SELECT 'primeiro pregao', cd_ticker, CAST(a AS VARCHAR) FROM busy
        UNION ALL SELECT 'ultimo pregao', cd_ticker, CAST(b AS VARCHAR) FROM busy
        UNION ALL SELECT 'indicadores', cd_indicador, CAST(count(*) AS VARCHAR) FROM macro JOIN indicators USING (id_indicador) GROUP BY cd_indicador
        UNION ALL SELECT 'primeiro valor', cd_indicador, CAST(min(dt_data) AS VARCHAR) FROM macro JOIN indicators USING (id_indicador) GROUP BY cd_indicador
        UNION ALL SELECT 'ultimo valor', cd_indicador, CAST(max(dt_data) AS VARCHAR) FROM macro JOIN indicators USING (id_indicador) GROUP BY cd_indicador
        UNION ALL SELECT 'acoes por setor', cd_setor, CAST(count(DISTINCT id_acao) AS VARCHAR) FROM setor LEFT JOIN empresa USING (id_setor) LEFT JOIN acao USING (id_empresa) GROUP BY cd_setor
        UNION ALL SELECT 'setores', cd_setor, CAST(count(id_data) AS VARCHAR) FROM setor LEFT JOIN empresa USING (id_setor) LEFT JOIN acao USING (id_empresa) LEFT JOIN bars USING (id_acao) GROUP BY cd_setor
        UNION ALL (SELECT 'erros', CAST(id_erro AS VARCHAR), ds_erro FROM errorlog ORDER BY dt_erro DESC, id_erro DESC LIMIT 20)"""),
)
def an6(m):
    return validation.report(
        {
            "dim_setor": m.setor,
            "dim_empresa": m.empresa,
            "dim_acao": m.acao,
            "dim_data": m.calendar,
            "dim_indicador_macro": m.indicators,
            "fato_cotacao": m.bars,
            "fato_indicador_macro": m.macro,
            "fato_dem_financeira": m.statements,
            "etl_log_erros": m.errors,
        }
    )
