"""Registration of queries and composition of their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from catalogue.roles import Market

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def portable(df: DataFrame) -> DataFrame:
    """Results in types both engines print alike: dates and timestamps as text, decimals as double, doubles to 6 digits."""

    def plain(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            return c.cast("string").alias(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(f.name)
        if isinstance(f.dataType, T.DecimalType):
            return c.cast("double").alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            return F.round(c.cast("double"), 6).alias(f.name)
        return c

    return df.select(*[plain(f) for f in df.schema])


def nullable_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Whole numbers that may be NULL as double, which both engines hand over alike."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def query(key: str, oracle: str | None = None):
    """Register `f(market) -> DataFrame` under `key` with its SQL text."""

    def register(f: Callable[[Market], DataFrame]):
        QUERIES[key] = lambda spark, sf_dir: portable(f(Market(spark, sf_dir)))
        if oracle is not None:
            ORACLES[key] = oracle
        return f

    return register


# Common table expressions of the role mapping: name -> (names it needs, SQL).
CTES: dict[str, tuple[str, str]] = {
    "ticks": (
        "",
        """SELECT l_suppkey AS id_acao, CAST(l_shipdate AS DATE) AS dt_data,
                  CAST(100 + CAST(l_extendedprice AS DECIMAL(18,2)) * 0.001 AS DECIMAL(18,4)) AS p,
                  CAST(l_quantity AS BIGINT) AS q, l_returnflag, l_linenumber,
                  (l_orderkey * 8 + l_linenumber) * 262144 + l_partkey % 262144 AS k
           FROM lineitem""",
    ),
    "bars": (
        "ticks",
        """SELECT id_acao, dt_data, CAST(strftime(dt_data, '%Y%m%d') AS INTEGER) AS id_data,
                  arg_min(p, k) AS vl_abertura, arg_max(p, k) AS vl_fechamento,
                  max(p) AS vl_maximo, min(p) AS vl_minimo, CAST(sum(q) AS BIGINT) AS vl_volume
           FROM ticks GROUP BY id_acao, dt_data""",
    ),
    "quotes": (
        "bars",
        """SELECT * EXCLUDE (c, b), CAST(sign(c - b) * ((2 * abs(c - b) * 1000000 + b) // (2 * b)) / 1000000.0 AS DECIMAL(10,6)) AS vl_retorno_diario,
                  CAST(vl_maximo - vl_minimo AS DECIMAL(18,4)) AS vl_amplitude
           FROM (SELECT *, CAST(vl_fechamento * 10000 AS BIGINT) AS c,
                        CAST(lag(vl_fechamento) OVER (PARTITION BY id_acao ORDER BY dt_data) * 10000 AS BIGINT) AS b FROM bars)""",
    ),
    "macro": (
        "",
        """SELECT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS id_indicador, CAST(o_orderdate AS DATE) AS dt_data,
                  CAST(strftime(CAST(o_orderdate AS DATE), '%Y%m%d') AS INTEGER) AS id_data,
                  CAST((2 * sum(CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT)) + 100 * count(*)) // (200 * count(*))
                       / 1000000.0 AS DECIMAL(18,6)) AS vl_indicador
           FROM orders GROUP BY ALL""",
    ),
    "indicators": (
        "",
        """SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS id_indicador,
                  CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'SELIC' WHEN '2' THEN 'IPCA' WHEN '3' THEN 'CAMBIO'
                       WHEN '4' THEN 'CDI' ELSE 'OUTRO' END AS cd_indicador,
                  o_orderpriority AS ds_indicador
           FROM orders""",
    ),
    "selic": ("macro", "SELECT id_data, dt_data, vl_indicador FROM macro WHERE id_indicador = 1"),
    "setor": ("", "SELECT r_regionkey AS id_setor, r_name AS cd_setor, r_name AS ds_setor FROM region"),
    "empresa": ("", "SELECT n_nationkey AS id_empresa, n_name AS ds_razao_social, n_regionkey AS id_setor FROM nation"),
    "acao": (
        "",
        """SELECT s_suppkey AS id_acao, 'T' || s_suppkey AS cd_ticker, s_nationkey AS id_empresa,
                  1000000 + s_suppkey AS nr_total_acoes, s_suppkey % 10 <> 7 AS fl_ativa,
                  ['NM', 'N2', 'N1', 'MA', 'TRAD'][s_suppkey % 5 + 1] AS cd_segmento
           FROM supplier""",
    ),
    "shares": (
        "acao empresa setor",
        """SELECT a.id_acao, a.cd_ticker, a.fl_ativa, a.cd_segmento, s.cd_setor, s.ds_setor
           FROM acao a JOIN empresa e USING (id_empresa) JOIN setor s USING (id_setor)""",
    ),
    "calendar": (
        "",
        """SELECT CAST(d AS DATE) AS dt_data, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS id_data,
                  CAST(year(d) AS INTEGER) AS nr_ano, CAST(month(d) AS INTEGER) AS nr_mes, CAST(day(d) AS INTEGER) AS nr_dia,
                  CAST(quarter(d) AS INTEGER) AS nr_trimestre, CASE WHEN month(d) <= 6 THEN 1 ELSE 2 END AS nr_semestre,
                  CAST(dayofweek(d) + 1 AS INTEGER) AS nr_dia_semana
           FROM (SELECT unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)) + 120,
                                               INTERVAL 1 DAY)) AS d FROM orders)""",
    ),
    "splits": (
        "ticks",
        """SELECT id_acao, dt_data, CAST(1.1 AS DECIMAL(10,4)) AS vl_fator
           FROM ticks WHERE l_returnflag = 'R' AND l_linenumber = 1""",
    ),
    "dividends": (
        "ticks",
        """SELECT id_acao, dt_data, CAST(CAST(p * 0.0137 AS DECIMAL(18,4)) AS DECIMAL(18,6)) AS vl_dividendo
           FROM ticks WHERE l_returnflag = 'A' AND l_linenumber = 2""",
    ),
    "statements": (
        "",
        """SELECT o_custkey % 25 AS id_empresa, CAST(last_day(CAST(o_orderdate AS DATE)) AS DATE) AS dt_data,
                  CAST(sum(v) AS DECIMAL(20,2)) AS vl_receita_liquida,
                  CAST(sum(CASE WHEN o_orderstatus = 'F' THEN v END) AS DECIMAL(20,2)) AS vl_lucro_liquido,
                  CAST(sum(CASE WHEN o_orderstatus = 'O' THEN v END) AS DECIMAL(20,2)) AS vl_ebitda,
                  CAST(sum(CASE WHEN o_orderstatus = 'P' THEN v END) AS DECIMAL(20,2)) AS vl_divida_bruta,
                  CAST(sum(2 * v) AS DECIMAL(20,2)) AS vl_patrimonio_liq,
                  CAST(sum(3 * v) AS DECIMAL(20,2)) AS vl_ativo_total
           FROM (SELECT *, CAST(o_totalprice AS DECIMAL(18,2)) AS v FROM orders) GROUP BY 1, 2""",
    ),
    "texts": (
        "",
        """SELECT o_orderkey AS id_staging, 'SELIC' AS cd_indicador, '11' AS cd_serie_bcb,
                  CASE WHEN o_orderkey % 97 = 0 THEN '' WHEN o_orderkey % 2 = 1 THEN strftime(o_orderdate, '%d/%m/%Y')
                       ELSE strftime(o_orderdate, '%Y-%m-%d') END AS dt_referencia,
                  CASE WHEN o_orderkey % 89 = 0 THEN 'abc'
                       WHEN o_orderkey % 2 = 1 THEN replace(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR), '.', ',')
                       ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS vl_indicador
           FROM orders""",
    ),
    "states": (
        "",
        """SELECT CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS id_carga,
                  CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 ELSE 2 END AS fl_processado FROM orders""",
    ),
    "control": (
        "",
        """SELECT o_orderkey AS id_carga, 'F' || o_custkey % 7 AS ds_fonte, 'arquivo_' || o_orderkey AS ds_arquivo,
                  'stg_cotacao' AS ds_tabela_destino, o_orderdate AS dt_inicio_carga,
                  CASE WHEN o_orderstatus = 'O' THEN NULL
                       ELSE o_orderdate + to_seconds(CAST(o_custkey % 3600 AS BIGINT)) END AS dt_fim_carga,
                  o_custkey AS nr_registros_carga, o_custkey % 10 AS nr_registros_erro,
                  CASE o_orderstatus WHEN 'F' THEN 'SUCESSO' WHEN 'O' THEN 'EXECUTANDO' ELSE 'ERRO' END AS ds_status
           FROM orders WHERE o_orderkey % 5 <> 0""",
    ),
    "errorlog": (
        "",
        """SELECT (l_orderkey * 8 + l_linenumber) * 262144 + l_partkey % 262144 AS id_erro,
                  CASE WHEN l_linenumber = 1 THEN NULL ELSE l_orderkey END AS id_carga, 'EXTRACT' AS ds_etapa,
                  l_linestatus AS ds_fonte, 'carga' AS ds_procedure, 'erro ' || l_linenumber AS ds_erro,
                  l_shipdate AS dt_erro
           FROM lineitem WHERE l_returnflag = 'R'""",
    ),
}


def mean_sql(x: str, scale: int, digits: int, factor: int = 1) -> str:
    """Mean of a decimal with `scale` digits times `factor`, rounded half away from zero in whole numbers."""
    total = f"(sum(CAST({x} * {10**scale} AS BIGINT)) * {factor})"
    return ratio_sql(total, f"count({x})", scale, digits)


def ratio_sql(total: str, rows: str, scale: int, digits: int) -> str:
    unit = f"(2 * {rows} * {10**scale})"
    return f"CAST(sign({total}) * ((2 * abs({total}) * {10**digits} + {rows} * {10**scale}) // {unit}) AS DOUBLE) / {10**digits}"


def sql(ctes: str, body: str) -> str:
    """`body` preceded by the named expressions and whatever they need."""
    ordered: list[str] = []

    def need(name: str) -> None:
        for dependency in CTES[name][0].split():
            need(dependency)
        if name not in ordered:
            ordered.append(name)

    for name in ctes.split():
        need(name)
    if not ordered:
        return body
    separator = ", " if body.lstrip().upper().startswith("WITH ") else " "
    body = body.lstrip()[5:] if separator == ", " else body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]})" for n in ordered) + separator + body
