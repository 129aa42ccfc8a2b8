"""Projections, filters, joins, aggregates, sorts, unions and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.base import mean_sql, nullable_counts, query, sql
from quotewell.functions import parsing
from quotewell.functions.calendar import between_days, date_key
from quotewell.functions.labels import resilience_class, volume_status
from quotewell.functions.valuation import dividend_yield, ev_ebitda, market_cap, price_earnings, return_on_equity
from quotewell.operators import aggregates, joins, typed
from quotewell.operators.returns import cumulative_returns
from quotewell.plans.market import two_period_returns
from quotewell.plans.validation import (
    busiest_tickers,
    indicator_coverage,
    latest_errors,
    sector_distribution,
    sessions_per_share,
)

# ---- projections and filters ----------------------------------------------------------------------


@query(
    "pf1_project",
    "SELECT o_orderkey AS id_carga, o_custkey AS nr_registros_carga, o_orderstatus AS ds_status FROM orders",
)
def pf1(m):
    names = {"o_orderkey": "id_carga", "o_custkey": "nr_registros_carga", "o_orderstatus": "ds_status"}
    return m.table("orders").select(*[F.col(a).alias(b) for a, b in names.items()])


@query("pf2_literals", "SELECT o_orderkey AS id_carga, 'KAGGLE_COTACAO' AS fonte, 'SUCESSO' AS status FROM orders")
def pf2(m):
    return m.table("orders").select(
        F.col("o_orderkey").alias("id_carga"), F.lit("KAGGLE_COTACAO").alias("fonte"), F.lit("SUCESSO").alias("status")
    )


@query(
    "pf3_not_blank",
    sql("texts", "SELECT id_staging, dt_referencia, vl_indicador FROM texts WHERE dt_referencia IS NOT NULL AND trim(dt_referencia) <> ''"),
)
def pf3(m):
    return m.texts.filter(parsing.is_filled(F.col("dt_referencia"))).select("id_staging", "dt_referencia", "vl_indicador")


@query(
    "pf4_equality",
    """SELECT o_orderkey, o_orderpriority, c_mktsegment FROM orders JOIN customer ON c_custkey = o_custkey
       WHERE o_orderpriority = '1-URGENT' AND lower(c_mktsegment) = 'building'""",
)
def pf4(m):
    wanted = m.table("customer").filter(parsing.same_text(F.col("c_mktsegment"), F.lit("Building")))
    urgent = m.table("orders").filter("o_orderpriority = '1-URGENT'")
    return urgent.join(wanted, urgent.o_custkey == wanted.c_custkey).select("o_orderkey", "o_orderpriority", "c_mktsegment")


@query(
    "pf5_date_between",
    sql("bars", "SELECT id_acao, id_data, CAST(vl_fechamento AS DOUBLE) AS vl_fechamento FROM bars WHERE id_data BETWEEN 19970101 AND 19970630"),
)
def pf5(m):
    return m.bars.filter(between_days(F.col("id_data"), "1997-01-01", "1997-06-30")).select("id_acao", "id_data", "vl_fechamento")


@query(
    "pf6_not_null",
    sql("quotes", "SELECT id_acao, CAST(count(*) AS BIGINT) AS retornos FROM quotes WHERE vl_retorno_diario IS NOT NULL GROUP BY id_acao"),
)
def pf6(m):
    return m.quotes.filter("vl_retorno_diario IS NOT NULL").groupBy("id_acao").agg(F.count("*").alias("retornos"))


@query(
    "pf7_volume_status",
    """SELECT l_returnflag, count(*) AS total_registros,
              CASE WHEN count(*) >= 20000 THEN 'OK' ELSE '*** ABAIXO DO MINIMO — verificar carga do CSV de cotacoes ***' END AS status
       FROM lineitem GROUP BY l_returnflag""",
)
def pf7(m):
    counted = m.table("lineitem").groupBy("l_returnflag").agg(F.count("*").alias("total_registros"))
    return counted.withColumn("status", volume_status(F.col("total_registros"), 20_000))


TWO_RETURNS = """
    SELECT id_acao,
           CAST(product(CASE WHEN id_data BETWEEN 19970101 AND 19971231 THEN 1 + CAST(vl_retorno_diario AS DOUBLE) END) - 1 AS DECIMAL(18,6)) AS ret_base,
           CAST(product(CASE WHEN id_data BETWEEN 19980101 AND 19981231 THEN 1 + CAST(vl_retorno_diario AS DOUBLE) END) - 1 AS DECIMAL(18,6)) AS ret_crise
    FROM quotes GROUP BY id_acao"""

CLASS = """CASE WHEN ret_crise >= 0 THEN 'Alta na crise' WHEN ret_crise > ret_base * 0.8 THEN 'Resiliente' ELSE 'Impactada' END"""

BASE, CRISIS = ("1997-01-01", "1997-12-31"), ("1998-01-01", "1998-12-31")


@query(
    "pf8_resilience_class",
    sql("quotes", f"""WITH r AS ({TWO_RETURNS})
        SELECT id_acao, {CLASS} AS classificacao FROM r WHERE ret_base IS NOT NULL AND ret_crise IS NOT NULL"""),
)
def pf8(m):
    both = two_period_returns(m.quotes, BASE, CRISIS)
    return both.select("id_acao", resilience_class(F.col("ret_base"), F.col("ret_crise")).alias("classificacao"))


PARSED = """
    SELECT *, coalesce(try_strptime(dt_referencia, '%Y-%m-%d'), try_strptime(dt_referencia, '%d/%m/%Y')) AS d,
           TRY_CAST(replace(vl_indicador, ',', '.') AS DECIMAL(18,6)) AS v FROM texts"""


@query(
    "pf9_reject_split",
    sql("texts", f"""WITH t AS ({PARSED}), r AS (
        SELECT 'aceito' AS motivo FROM t WHERE dt_referencia <> '' AND v IS NOT NULL
        UNION ALL SELECT 'dt_referencia missing' FROM t WHERE dt_referencia = ''
        UNION ALL SELECT 'vl_indicador invalid' FROM t WHERE v IS NULL)
        SELECT motivo, count(*) AS linhas FROM r GROUP BY motivo"""),
)
def pf9(m):
    rows = typed.apply_typing(m.texts, typed.SERIES)
    motives = F.when(F.col("ds_erro").isNull(), F.array(F.lit("aceito"))).otherwise(F.split("ds_erro", "; "))
    return rows.select(F.explode(motives).alias("motivo")).groupBy("motivo").agg(F.count("*").alias("linhas"))


# ---- joins ----------------------------------------------------------------------------------------


@query(
    "j1_star4",
    sql("quotes shares calendar", """SELECT cd_setor, nr_ano, count(*) AS pregoes, CAST(sum(vl_volume) AS BIGINT) AS volume
        FROM quotes JOIN acao USING (id_acao) JOIN empresa USING (id_empresa) JOIN setor USING (id_setor)
        JOIN calendar USING (id_data) GROUP BY cd_setor, nr_ano"""),
)
def j1(m):
    star = joins.star_join(
        m.bars.select("id_acao", "id_data", "vl_volume"),
        (m.calendar.select("id_data", "nr_ano"), "id_data"),
        (m.acao.select("id_acao", "id_empresa"), "id_acao"),
        (m.empresa.select("id_empresa", "id_setor"), "id_empresa"),
        (m.setor.select("id_setor", "cd_setor"), "id_setor"),
    )
    return star.groupBy("cd_setor", "nr_ano").agg(F.count("*").alias("pregoes"), F.sum("vl_volume").alias("volume"))


@query(
    "j2_star2",
    sql("macro indicators calendar", f"""SELECT cd_indicador, nr_ano, nr_trimestre, count(*) AS valores,
        {mean_sql("vl_indicador", 6, 6)} AS media
        FROM macro JOIN indicators USING (id_indicador) JOIN calendar USING (id_data)
        GROUP BY cd_indicador, nr_ano, nr_trimestre"""),
)
def j2(m):
    star = joins.star_join(
        m.macro.select("id_indicador", "id_data", "vl_indicador"),
        (m.indicators.select("id_indicador", "cd_indicador"), "id_indicador"),
        (m.calendar.select("id_data", "nr_ano", "nr_trimestre"), "id_data"),
    )
    return star.groupBy("cd_indicador", "nr_ano", "nr_trimestre").agg(
        F.count("*").alias("valores"), F.round(aggregates.exact_mean("vl_indicador"), 6).alias("media")
    )


@query(
    "j3_left_chain",
    sql("bars acao empresa setor", """SELECT s.cd_setor, s.ds_setor, count(DISTINCT a.id_acao) AS total_acoes, count(b.id_data) AS total_cotacoes
        FROM setor s LEFT JOIN (SELECT * FROM empresa WHERE id_setor <> 2) e ON e.id_setor = s.id_setor
        LEFT JOIN (SELECT * FROM acao WHERE id_acao % 7 <> 0) a ON a.id_empresa = e.id_empresa
        LEFT JOIN bars b ON b.id_acao = a.id_acao GROUP BY s.cd_setor, s.ds_setor"""),
)
def j3(m):
    shares = m.acao.filter("id_acao % 7 <> 0")
    return joins.left_chain_counts(m.setor, m.empresa.filter("id_setor <> 2"), shares, sessions_per_share(m.bars))


@query(
    "j4_log_left_control",
    sql("errorlog control", """SELECT e.id_erro, e.ds_erro, strftime(e.dt_erro, '%Y-%m-%d %H:%M:%S') AS dt_erro, c.ds_arquivo
        FROM errorlog e LEFT JOIN control c ON c.id_carga = e.id_carga"""),
)
def j4(m):
    from quotewell.sources.loading import errors_with_file

    return errors_with_file(m.errors, m.control).select("id_erro", "ds_erro", "dt_erro", "ds_arquivo")


@query(
    "j5_composite_join",
    sql("macro", f"""WITH a AS (SELECT CAST(year(dt_data) AS INTEGER) AS nr_ano, CAST(month(dt_data) AS INTEGER) AS nr_mes, {mean_sql("vl_indicador", 6, 6)} AS v
          FROM macro WHERE id_indicador = 1 GROUP BY 1, 2),
        b AS (SELECT CAST(year(dt_data) AS INTEGER) AS nr_ano, CAST(month(dt_data) AS INTEGER) AS nr_mes, {mean_sql("vl_indicador", 6, 6)} AS v
          FROM macro WHERE id_indicador = 2 AND dt_data >= DATE '1997-01-01' GROUP BY 1, 2)
        SELECT a.nr_ano, a.nr_mes, a.v AS selic, b.v AS ipca FROM a JOIN b ON a.nr_ano = b.nr_ano AND a.nr_mes = b.nr_mes"""),
)
def j5(m):
    first = aggregates.monthly_mean(m.series(1), "vl_indicador", "selic")
    later = m.series(2).filter(F.col("dt_data") >= F.lit("1997-01-01").cast("date"))
    both = first.join(aggregates.monthly_mean(later, "vl_indicador", "ipca"), ["nr_ano", "nr_mes"])
    return both.select("nr_ano", "nr_mes", F.round("selic", 6).alias("selic"), F.round("ipca", 6).alias("ipca"))


@query(
    "j6_two_period_join",
    sql("quotes acao", f"""WITH r AS ({TWO_RETURNS}),
        a AS (SELECT id_acao, ret_base FROM r), b AS (SELECT id_acao, ret_crise FROM r)
        SELECT cd_ticker, CAST(ret_base AS DOUBLE) AS ret_base, CAST(ret_crise AS DOUBLE) AS ret_crise
        FROM a JOIN b USING (id_acao) JOIN acao USING (id_acao) WHERE ret_base IS NOT NULL AND ret_crise IS NOT NULL"""),
)
def j6(m):
    both = two_period_returns(m.quotes, BASE, CRISIS)
    return both.join(m.acao.select("id_acao", "cd_ticker"), "id_acao").select("cd_ticker", "ret_base", "ret_crise")


@query(
    "j7_key_lookup",
    """SELECT known, CAST(count(*) AS BIGINT) AS linhas, CAST(count(DISTINCT cd_ticker) AS BIGINT) AS tickers FROM (
        SELECT 'T' || l_suppkey AS cd_ticker, s_suppkey IS NOT NULL AS known FROM lineitem
        LEFT JOIN (SELECT * FROM supplier WHERE s_suppkey % 9 <> 4) ON s_suppkey = l_suppkey) GROUP BY known""",
)
def j7(m):
    quoted = m.table("lineitem").select(F.concat(F.lit("T"), F.col("l_suppkey")).alias("cd_ticker"))
    found = joins.lookup_key(quoted, m.acao.filter("id_acao % 9 <> 4"), "cd_ticker", "id_acao")
    return found.groupBy(F.col("id_acao").isNotNull().alias("known")).agg(
        F.count("*").alias("linhas"), F.count_distinct("cd_ticker").alias("tickers")
    )


@query(
    "j8_fk_violations",
    "SELECT o_custkey, count(*) AS linhas FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 7 <> 0) GROUP BY o_custkey",
)
def j8(m):
    return joins.orphan_keys(m.table("orders"), "o_custkey", m.table("customer").filter("c_custkey % 7 <> 0"), "c_custkey")


PERIODS = [("P1", "1996-01-01", "1996-12-31"), ("P2", "1996-07-01", "1997-06-30"), ("P3", "1999-03-15", "1999-03-20")]
PERIODS_SQL = "(VALUES " + ", ".join(f"('{n}', DATE '{a}', DATE '{b}')" for n, a, b in PERIODS) + ") AS p(ds_crise, dt_inicio, dt_fim)"


def periods(m):
    rows = m.spark.createDataFrame(PERIODS, "ds_crise string, a string, b string")
    return rows.select("ds_crise", F.col("a").cast("date").alias("dt_inicio"), F.col("b").cast("date").alias("dt_fim"))


@query(
    "j9_period_tag",
    f"""SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS dt_data, ds_crise
        FROM orders LEFT JOIN {PERIODS_SQL} ON CAST(o_orderdate AS DATE) BETWEEN dt_inicio AND dt_fim""",
)
def j9(m):
    days = m.table("orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("dt_data"))
    return joins.tag_periods(days, periods(m), "dt_data", ["ds_crise"])


@query(
    "j10_asof_statement",
    sql("bars", """WITH s AS (SELECT o_custkey % (SELECT count(*) FROM supplier) AS id_acao, CAST(o_orderdate AS DATE) AS dt_data,
             CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(20,2)) AS vl_total
             FROM orders GROUP BY 1, 2)
        SELECT b.id_acao, b.id_data, CAST(s.vl_total AS DOUBLE) AS vl_total
        FROM bars b ASOF LEFT JOIN s ON b.id_acao = s.id_acao AND b.dt_data >= s.dt_data"""),
)
def j10(m):
    shares = m.acao.count()
    filed = (
        m.table("orders")
        .groupBy((F.col("o_custkey") % shares).alias("id_acao"), F.col("o_orderdate").cast("date").alias("dt_data"))
        .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(20,2)").alias("vl_total"))
    )
    days = m.bars.select("id_acao", "dt_data", "id_data")
    return joins.asof_latest(days, filed, "id_acao", "dt_data", ["vl_total"]).drop("dt_data")


@query(
    "j11_monthly_to_daily",
    sql("macro", f"""WITH mth AS (SELECT id_indicador, date_trunc('month', dt_data) AS mm, {mean_sql("vl_indicador", 6, 6)} AS valor FROM macro GROUP BY 1, 2)
        SELECT id_indicador, CAST(CAST(d AS DATE) AS VARCHAR) AS dt_data, valor
        FROM (SELECT id_indicador, valor, unnest(generate_series(mm, last_day(mm), INTERVAL 1 DAY)) AS d FROM mth)"""),
)
def j11(m):
    monthly = m.macro.groupBy("id_indicador", F.last_day("dt_data").alias("dt_data")).agg(
        F.round(aggregates.exact_mean("vl_indicador"), 6).alias("valor")
    )
    return joins.expand_monthly(monthly, "dt_data")


@query(
    "j12_insert_if_absent",
    sql("macro", "SELECT id_indicador, id_data, CAST(vl_indicador AS DOUBLE) AS vl_indicador FROM macro"),
)
def j12(m):
    keys = ["id_indicador", "id_data"]
    rows = m.macro.select(*keys, "vl_indicador")
    target = rows.filter("id_data <= 19980630")
    late = rows.filter("id_data > 19980101")
    batch = late.unionByName(late.withColumn("vl_indicador", F.col("vl_indicador") + 1))  # each key twice, the true value first
    new = joins.insert_if_absent(target, batch, keys, [F.col("vl_indicador")])
    return target.unionByName(new.select(*target.columns))


@query(
    "j13_scd1_upsert",
    """WITH old AS (SELECT c_custkey, c_name, c_mktsegment, c_nationkey FROM customer WHERE c_custkey % 10 <> 3),
            new AS (SELECT c_custkey, c_name, CASE c_custkey % 10 WHEN 1 THEN 'MUDOU' WHEN 5 THEN NULL ELSE c_mktsegment END AS c_mktsegment
                    FROM customer WHERE c_custkey % 10 IN (1, 3, 5))
       SELECT c_custkey, coalesce(n.c_name, o.c_name) AS c_name, coalesce(n.c_mktsegment, o.c_mktsegment) AS c_mktsegment,
              CAST(o.c_nationkey AS DOUBLE) AS c_nationkey,
              CASE WHEN o.c_custkey IS NULL THEN '2024-02-01' ELSE '2024-01-01' END || ' 00:00:00' AS dt_criacao,
              CASE WHEN c_custkey % 10 IN (1, 3) THEN '2024-02-01' ELSE '2024-01-01' END || ' 00:00:00' AS dt_atualizacao
       FROM old o FULL JOIN new n USING (c_custkey)""",
)
def j13(m):
    """Every fifth arrives without its segment and keeps the known one; the nation is no attribute of the batch and stays."""
    clients = m.table("customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    start, now = [F.lit(d).cast("timestamp") for d in ("2024-01-01", "2024-02-01")]
    current = clients.filter("c_custkey % 10 <> 3").withColumns({"dt_criacao": start, "dt_atualizacao": start})
    batch = clients.filter("c_custkey % 10 IN (1, 3, 5)").withColumn(
        "c_mktsegment", F.when(F.col("c_custkey") % 10 == 1, "MUDOU").when(F.col("c_custkey") % 10 == 3, F.col("c_mktsegment"))
    )
    merged = joins.scd1_upsert(current, batch, "c_custkey", ["c_name", "c_mktsegment"], now)
    return nullable_counts(merged, "c_nationkey")


@query(
    "j14_parent_delete_guard",
    """SELECT c_custkey, c_custkey NOT IN (SELECT o_custkey FROM orders) AS permitido
       FROM (SELECT 2 * c_custkey AS c_custkey FROM customer)""",
)
def j14(m):
    deletes = m.table("customer").select((2 * F.col("c_custkey")).alias("c_custkey"))  # half of them never ordered
    return joins.guard_deletes(deletes, m.table("orders"), "c_custkey", "o_custkey")


# ---- aggregates -----------------------------------------------------------------------------------

COUNTED = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@query("ag1_table_counts", " UNION ALL ".join(f"SELECT '{t}' AS tabela, count(*) AS registros FROM {t}" for t in COUNTED))
def ag1(m):
    return aggregates.table_counts({t: m.table(t) for t in COUNTED})


@query(
    "ag2_ticker_coverage",
    sql("bars acao", """SELECT cd_ticker, count(*) AS pregoes, CAST(min(dt_data) AS VARCHAR) AS primeiro_pregao, CAST(max(dt_data) AS VARCHAR) AS ultimo_pregao
        FROM bars JOIN acao USING (id_acao) GROUP BY cd_ticker"""),
)
def ag2(m):
    seen = aggregates.coverage(m.bars, "id_acao", "dt_data", "pregoes", "primeiro_pregao", "ultimo_pregao")
    return seen.join(m.acao.select("id_acao", "cd_ticker"), "id_acao").drop("id_acao")


@query(
    "ag3_indicator_coverage",
    sql("macro indicators", """SELECT cd_indicador, ds_indicador, count(*) AS total_registros, CAST(min(dt_data) AS VARCHAR) AS data_mais_antiga,
        CAST(max(dt_data) AS VARCHAR) AS data_mais_recente FROM macro JOIN indicators USING (id_indicador) GROUP BY 1, 2"""),
)
def ag3(m):
    return indicator_coverage(m.macro, m.indicators)


@query(
    "ag4_distinct_and_nonnull",
    sql("bars acao empresa setor", """SELECT cd_setor, ds_setor, count(DISTINCT a.id_acao) AS total_acoes, count(b.id_data) AS total_cotacoes
        FROM setor LEFT JOIN empresa e USING (id_setor) LEFT JOIN acao a USING (id_empresa)
        LEFT JOIN bars b ON b.id_acao = a.id_acao GROUP BY 1, 2"""),
)
def ag4(m):
    return sector_distribution(sessions_per_share(m.bars), m.acao, m.empresa, m.setor)


@query(
    "ag5_monthly_return_x21",
    sql("quotes", f"""SELECT CAST(year(dt_data) AS INTEGER) AS nr_ano, CAST(month(dt_data) AS INTEGER) AS nr_mes,
        {mean_sql("vl_retorno_diario", 6, 6, 21)} AS retorno_mensal_medio
        FROM quotes WHERE vl_retorno_diario IS NOT NULL GROUP BY 1, 2"""),
)
def ag5(m):
    out = aggregates.monthly_mean(m.quotes, "vl_retorno_diario", "retorno_mensal_medio", factor=21)
    return out.withColumn("retorno_mensal_medio", F.round("retorno_mensal_medio", 6))


@query(
    "ag6_monthly_macro_mean",
    sql("selic", f"""SELECT CAST(year(dt_data) AS INTEGER) AS nr_ano, CAST(month(dt_data) AS INTEGER) AS nr_mes,
        {mean_sql("vl_indicador", 6, 6)} AS selic_media_mensal FROM selic GROUP BY 1, 2"""),
)
def ag6(m):
    out = aggregates.monthly_mean(m.series(1), "vl_indicador", "selic_media_mensal")
    return out.withColumn("selic_media_mensal", F.round("selic_media_mensal", 6))


def state_sql(table: str, where: str = "true") -> str:
    sums = ", ".join(
        f"CAST(sum(CASE WHEN fl_processado = {k} THEN 1 ELSE 0 END) AS DOUBLE) AS {n}"
        for k, n in enumerate(["pendentes", "processados", "com_erro"])
    )
    return f"SELECT '{table}' AS tabela, count(*) AS total, {sums} FROM states WHERE {where}"


def states_of(tables):
    return nullable_counts(aggregates.state_summaries(tables), "pendentes", "processados", "com_erro")


@query("ag7_state_counts", sql("states", state_sql("stg_cotacao") + " UNION ALL " + state_sql("stg_vazia", "id_carga > 9")))
def ag7(m):
    return states_of({"stg_cotacao": m.states, "stg_vazia": m.states.filter("id_carga > 9")})


@query(
    "ag8_cumulative_return",
    sql("quotes", """SELECT id_acao, CAST(CAST(product(1 + CAST(vl_retorno_diario AS DOUBLE)) - 1 AS DECIMAL(18,6)) AS DOUBLE) AS retorno
        FROM quotes WHERE id_data BETWEEN 19960101 AND 19961231 GROUP BY id_acao"""),
)
def ag8(m):
    return cumulative_returns(m.quotes, {"retorno": ("1996-01-01", "1996-12-31")})


ACCOUNTS = {"vl_receita_liquida": ["purchase", "click"], "vl_lucro_liquido": ["purchase"], "vl_divida_bruta": ["error"]}


@query(
    "ag9_account_pivot",
    """WITH e AS (SELECT user_id AS cd_cvm, CAST(ts AS DATE) AS d, event_type, CAST(value AS DECIMAL(18,2)) AS v FROM events WHERE event_type IN ('purchase', 'click', 'error'))
       SELECT cd_cvm, CAST(d AS VARCHAR) AS dt_data,
              CAST(sum(CASE WHEN event_type IN ('purchase', 'click') THEN v END) AS DOUBLE) AS vl_receita_liquida,
              CAST(sum(CASE WHEN event_type = 'purchase' THEN v END) AS DOUBLE) AS vl_lucro_liquido,
              CAST(sum(CASE WHEN event_type = 'error' THEN v END) AS DOUBLE) AS vl_divida_bruta
       FROM e GROUP BY cd_cvm, d""",
)
def ag9(m):
    rows = m.table("events").select(
        F.col("user_id").alias("cd_cvm"),
        F.col("ts").cast("date").alias("dt_data"),
        F.col("event_type").alias("cd_conta"),
        F.col("value").cast("decimal(18,2)").alias("vl_conta"),
    )
    return aggregates.pivot_measures(rows, ["cd_cvm", "dt_data"], "cd_conta", "vl_conta", ACCOUNTS, "decimal(20,2)")


@query(
    "ag10_calendar_grain",
    sql("macro calendar", f"""SELECT nr_ano, nr_semestre, nr_trimestre, count(vl_indicador) AS linhas, CAST(sum(vl_indicador) AS DOUBLE) AS soma,
        {mean_sql("vl_indicador", 6, 6)} AS media,
        CAST(min(vl_indicador) AS DOUBLE) AS minimo, CAST(max(vl_indicador) AS DOUBLE) AS maximo
        FROM macro JOIN calendar USING (id_data) GROUP BY 1, 2, 3"""),
)
def ag10(m):
    out = aggregates.by_grain(m.macro, m.calendar, ["nr_ano", "nr_semestre", "nr_trimestre"], "vl_indicador")
    return out.withColumn("media", F.round("media", 6))


# ---- sorts and unions -----------------------------------------------------------------------------


@query(
    "sl1_top20",
    sql("bars acao", """SELECT cd_ticker, count(*) AS pregoes, CAST(min(dt_data) AS VARCHAR) AS primeiro_pregao, CAST(max(dt_data) AS VARCHAR) AS ultimo_pregao
        FROM bars JOIN acao USING (id_acao) GROUP BY cd_ticker ORDER BY pregoes DESC, cd_ticker LIMIT 20"""),
)
def sl1(m):
    return busiest_tickers(sessions_per_share(m.bars), m.acao)


LATEST = """SELECT id_erro, CAST(id_carga AS DOUBLE) AS id_carga, ds_etapa, ds_fonte, ds_procedure, ds_erro, strftime(dt_erro, '%Y-%m-%d %H:%M:%S') AS dt_erro
            FROM (SELECT * FROM errorlog ORDER BY dt_erro DESC, id_erro DESC LIMIT {n})"""


@query("sl2_latest20", sql("errorlog", LATEST.format(n=20)))
def sl2(m):
    return nullable_counts(latest_errors(m.errors), "id_carga")


@query("sl3_latest100", sql("errorlog", LATEST.format(n=100)))
def sl3(m):
    return nullable_counts(latest_errors(m.errors, 100), "id_carga")


@query(
    "sl4_multi_key_sort",
    sql("macro", """SELECT CAST(year(dt_data) AS INTEGER) AS nr_ano, CAST(month(dt_data) AS INTEGER) AS nr_mes, id_indicador, count(*) AS valores
        FROM macro GROUP BY 1, 2, 3 ORDER BY 1, 2, 3"""),
)
def sl4(m):
    counts = m.macro.groupBy(F.year("dt_data").alias("nr_ano"), F.month("dt_data").alias("nr_mes"), "id_indicador")
    return counts.agg(F.count("*").alias("valores")).orderBy("nr_ano", "nr_mes", "id_indicador")


@query(
    "sl5_desc_alias",
    sql("quotes acao", f"""WITH r AS ({TWO_RETURNS})
        SELECT cd_ticker, CAST(round((ret_crise - ret_base) * 100, 2) AS DOUBLE) AS variacao FROM r JOIN acao USING (id_acao)
        WHERE ret_crise IS NOT NULL AND ret_base IS NOT NULL ORDER BY variacao DESC"""),
)
def sl5(m):
    change = F.round((F.col("ret_crise") - F.col("ret_base")) * 100, 2).alias("variacao")
    both = two_period_returns(m.quotes, BASE, CRISIS).join(m.acao.select("id_acao", "cd_ticker"), "id_acao")
    return both.select("cd_ticker", change).orderBy(F.desc("variacao"), "cd_ticker")


@query("so1_union_counts", " UNION ALL ".join(f"SELECT '{t}' AS tabela, count(*) AS registros FROM {t}" for t in COUNTED) + " ORDER BY tabela")
def so1(m):
    return aggregates.table_counts({t: m.table(t) for t in COUNTED}).orderBy("tabela")


@query("so2_union_states", sql("states", " UNION ALL ".join(state_sql(f"stg_{k}", f"id_carga = {k}") for k in range(1, 7))))
def so2(m):
    return states_of({f"stg_{k}": m.states.filter(F.col("id_carga") == k) for k in range(1, 7)})


# ---- scalar functions -----------------------------------------------------------------------------


@query("sc1_trim", "SELECT p_partkey, trim('  ' || p_name || ' ') AS nome, trim(p_brand) AS marca FROM part")
def sc1(m):
    padded = F.concat(F.lit("  "), F.col("p_name"), F.lit(" "))
    return m.table("part").select("p_partkey", F.trim(padded).alias("nome"), F.trim("p_brand").alias("marca"))


@query(
    "sc2_concat",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE concat('BCB_', o_orderpriority) END AS fonte FROM orders",
)
def sc2(m):
    code = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    return m.table("orders").select("o_orderkey", parsing.source_label("BCB_", code).alias("fonte"))


@query(
    "sc3_round",
    "SELECT o_orderkey, CAST(round(CAST(o_totalprice AS DECIMAL(18,2)), 1) AS DOUBLE) AS um, CAST(round(CAST(o_totalprice AS DECIMAL(18,2)) * 0.125, 2) AS DOUBLE) AS dois FROM orders",
)
def sc3(m):
    price = F.col("o_totalprice").cast("decimal(18,2)")
    return m.table("orders").select("o_orderkey", F.round(price, 1).alias("um"), F.round(price * F.expr("0.125"), 2).alias("dois"))


@query(
    "sc4_arithmetic",
    sql("quotes", """SELECT id_acao, id_data, round(CAST(vl_retorno_diario AS DOUBLE) * 21 * 100, 6) AS mensal_pct,
        CAST(vl_retorno_diario * 0.8 AS DOUBLE) AS parte, CAST(vl_maximo - vl_minimo AS DOUBLE) AS amplitude FROM quotes"""),
)
def sc4(m):
    r = F.col("vl_retorno_diario")
    return m.quotes.select(
        "id_acao",
        "id_data",
        (r.cast("double") * 21 * 100).alias("mensal_pct"),
        (r * F.expr("0.8")).alias("parte"),
        (F.col("vl_maximo") - F.col("vl_minimo")).alias("amplitude"),
    )


@query("sc5_seconds_between", sql("control", "SELECT id_carga, CAST(date_diff('second', dt_inicio_carga, dt_fim_carga) AS DOUBLE) AS duracao_segundos FROM control"))
def sc5(m):
    seconds = parsing.duration_seconds(F.col("dt_inicio_carga"), F.col("dt_fim_carga")).alias("duracao_segundos")
    return nullable_counts(m.control.select("id_carga", seconds), "duracao_segundos")


@query("sc6_now", "SELECT o_orderkey AS id_staging, '2024-01-15 08:30:00' AS dt_carga, 0 AS fl_processado FROM orders")
def sc6(m):
    from quotewell.sources.loading import as_batch

    keyed = as_batch(m.table("orders").select("o_orderkey"), now=F.lit("2024-01-15 08:30:00").cast("timestamp"))
    return keyed.select(F.col("o_orderkey").alias("id_staging"), "dt_carga", "fl_processado")


@query("sc7_date_key", "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS id_data FROM orders")
def sc7(m):
    return m.table("orders").select("o_orderkey", date_key(F.col("o_orderdate").cast("date")).alias("id_data"))


@query(
    "sc8_date_parse",
    sql("texts", f"SELECT id_staging, CAST(CAST(d AS DATE) AS VARCHAR) AS dt_data FROM ({PARSED})"),
)
def sc8(m):
    return m.texts.select("id_staging", parsing.parse_date(F.col("dt_referencia")).alias("dt_data"))


@query(
    "sc9_number_parse",
    sql("texts", """SELECT id_staging, CAST(TRY_CAST(replace(vl_indicador, ',', '.') AS DECIMAL(18,4)) AS DOUBLE) AS decimal_lido,
        CAST(TRY_CAST(replace(replace(vl_indicador, ',', ''), '.', '') AS BIGINT) AS DOUBLE) AS inteiro_lido FROM texts"""),
)
def sc9(m):
    text = F.col("vl_indicador")
    read = m.texts.select(
        "id_staging", parsing.parse_decimal(text).alias("decimal_lido"), parsing.parse_integer(text).alias("inteiro_lido")
    )
    return nullable_counts(read, "inteiro_lido")


# Fixed values repeated for the SQL side.
WEEKDAYS_SQL = "['Domingo','Segunda-feira','Terça-feira','Quarta-feira','Quinta-feira','Sexta-feira','Sábado']"
MONTHS_SQL = "['Janeiro','Fevereiro','Março','Abril','Maio','Junho','Julho','Agosto','Setembro','Outubro','Novembro','Dezembro']"


@query(
    "sc10_calendar",
    sql("calendar", f"""SELECT id_data, CAST(dt_data AS VARCHAR) AS dt_data, nr_ano, nr_mes, nr_dia, nr_trimestre, nr_semestre,
        {WEEKDAYS_SQL}[nr_dia_semana] AS ds_dia_semana, nr_dia_semana, false AS fl_feriado,
        nr_dia_semana BETWEEN 2 AND 6 AS fl_dia_util, {MONTHS_SQL}[nr_mes] AS ds_mes FROM calendar"""),
)
def sc10(m):
    return m.calendar


@query(
    "sc11_type_from_suffix",
    """SELECT o_orderkey, CASE WHEN CAST(o_orderkey AS VARCHAR) LIKE '%11' THEN 'UNIT' WHEN o_orderkey % 2 = 1 THEN 'ON' ELSE 'PN' END AS cd_tipo
       FROM orders""",
)
def sc11(m):
    ticker = F.concat(F.lit("TICK"), F.col("o_orderkey"))
    return m.table("orders").select("o_orderkey", parsing.share_type(ticker).alias("cd_tipo"))


@query(
    "sc12_row_json",
    """SELECT o_orderkey, CAST(json_object('o_orderkey', o_orderkey, 'o_custkey', CASE WHEN o_custkey % 3 <> 0 THEN o_custkey END,
       'o_orderstatus', o_orderstatus) AS VARCHAR) AS ds_dados FROM orders""",
)
def sc12(m):
    rows = m.table("orders").withColumn("o_custkey", F.when(F.col("o_custkey") % 3 != 0, F.col("o_custkey")))
    return rows.select("o_orderkey", parsing.row_json("o_orderkey", "o_custkey", "o_orderstatus").alias("ds_dados"))


@query(
    "sc13_valuation",
    sql("statements", """SELECT id_empresa, CAST(dt_data AS VARCHAR) AS dt_data,
        CAST(TRY_CAST(1000 * vl_receita_liquida / nullif(CAST(vl_lucro_liquido AS DOUBLE), 0) AS DECIMAL(10,4)) AS DOUBLE) AS vl_pl,
        CAST(TRY_CAST(CAST(vl_lucro_liquido AS DOUBLE) / nullif(CAST(vl_patrimonio_liq AS DOUBLE), 0) AS DECIMAL(10,6)) AS DOUBLE) AS vl_roe,
        CAST(TRY_CAST(CAST(vl_lucro_liquido AS DOUBLE) / nullif(CAST(vl_receita_liquida AS DOUBLE), 0) AS DECIMAL(10,6)) AS DOUBLE) AS vl_dy,
        CAST(TRY_CAST(CAST(1000 * vl_receita_liquida + coalesce(vl_divida_bruta, 0) AS DOUBLE) / nullif(CAST(vl_ebitda AS DOUBLE), 0) AS DECIMAL(10,4)) AS DOUBLE) AS vl_ev_ebitda,
        CAST(1000 * vl_receita_liquida AS DOUBLE) AS vl_market_cap
        FROM statements"""),
)
def sc13(m):
    cap = market_cap(F.lit(1000), F.col("vl_receita_liquida"))
    profit = F.col("vl_lucro_liquido")
    return m.statements.select(
        "id_empresa",
        "dt_data",
        price_earnings(cap, profit).alias("vl_pl"),
        return_on_equity(profit, F.col("vl_patrimonio_liq")).alias("vl_roe"),
        dividend_yield(profit, F.col("vl_receita_liquida")).alias("vl_dy"),
        ev_ebitda(cap, F.col("vl_divida_bruta"), F.col("vl_ebitda")).alias("vl_ev_ebitda"),
        cap.alias("vl_market_cap"),
    )


@query("sc14_active_flag", "SELECT o_orderkey, o_orderstatus = 'F' AS fl_ativa FROM orders")
def sc14(m):
    situation = F.when(F.col("o_orderstatus") == "F", " Ativa").when(F.col("o_orderstatus") == "O", "CANCELADA")
    return m.table("orders").select("o_orderkey", parsing.is_active(situation).alias("fl_ativa"))


@query(
    "sc15_scale",
    """SELECT o_orderkey, CAST(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) * 1000 ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS DOUBLE) AS vl_reais,
              CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS vl_informado FROM orders""",
)
def sc15(m):
    value = F.col("o_totalprice").cast("decimal(18,2)")
    scale = F.when(F.col("o_orderstatus") == "F", "MIL").otherwise("UNIDADE")
    return m.table("orders").select(
        "o_orderkey",
        parsing.whole_currency(value, scale).alias("vl_reais"),
        parsing.whole_currency(value, scale, enabled=False).alias("vl_informado"),
    )
