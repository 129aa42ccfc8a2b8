"""Returns, risk, corporate actions, procedures and market questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.base import mean_sql, query, ratio_sql, sql
from catalogue.relational import BASE, CLASS, CRISIS, PERIODS_SQL, TWO_RETURNS, periods
from quotewell.operators import corporate, fundamentals, joins, returns
from quotewell.plans import market

# ---- windows --------------------------------------------------------------------------------------


@query("wn1_daily_return", sql("quotes", "SELECT id_acao, id_data, CAST(vl_retorno_diario AS DOUBLE) AS vl_retorno_diario FROM quotes"))
def wn1(m):
    return returns.with_daily_return(m.bars).select("id_acao", "id_data", "vl_retorno_diario")


@query("wn2_amplitude", sql("quotes", "SELECT id_acao, id_data, CAST(vl_amplitude AS DOUBLE) AS vl_amplitude FROM quotes"))
def wn2(m):
    return returns.with_amplitude(m.bars).select("id_acao", "id_data", "vl_amplitude")


RISK = """SELECT id_acao, id_data, dt_data, vl_fechamento, vl_retorno_diario,
    CASE WHEN count(r) OVER w >= {n} THEN CAST(stddev_samp(r) OVER w * sqrt(252) AS DECIMAL(10,6)) END AS vl_volatilidade,
    CASE WHEN count(x) OVER w >= {n} AND count(r) OVER w >= {n} THEN CAST(avg(x) OVER w * 252 / nullif(stddev_samp(r) OVER w * sqrt(252), 0) AS DECIMAL(10,6)) END AS vl_sharpe
    FROM (SELECT q.*, CAST(q.vl_retorno_diario AS DOUBLE) AS r, CAST(q.vl_retorno_diario AS DOUBLE) - CAST(s.vl_indicador AS DOUBLE) / 100 AS x
          FROM quotes q LEFT JOIN selic s USING (id_data))
    WINDOW w AS (PARTITION BY id_acao ORDER BY id_data ROWS BETWEEN {b} PRECEDING AND CURRENT ROW)"""

RISK_252 = RISK.format(n=200, b=251)  # some days lack a rate, so 200 of 252 must be known


def risk(m, window=252, need=200):
    rate = m.series(1).select("id_data", F.col("vl_indicador").alias("vl_taxa"))
    rows = m.quotes.select("id_acao", "id_data", "vl_fechamento", "vl_retorno_diario").join(rate, "id_data", "left")
    return returns.with_rolling_risk(rows, window=window, min_returns=need, rate="vl_taxa")


@query(
    "wn3_rolling_volatility",
    sql("bars", """SELECT id_acao, id_data, CAST(CASE WHEN count(r) OVER w >= 5 THEN CAST(stddev_samp(r) OVER w * sqrt(252) AS DECIMAL(10,6)) END AS DOUBLE) AS vl_volatilidade
        FROM (SELECT user_id AS id_acao, id_data, CAST(CAST(c / lag(c) OVER (PARTITION BY user_id ORDER BY id_data) - 1 AS DECIMAL(10,6)) AS DOUBLE) AS r
              FROM (SELECT user_id, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS id_data, 100 + max(value) AS c FROM events GROUP BY 1, 2))
        WINDOW w AS (PARTITION BY id_acao ORDER BY id_data ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"""),
)
def wn3(m):
    days = m.table("events").groupBy(
        F.col("user_id").alias("id_acao"), F.date_format("ts", "yyyyMMdd").cast("int").alias("id_data")
    )
    bars = days.agg((100 + F.max("value")).alias("vl_fechamento"))
    return returns.with_rolling_risk(returns.with_daily_return(bars), window=5).select("id_acao", "id_data", "vl_volatilidade")


@query(
    "wn4_sharpe",
    sql("quotes selic", f"""SELECT id_acao, id_data, CAST(vl_volatilidade AS DOUBLE) AS vl_volatilidade, CAST(vl_sharpe AS DOUBLE) AS vl_sharpe
        FROM ({RISK_252})"""),
)
def wn4(m):
    return risk(m).select("id_acao", "id_data", "vl_volatilidade", "vl_sharpe")


# The SQL side joins every quote with its events: a plain, independent statement of the rule.
SPLIT_FACTOR = """SELECT b.id_acao, b.id_data, coalesce(product(CAST(s.vl_fator AS DOUBLE)), 1) AS f
    FROM bars b LEFT JOIN splits s ON s.id_acao = b.id_acao AND s.dt_data > b.dt_data GROUP BY 1, 2"""

KEPT = """SELECT d.id_acao, d.dt_data, (CAST(b.vl_fechamento AS DOUBLE) - CAST(d.v AS DOUBLE)) / CAST(b.vl_fechamento AS DOUBLE) AS g
    FROM (SELECT id_acao, dt_data, sum(vl_dividendo) AS v FROM dividends GROUP BY 1, 2) d JOIN bars b USING (id_acao, dt_data)"""

DIVIDEND_FACTOR = f"""SELECT b.id_acao, b.id_data, coalesce(product(k.g), 1) AS g
    FROM bars b LEFT JOIN ({KEPT}) k ON k.id_acao = b.id_acao AND k.dt_data >= b.dt_data GROUP BY 1, 2"""

ADJUSTED = f"""SELECT id_acao, id_data, dt_data, vl_retorno_diario, CAST(vl_fechamento AS DOUBLE) * round(g / f, 12) AS a, round(g / f, 12) AS h
    FROM quotes JOIN ({SPLIT_FACTOR}) USING (id_acao, id_data) JOIN ({DIVIDEND_FACTOR}) USING (id_acao, id_data)"""

ADJUSTED_RETURN = f"""SELECT id_acao, id_data, CAST(CAST(a AS DECIMAL(28,10)) AS DECIMAL(18,4)) AS vl_fechamento_aj,
    CASE WHEN h = lag(h) OVER w THEN vl_retorno_diario ELSE CAST(CAST(a / lag(a) OVER w - 1 AS DECIMAL(22,12)) AS DECIMAL(10,6)) END AS vl_retorno_aj
    FROM ({ADJUSTED}) WINDOW w AS (PARTITION BY id_acao ORDER BY id_data)"""


@query(
    "wn5_split_adjust",
    sql("bars splits", f"""SELECT id_acao, id_data, CAST(CAST(CAST(vl_fechamento AS DOUBLE) / f AS DECIMAL(18,4)) AS DOUBLE) AS vl_ajustado
        FROM bars JOIN ({SPLIT_FACTOR}) USING (id_acao, id_data)"""),
)
def wn5(m):
    rows = corporate.with_adjustment(m.bars.select("id_acao", "id_data", "vl_fechamento"), splits=m.splits)
    price = F.col("vl_fechamento").cast("double") * F.col("fator_ajuste")
    return rows.select("id_acao", "id_data", price.cast("decimal(18,4)").alias("vl_ajustado"))


@query(
    "wn6_dividend_adjust",
    sql("bars dividends", f"""SELECT id_acao, id_data, CAST(CAST(CAST(vl_fechamento AS DOUBLE) * g AS DECIMAL(18,4)) AS DOUBLE) AS vl_ajustado
        FROM bars JOIN ({DIVIDEND_FACTOR}) USING (id_acao, id_data)"""),
)
def wn6(m):
    rows = corporate.with_adjustment(m.bars.select("id_acao", "id_data", "vl_fechamento"), dividends=m.dividends)
    price = F.col("vl_fechamento").cast("double") * F.col("fator_ajuste")
    return rows.select("id_acao", "id_data", price.cast("decimal(18,4)").alias("vl_ajustado"))


def adjusted(m):
    return corporate.adjusted_prices(m.bars.select("id_acao", "id_data", "vl_fechamento"), m.splits, m.dividends)


@query(
    "wn7_adjusted_return",
    sql("quotes splits dividends", f"SELECT id_acao, id_data, CAST(vl_retorno_aj AS DOUBLE) AS vl_retorno_aj FROM ({ADJUSTED_RETURN})"),
)
def wn7(m):
    return adjusted(m).select("id_acao", "id_data", "vl_retorno_aj")


TRAILING = """SELECT b.id_acao, b.id_data, CAST(coalesce(sum(d.vl_dividendo), 0) AS DECIMAL(18,6)) AS vl_dividendos_12m
    FROM bars b LEFT JOIN dividends d ON d.id_acao = b.id_acao AND d.dt_data BETWEEN b.dt_data - 364 AND b.dt_data GROUP BY 1, 2"""


@query(
    "wn8_trailing_dividends",
    sql("bars dividends", f"SELECT id_acao, id_data, CAST(vl_dividendos_12m AS DOUBLE) AS vl_dividendos_12m FROM ({TRAILING})"),
)
def wn8(m):
    quotes = m.bars.select("id_acao", "id_data")
    return corporate.with_trailing_dividends(quotes, m.dividends)


LINES = """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY {keys}
    ORDER BY {order}) AS n FROM lineitem) WHERE n = 1"""


@query("wn9_last_version", LINES.format(keys="l_orderkey", order="l_linenumber DESC, l_partkey, l_extendedprice"))
def wn9(m):
    lines = m.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return fundamentals.latest_versions(lines, ["l_orderkey"], "l_linenumber", F.col("l_partkey"), F.col("l_extendedprice"))


@query("wn10_dedup", LINES.format(keys="l_orderkey, l_linenumber", order="l_partkey, l_extendedprice"))
def wn10(m):
    lines = m.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return joins.keep_first(lines, ["l_orderkey", "l_linenumber"], [F.col("l_partkey"), F.col("l_extendedprice")])


MONTHLY_RATE = """SELECT CAST(year(dt_data) AS INTEGER) AS nr_ano, CAST(month(dt_data) AS INTEGER) AS nr_mes,
    sum(CAST(vl_indicador * 1000000 AS BIGINT)) AS s, count(*) AS n FROM selic GROUP BY 1, 2"""


@query(
    "wn11_rate_rise_months",
    sql("selic", f"""SELECT nr_ano, nr_mes, {ratio_sql("s", "n", 6, 6)} AS media, {ratio_sql("ps", "pn", 6, 6)} AS anterior
        FROM (SELECT *, lag(s) OVER (ORDER BY nr_ano, nr_mes) AS ps, lag(n) OVER (ORDER BY nr_ano, nr_mes) AS pn FROM ({MONTHLY_RATE})) WHERE s * pn > ps * n"""),
)
def wn11(m):
    out = market.rising_rate_months(m.macro, m.indicators)
    return out.select("nr_ano", "nr_mes", F.round("media", 6).alias("media"), F.round("anterior", 6).alias("anterior"))


# ---- procedures -----------------------------------------------------------------------------------

RATE_SQL = sql(
    "quotes shares selic",
    f"""WITH r AS (SELECT CAST(year(dt_data) AS INTEGER) AS nr_ano, CAST(month(dt_data) AS INTEGER) AS nr_mes, sum(CAST(vl_retorno_diario * 1000000 AS BIGINT)) * 2100 AS rs, count(*) AS rn
         FROM quotes JOIN shares USING (id_acao) WHERE cd_setor = 'EUROPE' AND dt_data BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'
         AND vl_retorno_diario IS NOT NULL GROUP BY 1, 2),
       s AS (SELECT CAST(year(dt_data) AS INTEGER) AS nr_ano, CAST(month(dt_data) AS INTEGER) AS nr_mes, sum(CAST(vl_indicador * 1000000 AS BIGINT)) AS ss, count(*) AS sn
         FROM selic WHERE dt_data BETWEEN DATE '1996-01-01' AND DATE '2000-12-31' GROUP BY 1, 2)
       SELECT nr_ano, nr_mes, {ratio_sql("rs", "rn", 6, 4)} AS retorno_acoes_pct, {ratio_sql("ss", "sn", 6, 4)} AS selic_pct,
              {ratio_sql("(rs * sn - ss * rn)", "(rn * sn)", 6, 4)} AS diferenca
       FROM r JOIN s USING (nr_ano, nr_mes) ORDER BY nr_ano, nr_mes""",
)


@query("an1_rate_vs_sector_return", RATE_SQL)
def an1(m):
    quotes = m.quotes_of(joins.share_dimensions(m.acao, m.empresa, m.setor, [], keep=F.col("s.cd_setor") == "EUROPE"))
    out = market.rate_against_sector(
        quotes, m.acao, m.empresa, m.setor, m.macro, m.indicators, "1996-01-01", "2000-12-31", sector="EUROPE"
    )
    return out.orderBy("nr_ano", "nr_mes")


RESILIENCE = f"""SELECT cd_ticker, ds_setor, CAST(round(ret_base * 100, 2) AS DOUBLE) AS retorno_1997_pct,
    CAST(round(ret_crise * 100, 2) AS DOUBLE) AS retorno_1998_pct, CAST(round((ret_crise - ret_base) * 100, 2) AS DOUBLE) AS variacao,
    {CLASS} AS classificacao FROM ({TWO_RETURNS}) JOIN shares USING (id_acao)
    WHERE fl_ativa AND ret_base IS NOT NULL AND ret_crise IS NOT NULL"""


def resilience(m):
    return market.resilience(m.quotes, m.acao, m.empresa, m.setor, BASE, CRISIS)


@query("an2_resilience", sql("quotes shares", RESILIENCE + " ORDER BY variacao DESC, cd_ticker"))
def an2(m):
    return resilience(m).orderBy(F.desc("variacao"), "cd_ticker")


@query(
    "ag14_sector_resilience",
    sql("quotes shares", f"SELECT ds_setor, classificacao, count(*) AS acoes, {mean_sql('CAST(variacao AS DECIMAL(18,2))', 2, 4)} AS variacao_media FROM ({RESILIENCE}) GROUP BY 1, 2"),
)
def ag14(m):
    return market.sector_resilience(resilience(m))


@query(
    "an7_return_function",
    sql("quotes acao", """SELECT cd_ticker, round(product(1 + CAST(vl_retorno_diario AS DOUBLE)) - 1, 6) AS retorno
        FROM acao LEFT JOIN (SELECT * FROM quotes WHERE dt_data BETWEEN DATE '1997-01-01' AND DATE '1998-12-31') USING (id_acao) GROUP BY 1"""),
)
def an7(m):
    named = m.quotes.join(m.acao.select("id_acao", "cd_ticker"), "id_acao")
    named.select("cd_ticker", "dt_data", "vl_retorno_diario").createOrReplaceTempView("cotacao_por_ticker")
    m.acao.createOrReplaceTempView("dim_acao")
    market.register_return_function(m.spark, "cotacao_por_ticker")
    return m.spark.sql(
        "SELECT cd_ticker, fn_retorno_acumulado(cd_ticker, DATE '1997-01-01', DATE '1998-12-31') AS retorno FROM dim_acao"
    )


@query(
    "ag15_total_return",
    sql("quotes splits dividends", f"""SELECT id_acao, CAST(CAST(product(1 + CAST(vl_retorno_aj AS DOUBLE)) - 1 AS DECIMAL(18,6)) AS DOUBLE) AS retorno_total
        FROM ({ADJUSTED_RETURN}) WHERE id_data BETWEEN 19970101 AND 19981231 GROUP BY id_acao"""),
)
def ag15(m):
    return returns.cumulative_returns(adjusted(m), {"retorno_total": ("1997-01-01", "1998-12-31")}, returns="vl_retorno_aj")


# ---- questions ------------------------------------------------------------------------------------

LIQUIDITY = """SELECT cd_setor, count(*) AS acoes, avg(v) AS volume_medio, avg(s) AS volatilidade_media, corr(v, s) AS correlacao
    FROM (SELECT id_acao, avg(CAST(vl_volume AS DOUBLE)) AS v, stddev_samp(CAST(vl_retorno_diario AS DOUBLE)) AS s FROM quotes GROUP BY 1)
    JOIN shares USING (id_acao) GROUP BY 1"""


def shares_by_sector(m):
    return joins.share_dimensions(m.acao, m.empresa, m.setor, ["s.cd_setor"])


@query(
    "ag11_volume_vs_volatility",
    sql("quotes shares", f"""SELECT cd_setor, acoes, round(volume_medio, 6) AS volume_medio, round(volatilidade_media, 6) AS volatilidade_media, round(correlacao, 6) AS correlacao FROM ({LIQUIDITY})"""),
)
def ag11(m):
    return market.volume_against_volatility(m.quotes, shares_by_sector(m))


@query(
    "ag11_sector_correlation",
    sql("quotes shares", f"SELECT round(corr(volume_medio, volatilidade_media), 6) AS correlacao_setores FROM ({LIQUIDITY})"),
)
def ag11b(m):
    return market.correlation_across_sectors(market.volume_against_volatility(m.quotes, shares_by_sector(m)))


@query(
    "ag12_fx_sensitivity",
    sql("quotes macro shares", """SELECT id_acao, count(*) AS pregoes, round(corr(r, r_fx), 6) AS correlacao,
        round(avg(CASE WHEN r_fx > 0 THEN CASE WHEN r > 0 THEN 1.0 ELSE 0.0 END END), 6) AS altas_com_cambio
        FROM (SELECT id_acao, id_data, CAST(vl_retorno_diario AS DOUBLE) AS r FROM quotes WHERE vl_retorno_diario IS NOT NULL)
        JOIN (SELECT id_data, CAST(vl_indicador AS DOUBLE) / lag(CAST(vl_indicador AS DOUBLE)) OVER (ORDER BY id_data) - 1 AS r_fx FROM macro WHERE id_indicador = 3) USING (id_data)
        JOIN (SELECT id_acao FROM shares WHERE cd_setor = 'AMERICA') USING (id_acao) WHERE r_fx IS NOT NULL GROUP BY 1"""),
)
def ag12(m):
    exporters = joins.share_dimensions(m.acao, m.empresa, m.setor, [], keep=F.col("s.cd_setor") == "AMERICA")
    return market.exchange_sensitivity(m.quotes_of(exporters), exporters, m.series(3))


@query(
    "ag13_sharpe_by_segment",
    sql("quotes selic acao", f"""SELECT cd_segmento, count(DISTINCT id_acao) AS acoes, round(avg(CAST(vl_retorno_diario AS DOUBLE)), 6) AS retorno_medio,
        round(avg(CAST(vl_volatilidade AS DOUBLE)), 6) AS volatilidade_media, round(avg(CAST(vl_sharpe AS DOUBLE)), 6) AS sharpe_medio
        FROM ({RISK_252}) JOIN acao USING (id_acao) GROUP BY 1"""),
)
def ag13(m):
    return market.sharpe_by_segment(risk(m), m.acao)


PHASES = f"""SELECT ds_crise, 'antes' AS fase, dt_inicio - CAST(dt_fim - dt_inicio + 1 AS INTEGER) AS a, dt_inicio - 1 AS b FROM {PERIODS_SQL}
    UNION ALL SELECT ds_crise, 'durante', dt_inicio, dt_fim FROM {PERIODS_SQL}
    UNION ALL SELECT ds_crise, 'depois', dt_fim + 1, dt_fim + CAST(dt_fim - dt_inicio + 1 AS INTEGER) FROM {PERIODS_SQL}"""


@query(
    "an11_crisis_phases",
    sql("quotes", f"""SELECT id_acao, ds_crise, fase, count(*) AS pregoes, round(product(1 + r) - 1, 6) AS retorno, round(stddev_samp(r), 6) AS volatilidade
        FROM (SELECT id_acao, dt_data, CAST(vl_retorno_diario AS DOUBLE) AS r FROM quotes WHERE vl_retorno_diario IS NOT NULL)
        JOIN ({PHASES}) ON dt_data BETWEEN a AND b GROUP BY 1, 2, 3"""),
)
def an11(m):
    return market.crisis_study(m.quotes, periods(m))


# ---- derived tables -------------------------------------------------------------------------------


@query(
    "an8_indicator_fact",
    sql("quotes selic statements dividends acao", f"""WITH k AS ({RISK.format(n=40, b=59)}),
        e AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY id_acao, date_trunc('month', dt_data) ORDER BY dt_data DESC) = 1),
        t AS ({TRAILING}),
        x AS (SELECT e.*, a.nr_total_acoes, a.id_empresa, t.vl_dividendos_12m, CAST(a.nr_total_acoes * e.vl_fechamento AS DECIMAL(20,2)) AS cap
              FROM e JOIN acao a USING (id_acao) JOIN t USING (id_acao, id_data)),
        y AS (SELECT x.*, s.* EXCLUDE (id_empresa, dt_data) FROM x ASOF LEFT JOIN statements s ON x.id_empresa = s.id_empresa AND x.dt_data >= s.dt_data)
        SELECT id_acao, id_data, CAST(TRY_CAST(CAST(cap AS DOUBLE) / nullif(CAST(vl_lucro_liquido AS DOUBLE), 0) AS DECIMAL(10,4)) AS DOUBLE) AS vl_pl,
          CAST(TRY_CAST(CAST(vl_lucro_liquido AS DOUBLE) / nullif(CAST(vl_patrimonio_liq AS DOUBLE), 0) AS DECIMAL(10,6)) AS DOUBLE) AS vl_roe,
          CAST(TRY_CAST(CAST(vl_dividendos_12m AS DOUBLE) / nullif(CAST(vl_fechamento AS DOUBLE), 0) AS DECIMAL(10,6)) AS DOUBLE) AS vl_dy,
          CAST(TRY_CAST(CAST(cap + coalesce(vl_divida_bruta, 0) AS DOUBLE) / nullif(CAST(vl_ebitda AS DOUBLE), 0) AS DECIMAL(10,4)) AS DOUBLE) AS vl_ev_ebitda,
          CAST(vl_sharpe AS DOUBLE) AS vl_sharpe, CAST(vl_volatilidade AS DOUBLE) AS vl_volatilidade, CAST(cap AS DOUBLE) AS vl_market_cap FROM y"""),
)
def an8(m):
    rate = m.series(1).select("id_data", F.col("vl_indicador").alias("vl_taxa"))
    return fundamentals.indicator_fact(
        m.quotes.select("id_acao", "id_data", "vl_fechamento", "vl_retorno_diario"),
        m.acao.select("id_acao", "id_empresa", "nr_total_acoes"),
        m.statements,
        m.dividends,
        rate,
        window=60,
        min_returns=40,
    )


@query(
    "an9_adjusted_price_fact",
    sql("quotes splits dividends", f"SELECT id_acao, id_data, CAST(vl_fechamento_aj AS DOUBLE) AS vl_fechamento_aj, CAST(vl_retorno_aj AS DOUBLE) AS vl_retorno_aj FROM ({ADJUSTED_RETURN})"),
)
def an9(m):
    return adjusted(m)
