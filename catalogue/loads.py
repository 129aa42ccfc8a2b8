"""The store over several deliveries: late quotes, restated statements, derived facts kept up to date, keys, logs, quarantine.

The stores here hold the mapped rows under their own keys, so that results compare with the plain SQL over all rows at once.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.base import nullable_counts, query, sql
from catalogue.files import (
    DIVIDENDS,
    FULL_LOAD,
    QUOTES,
    REGISTRY,
    SELIC,
    SPLITS,
    delivered,
    dividend_lines,
    quote_lines,
    registry_lines,
    series_lines,
    split_lines,
)
from catalogue.market import ADJUSTED_RETURN, PHASES, RISK, TRAILING, periods
from quotewell.operators import fundamentals, returns
from quotewell.operators.aggregates import table_counts
from quotewell.plans import derived, market, warehouse
from quotewell.session import shared_dir, stored
from quotewell.sources import loading
from quotewell.sources.csv_files import statement_source, write_csv
from quotewell.sources.store import Store
from quotewell.streaming import quotes as stream

EARLY = "id_data < 19970701"
WITHHELD = "(id_acao * 31 + id_data) % 11 = 0"


def new_store(m):
    """A store whose dimensions hold the mapped shares under their own keys."""
    store = Store(m.spark, shared_dir(m.spark, "store"))
    warehouse.create_tables(store, "1992-01-01", "1998-12-31")
    store.append(m.acao, "dim_acao")
    return store


def once(m):
    """The mapped quotes, computed once for all the deliveries that are cut from them."""
    return stored(m.bars, "bars")


def quote_rows(m):
    bars = once(m).withColumn("cd_ticker", F.concat(F.lit("T"), F.col("id_acao"))).drop("id_acao")
    return bars.withColumn("id_staging", F.monotonically_increasing_id())


def parts(rows, late):
    """First and second delivery; `late` rows of the first period come with the second."""
    first = F.expr(f"{EARLY} AND NOT ({late})")
    return [rows.filter(first), rows.filter(~first)]


def load_two_deliveries(m):
    """Quotes, rates, statements and events in two deliveries, the second with a tenth of the first period's quotes; derived after each."""
    store = new_store(m)
    ticker = F.concat(F.lit("T"), F.col("id_acao")).alias("cd_ticker")
    quotes = once(m).select("*", ticker).withColumn("id_staging", F.monotonically_increasing_id())
    rates = m.series(1).select(F.lit("SELIC").alias("cd_indicador"), "dt_data", "vl_indicador", "id_data", F.lit(0).alias("id_staging"))
    statements = m.statements.withColumn("ds_tipo_dem", F.lit("ANUAL"))
    # Each event is one of its own, as repeated ones would be taken once.
    name = F.concat(F.lit("evento "), F.col("k"))
    events = m.ticks.select("id_acao", ticker, "dt_data", F.date_format("dt_data", "yyyyMMdd").cast("int").alias("id_data"), "p", "l_returnflag", "l_linenumber", name.alias("nome"), F.col("k").alias("id_staging"))
    amount = ((F.col("p").cast("decimal(14,0)") * F.expr("0.0001")).cast("decimal(18,4)") * F.expr("0.0137")).cast("decimal(18,4)").cast("decimal(18,6)")
    dividends = events.filter("l_returnflag = 'A' AND l_linenumber = 2").withColumns(
        {"vl_dividendo": amount, "ds_tipo": F.col("nome"), "dt_ex": F.col("dt_data"), "dt_pagamento": F.lit(None).cast("date")}
    )
    splits = events.filter("l_returnflag = 'R' AND l_linenumber = 1").withColumns(
        {"ds_tipo": F.lit("BONIFICACAO"), "vl_fator": F.lit("1.1").cast("decimal(10,4)"), "ds_descricao": F.col("nome")}
    )
    never = "false"
    for quote, rate, filed, paid, split in zip(parts(quotes, WITHHELD), *[parts(x, never) for x in (rates, statements, dividends, splits)]):
        warehouse.load_quotes(store, quote.drop("id_acao", "id_data"))
        warehouse.load_series(store, rate.drop("id_data"), "SELIC")
        store.append(filed, "fato_dem_financeira")
        first = filed.groupBy("id_empresa").agg(F.min("id_data").alias("id_de")).join(store.read("dim_acao"), "id_empresa")
        derived.note_changes(store, first.select("id_acao", "id_de"), [derived.INDICATORS], "demonstracao")
        warehouse.load_events(store, paid.drop("id_acao", "id_data"), "hist_dividendos", ["vl_dividendo", "ds_tipo", "dt_ex", "dt_pagamento"])
        warehouse.load_events(store, split.drop("id_acao", "id_data"), "hist_desdobramento", ["ds_tipo", "vl_fator", "ds_descricao"])
        derived.derive_adjusted(store)
        derived.derive_indicators(store, window=60, min_returns=40)
    return store


@query(
    "an9_second_delivery",
    sql("quotes splits dividends", f"SELECT id_acao, id_data, CAST(vl_fechamento_aj AS DOUBLE) AS vl_fechamento_aj, CAST(vl_retorno_aj AS DOUBLE) AS vl_retorno_aj FROM ({ADJUSTED_RETURN})"),
)
def an9_second(m):
    return load_two_deliveries(m).read("hist_preco_ajustado").select("id_acao", "id_data", "vl_fechamento_aj", "vl_retorno_aj")


@query(
    "an8_second_delivery",
    sql("quotes selic statements dividends acao", f"""WITH k AS ({RISK.format(n=40, b=59)}),
        e AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY id_acao, date_trunc('month', dt_data) ORDER BY dt_data DESC) = 1),
        t AS ({TRAILING}),
        x AS (SELECT e.*, a.nr_total_acoes, a.id_empresa, t.vl_dividendos_12m, CAST(a.nr_total_acoes * e.vl_fechamento AS DECIMAL(20,2)) AS cap
              FROM e JOIN acao a USING (id_acao) JOIN t USING (id_acao, id_data)),
        y AS (SELECT x.*, s.* EXCLUDE (id_empresa, dt_data) FROM x ASOF LEFT JOIN statements s ON x.id_empresa = s.id_empresa AND x.dt_data >= s.dt_data)
        SELECT id_acao, id_data, CAST(TRY_CAST(CAST(cap AS DOUBLE) / nullif(CAST(vl_lucro_liquido AS DOUBLE), 0) AS DECIMAL(10,4)) AS DOUBLE) AS vl_pl,
          CAST(TRY_CAST(CAST(vl_dividendos_12m AS DOUBLE) / nullif(CAST(vl_fechamento AS DOUBLE), 0) AS DECIMAL(10,6)) AS DOUBLE) AS vl_dy,
          CAST(vl_sharpe AS DOUBLE) AS vl_sharpe, CAST(vl_volatilidade AS DOUBLE) AS vl_volatilidade, CAST(cap AS DOUBLE) AS vl_market_cap FROM y"""),
)
def an8_second(m):
    return load_two_deliveries(m).read("fato_indicadores").select("id_acao", "id_data", "vl_pl", "vl_dy", "vl_sharpe", "vl_volatilidade", "vl_market_cap")


@query(
    "wn1_late_quotes",
    sql("quotes", """SELECT id_acao, id_data, CAST(vl_fechamento AS DOUBLE) AS vl_fechamento, CAST(vl_retorno_diario AS DOUBLE) AS vl_retorno_diario,
        CAST(vl_amplitude AS DOUBLE) AS vl_amplitude FROM quotes"""),
)
def wn1_late(m):
    """Three deliveries of any days; the third repeats part of the first with other prices, which change nothing."""
    store = new_store(m)
    rows, place = quote_rows(m), F.pmod(F.xxhash64("cd_ticker", "id_data"), F.lit(3))
    again = rows.filter((place == 0) & (F.col("id_data") % 5 == 0)).withColumn("vl_fechamento", F.col("vl_minimo"))
    for k in range(3):
        part = rows.filter(place == k)
        warehouse.load_quotes(store, (part.unionByName(again) if k == 2 else part).drop("id_data"))
    return store.read("fato_cotacao").select("id_acao", "id_data", "vl_fechamento", "vl_retorno_diario", "vl_amplitude")


def drop_files(m, folder):
    """Three files' worth of quotes, dealt at random over them."""
    place = F.pmod(F.xxhash64("ticker", "date"), F.lit(3))
    for k in range(3):
        write_csv(quote_lines(m).filter(place == k), f"{folder}/{k}", QUOTES)


@query("st1_quotes_stream", sql("quotes", "SELECT id_acao, id_data, CAST(vl_fechamento AS DOUBLE) AS vl_fechamento, CAST(vl_retorno_diario AS DOUBLE) AS vl_retorno_diario FROM quotes"))
def st1_quotes(m):
    """Files of shuffled days arrive one after the other; each run takes the new ones."""
    store, root = new_store(m), shared_dir(m.spark, "arrivals")
    lines, place = stored(quote_lines(m), "lines"), F.pmod(F.xxhash64("ticker", "date"), F.lit(3))
    for k in range(3):
        write_csv(lines.filter(place == k), f"{root}/in/{k}", QUOTES)
        stream.stream_quotes(store, f"{root}/in", f"{root}/checkpoint").awaitTermination()
    return store.read("fato_cotacao").select("id_acao", "id_data", "vl_fechamento", "vl_retorno_diario")


@query("st1_stateful_returns", sql("quotes", "SELECT id_acao, id_data, CAST(vl_fechamento AS DOUBLE) AS vl_fechamento, CAST(vl_retorno_diario AS DOUBLE) AS vl_retorno_diario FROM quotes"))
def st1_stateful(m):
    """The same days as a stream of rows whose state holds each share's closes."""
    root = shared_dir(m.spark, "arrivals")
    rows = once(m).select("id_acao", "id_data", "vl_fechamento")
    place = F.pmod(F.xxhash64("id_acao", "id_data"), F.lit(3))
    for k in range(3):
        rows.filter(place == k).write.mode("append").parquet(f"{root}/in/{k}")
        arriving = m.spark.readStream.schema(rows.schema).option("recursiveFileLookup", True).parquet(f"{root}/in")
        stream.write_changes(stream.stateful_returns(arriving), f"{root}/out", f"{root}/checkpoint").awaitTermination()
    last = stream.latest_changes(m.spark.read.parquet(f"{root}/out"), ["id_acao", "id_data"])
    return last.select("id_acao", "id_data", "vl_fechamento", "vl_retorno_diario")


WINDOWS = """SELECT o_orderkey AS pedido, CAST(o_orderkey % 10 + 1 AS BIGINT) AS id_acao, CAST(strftime(CAST(o_orderdate AS DATE), '%Y%m%d') AS INTEGER) AS de,
    CAST(strftime(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 200 AS INTEGER), '%Y%m%d') AS INTEGER) AS ate FROM orders"""


@query(
    "an7_prefix_windows",
    sql("quotes", f"""SELECT w.pedido, w.id_acao, round(product(1 + CAST(q.vl_retorno_diario AS DOUBLE)) - 1, 6) AS vl_retorno
        FROM ({WINDOWS}) w LEFT JOIN quotes q ON q.id_acao = w.id_acao AND q.id_data BETWEEN w.de AND w.ate AND q.vl_retorno_diario IS NOT NULL GROUP BY 1, 2"""),
)
def an7_prefix(m):
    """A window of its own for every order: two lookups each in the shares' running sums."""
    day = F.col("o_orderdate").cast("date")
    as_key = lambda c: F.date_format(c, "yyyyMMdd").cast("int")
    windows = m.table("orders").select(
        F.col("o_orderkey").alias("pedido"), (F.col("o_orderkey") % 10 + 1).alias("id_acao"), as_key(day).alias("de"), as_key(F.date_add(day, (F.col("o_orderkey") % 200).cast("int"))).alias("ate")
    )
    return returns.window_returns(windows, returns.growth_to_date(m.quotes), "de", "ate").select("pedido", "id_acao", "vl_retorno")


@query(
    "an11_stored_fact",
    sql("quotes", f"""SELECT id_acao, ds_crise, fase, count(*) AS pregoes, round(product(1 + r) - 1, 6) AS retorno, round(stddev_samp(r), 6) AS volatilidade
        FROM (SELECT id_acao, dt_data, CAST(vl_retorno_diario AS DOUBLE) AS r FROM quotes WHERE vl_retorno_diario IS NOT NULL)
        JOIN ({PHASES}) ON dt_data BETWEEN a AND b GROUP BY 1, 2, 3"""),
)
def an11_stored(m):
    """The crisis study over the stored fact, whose folders of other years stay unread."""
    store = new_store(m)
    warehouse.load_quotes(store, quote_rows(m).drop("id_data"))
    return market.crisis_study(store.read("fato_cotacao"), periods(m))


# ---- statements -----------------------------------------------------------------------------------

FILED = """SELECT o_custkey AS id_empresa, CAST(strftime(last_day(CAST(o_orderdate AS DATE)), '%Y%m%d') AS INTEGER) AS id_data,
    sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderstatus = 'F') AS f, sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderstatus = 'O') AS o,
    sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderstatus = 'P') AS p FROM orders GROUP BY 1, 2"""


def account_lines(m, version, more=0):
    """Orders as filed accounts: a company's month is a statement, the order's state an account."""
    value = F.sum(F.col("o_totalprice").cast("decimal(18,2)")) + F.lit(more).cast("decimal(18,2)")
    account = F.when(F.col("o_orderstatus") == "F", "3.01").when(F.col("o_orderstatus") == "O", "3.11").otherwise("3.05")
    day = F.last_day(F.col("o_orderdate").cast("date"))
    rows = m.table("orders").groupBy("o_custkey", day.alias("day"), account.alias("CD_CONTA")).agg(value.alias("value"))
    return rows.select(
        F.col("o_custkey").cast("string").alias("CD_CVM"),
        F.date_format("day", "yyyy-MM-dd").alias("DT_REFER"),
        F.lit(str(version)).alias("VERSAO"),
        F.lit("UNIDADE").alias("ESCALA_MOEDA"),
        F.lit("ÚLTIMO").alias("ORDEM_EXERC"),
        "CD_CONTA",
        F.lit("conta").alias("DS_CONTA"),
        F.col("value").cast("string").alias("VL_CONTA"),
    )


@query(
    "an10_statements",
    f"""SELECT id_empresa, id_data, CAST(f + m AS DOUBLE) AS vl_receita_liquida, CAST(o + m AS DOUBLE) AS vl_lucro_liquido, CAST(p + m AS DOUBLE) AS vl_ebitda,
          CASE WHEN id_empresa % 2 = 0 THEN 2 ELSE 1 END AS versoes
        FROM (SELECT *, CASE WHEN id_empresa % 2 = 0 THEN 1000 ELSE 0 END AS m FROM ({FILED}))""",
)
def an10_statements(m):
    """First versions of most companies, then a restatement of the even ones, then the first versions of all: the late ones change nothing."""
    store = Store(m.spark, shared_dir(m.spark, "store"))
    warehouse.create_tables(store, "1992-01-01", "1998-12-31")
    store.append(m.table("customer").select(F.col("c_custkey").alias("id_empresa"), F.col("c_custkey").cast("string").alias("cd_cvm"), F.col("c_name").alias("ds_razao_social")), "dim_empresa")
    source, key = statement_source("DRE"), F.col("CD_CVM").cast("int")
    for lines in (account_lines(m, 1).filter(key % 3 != 0), account_lines(m, 2, 1000).filter(key % 2 == 0), account_lines(m, 1)):
        loading.load_source(store, source, delivered(m, lines, source))
        warehouse.load_statements(store, warehouse.settle_staging(store, source.table, source.name))
    versions = store.read("hist_dem_versao").groupBy("id_empresa", "id_data").agg(F.count_distinct("nr_versao").cast("int").alias("versoes"))
    measures = ["vl_receita_liquida", "vl_lucro_liquido", "vl_ebitda"]
    return store.read("fato_dem_financeira").select("id_empresa", "id_data", *measures).join(versions, ["id_empresa", "id_data"])


VERSIONS = """SELECT CAST(o_custkey % 50 AS INTEGER) AS id_empresa, o_orderpriority AS cd_conta, CAST(o_orderkey % 9 AS INTEGER) AS nr_versao,
    min(CAST(o_orderdate AS DATE)) AS dt_entrega, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(20,2)) AS vl_conta FROM orders GROUP BY ALL"""


def versions(m):
    return m.table("orders").groupBy(
        (F.col("o_custkey") % 50).cast("int").alias("id_empresa"), F.col("o_orderpriority").alias("cd_conta"), (F.col("o_orderkey") % 9).cast("int").alias("nr_versao")
    ).agg(F.min(F.col("o_orderdate").cast("date")).alias("dt_entrega"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(20,2)").alias("vl_conta"))


@query(
    "wn9_known_on_day",
    f"""SELECT id_empresa, cd_conta, max(nr_versao) AS nr_versao, CAST(arg_max(vl_conta, nr_versao) AS DOUBLE) AS vl_conta FROM ({VERSIONS})
        WHERE dt_entrega <= DATE '1998-01-31' GROUP BY 1, 2""",
)
def wn9_known(m):
    return fundamentals.known_versions(versions(m), "1998-01-31", ["id_empresa", "cd_conta"]).select("id_empresa", "cd_conta", "nr_versao", "vl_conta")


@query(
    "wn9_validity",
    f"""WITH v AS ({VERSIONS}), k AS (SELECT * FROM v WHERE NOT EXISTS (SELECT 1 FROM v o WHERE o.id_empresa = v.id_empresa AND o.cd_conta = v.cd_conta
          AND o.nr_versao > v.nr_versao AND o.dt_entrega <= v.dt_entrega))
        SELECT id_empresa, cd_conta, nr_versao, CAST(dt_entrega AS VARCHAR) AS dt_inicio,
          CAST((SELECT min(o.dt_entrega) FROM k o WHERE o.id_empresa = k.id_empresa AND o.cd_conta = k.cd_conta AND o.dt_entrega > k.dt_entrega) AS VARCHAR) AS dt_fim FROM k""",
)
def wn9_validity(m):
    return fundamentals.validity(versions(m), ["id_empresa", "cd_conta"]).select("id_empresa", "cd_conta", "nr_versao", "dt_inicio", "dt_fim")


# ---- keys, change log, quarantine, ledger ---------------------------------------------------------

KEYS = {"fato_cotacao": "id_cotacao", "fato_indicador_macro": "id_fato", "fato_indicadores": "id_fato", "hist_dividendos": "id_dividendo", "hist_desdobramento": "id_desdobramento", "hist_preco_ajustado": "id_preco_aj"}


@query(
    "u1_fact_keys",
    sql("bars selic dividends splits", """SELECT tabela, linhas, linhas AS chaves, CAST(0 AS BIGINT) AS nulas FROM (
          SELECT 'fato_cotacao' AS tabela, count(*) AS linhas FROM bars UNION ALL SELECT 'fato_indicador_macro', count(*) FROM selic
          UNION ALL SELECT 'fato_indicadores', count(DISTINCT (id_acao, date_trunc('month', dt_data))) FROM bars
          UNION ALL SELECT 'hist_dividendos', count(*) FROM dividends UNION ALL SELECT 'hist_desdobramento', count(*) FROM splits
          UNION ALL SELECT 'hist_preco_ajustado', count(*) FROM bars)"""),
)
def u1_fact_keys(m):
    store = load_two_deliveries(m)
    counts = None
    for table, key in KEYS.items():
        one = store.read(table).agg(F.count("*").alias("linhas"), F.count_distinct(key).alias("chaves"), F.count_if(F.col(key).isNull()).alias("nulas"))
        one = one.select(F.lit(table).alias("tabela"), "linhas", "chaves", "nulas")
        counts = one if counts is None else counts.unionByName(one)
    return counts


@query(
    "u2_change_log",
    """SELECT c_custkey AS cliente, CASE WHEN c_custkey % 10 = 3 OR c_custkey % 10 = 1 THEN ds_operacao ELSE 'INSERT' END AS ds_operacao, antes, depois FROM (
         SELECT c_custkey, 'INSERT' AS ds_operacao, NULL AS antes, c_name AS depois FROM customer
         UNION ALL SELECT c_custkey, 'UPDATE', c_name, c_name || ' S.A.' FROM customer WHERE c_custkey % 10 = 1)""",
)
def u2_change_log(m):
    """Companies in two registries: the second renames some and brings the ones that the first left out; a third changes nothing."""
    store = Store(m.spark, shared_dir(m.spark, "store"))
    rows = m.table("customer").select(F.col("c_custkey").cast("string").alias("cd_cvm"), F.col("c_name").alias("ds_nome_pregao"), F.col("c_custkey").alias("id_staging"))
    columns = {"nr_cnpj": F.lit("x"), "ds_razao_social": F.lit("y"), "dt_constituicao": F.lit(None).cast("date"), "dt_listagem": F.lit(None).cast("date"), "fl_ativa": F.lit(True), "ds_setor_atividade": F.lit("z")}
    rows = rows.withColumns(columns)
    key = F.col("id_staging")
    renamed = rows.withColumn("ds_nome_pregao", F.when(key % 10 == 1, F.concat("ds_nome_pregao", F.lit(" S.A."))).otherwise(F.col("ds_nome_pregao")))
    for registry in (rows.filter(key % 10 != 3), renamed, renamed):
        warehouse.load_companies(store, registry)
    image = lambda c, name: F.get_json_object(c, f"$.{name}")
    return store.read("log_auditoria").select(
        image("ds_dados_depois", "cd_cvm").cast("bigint").alias("cliente"), "ds_operacao",
        image("ds_dados_antes", "ds_nome_pregao").alias("antes"), image("ds_dados_depois", "ds_nome_pregao").alias("depois"),
    )


@query(
    "dq3_quarantine",
    sql("bars", """SELECT regra, count(*) AS linhas FROM (SELECT unnest(list_filter([CASE WHEN id_acao % 7 = 0 THEN 'vl_volume is required' END, CASE WHEN id_data % 50 = 3 THEN 'high at or above low' END,
          CASE WHEN id_data % 31 = 4 THEN 'volume not negative' END], lambda x: x IS NOT NULL)) AS regra FROM (SELECT *, id_acao % 7 = 0 AS void FROM bars))
        WHERE regra <> 'volume not negative' GROUP BY 1 UNION ALL SELECT 'volume not negative', count(*) FROM bars WHERE id_data % 31 = 4 AND id_acao % 7 <> 0
        UNION ALL SELECT 'no fato', count(*) FROM bars WHERE id_acao % 7 <> 0 AND id_data % 50 <> 3 AND id_data % 31 <> 4"""),
)
def dq3_quarantine(m):
    """Spoilt quotes: each goes to quarantine with all the rules it breaks, the others to the fact."""
    store = new_store(m)
    day, share = F.col("id_data"), F.substring("cd_ticker", 2, 20).cast("bigint")
    rows = quote_rows(m).withColumns({
        "vl_volume": F.when(share % 7 == 0, F.lit(None)).when(day % 31 == 4, F.lit(-1)).otherwise(F.col("vl_volume")).cast("bigint"),
        "vl_maximo": F.when(day % 50 == 3, F.col("vl_minimo") - 1).otherwise(F.col("vl_maximo")).cast("decimal(18,4)"),
    })
    warehouse.load_quotes(store, rows.drop("id_data"))
    rules = store.read("quarentena").select(F.explode(F.split("ds_regras", "; ")).alias("regra")).groupBy("regra").agg(F.count("*").alias("linhas"))
    kept = store.read("fato_cotacao").agg(F.count("*").alias("linhas")).select(F.lit("no fato").alias("regra"), "linhas")
    return rules.unionByName(kept)


@query(
    "src12_file_ledger",
    """WITH f AS (SELECT o_orderstatus AS s, 'valor' || chr(10) || string_agg(CAST(o_orderkey AS VARCHAR), chr(10) ORDER BY o_orderkey) || chr(10) AS body FROM orders GROUP BY 1)
       SELECT s AS arquivo, sha256(body) AS ds_checksum, CAST(length(body) AS BIGINT) AS nr_bytes, CASE s WHEN 'P' THEN 2 ELSE 1 END AS id_carga FROM f""",
)
def src12_ledger(m):
    """The first delivery has two files, the second one of them again and a third: only that one is read."""
    store, root = Store(m.spark, shared_dir(m.spark, "store")), shared_dir(m.spark, "in")
    lines = m.table("orders").select("o_orderstatus", F.col("o_orderkey").alias("valor"))
    for folder, states in (("dia1", ["F", "O"]), ("dia2", ["F", "P"])):
        for state in states:
            one = lines.filter(F.col("o_orderstatus") == state).select(F.col("valor").cast("string")).coalesce(1).sortWithinPartitions(F.col("valor").cast("bigint"))
            one.write.option("header", True).csv(f"{root}/{folder}/{state}")
        loading.load_source(store, ONE_COLUMN, f"{root}/{folder}", skip_repeated=True)
    return store.read("etl_arquivos").select(F.regexp_extract("ds_arquivo", "/(.)/[^/]*$", 1).alias("arquivo"), "ds_checksum", "nr_bytes", F.col("id_carga").cast("int"))


ONE_COLUMN = loading.CsvSource(name="ORDENS", table="stg_indicadores_macro", columns={"valor": "vl_indicador"})


# ---- the whole load -------------------------------------------------------------------------------


def kind_lines(m, kind):
    """The accounts of one kind of statement, from the same orders."""
    lines = account_lines(m, 1).withColumn("VL_CONTA", F.col("VL_CONTA").cast("decimal(20,2)"))
    if kind == "DRE":
        return lines.withColumn("VL_CONTA", F.col("VL_CONTA").cast("string"))
    names = {"BPA": {"3.01": "1"}, "BPP": {"3.01": "2.03", "3.11": "2.01.04", "3.05": "2.02.01"}}[kind]
    code = F.element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), F.col("CD_CONTA"))
    return lines.withColumns({"CD_CONTA": code, "VL_CONTA": (F.col("VL_CONTA") * 2).cast("string")}).filter("CD_CONTA IS NOT NULL")


def first_of_month(series):
    return series.groupBy(F.trunc("dt_data", "month").alias("_m")).agg(F.min("dt_data").alias("dt_data"), F.min_by("vl_indicador", "dt_data").alias("vl_indicador"))


LISTED = "id_acao % 9 <> 4 AND id_acao % 11 <> 0 AND id_acao IN (SELECT c_custkey FROM customer)"


@query(
    "an10_eleven_sources",
    sql("quotes macro", f"""WITH splits AS (SELECT DISTINCT l_suppkey AS id_acao, CAST(l_shipdate AS DATE) AS dt_data, CAST(1.1 AS DECIMAL(10,4)) AS vl_fator FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber = 1),
        dividends AS (SELECT DISTINCT id_acao, dt_data, CAST(CAST(p * 0.0137 AS DECIMAL(18,4)) AS DECIMAL(18,6)) AS vl_dividendo FROM ticks WHERE l_returnflag = 'A' AND l_linenumber = 2),
        ipca AS (SELECT date_trunc('month', dt_data) AS a, arg_min(vl_indicador, dt_data) AS v FROM macro WHERE id_indicador = 2 GROUP BY 1),
        filed AS ({FILED})
        SELECT * REPLACE (CAST(id_data AS DOUBLE) AS id_data) FROM (SELECT 'fato_cotacao' AS tabela, 'T' || id_acao AS chave, id_data, CAST(vl_fechamento AS DOUBLE) AS v1, CAST(vl_retorno_diario AS DOUBLE) AS v2, CAST(NULL AS DOUBLE) AS v3 FROM quotes WHERE {LISTED}
        UNION ALL SELECT 'fato_indicador_macro', CASE id_indicador WHEN 1 THEN 'SELIC' WHEN 3 THEN 'CAMBIO' ELSE 'CDI' END, id_data, CAST(vl_indicador AS DOUBLE), NULL, NULL FROM macro WHERE id_indicador IN (1, 3, 4)
        UNION ALL SELECT 'fato_indicador_macro', 'IPCA', CAST(strftime(d, '%Y%m%d') AS INTEGER), CAST(v AS DOUBLE), NULL, NULL FROM (SELECT v, unnest(generate_series(CAST(a AS DATE), last_day(CAST(a AS DATE)), INTERVAL 1 DAY)) AS d FROM ipca)
        UNION ALL SELECT 'fato_dem_financeira', CAST(id_empresa AS VARCHAR), id_data, CAST(f AS DOUBLE), CAST(CASE WHEN o IS NULL AND p IS NULL THEN NULL ELSE 2 * (coalesce(o, 0) + coalesce(p, 0)) END AS DOUBLE), CAST(2 * f AS DOUBLE) FROM filed
          WHERE id_empresa % 11 <> 0 AND id_empresa IN (SELECT c_custkey FROM customer)
        UNION ALL SELECT 'hist_desdobramento', 'T' || id_acao, CAST(strftime(dt_data, '%Y%m%d') AS INTEGER), CAST(vl_fator AS DOUBLE), NULL, NULL FROM splits WHERE {LISTED}
        UNION ALL SELECT 'hist_dividendos', 'T' || id_acao, CAST(strftime(dt_data, '%Y%m%d') AS INTEGER), CAST(vl_dividendo AS DOUBLE), NULL, NULL FROM dividends WHERE {LISTED}
        UNION ALL SELECT 'hist_preco_ajustado', 'T' || id_acao, id_data, CAST(vl_fechamento_aj AS DOUBLE), CAST(vl_retorno_aj AS DOUBLE), NULL FROM ({ADJUSTED_RETURN}) WHERE {LISTED}
        UNION ALL SELECT 'sobra', fonte, NULL, 0, NULL, NULL FROM (VALUES ('KAGGLE_COTACAO'), ('DIVIDENDOS'), ('BCB_SELIC'), ('CVM_DFP_DRE')) AS t(fonte)
        UNION ALL SELECT 'auditoria', 'dim_empresa', NULL, (SELECT count(*) FROM customer WHERE c_custkey % 11 <> 0), NULL, NULL)"""),
)
def an10_eleven(m):
    """All eleven sources from files to the star schema, with values; and that every row read is loaded or on record.

    `sobra`: lines read less rows loaded less rows logged, per source (repeated dividends load once).
    """
    store = Store(m.spark, shared_dir(m.spark, "store"))
    paths = {
        "COTACOES": delivered(m, quote_lines(m), QUOTES),
        "CVM_CADASTRO": delivered(m, registry_lines(m), REGISTRY),
        "DIVIDENDOS": delivered(m, dividend_lines(m), DIVIDENDS),
        "DESDOBRAMENTOS": delivered(m, split_lines(m), SPLITS),
        "BCB_IPCA": delivered(m, series_lines(first_of_month(m.series(2))), SELIC),
    }
    for number, code in [(1, "SELIC"), (3, "CAMBIO"), (4, "CDI")]:
        paths[f"BCB_{code}"] = delivered(m, series_lines(m.series(number)), SELIC)
    for kind in ("DRE", "BPA", "BPP"):
        paths[f"CVM_DFP_{kind}"] = delivered(m, kind_lines(m, kind), statement_source(kind))
    tickers = m.acao.filter("id_acao % 9 <> 4").select("cd_ticker", F.col("id_acao").cast("string").alias("cd_cvm"), "nr_total_acoes")
    warehouse.run_all(store, paths, tickers, FULL_LOAD, first="1992-01-01", last="1998-12-31", window=60)
    return nullable_counts(whole_load(store), "id_data")


def whole_load(store):
    shares = store.read("dim_acao").select("id_acao", F.col("cd_ticker").alias("chave"))
    series = store.read("dim_indicador_macro").select("id_indicador", F.col("cd_indicador").alias("chave"))
    companies = store.read("dim_empresa").select("id_empresa", F.col("cd_cvm").alias("chave"))
    none = F.lit(None).cast("double")

    def values(table, names, key, *columns):
        cells = [F.col(c).cast("double") for c in columns] + [none] * (3 - len(columns))
        rows = store.read(table).join(names, key)
        return rows.select(F.lit(table).alias("tabela"), "chave", "id_data", *[c.alias(f"v{i}") for i, c in enumerate(cells, start=1)])

    out = values("fato_cotacao", shares, "id_acao", "vl_fechamento", "vl_retorno_diario")
    out = out.unionByName(values("fato_indicador_macro", series, "id_indicador", "vl_indicador"))
    out = out.unionByName(values("fato_dem_financeira", companies, "id_empresa", "vl_receita_liquida", "vl_divida_bruta", "vl_patrimonio_liq"))
    out = out.unionByName(values("hist_desdobramento", shares, "id_acao", "vl_fator"))
    out = out.unionByName(values("hist_dividendos", shares, "id_acao", "vl_dividendo"))
    out = out.unionByName(values("hist_preco_ajustado", shares, "id_acao", "vl_fechamento_aj", "vl_retorno_aj"))

    def single(table, name, rows):
        return rows.select(F.lit(table).alias("tabela"), F.lit(name).alias("chave"), F.lit(None).cast("int").alias("id_data"), "v1", none.alias("v2"), none.alias("v3"))

    # Rows staged, less those in the fact, less those on record with the reason why they are not.
    unknown = lambda table, names, column: store.read(table).join(names, F.col(column) == F.col("chave"), "left_anti")
    paid = store.read("stg_dividendos").dropDuplicates(["ticker", "dt_aprovacao", "vl_provento"])
    balance = {
        "KAGGLE_COTACAO": (store.read("stg_cotacao"), store.read("fato_cotacao"), store.read("etl_log_erros").filter("ds_fonte = 'KAGGLE_COTACAO'")),
        "BCB_SELIC": (store.read("stg_indicadores_macro").filter("ds_fonte = 'BCB_SELIC'"), store.read("fato_indicador_macro").join(series.filter("chave = 'SELIC'"), "id_indicador"), None),
        "CVM_DFP_DRE": (store.read("stg_dem_financeira").filter("ds_fonte = 'CVM_DFP_DRE'"), store.read("hist_dem_versao").filter("ds_quadro = 'DRE'"),
                        unknown("stg_dem_financeira", companies, "cd_cvm").filter("ds_fonte = 'CVM_DFP_DRE'")),
        "DIVIDENDOS": (paid, store.read("hist_dividendos"), paid.join(shares, F.col("ticker") == F.col("chave"), "left_anti")),
    }
    for source, (staged, loaded, lost) in balance.items():
        counts = table_counts({"1": staged, "-1": loaded} | ({"-1 ": lost} if lost is not None else {}))
        out = out.unionByName(single("sobra", source, counts.agg(F.sum(F.trim("tabela").cast("int") * F.col("registros")).cast("double").alias("v1"))))
    audit = store.read("log_auditoria").filter("ds_tabela = 'dim_empresa'").agg(F.count("*").cast("double").alias("v1"))
    return out.unionByName(single("auditoria", "dim_empresa", audit))
