from __future__ import annotations

from datetime import date

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from quotewell.operators import fundamentals, quality, typed
from quotewell.plans.monitoring import register_views
from quotewell.plans.warehouse import run_all
from quotewell.sources import csv_files, loading
from quotewell.sources.store import Store, save_bucketed
from quotewell.streaming.arrivals import load_arrivals

QUOTE_LINES = """ticker,date,open,close,high,low,volume
PETR4,2024-01-15,32.45,33.10,33.50,31.90,45230000
PETR4,16/01/2024,"33,10","32,40","33,20","32,00","45.230.000"
,2024-01-16,1.00,1.00,1.00,1.00,10
VALE3,2024-02-30,70.0,71.0,72.0,69.0,10
VALE3,2024-01-15,70.0,71.0,69.0,72.0,10
VALE3,2024-01-16,70.0,71.0,72.0,69.0,-1
VALE3,2024-01-17,70.0,71.0
PETR4,2024-01-15,1.00,1.00,1.00,1.00,1
XXXX3,2024-01-15,1.00,1.00,1.00,1.00,1
"""

SERIES_LINES = 'data;valor\r\n"15/01/2024";"0,043250"\r\n"";"0,04"\r\n"15/01/2024";"0,050000"\r\n"16/01/2024";"0,043250"\r\n'

HEADER = (
    "CNPJ_CIA;DT_REFER;VERSAO;DENOM_CIA;CD_CVM;GRUPO_DFP;MOEDA;ESCALA_MOEDA;ORDEM_EXERC;DT_INI_EXERC;DT_FIM_EXERC;"
    "CD_CONTA;DS_CONTA;VL_CONTA;ST_CONTA_FIXA"
)


def filed(code, day, version, order, account, text, value):
    return f"c;{day};{version};Cia;{code};g;REAL;UNIDADE;{order};a;b;{account};{text};{value};S"


STATEMENT_LINES = "\n".join(
    [
        HEADER,
        filed("9512", "2023-12-31", 1, "ÚLTIMO", "3.01", "Receita", 1000),
        filed("9512", "2023-12-31", 2, "ÚLTIMO", "3.01", "Receita", 1100),
        filed("9512", "2022-12-31", 1, "PENÚLTIMO", "3.01", "Receita", 900),
        filed(" ", "2023-12-31", 1, "ÚLTIMO", "3.01", "Receita", 5),
        filed("9512", "2023-12-31", 1, "ÚLTIMO", "3.11", "Lucro", -50),
    ]
)

REGISTRY_LINES = """CNPJ_CIA;DENOM_SOCIAL;DENOM_COMERC;DT_REG;DT_CONST;SIT;CD_CVM;SETOR_ATIV;UF
33.000.167/0001-01;PETRÓLEO BRASILEIRO S.A.;PETROBRAS;1977-07-20;1953-10-03;ATIVO;9512;Petróleo;RJ
33.592.510/0001-54;VALE S.A.;VALE;1970-01-02;11/01/1943;ATIVO;4170;Mineração;RJ
00.000.000/0001-91;ANTIGA S.A.;ANTIGA;1977-07-20;1808-10-12;CANCELADA;1;Bancos;DF
x;SEM CODIGO;SC;;;ATIVO; ;Bancos;DF
"""

DIVIDEND_LINES = """ticker;cd_cvm;dt_aprovacao;valor;tipo;dt_ex;dt_pagamento
PETR4;9512;10/01/2024;1,000000;Dividendo;15/01/2024;
PETR4;9512;10/01/2024;0;JCP;15/01/2024;
"""

SPLIT_LINES = """ticker;data;tipo;fator;descricao
PETR4;2024-01-16;split;2,0000;um para dois
PETR4;2024-01-16;cisao;2,0000;outro
"""


@pytest.fixture
def files(tmp_path):
    def write(name, text, encoding="utf-8"):
        path = tmp_path / name
        path.write_bytes(text.encode(encoding))
        return str(path)

    return {
        "COTACOES": write("quotes.csv", QUOTE_LINES),
        "BCB_SELIC": write("series.csv", SERIES_LINES),
        "BCB_IPCA": write("ipca.csv", "data;valor\n31/01/2024;0,42\n"),
        "BCB_CAMBIO": str(tmp_path / "missing.csv"),
        "BCB_CDI": write("cdi.csv", "data;valor\n01/01/2024;1\n"),
        "CVM_CADASTRO": write("registry.csv", REGISTRY_LINES, "latin-1"),
        "CVM_DFP_DRE": write("dre.csv", STATEMENT_LINES, "latin-1"),
        "DIVIDENDOS": write("dividends.csv", DIVIDEND_LINES),
        "DESDOBRAMENTOS": write("splits.csv", SPLIT_LINES),
    }


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def test_quotes_typed_and_rejected(spark, files):
    lines = csv_files.read_text_columns(spark, files["COTACOES"], csv_files.QUOTES)
    assert lines.count() == 9
    assert [r[0] for r in csv_files.bad_lines(lines).collect()] == ["VALE3,2024-01-17,70.0,71.0"]
    rows = typed.apply_typing(csv_files.staging_columns(lines, csv_files.QUOTES), typed.QUOTES)
    kept = rows_of(typed.passed(rows).select("cd_ticker", "dt_data", "vl_fechamento", "vl_volume"), "cd_ticker", "dt_data", "vl_volume")
    assert kept[1:3] == [("PETR4", date(2024, 1, 15), 33.1, 45230000), ("PETR4", date(2024, 1, 16), 32.4, 45230000)]
    reasons = dict(rows_of(typed.reasons_count(rows)))
    assert reasons == {"ticker missing": 1, "dt_pregao invalid": 1, "high below low": 1, "negative volume": 1}
    assert typed.passed(rows).count() + typed.rejected(rows).count() == 8


def test_series_with_carriage_returns(spark, files):
    rows = csv_files.read_staging(spark, files["BCB_SELIC"], csv_files.series_source("SELIC", "11"))
    values = rows_of(typed.passed(typed.apply_typing(rows, typed.SERIES)).select("dt_data", "vl_indicador"), "dt_data", "vl_indicador")
    assert values == [(date(2024, 1, 15), 0.04325), (date(2024, 1, 15), 0.05), (date(2024, 1, 16), 0.04325)]


def test_statements_by_header_name(spark, files):
    rows = csv_files.read_staging(spark, files["CVM_DFP_DRE"], csv_files.statement_source("DRE"))
    assert rows.count() == 3
    good = typed.passed(typed.apply_typing(rows, typed.STATEMENTS))
    last = fundamentals.latest_versions(good, ["cd_cvm", "dt_data", "cd_conta"], "nr_versao")
    wide = fundamentals.statement_measures(last, ["cd_cvm", "dt_data"])
    assert rows_of(wide.select("cd_cvm", "vl_receita_liquida", "vl_lucro_liquido")) == [("9512", 1100.0, -50.0)]


def test_registry_by_header_name(spark, files):
    rows = csv_files.read_staging(spark, files["CVM_CADASTRO"], csv_files.REGISTRY)
    good = typed.passed(typed.apply_typing(rows, typed.REGISTRY))
    found = rows_of(good.select("cd_cvm", "ds_razao_social", "fl_ativa", "dt_constituicao"), "cd_cvm")
    assert found[0] == ("1", "ANTIGA S.A.", False, date(1808, 10, 12))
    assert found[2] == ("9512", "PETRÓLEO BRASILEIRO S.A.", True, date(1953, 10, 3))


def test_load_records_counts_and_bad_lines(store, files):
    report = loading.load_source(store, csv_files.QUOTES, files["COTACOES"]).first()
    assert (report["registros_lidos"], report["registros_carregados"], report["registros_erro"], report["status"]) == (9, 8, 1, "PARCIAL")
    control = store.read("etl_controle_carga").first()
    assert control["ds_status"] == "PARCIAL" and control["dt_fim_carga"] >= control["dt_inicio_carga"]
    error = store.read("etl_log_erros").first()
    assert error["ds_dados"].startswith("VALE3") and error["id_carga"] == control["id_carga"]


def test_reload_replaces_pending_and_keeps_processed(store, files, tmp_path):
    source = csv_files.series_source("SELIC", "11")
    for _ in range(2):
        loading.load_source(store, source, files["BCB_SELIC"])
    staging = store.read("stg_indicadores_macro")
    assert staging.count() == 3
    store.settle(staging.withColumn("fl_processado", F.lit(1)), "stg_indicadores_macro", source.name)
    empty = tmp_path / "empty.csv"
    empty.write_text("data;valor\n")
    loading.load_source(store, source, files["BCB_SELIC"])
    assert rows_of(store.read("stg_indicadores_macro").groupBy("fl_processado").count(), "fl_processado") == [(0, 3), (1, 3)]
    loading.load_source(store, source, str(empty))
    assert rows_of(store.read("stg_indicadores_macro").groupBy("fl_processado").count(), "fl_processado") == [(1, 3)]


def test_old_processed_loads_are_dropped(store, files):
    source = csv_files.series_source("SELIC", "11")
    for _ in range(3):
        loading.load_source(store, source, files["BCB_SELIC"])
        pending = store.read("stg_indicadores_macro").filter("fl_processado = 0")
        store.settle(pending.withColumn("fl_processado", F.lit(1)), "stg_indicadores_macro", source.name)
    loading.load_source(store, source, files["BCB_SELIC"])
    assert loading.drop_expired(store, "stg_indicadores_macro", source.name, keep=1) == 2
    found = rows_of(store.read("stg_indicadores_macro").groupBy("fl_processado", "id_carga").count(), "id_carga")
    assert found == [(1, 3, 3), (0, 4, 3)]


def test_repeated_delivery_is_skipped(store, files):
    plan = [step for step in csv_files.FULL_LOAD if step[0] in ("BCB_SELIC", "BCB_CDI")]
    for status in ("SUCESSO", "REPETIDO"):
        report = loading.full_extract(store, files, plan, skip_repeated=True)
        assert {r.status for r in report.collect()} == {status}
    assert store.read("stg_indicadores_macro").count() == 4


def test_marks_move_to_the_latest_date_loaded(spark, store):
    days = spark.createDataFrame([(date(2024, 1, 5),), (date(2024, 1, 9),)], "d date")
    assert loading.read_mark(store, "ULTIMA_CARGA_COTACAO") == "1900-01-01"
    loading.advance_mark(store, "ULTIMA_CARGA_COTACAO", days, "d")
    mark = loading.read_mark(store, "ULTIMA_CARGA_COTACAO")
    assert mark == "2024-01-09" and loading.after_mark(days, "d", mark).count() == 0
    assert loading.advance_mark(store, "ULTIMA_CARGA_COTACAO", days.limit(0), "d") is None


def test_repeated_files_are_known(spark, tmp_path):
    for name, text in [("a", "1\n2\n"), ("b", "1\n2\n"), ("c", "1\n3\n")]:
        (tmp_path / "in" / name).mkdir(parents=True)
        (tmp_path / "in" / name / "f.csv").write_text(text)
    sums = {r.ds_arquivo[-7]: r.ds_checksum for r in loading.file_checksums(spark, str(tmp_path / "in")).collect()}
    assert sums["a"] == sums["b"] != sums["c"] and len(sums["a"]) == 64
    digests = loading.delivery_digests(spark, str(tmp_path / "in"))
    seen = digests.filter(F.col("ds_arquivo").endswith("/a")).withColumn("ds_status", F.lit("SUCESSO"))
    assert [r.ds_arquivo[-1] for r in loading.unseen_files(digests, seen).collect()] == ["c"]


def test_stream_takes_every_file_once(spark, tmp_path):
    source = csv_files.series_source("SELIC", "11")
    folder = tmp_path / "in"
    folder.mkdir()

    def run():
        load_arrivals(
            spark, str(folder), source, typed.SERIES, str(tmp_path / "out"), ["cd_indicador", "dt_data"],
            str(tmp_path / "checkpoint"), files_per_batch=1,
        ).awaitTermination()
        return rows_of(spark.read.parquet(str(tmp_path / "out")).select("dt_data", "vl_indicador"), "dt_data")

    (folder / "1.csv").write_text("data;valor\n15/01/2024;0,1\n16/01/2024;0,2\n")
    first = run()
    assert first == [(date(2024, 1, 15), 0.1), (date(2024, 1, 16), 0.2)]
    assert run() == first
    (folder / "2.csv").write_text("data;valor\n16/01/2024;0,9\n17/01/2025;0,3\nruim;1\n")
    assert run() == [*first, (date(2025, 1, 17), 0.3)]
    lost = spark.read.parquet(str(tmp_path / "out_rejects")).select("ds_erro", "ds_dados")
    assert [(r.ds_erro, "ruim" in r.ds_dados) for r in lost.collect()] == [("dt_referencia invalid", True)]


def test_whole_run_twice(spark, store, files):
    tickers = spark.createDataFrame([("PETR4", "9512", 1000), ("VALE3", "4170", 2000)], "cd_ticker string, cd_cvm string, nr_total_acoes bigint")
    sectors = spark.createDataFrame([("Petróleo", "PETRO")], "ds_setor_atividade string, cd_setor string")
    plan = [step for step in csv_files.FULL_LOAD if step[0] not in ("BCB_CDI", "CVM_DFP_BPA", "CVM_DFP_BPP")]
    for _ in range(2):
        report = run_all(store, files, tickers, plan, sectors, "2023-01-01", "2024-12-31", window=2)
        states = {r.etapa: (r.registros_carregados, r.status) for r in report.collect()}
        assert states["COTACOES"] == (8, "PARCIAL") and states["BCB_CAMBIO"] == (0, "ERRO")
        assert states["DESDOBRAMENTOS"] == (2, "SUCESSO") and states["BCB_SELIC"] == (3, "SUCESSO")
        quotes = store.read("fato_cotacao").select("id_data", "vl_fechamento", "vl_amplitude", "vl_retorno_diario")
        assert rows_of(quotes, "id_data") == [(20240115, 33.1, 1.6, None), (20240116, 32.4, 1.2, -0.021148)]
        macro = store.read("fato_indicador_macro").groupBy("id_indicador").count()
        assert rows_of(macro, "id_indicador") == [(1, 2), (2, 31)]
        assert store.read("dim_empresa").count() == 3 and store.read("dim_acao").count() == 2
        assert store.read("hist_dividendos").count() == 1 and store.read("hist_desdobramento").count() == 1
        adjusted = store.read("hist_preco_ajustado").select("id_data", "vl_fechamento_aj")
        assert rows_of(adjusted, "id_data") == [(20240115, 16.05), (20240116, 32.4)]
        assert loading.read_mark(store, "ULTIMA_CARGA_COTACAO") == "2024-01-16"
        assert store.read("parametros_sistema").groupBy("cd_parametro").count().filter("count > 1").count() == 0
        assert store.read("fato_dem_financeira").count() == 1 and store.read("fato_indicadores").count() == 1
    company = store.read("dim_empresa").filter("cd_cvm = '9512'").first()
    assert company["id_setor"] == 7 and company["fl_ativa"]
    assert rows_of(store.read("dim_acao").select("cd_ticker", "id_acao", "ds_acao"), "id_acao") == [
        ("PETR4", 1, "PETROBRAS PN"), ("VALE3", 2, "VALE ON"),
    ]

    register_views(store)
    pending = {r.tabela: (r.processados, r.com_erro) for r in spark.sql("SELECT * FROM vw_etl_staging_pendentes").collect()}
    assert pending["stg_cotacao"] == (8, 8)  # two loads: 4 good and 4 bad each
    assert spark.sql("SELECT count(*) FROM log_erros_etl WHERE ds_erro = 'unknown cd_ticker'").first()[0] == 2
    assert spark.sql("SELECT count(*) FROM vw_etl_resumo_cargas WHERE ds_status = 'ERRO'").first()[0] == 2

    names = ["dim_setor", "dim_empresa", "dim_acao", "dim_tipo_acao", "dim_data", "dim_indicador_macro", "fato_cotacao",
             "fato_indicador_macro", "fato_dem_financeira", "fato_indicadores", "hist_preco_ajustado", "hist_dividendos"]
    broken = quality.check_model({n: store.read(n) for n in names}).filter("violacoes > 0")
    assert [tuple(r)[:2] for r in broken.collect()] == []


def test_late_quotes_correct_the_session_after_them(spark, store):
    from quotewell.plans.warehouse import load_quotes

    store.append(spark.createDataFrame([(1, "A"), (2, "B")], "id_acao int, cd_ticker string"), "dim_acao")

    def batch(*quotes):
        rows = [(i, 1, d[11:] or "A", date.fromisoformat(d[:10]), c, c, c, c, 1) for i, (d, c) in enumerate(quotes)]
        columns = "id_staging long, id_carga long, cd_ticker string, dt_data date, vl_abertura double, vl_fechamento double, "
        df = spark.createDataFrame(rows, columns + "vl_maximo double, vl_minimo double, vl_volume long")
        prices = ["vl_abertura", "vl_fechamento", "vl_maximo", "vl_minimo"]
        load_quotes(store, df.withColumns({c: F.col(c).cast("decimal(18,4)") for c in prices}))
        return rows_of(store.read("fato_cotacao").select("id_data", "vl_retorno_diario"), "id_data")

    assert batch(("2022-12-30", 10.0), ("2023-01-03", 11.0)) == [(20221230, None), (20230103, 0.1)]
    assert batch(("2023-01-04", 22.0), ("2023-01-03", 99.0))[2:] == [(20230104, 1.0)]
    assert batch(("2023-01-02", 20.0), ("2023-01-05", 11.0), ("2021-05-03 B", 7.0)) == [
        (20210503, None), (20221230, None), (20230102, 1.0), (20230103, -0.45), (20230104, 1.0), (20230105, -0.5),
    ]


def test_failed_rows_come_back_from_the_log(spark, store, files):
    loading.load_source(store, csv_files.QUOTES, files["COTACOES"])
    from quotewell.plans.warehouse import settle_staging

    assert settle_staging(store, "stg_cotacao", "KAGGLE_COTACAO").count() == 4
    again = loading.failed_rows(store.read("etl_log_erros").filter("ds_etapa = 'TRANSFORM'"), typed.QUOTES.raw(), load_id=1)
    fixed = again.withColumn("ticker", F.coalesce(F.col("ticker"), F.lit("ITUB4")))
    assert rows_of(typed.passed(typed.apply_typing(fixed, typed.QUOTES)).select("cd_ticker")) == [("ITUB4",)]


def test_bucketed_fact_needs_no_shuffle_for_windows(spark, bars):
    from quotewell.operators.returns import with_daily_return

    save_bucketed(bars({1: ["10", "11"], 2: ["5", "6"]}), "fato_cotacao_buckets", 4)
    plan = with_daily_return(spark.table("fato_cotacao_buckets"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_files_with_other_column_orders_are_read_by_name(spark, tmp_path):
    source = csv_files.REGISTRY
    names = list(source.columns)
    for file, order in (("a", names), ("b", names[::-1])):
        (tmp_path / f"{file}.csv").write_text(";".join(order) + "\n" + ";".join(f"{file}-{n}" for n in order) + "\n")
    rows = csv_files.read_staging(spark, str(tmp_path), source).orderBy("cd_cvm").collect()
    assert [(r.cd_cvm, r.ds_situacao) for r in rows] == [("a-CD_CVM", "a-SIT"), ("b-CD_CVM", "b-SIT")]


def test_row_numbers_follow_file_names_not_sizes(spark, store, tmp_path):
    (tmp_path / "a.csv").write_text("data;valor\n01/01/2024;1\n")
    (tmp_path / "b.csv").write_text("data;valor\n" + "".join(f"01/01/2024;{i}\n" for i in range(2, 60)))
    source = csv_files.series_source("SELIC", "11")
    loading.load_source(store, source, str(tmp_path))
    rows = store.read("stg_indicadores_macro").orderBy("id_staging").collect()
    assert [r.vl_indicador for r in rows] == [str(i) for i in range(1, 60)]


def test_checksum_of_any_file_size(spark, tmp_path):
    import hashlib

    body = b"x" * (65 << 20)  # above what was once a limit
    (tmp_path / "big file.bin").write_bytes(body)
    assert [r.ds_checksum for r in loading.file_checksums(spark, str(tmp_path)).collect()] == [hashlib.sha256(body).hexdigest()]


def test_statements_of_other_kinds_and_versions_add_up(spark, store):
    from quotewell.operators import typed
    from quotewell.plans import warehouse

    warehouse.create_tables(store, "2023-01-01", "2023-12-31")
    store.append(spark.createDataFrame([(1, "9512", "P")], "id_empresa int, cd_cvm string, ds_razao_social string"), "dim_empresa")
    schema = "id_staging bigint, cd_cvm string, ds_conta string, cd_conta string, vl_conta string, ds_tipo_dem string, dt_referencia string, nr_versao string"

    def deliver(load_id, kind, account, value, version):
        row = spark.createDataFrame([(load_id, "9512", "c", account, value, kind, "2023-12-31", version)], schema)
        source = f"CVM_DFP_{kind}"
        store.replace_pending(row.withColumns({"ds_fonte": F.lit(source), "dt_carga": F.current_timestamp()}), "stg_dem_financeira", source, load_id)
        warehouse.settle_staging(store, "stg_dem_financeira", source)
        warehouse.load_statements(store, warehouse.statements_on_hand(store, "DFP"))

    deliver(1, "DRE", "3.11", "-50", "1")
    deliver(2, "BPP", "2.03", "900", "1")
    deliver(3, "DRE", "3.11", "-60", "2")
    rows = store.read("fato_dem_financeira").select("vl_lucro_liquido", "vl_patrimonio_liq")
    assert rows_of(rows) == [(-60.0, 900.0)]
    assert typed is not None


def test_unknown_tickers_and_late_days_are_not_lost(spark, store):
    from quotewell.plans import warehouse

    warehouse.create_tables(store, "2023-01-01", "2023-12-31")
    tickers = spark.createDataFrame([("PETR4", "1", 10)], "cd_ticker string, cd_cvm string, nr_total_acoes bigint")
    warehouse.load_shares(store, tickers)
    assert [r.ds_erro for r in store.read("etl_log_erros").collect()] == ["unknown cd_cvm"]
    warehouse.extend_calendar(store, spark.sql("SELECT DATE '2025-03-04' AS dt_data"))
    assert store.read("dim_data").filter("nr_ano = 2025").count() == 365 and store.read("dim_data").count() == 365 + 366 + 365
