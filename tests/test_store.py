"""Commits, several deliveries, and what keeps derived facts up to date."""

from __future__ import annotations

import os
from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from quotewell.operators import fundamentals, joins, quality
from quotewell.operators.keys import with_block_keys
from quotewell.plans import derived, market, warehouse
from quotewell.sources import csv_files, loading
from quotewell.sources.snapshots import CommitConflict
from quotewell.sources.store import Store
from quotewell.streaming import quotes as stream

SHARES = [(1, "A", 10, 1000), (2, "B", 10, 500)]


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


@pytest.fixture
def market_store(spark, store):
    """Two shares of one company, a calendar, and the seeds."""
    warehouse.create_tables(store, "2021-01-01", "2024-12-31")
    store.append(spark.createDataFrame(SHARES, "id_acao int, cd_ticker string, id_empresa int, nr_total_acoes bigint"), "dim_acao")
    store.append(spark.createDataFrame([(10, "77", "Cia")], "id_empresa int, cd_cvm string, ds_razao_social string"), "dim_empresa")
    return store


def quotes(spark, *rows):
    """(ticker, day, close) as typed rows of a delivery."""
    values = [(i, t, date.fromisoformat(d), *[Decimal(str(c))] * 4, 100) for i, (t, d, c) in enumerate(rows)]
    prices = ", ".join(f"{c} decimal(18,4)" for c in ("vl_abertura", "vl_fechamento", "vl_maximo", "vl_minimo"))
    return spark.createDataFrame(values, f"id_staging bigint, cd_ticker string, dt_data date, {prices}, vl_volume bigint")


def setor(spark, *codes):
    return spark.createDataFrame([(i, c, c) for i, c in enumerate(codes, start=1)], "id_setor int, cd_setor string, ds_setor string")


def codes(store, at=None):
    return sorted(r.cd_setor for r in store.read("dim_setor", at).collect())


# ---- commits --------------------------------------------------------------------------------------


def test_a_stop_between_the_writes_leaves_the_old_table_whole(spark, store, monkeypatch):
    store.overwrite(setor(spark, "a", "b"), "dim_setor")

    def stop(*_):
        raise OSError("stopped")

    with monkeypatch.context() as broken:
        broken.setattr(store._commits, "publish", stop)
        with pytest.raises(OSError):
            store.swap(store.read("dim_setor").limit(1), "dim_setor")
        with pytest.raises(OSError), store.commit():
            store.append(setor(spark, "c"), "dim_setor")
            store.overwrite(setor(spark, "z").limit(0), "dim_subsetor")
    assert codes(store) == ["a", "b"] and codes(Store(spark, store.root)) == ["a", "b"]
    store.append(setor(spark, "d"), "dim_setor")
    assert codes(store) == ["a", "b", "d"]


def test_writes_of_a_commit_appear_together(spark, store):
    other = Store(spark, store.root)
    with store.commit():
        store.append(setor(spark, "a"), "dim_setor")
        with store.commit():
            store.append(setor(spark, "b"), "dim_setor")
        assert codes(store) == ["a", "b"] and codes(other) == []
        assert store.reserve("x", 3) == 1
    assert codes(other) == ["a", "b"] and store.reserve("x", 1) == 4
    with pytest.raises(ValueError), store.commit():
        store.append(setor(spark, "c"), "dim_setor")
        raise ValueError("no")
    assert codes(store) == ["a", "b"] and len(store.versions()) == 2


def test_the_second_of_two_writers_fails(spark, store):
    store.append(setor(spark, "a"), "dim_setor")
    other = Store(spark, store.root)
    with pytest.raises(CommitConflict), store.commit():
        store.append(setor(spark, "mine"), "dim_setor")
        other.append(setor(spark, "theirs"), "dim_setor")
    assert codes(store) == ["a", "theirs"]
    store.append(setor(spark, "mine"), "dim_setor")
    assert codes(store) == ["a", "mine", "theirs"]


def test_older_commits_can_be_read_until_they_are_dropped(spark, store):
    for text in ("a", "b", "c"):
        store.overwrite(setor(spark, text), "dim_setor")
    assert [codes(store, at) for at in store.versions()] == [["a"], ["b"], ["c"]]
    assert store.vacuum(keep=1) == 2
    assert len(store.versions()) == 1 and codes(store) == ["c"]
    assert len([d for d in os.listdir(store.path("dim_setor")) if d.startswith("versao=")]) == 1


def test_small_folders_become_one(spark, store):
    for text in ("a", "b", "c"):
        store.append(setor(spark, text), "dim_setor")
    store.compact("dim_setor")
    assert len(store.folders("dim_setor")) == 1 and codes(store) == ["a", "b", "c"]
    [folder] = store.folders("dim_setor")
    assert len([f for f in os.listdir(folder) if f.endswith(".parquet")]) == 1


# ---- quotes over several deliveries ---------------------------------------------------------------


def returns(store):
    rows = store.read("fato_cotacao").select("id_acao", "id_data", "vl_retorno_diario")
    return rows_of(rows, "id_acao", "id_data")


def test_a_later_batch_reads_no_folder_of_other_years(spark, market_store):
    store = market_store
    warehouse.load_quotes(store, quotes(spark, ("A", "2022-12-30", 10), ("A", "2023-01-02", 11), ("B", "2022-06-01", 5)))
    before = store.folders("fato_cotacao")
    for folder in before:  # unreadable from here on
        for file in Path(folder).glob("*.parquet"):
            file.write_bytes(b"x" * file.stat().st_size)
    warehouse.load_quotes(store, quotes(spark, ("A", "2024-01-02", 22), ("B", "2024-01-02", 10)))
    after = store.folders("fato_cotacao")
    assert after[: len(before)] == before
    fresh = spark.read.parquet(*after[len(before) :])
    assert rows_of(fresh.select("id_acao", "vl_retorno_diario"), "id_acao") == [(1, 1.0), (2, 1.0)]


def test_late_quotes_rewrite_their_own_years_only(spark, market_store):
    store = market_store
    warehouse.load_quotes(store, quotes(spark, ("A", "2021-03-01", 10), ("A", "2022-03-01", 20), ("A", "2024-03-01", 40), ("B", "2022-05-02", 7), ("B", "2024-05-02", 14)))
    before = set(store.folders("fato_cotacao"))
    warehouse.load_quotes(store, quotes(spark, ("A", "2022-09-01", 80), ("A", "2021-03-01", 99)))
    assert returns(store) == [(1, 20210301, None), (1, 20220301, 1.0), (1, 20220901, 3.0), (1, 20240301, -0.5), (2, 20220502, None), (2, 20240502, 1.0)]
    kept = {f[-4:] for f in before & set(store.folders("fato_cotacao"))}
    assert kept == {"2021"}
    state = rows_of(store.read("estado_cotacao").select("id_acao", "nr_ano", "id_primeiro", "id_ultimo", "vl_fechamento", "nr_pregoes"), "id_acao", "nr_ano")
    assert state[:3] == [(1, 2021, 20210301, 20210301, 10.0, 1), (1, 2022, 20220301, 20220901, 80.0, 2), (1, 2024, 20240301, 20240301, 40.0, 1)]
    ids = store.read("fato_cotacao").select("id_cotacao").collect()
    assert len({r[0] for r in ids}) == 6 and None not in {r[0] for r in ids}


def test_a_repeated_delivery_changes_nothing(spark, market_store):
    store = market_store
    batch = quotes(spark, ("A", "2022-03-01", 20), ("B", "2022-03-01", 7))
    warehouse.load_quotes(store, batch)
    keys = rows_of(store.read("fato_cotacao").select("id_acao", "id_cotacao"), "id_acao")
    number = store.versions()[-1]
    warehouse.load_quotes(store, batch)
    assert store.versions()[-1] == number and rows_of(store.read("fato_cotacao").select("id_acao", "id_cotacao"), "id_acao") == keys


def test_impossible_days_are_logged_and_do_not_stretch_the_calendar(spark, market_store):
    store = market_store
    days = store.read("dim_data").count()
    warehouse.load_quotes(store, quotes(spark, ("A", "2304-01-15", 10), ("A", "0204-01-15", 10), ("A", "2024-01-15", 10)))
    assert store.read("dim_data").count() == days and store.read("fato_cotacao").count() == 1
    assert [r.ds_erro for r in store.read("etl_log_erros").collect()] == ["day out of range"] * 2
    holidays = spark.createDataFrame([(date(2025, 1, 1),)], "dt_data date")
    warehouse.extend_calendar(store, spark.sql("SELECT DATE '2025-02-03' AS dt_data"), holidays=holidays)
    assert store.read("dim_data").filter("fl_feriado").select("id_data").collect()[0][0] == 20250101


def test_rows_that_break_rules_wait_in_quarantine(spark, market_store):
    store = market_store
    bad = quotes(spark, ("A", "2024-01-02", 1), ("A", "2024-01-03", 2), ("A", "2024-01-04", 3)).withColumns(
        {"vl_maximo": F.when(F.col("id_staging") == 1, 0).otherwise(F.col("vl_maximo")).cast("decimal(18,4)"), "vl_volume": F.when(F.col("id_staging") < 2, -1).otherwise(5).cast("bigint")}
    )
    warehouse.load_quotes(store, bad)
    held = sorted((r.ds_tabela, r.ds_regras) for r in store.read("quarentena").collect())
    assert held == [("fato_cotacao", "high at or above low; volume not negative"), ("fato_cotacao", "volume not negative")]
    assert returns(store) == [(1, 20240104, None)]


def test_mask_has_a_bit_a_rule(spark):
    rules = {"a": F.expr("x > 0"), "b": F.expr("x < 10"), "c": F.expr("x IS NOT NULL")}
    rows = spark.createDataFrame([(-1,), (5,), (11,), (None,)], "x int")
    mask = quality.broken_mask(rules)
    assert [tuple(r) for r in rows.select(mask.alias("m"), quality.broken_names(mask, rules).alias("n")).collect()] == [(1, "a"), (0, ""), (2, "b"), (4, "c")]


# ---- derived facts --------------------------------------------------------------------------------


def events(spark, ticker, day, amount):
    row = (0, ticker, date.fromisoformat(day), Decimal(amount), "DIVIDENDO", date.fromisoformat(day), None)
    return spark.createDataFrame([row], "id_staging bigint, cd_ticker string, dt_data date, vl_dividendo decimal(18,6), ds_tipo string, dt_ex date, dt_pagamento date")


def splits(spark, ticker, day, factor):
    row = (0, ticker, date.fromisoformat(day), "SPLIT", Decimal(factor), "x")
    return spark.createDataFrame([row], "id_staging bigint, cd_ticker string, dt_data date, ds_tipo string, vl_fator decimal(10,4), ds_descricao string")


def figures(store, table, *values):
    return rows_of(store.read(table).select("id_acao", "id_data", *values), "id_acao", "id_data")


DIVIDEND, SPLIT = ["vl_dividendo", "ds_tipo", "dt_ex", "dt_pagamento"], ["ds_tipo", "vl_fator", "ds_descricao"]


def test_derived_facts_follow_small_deliveries(spark, market_store):
    """After each step the same as a rebuild of everything, and years without news keep their files."""
    store = market_store
    columns = {"hist_preco_ajustado": ["vl_fechamento_aj", "vl_retorno_aj"], "fato_indicadores": ["vl_dy", "vl_volatilidade", "vl_market_cap", "vl_pl"]}

    def derive(rebuild=True):
        before = {t: set(store.folders(t)) for t in columns}
        derived.derive_adjusted(store)
        derived.derive_indicators(store, window=2)
        replaced = {t: {f[-4:] for f in set(store.folders(t)) - before[t]} for t in columns}
        assert store.read("estado_mudanca").isEmpty()
        if rebuild:
            found = {t: figures(store, t, *c) for t, c in columns.items()}
            derived.derive_adjusted(store, whole=True)
            derived.derive_indicators(store, window=2, whole=True)
            assert found == {t: figures(store, t, *c) for t, c in columns.items()}
        return replaced["hist_preco_ajustado"], replaced["fato_indicadores"]

    days = [f"{y}-{m:02d}-{d:02d}" for y in (2021, 2022, 2023) for m in (1, 6) for d in (3, 4, 9)]
    warehouse.load_quotes(store, quotes(spark, *[(t, d, 10 + i + (t == "B")) for i, d in enumerate(days) for t in "AB"]))
    assert derive(rebuild=False) == ({"2021", "2022", "2023"}, {"2021", "2022", "2023"})
    warehouse.load_quotes(store, quotes(spark, ("A", "2024-01-02", 33)))
    assert derive(rebuild=False) == ({"2024"}, {"2024"})
    warehouse.load_quotes(store, quotes(spark, ("A", "2024-01-05", 35)))  # takes the place of the month's row
    assert derive() == ({"2024"}, {"2024"}) and 20240102 not in {r[1] for r in figures(store, "fato_indicadores")}
    warehouse.load_events(store, events(spark, "B", "2022-01-04", "1.5"), "hist_dividendos", DIVIDEND)
    assert derive(rebuild=False) == ({"2021", "2022"}, {"2022"})
    warehouse.load_events(store, splits(spark, "A", "2023-06-04", "2"), "hist_desdobramento", SPLIT)
    assert derive() == ({"2021", "2022", "2023"}, set())
    warehouse.load_events(store, events(spark, "A", "2024-06-03", "2"), "hist_dividendos", DIVIDEND)  # after the last session
    warehouse.load_quotes(store, quotes(spark, ("A", "2024-02-02", 40)))  # moves the price that the dividend is taken from
    assert derive()[0] == {"2021", "2022", "2023", "2024"}
    rate = spark.createDataFrame([(0, "SELIC", date(2024, 2, 2), Decimal("0.05"))], "id_staging bigint, cd_indicador string, dt_data date, vl_indicador decimal(18,6)")
    warehouse.load_series(store, rate, "SELIC")
    shares = spark.createDataFrame([("A", "77", 4000)], "cd_ticker string, cd_cvm string, nr_total_acoes bigint")
    store.overwrite(store.read("dim_acao").withColumn("id_tipo_acao", F.lit(1)), "dim_acao")
    warehouse.load_shares(store, shares.withColumn("cd_ticker", F.lit("A")))
    assert derive()[1] == {"2021", "2022", "2023", "2024"}
    log = store.read("log_auditoria").filter("ds_tabela = 'dim_acao'").collect()
    assert [r.ds_operacao for r in log] == ["UPDATE"] and '"nr_total_acoes":1000' in log[0].ds_dados_antes and '"nr_total_acoes":4000' in log[0].ds_dados_depois


# ---- statements -----------------------------------------------------------------------------------


def accounts(spark, version, value, day="2024-05-01", account="3.01", scale=None):
    row = (0, "77", date(2023, 12, 31), account, "conta", Decimal(value), "DRE", version, scale, day)
    schema = "id_staging bigint, cd_cvm string, dt_data date, cd_conta string, ds_conta string, vl_conta decimal(20,2), ds_tipo_dem string, nr_versao int, ds_escala string, dt string"
    return spark.createDataFrame([row], schema).withColumn("dt_carga", F.to_timestamp("dt")).drop("dt")


def test_an_older_version_that_comes_late_does_not_win(spark, market_store):
    store = market_store
    revenue = lambda: [float(r[0]) for r in store.read("fato_dem_financeira").select("vl_receita_liquida").collect()]
    warehouse.load_statements(store, accounts(spark, 2, "1100", "2024-05-01"))
    assert revenue() == [1100.0]
    warehouse.load_statements(store, accounts(spark, 1, "1000", "2024-06-01"))
    assert revenue() == [1100.0]
    warehouse.load_statements(store, accounts(spark, 3, "1200", "2024-07-01"))
    warehouse.load_statements(store, accounts(spark, 3, "9999", "2024-08-01"))  # a version is taken once
    warehouse.load_statements(store, accounts(spark, 1, "-5", "2024-08-01", "3.11"))
    assert rows_of(store.read("fato_dem_financeira").select("vl_receita_liquida", "vl_lucro_liquido")) == [(1200.0, -5.0)]
    history = store.read("hist_dem_versao")
    on = lambda d: [float(r.vl_conta) for r in fundamentals.known_versions(history, d).filter("cd_conta = '3.01'").collect()]
    assert [on(d) for d in ("2024-04-30", "2024-06-15", "2024-07-01")] == [[], [1100.0], [1200.0]]
    spans = fundamentals.validity(history.filter("cd_conta = '3.01'")).select("nr_versao", "dt_inicio", "dt_fim")
    assert rows_of(spans, "nr_versao") == [(2, date(2024, 5, 1), date(2024, 7, 1)), (3, date(2024, 7, 1), None)]


def test_statements_of_other_years_keep_their_files_and_scale_is_a_choice(spark, market_store):
    store = market_store
    warehouse.load_statements(store, accounts(spark, 1, "7", scale="MIL").withColumn("dt_data", F.lit(date(2022, 12, 31))))
    before = store.folders("fato_dem_financeira")
    warehouse.load_statements(store, accounts(spark, 1, "7", scale="MIL"), whole=True)
    assert set(before) < set(store.folders("fato_dem_financeira"))
    rows = rows_of(store.read("fato_dem_financeira").select("id_data", "vl_receita_liquida", "id_fato"), "id_data")
    assert [r[:2] for r in rows] == [(20221231, 7.0), (20231231, 7000.0)] and len({r[2] for r in rows}) == 2


def test_equal_days_go_by_the_order_column(spark):
    left = spark.createDataFrame([(1, date(2024, 1, 5))], "k int, d date")
    right = spark.createDataFrame([(1, date(2024, 1, 1), 9, 1), (1, date(2024, 1, 1), 5, 2)], "k int, d date, v int, version int")
    assert joins.asof_latest(left, right, "k", "d", ["v"]).collect()[0].v == 9
    assert joins.asof_latest(left, right, "k", "d", ["v"], latest_by="version").collect()[0].v == 5


# ---- companies ------------------------------------------------------------------------------------


def test_segments_and_subsectors_reach_the_companies(spark, store):
    warehouse.create_tables(store, "2024-01-01", "2024-12-31")
    rows = [(1, "77", "x", "Razao", "Nome", "Banco", True, None, None), (2, "88", "x", "Outra", "Outra", "Banco", True, None, None)]
    registry = spark.createDataFrame(rows, "id_staging bigint, cd_cvm string, nr_cnpj string, ds_razao_social string, ds_nome_pregao string, ds_setor_atividade string, fl_ativa boolean, dt_listagem date, dt_constituicao date")
    sectors = spark.createDataFrame([("Banco", "FIN")], "ds_setor_atividade string, cd_setor string")
    listing = spark.createDataFrame([("77", "NM", "BANCOS"), ("88", "XX", "BANCOS")], "cd_cvm string, cd_segmento string, cd_subsetor string")
    for _ in range(2):
        warehouse.load_companies(store, registry, sectors, listing)
    found = rows_of(store.read("dim_empresa").select("cd_cvm", "id_setor", "id_segmento", "id_subsetor"), "cd_cvm")
    assert found == [("77", 1, 1, 1), ("88", 1, None, 1)]
    assert rows_of(store.read("dim_subsetor").select("id_subsetor", "id_setor", "cd_subsetor")) == [(1, 1, "BANCOS")]
    assert {r.ds_erro for r in store.read("etl_log_erros").collect()} == {"unknown cd_segmento"}
    assert [r.ds_operacao for r in store.read("log_auditoria").collect()] == ["INSERT"] * 2
    risk = spark.createDataFrame([(1, 0.1, 0.2, 0.3)], "id_acao int, vl_retorno_diario double, vl_volatilidade double, vl_sharpe double")
    shares = spark.createDataFrame([(1, 1)], "id_acao int, id_empresa int").join(store.read("dim_empresa"), "id_empresa").join(store.read("dim_segmento_listagem"), "id_segmento")
    assert [r.cd_segmento for r in market.sharpe_by_segment(risk, shares).collect()] == ["NM"]


def test_block_keys_are_dense_without_a_sort(spark):
    rows = with_block_keys(spark.range(0, 1000, 1, 7), "n", 5)
    assert sorted(r.n for r in rows.collect()) == list(range(5, 1005))
    assert "rangepartitioning" not in rows._jdf.queryExecution().executedPlan().toString()


# ---- files and streams ----------------------------------------------------------------------------


def test_a_repeated_file_in_a_mixed_folder_is_left_out_alone(store, tmp_path):
    source = csv_files.series_source("SELIC", "11")
    for folder, names in (("one", "ab"), ("two", "bc")):
        (tmp_path / folder).mkdir()
        for name in names:
            (tmp_path / folder / f"{name} x.csv").write_text(f"data;valor\n01/01/2024;{ord(name)}\n")
    first = loading.load_source(store, source, str(tmp_path / "one"), skip_repeated=True).first()
    second = loading.load_source(store, source, str(tmp_path / "two"), skip_repeated=True).first()
    assert (first.registros_carregados, second.registros_carregados, second.id_carga) == (2, 1, 2)
    ledger = sorted((r.id_carga, r.ds_arquivo[-7:], len(r.ds_checksum)) for r in store.read("etl_arquivos").collect())
    assert ledger == [(1, "a x.csv", 64), (1, "b x.csv", 64), (2, "c x.csv", 64)]
    assert [r.vl_indicador for r in store.read("stg_indicadores_macro").collect()] == [str(ord("c"))]


def test_many_loads_leave_one_file_a_log(store, tmp_path):
    (tmp_path / "s.csv").write_text("data;valor\n01/01/2024;1\nx\n")
    plan = [(f"S{i}", csv_files.series_source(f"S{i}", str(i))) for i in range(4)]
    loading.full_extract(store, {name: str(tmp_path / "s.csv") for name, _ in plan} | {"S3": "/none"}, plan)
    for table in ("etl_controle_carga", "etl_log_erros", "etl_arquivos"):
        [folder] = store.folders(table)
        assert len([f for f in os.listdir(folder) if f.endswith(".parquet")]) == 1
    assert sorted(r.id_carga for r in store.read("etl_controle_carga").collect()) == [1, 2, 3, 4]
    numbers = [r.id_erro for r in store.read("etl_log_erros").collect()]
    assert len(numbers) == len(set(numbers)) == 5


def test_quotes_stream_into_the_store_and_a_batch_is_taken_once(spark, market_store, tmp_path):
    store, folder, checkpoint = market_store, tmp_path / "in", str(tmp_path / "check")
    folder.mkdir()
    head = "ticker,date,open,close,high,low,volume\n"

    def arrive(name, *lines):
        (folder / name).write_text(head + "".join(f"{t},{d},{c},{c},{c},{c},1\n" for t, d, c in lines) + "A,2024-01-09\n,2024-01-09,1,1,1,1,1\n")
        stream.stream_quotes(store, str(folder), checkpoint).awaitTermination()

    arrive("1.csv", ("A", "2024-01-02", 10), ("A", "2024-01-04", 30))
    arrive("2.csv", ("A", "2024-01-03", 20), ("A", "2024-01-02", 99), ("?", "2024-01-03", 1))
    assert returns(store) == [(1, 20240102, None), (1, 20240103, 1.0), (1, 20240104, 0.5)]
    reasons = sorted(r.ds_erro for r in store.read("etl_log_erros").collect())
    assert reasons == ["malformed line"] * 2 + ["ticker missing"] * 2 + ["unknown cd_ticker"]
    done = [v for k, v in store.snapshot().marks.items() if k.startswith("stream.")]
    assert done == [2]
    # The last batch comes again, as after a failure between the commit and the checkpoint's own note of it.
    (tmp_path / "check" / "commits" / "1").unlink()
    (tmp_path / "check" / "commits" / ".1.crc").unlink(missing_ok=True)
    number = store.versions()[-1]
    stream.stream_quotes(store, str(folder), checkpoint).awaitTermination()
    assert store.versions()[-1] == number


def test_state_of_a_stream_repairs_the_session_after_a_late_quote(spark, tmp_path):
    schema = "id_acao int, id_data int, vl_fechamento decimal(18,4), place int"

    def run(name, batches, **options):
        for i, rows in enumerate(batches):
            values = [(a, d, None if c is None else Decimal(c), p) for a, d, c, p in rows]
            spark.createDataFrame(values, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / name / "in" / str(i)))
            arriving = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(str(tmp_path / name / "in"))
            rows = stream.stateful_returns(arriving, order="place", **options)
            stream.write_changes(rows, str(tmp_path / name / "out"), str(tmp_path / name / "check")).awaitTermination()
        last = stream.latest_changes(spark.read.parquet(str(tmp_path / name / "out")), ["id_acao", "id_data"])
        return rows_of(last.select("id_acao", "id_data", "vl_retorno_diario"), "id_acao", "id_data")

    first = [(1, 20240102, "10", 1), (1, 20240105, "30", 2), (2, 20240102, "7", 3), (1, 20240102, "99", 9), (None, 20240102, "1", 1), (1, 20240101, None, 1)]
    second = [(1, 20240103, "20", 1), (1, 20240105, "1", 1), (1, 20231229, "5", 2)]
    assert run("all", [first, second]) == [(1, 20231229, None), (1, 20240102, 1.0), (1, 20240103, 1.0), (1, 20240105, 0.5), (2, 20240102, None)]
    assert run("short", [first, second], keep=2) == [(1, 20240102, None), (1, 20240103, 1.0), (1, 20240105, 0.5), (2, 20240102, None)]


# ---- windows and periods over the stored fact -----------------------------------------------------


def test_any_window_takes_two_lookups(spark):
    from quotewell.operators.returns import growth_to_date, window_returns

    days = [(1, 20240102, None), (1, 20240103, "0.10"), (1, 20240105, "0.20"), (1, 20240110, "-1"), (1, 20240111, None), (2, 20240103, "0.50")]
    fact = spark.createDataFrame([(a, d, r and Decimal(r)) for a, d, r in days], "id_acao int, id_data int, vl_retorno_diario decimal(10,6)")
    asked = [("a", 1, 20240101, 20240104), ("b", 1, 20240103, 20240105), ("c", 1, 20240104, 20240104), ("d", 1, 20240105, 20240201), ("e", 1, 20240111, 20240111),
             ("f", 2, 20230101, 20250101), ("g", 3, 20230101, 20250101), ("h", 1, 20240105, 20240103), ("b", 1, 20240103, 20240105), ("i", None, 20240101, 20240301)]
    windows = spark.createDataFrame(asked, "nome string, id_acao int, de int, ate int")
    out = window_returns(windows, growth_to_date(fact), "de", "ate")
    found = sorted((r.nome, r.vl_retorno and round(r.vl_retorno, 9)) for r in out.collect())
    assert found == [("a", 0.1), ("b", 0.32), ("b", 0.32), ("c", None), ("d", -1.0), ("e", None), ("f", 0.5), ("g", None), ("h", None), ("i", None)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_crisis_study_reads_the_years_of_its_phases(spark, market_store):
    store = market_store
    rows = [("A", f"{y}-{m:02d}-05", 10 + y % 7 + m) for y in (2021, 2022, 2023, 2024) for m in (1, 2, 3)]
    warehouse.load_quotes(store, quotes(spark, *rows))
    periods = spark.createDataFrame([("X", date(2023, 1, 20), date(2023, 2, 20)), ("never", date(2023, 2, 1), date(2023, 1, 1))], "ds_crise string, dt_inicio date, dt_fim date")
    out = market.crisis_study(store.read("fato_cotacao"), periods)
    assert "dynamicpruning" in out._jdf.queryExecution().executedPlan().toString().lower()
    plain = market.crisis_study(store.read("fato_cotacao").drop("nr_ano"), periods)
    assert rows_of(out, "fase") == rows_of(plain, "fase") and {r.fase for r in out.collect()} == {"antes", "durante", "depois"}
