"""What keeps the loads' work in step with their rows: shuffles, passes, groups."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import Observation, functions as F

from quotewell.operators.typed import QUOTES as TYPING, apply_typing
from quotewell.plans import derived, warehouse
from quotewell.sources import csv_files, loading
from quotewell.sources.store import Store
from quotewell.streaming import quotes as stream


def test_neighbouring_shares_are_one_group_of_the_streams_state(spark, tmp_path):
    schema = "id_acao int, id_data int, vl_fechamento decimal(18,4)"
    rows = [(a, 20240102 + d, Decimal(10 + a % 3 + d)) for a in (-17, -1, 0, 1, 15, 16) for d in range(3)]
    for day in (20240102, 20240104, 20240103):
        spark.createDataFrame([r for r in rows if r[1] == day], schema).write.mode("append").parquet(str(tmp_path / "in" / str(day)))
        arriving = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
        query = stream.write_changes(stream.stateful_returns(arriving), str(tmp_path / "out"), str(tmp_path / "check"))
        query.awaitTermination()
        states = max(s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"])
        assert states == 4  # -32 to -17, -16 to -1, 0 to 15, 16 to 31
    last = stream.latest_changes(spark.read.parquet(str(tmp_path / "out")), ["id_acao", "id_data"])
    found = {(r.id_acao, r.id_data): r.vl_retorno_diario for r in last.collect()}
    cents = lambda c, b: (c / b - 1).quantize(Decimal("0.000001"))
    closes = {(a, d): c for a, d, c in rows}
    assert found == {(a, d): cents(c, closes[a, d - 1]) if (a, d - 1) in closes else None for (a, d), c in closes.items()}


def test_text_keys_have_a_state_each(spark, tmp_path):
    schema = "cd string, id_data int, vl_fechamento decimal(18,4), place int"
    rows = [("a", 1, Decimal(10), None), ("a", 1, Decimal(20), 5), ("b", 2, Decimal(5), 1)]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    arriving = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    stream.write_changes(stream.stateful_returns(arriving, key="cd", order="place"), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out")).select("cd", "id_data", "vl_fechamento").collect()
    assert sorted((r[0], r[1], int(r[2])) for r in out) == [("a", 1, 20), ("b", 2, 5)]


def test_quotes_are_shuffled_once_for_their_returns_and_their_folders(spark):
    price = ", ".join(f"{c} decimal(18,4)" for c in ("vl_fechamento", "vl_maximo", "vl_minimo"))
    ten, one = Decimal(10), Decimal(1)
    held = spark.createDataFrame([(1, 20240103, 2024, ten, ten, one, Decimal(7), one), (2, 20240103, 2024, ten, ten, one, Decimal(7), one)],
                                 f"id_acao int, id_data int, nr_ano int, {price}, vl_retorno_diario decimal(10,6), vl_amplitude decimal(18,4)")
    seeds = spark.createDataFrame([(1, 2024, 20231229, Decimal(5))], "id_acao int, nr_ano int, id_data int, vl_fechamento decimal(18,4)")
    out = warehouse._with_returns(held, seeds, Observation(), 3)
    # The shares without a seed row keep what they have.
    assert sorted((r.id_acao, r.vl_retorno_diario, r.vl_amplitude) for r in out.collect()) == [(1, one, 9), (2, 7, one)]
    plan = out.sortWithinPartitions("nr_ano")._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("Exchange") == 1 and plan.count("Sort ") == 1


def test_lines_of_a_stream_are_typed_and_kept_apart_in_one_pass(spark, tmp_path):
    (tmp_path / "q.csv").write_text("ticker,date,open,close,high,low,volume\nA,2024-01-02,1,1,1,1,1\nA,2024-01-03\n")
    lines = csv_files.read_text_columns(spark, str(tmp_path / "q.csv"), csv_files.QUOTES)
    out = apply_typing(csv_files.staging_columns(lines, csv_files.QUOTES, with_bad=True), TYPING)
    assert sorted((r._bad_line or "", r.fl_processado) for r in out.collect()) == [("", 1), ("A,2024-01-03", 2)]
    assert len(csv_files.staging_columns(lines, csv_files.QUOTES).collect()) == 1


def test_changed_years_are_found_without_a_join(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    schema = "id_acao int, id_data int, vl_fechamento_aj decimal(18,4), vl_retorno_aj decimal(10,6)"
    one, two = Decimal(1), Decimal(2)
    old = [(1, 20200102, one, None), (1, 20210102, one, two), (1, 20220102, None, one), (1, 20230102, one, one), (2, 20230102, two, two)]
    new = [(1, 20200102, None, one), (1, 20210102, one, two), (1, 20230102, two, two), (2, 20230102, one, one), (1, 20240102, one, one)]
    frames = [spark.createDataFrame(rows, schema) for rows in (old, new)]
    columns = ["id_acao", "id_data", "vl_fechamento_aj", "vl_retorno_aj"]
    assert derived.differing_years(store, "hist_preco_ajustado", *frames, columns) == [2020, 2022, 2023, 2024]
    assert derived.differing_years(store, "hist_preco_ajustado", frames[0], frames[0].orderBy(F.desc("id_data")), columns) == []


def test_pending_rows_are_settled_without_a_shuffle(spark, tmp_path, monkeypatch):
    store, source = Store(spark, str(tmp_path / "store")), csv_files.series_source("SELIC", "11")
    (tmp_path / "s.csv").write_text("data;valor\n01/01/2024;1\n02/01/2024;x\n")
    loading.load_source(store, source, str(tmp_path / "s.csv"))
    gathered = Store._gathered

    def no_staging(self, rows, table):
        assert table != source.table
        return gathered(self, rows, table)

    monkeypatch.setattr(Store, "_gathered", no_staging)
    kept = warehouse.settle_staging(store, source.table, source.name)
    assert [r.dt_data for r in kept.collect()] == [date(2024, 1, 1)]
    assert sorted(r.fl_processado for r in store.read(source.table).collect()) == [1, 2]
