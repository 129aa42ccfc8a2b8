from __future__ import annotations

import random
from datetime import date, timedelta

from conftest import day, rows_of
from pyspark.sql import functions as F

from quotewell.operators import aggregates, joins, keys, quality
from quotewell.operators.audit import audit_changes


def test_asof_takes_the_latest_on_or_before(spark):
    rng = random.Random(1)
    left = [(k, date(2024, 1, 1) + timedelta(days=d), k * 100 + d) for k in (1, 2) for d in range(0, 60, 3)]
    right = {(rng.choice([1, 2]), date(2024, 1, 1) + timedelta(days=rng.randrange(60))): float(i) for i in range(15)}
    a = spark.createDataFrame(left, "k int, d date, n int")
    b = spark.createDataFrame([(k, d, v) for (k, d), v in right.items()], "k int, d date, v double")
    for lag in (0, 5):
        found = rows_of(joins.asof_latest(a, b, "k", "d", ["v"], lag_days=lag), "k", "d")
        for k, d, _, v in found:
            known = [(p, x) for (q, p), x in right.items() if q == k and p + timedelta(days=lag) <= d]
            assert v == (max(known)[1] if known else None)


def test_overlapping_periods_fan_out_and_other_rows_stay(spark):
    days = spark.createDataFrame([(day(d),) for d in ("2024-01-31", "2024-02-01", "2024-02-10", "2024-05-01")], "dt date")
    periods = spark.createDataFrame(
        [("a", day("2024-01-31"), day("2024-02-09")), ("b", day("2024-02-01"), day("2024-02-29"))],
        "ds_crise string, dt_inicio date, dt_fim date",
    )
    found = rows_of(joins.tag_periods(days, periods, "dt", ["ds_crise"]), "dt", "ds_crise")
    assert [(str(d), c) for d, c in found] == [
        ("2024-01-31", "a"), ("2024-02-01", "a"), ("2024-02-01", "b"), ("2024-02-10", "b"), ("2024-05-01", None),
    ]


def test_monthly_value_on_every_day(spark):
    monthly = spark.createDataFrame([(day("2024-01-31"), 0.42)], "dt date, v double")
    found = rows_of(joins.expand_monthly(monthly, "dt"), "dt")
    assert len(found) == 31 and found[0] == (0.42, date(2024, 1, 1)) and found[-1] == (0.42, date(2024, 1, 31))


def test_insert_if_absent_twice_changes_nothing(spark):
    schema = "k int, d int, v int"
    target = spark.createDataFrame([(1, 10, 0)], schema)
    batch = spark.createDataFrame([(1, 10, 5), (1, 11, 7), (1, 11, 6), (2, 10, 1)], schema)
    new = joins.insert_if_absent(target, batch, ["k", "d"], [F.col("v")], prune_on=["d"])
    assert rows_of(new, "k", "d") == [(1, 11, 6), (2, 10, 1)]
    assert joins.insert_if_absent(target.union(new), batch, ["k", "d"], [F.col("v")], prune_on=["d"]).count() == 0
    assert joins.insert_if_absent(target, batch.limit(0), ["k", "d"], [F.col("v")], prune_on=["d"]).count() == 0


def test_scd1_twice_equals_once(spark):
    first, second = F.lit("2024-01-01").cast("timestamp"), F.lit("2024-02-01").cast("timestamp")
    empty = spark.createDataFrame([], "k int, a string, dt_criacao timestamp, dt_atualizacao timestamp")
    start = joins.scd1_upsert(empty, spark.createDataFrame([(1, "x"), (2, "y")], "k int, a string"), "k", ["a"], first)
    batch = spark.createDataFrame([(2, None), (3, "z")], "k int, a string")
    once = joins.scd1_upsert(start, batch, "k", ["a"], second)
    found = [(r.k, r.a, r.dt_criacao.month, r.dt_atualizacao.month) for r in once.orderBy("k").collect()]
    assert found == [(1, "x", 1, 1), (2, "y", 1, 1), (3, "z", 2, 2)]
    third = F.lit("2024-03-01").cast("timestamp")
    assert rows_of(joins.scd1_upsert(once, batch, "k", ["a"], third), "k") == rows_of(once, "k")


def test_orphans_and_delete_guard(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (9,), (9,), (None,)], "p int")
    parent = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    assert rows_of(joins.orphan_keys(child, "p", parent, "id"), "p") == [(9, 2)]
    assert rows_of(joins.guard_deletes(parent, child, "id", "p"), "id") == [(1, False), (2, False), (3, True)]


def test_unknown_natural_key_gives_null(spark):
    df = spark.createDataFrame([("A",), ("B",)], "t string")
    dim = spark.createDataFrame([("A", 1)], "t string, id int")
    assert rows_of(joins.lookup_key(df, dim, "t", "id"), "t") == [("A", 1), ("B", None)]


def test_scd1_keeps_what_the_batch_does_not_know(spark):
    first, second = [F.lit(d).cast("timestamp") for d in ("2024-01-01", "2024-02-01")]
    current = spark.createDataFrame([(1, "x", 7)], "k int, a string, other int").withColumns({"dt_criacao": first, "dt_atualizacao": first})
    merged = joins.scd1_upsert(current, spark.createDataFrame([(1, None)], "k int, a string"), "k", ["a"], second)
    assert rows_of(merged.select("a", "other", F.to_date("dt_atualizacao").cast("string"))) == [("x", 7, "2024-01-01")]


def test_key_lookup_plans_without_a_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan", "plan")
    joins.lookup_key(spark.range(10).select(F.col("id").alias("t")), spark.range(3).select(F.col("id").alias("t"), "id"), "t", "id")
    assert not tracker.getJobIdsForGroup("plan")


def test_sector_without_company_counts_zero(spark):
    setor = spark.createDataFrame([(1, "FIN", "f"), (2, "TI", "t")], "id_setor int, cd_setor string, ds_setor string")
    empresa = spark.createDataFrame([(10, 1)], "id_empresa int, id_setor int")
    acao = spark.createDataFrame([(100, 10), (101, 10)], "id_acao int, id_empresa int")
    counts = spark.createDataFrame([(100, 7)], "id_acao int, pregoes bigint")
    found = rows_of(joins.left_chain_counts(setor, empresa, acao, counts), "cd_setor")
    assert found == [("FIN", "f", 2, 7), ("TI", "t", 0, 0)]


def test_empty_staging_sums_are_null(spark):
    empty = spark.createDataFrame([], "fl_processado int")
    assert rows_of(aggregates.state_summary(empty, "t")) == [("t", 0, None, None, None)]


def test_pivot_keeps_signs_and_leaves_other_accounts_out(spark):
    rows = spark.createDataFrame([("9512", "3.01", 1100.0), ("9512", "3.11", -50.0), ("9512", "7", 1.0)], "c string, a string, v double")
    out = aggregates.pivot_measures(rows, ["c"], "a", "v", {"receita": ["3.01"], "lucro": ["3.11"], "ativo": ["1"]}, "decimal(20,2)")
    assert rows_of(out) == [("9512", 1100.0, -50.0, None)]


def test_dense_keys_have_no_gaps_and_follow_the_order(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("n"))
    found = rows_of(keys.with_dense_keys(df, ["n"], "k", start=11, partitions=6), "n")
    assert [k for _, k in found] == list(range(11, 5011))


def test_first_row_per_key(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 5, "c")], "k int, o int, v string")
    assert rows_of(joins.keep_first(df, ["k"], [F.col("o")]), "k") == [(1, 1, "a"), (2, 5, "c")]


def test_quality_rules(spark):
    quotes = spark.createDataFrame(
        [(1, 20240102, 1.0, 1.0, 2.0, 3.0, -1), (1, 20240102, 1.0, None, 3.0, 2.0, 5), (None, 20240102, 1.0, 1.0, None, 2.0, 5)],
        "id_acao int, id_data int, vl_abertura double, vl_fechamento double, vl_maximo double, vl_minimo double, vl_volume int",
    )
    found = dict(rows_of(quality.check_table(quotes, "fato_cotacao")))
    assert found["high at or above low"] == 1 and found["volume not negative"] == 1
    assert found["vl_fechamento is required"] == 1 and found["vl_maximo is required"] == 1 and found["id_acao is required"] == 1
    assert rows_of(quality.duplicate_keys(quotes.filter("id_acao = 1"), ["id_acao", "id_data"])) == [(1, 20240102, 2)]


def test_widths_precision_and_lists(spark):
    df = spark.createDataFrame([("abc", 99999.0), ("ab", 1.0), (None, None)], "t string, v double")
    rules = quality.width_rules({"t": 2}) | quality.precision_rules({"v": "decimal(5,2)"}) | quality.allowed_rules({"t": ["ab"]})
    assert [n for _, n in quality.count_violations(df, rules).collect()] == [1, 1, 1]


def test_audit_images(spark):
    schema = "k int, v string"
    old = spark.createDataFrame([(1, "a"), (2, "b"), (4, "d")], schema)
    new = spark.createDataFrame([(1, "a"), (2, "c"), (3, "d")], schema)
    out = audit_changes(old, new, ["k"], "t").select("k", "ds_operacao", "ds_dados_antes", "ds_dados_depois")
    assert rows_of(out, "k") == [
        (2, "UPDATE", '{"k":2,"v":"b"}', '{"k":2,"v":"c"}'),
        (3, "INSERT", None, '{"k":3,"v":"d"}'),
        (4, "DELETE", '{"k":4,"v":"d"}', None),
    ]
