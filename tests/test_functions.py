from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from conftest import rows_of
from pyspark.sql import functions as F

from quotewell.functions import parsing, valuation
from quotewell.functions.calendar import WEEKDAYS, build_calendar, date_key, date_of, key_literal
from quotewell.functions.labels import resilience_class, volume_status
from quotewell.seeds import seed_names, seed_table


def apply(spark, function, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


def test_dates_in_two_formats(spark):
    found = apply(spark, parsing.parse_date, ["2024-01-15", "15/01/2024", " 01/02/2020 ", "2024-02-30", "", None])
    assert found == [date(2024, 1, 15), date(2024, 1, 15), date(2020, 2, 1), None, None, None]


def test_decimals_with_comma_or_point(spark):
    found = apply(spark, parsing.parse_decimal, ["32.45", "32,45", "1.234,50", "-0,5", "abc", "", None])
    assert found == [Decimal("32.4500"), Decimal("32.4500"), Decimal("1234.5000"), Decimal("-0.5000"), None, None, None]


def test_integers_with_thousands_points(spark):
    assert apply(spark, parsing.parse_integer, ["45230000", "45.230.000", "x", None]) == [45230000, 45230000, None, None]


def test_too_wide_for_its_decimal_is_null(spark):
    assert apply(spark, lambda c: parsing.parse_decimal(c, 5, 2), ["999.99", "1000.00"]) == [Decimal("999.99"), None]


def test_share_type_from_suffix(spark):
    assert apply(spark, parsing.share_type, ["PETR3", "PETR4", "TAEE11", "SANB11"]) == ["ON", "PN", "UNIT", "UNIT"]


def test_active_flag(spark):
    assert apply(spark, parsing.is_active, ["ATIVO", " ativa ", "CANCELADA", None]) == [True, True, False, False]


def test_duration_is_null_while_running(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 1, 8), datetime(2024, 1, 1, 8, 1, 5)), (datetime(2024, 1, 1, 8), None)], "a timestamp, b timestamp"
    )
    assert [r[0] for r in df.select(parsing.duration_seconds(F.col("a"), F.col("b"))).collect()] == [65, None]


def test_json_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert df.select(parsing.row_json("a", "b")).first()[0] == '{"a":1,"b":null}'


def test_text_equality_ignores_case_and_accents(spark):
    assert apply(spark, lambda c: parsing.same_text(c, F.lit("ÚLTIMO")), ["ultimo", "Último", "PENÚLTIMO"]) == [True, True, False]


def test_calendar(spark):
    days = build_calendar(spark, "2000-01-01", "2024-12-31")
    assert days.count() == 9132
    wanted = days.filter("id_data IN (20240114, 20240115)").orderBy("id_data").collect()
    assert [(r.nr_dia_semana, r.ds_dia_semana, r.ds_mes, r.nr_trimestre, r.nr_semestre, r.fl_dia_util) for r in wanted] == [
        (1, "Domingo", "Janeiro", 1, 1, False),
        (2, "Segunda-feira", "Janeiro", 1, 1, True),
    ]
    assert len(WEEKDAYS) == 7


def test_holidays_are_not_business_days(spark):
    holidays = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 1, 1),)], "dt_data date")
    days = build_calendar(spark, "2024-01-01", "2024-01-02", holidays)
    assert rows_of(days.select("id_data", "fl_feriado", "fl_dia_util"), "id_data") == [(20240101, True, False), (20240102, False, True)]


def test_date_keys_go_both_ways(spark):
    df = spark.createDataFrame([(date(2024, 2, 29),)], "d date").withColumn("k", date_key(F.col("d")))
    assert df.select("k", date_of(F.col("k"))).first() == (20240229, date(2024, 2, 29))
    assert key_literal("2024-02-29") == 20240229


def test_class_boundaries_are_decimal(spark):
    rows = [("A", "0.10", "0.02"), ("B", "-0.20", "-0.10"), ("C", "-0.20", "-0.16"), ("D", "0.50", "-0.01")]
    df = spark.createDataFrame([(n, Decimal(a), Decimal(b)) for n, a, b in rows], "n string, a decimal(18,6), b decimal(18,6)")
    found = rows_of(df.select("n", resilience_class(F.col("a"), F.col("b"))), "n")
    assert found == [("A", "Alta na crise"), ("B", "Resiliente"), ("C", "Impactada"), ("D", "Impactada")]


def test_volume_status(spark):
    found = apply(spark, volume_status, [200_000, 199_999], "bigint")
    assert found[0] == "OK" and found[1].startswith("***")


def test_ratios_without_denominator_are_null(spark):
    df = spark.createDataFrame([(Decimal("10.00"), Decimal("0.00")), (Decimal("10.00"), None)], "a decimal(20,2), b decimal(20,2)")
    for ratio in (valuation.price_earnings, valuation.return_on_equity, valuation.dividend_yield):
        assert [r[0] for r in df.select(ratio(F.col("a"), F.col("b"))).collect()] == [None, None]


def test_seed_sizes(spark):
    sizes = {name: seed_table(spark, name).count() for name in seed_names()}
    assert sorted(sizes.values()) == [3, 4, 4, 5, 5, 12]
