from __future__ import annotations

import math
import random
import statistics
from decimal import Decimal

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from quotewell.operators import corporate, returns


def test_daily_return(bars):
    found = rows_of(returns.with_daily_return(bars({1: ["10", "11", "9.9"], 2: ["5", "0", "5"]})), "id_acao", "id_data")
    assert [r[-1] for r in found] == [None, 0.1, -0.1, None, -1.0, None]


def test_return_half_way_rounds_up(bars):
    found = rows_of(returns.with_daily_return(bars({1: ["16", "16.000008"]}).withColumn("vl_fechamento", F.col("vl_fechamento"))), "id_data")
    assert found[1][-1] == 0.0  # four digits kept: 16.0000
    found = rows_of(returns.with_daily_return(bars({1: ["160", "160.0004"]})), "id_data")
    assert found[1][-1] == 0.000003  # 0.0000025 exactly


def test_cumulative_return_and_endpoints(bars):
    quotes = returns.with_daily_return(bars({1: ["10", "11", "9.9"], 2: ["7"]}))
    window = {"r": ("2024-01-01", "2024-01-31"), "outside": ("2023-01-01", "2023-12-31")}
    assert rows_of(returns.cumulative_returns(quotes, window), "id_acao") == [(1, -0.01, None), (2, None, None)]
    ends = rows_of(returns.endpoint_returns(quotes, {"r": window["r"]}), "id_acao")
    assert ends[0][1] == pytest.approx(-0.01) and ends[1][1] == 0.0


def test_rolling_risk_against_plain_formula(spark):
    rng = random.Random(7)
    series = {share: [round(rng.uniform(-0.05, 0.05), 6) for _ in range(40)] for share in (1, 2)}
    series[2][5] = None
    rate = 0.04
    rows = [
        (share, 20240000 + i, None if r is None else Decimal(str(r)), Decimal(str(rate)))
        for share, values in series.items()
        for i, r in enumerate(values)
    ]
    df = spark.createDataFrame(rows, "id_acao int, id_data int, vl_retorno_diario decimal(10,6), taxa decimal(18,6)")
    out = returns.with_rolling_risk(df, window=10, min_returns=9, rate="taxa")
    for share, key, _, _, volatility, sharpe in rows_of(out.select("id_acao", "id_data", "vl_retorno_diario", "taxa", "vl_volatilidade", "vl_sharpe"), "id_acao", "id_data"):
        i = key - 20240000
        known = [r for r in series[share][max(0, i - 9) : i + 1] if r is not None]
        if len(known) < 9:
            assert volatility is None and sharpe is None
            continue
        expected = statistics.stdev(known) * math.sqrt(252)
        assert volatility == pytest.approx(expected, abs=1e-6)
        mean = statistics.mean(r - rate / 100 for r in known)
        assert sharpe == pytest.approx(mean * 252 / expected, abs=1e-5)


def test_flat_returns_have_zero_volatility_and_no_sharpe(spark):
    rows = [(1, i, Decimal("0.010000"), Decimal("0.04")) for i in range(6)]
    df = spark.createDataFrame(rows, "id_acao int, id_data int, vl_retorno_diario decimal(10,6), taxa decimal(18,6)")
    last = rows_of(returns.with_rolling_risk(df, window=5, rate="taxa").select("vl_volatilidade", "vl_sharpe", "id_data"), "id_data")[-1]
    assert last[:2] == (0.0, None)


def events(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


SPLIT = "id_acao int, id_data int, vl_fator decimal(10,4)"
DIVIDEND = "id_acao int, dt_ex date, vl_dividendo decimal(18,6)"


def adjusted(bars, spark, closes, splits=(), dividends=()):
    from conftest import day

    s = spark.createDataFrame([(1, d, Decimal(f)) for d, f in splits], SPLIT)
    v = spark.createDataFrame([(1, day(d) if d else None, Decimal(a)) for d, a in dividends], DIVIDEND)
    out = corporate.adjusted_prices(bars({1: closes}), s, v)
    return rows_of(out, "id_data")


def test_split_divides_earlier_closes(bars, spark):
    found = adjusted(bars, spark, ["20", "22", "11", "12"], splits=[(20240104, "2")])
    assert [r[2] for r in found] == [10, 11, 11, 12]
    assert [r[3] for r in found] == [None, 0.1, 0.0, 0.090909]


def test_dividend_scales_closes_up_to_the_last_day_with_the_right(bars, spark):
    found = adjusted(bars, spark, ["10", "10", "9.5"], dividends=[("2024-01-03", "0.5")])
    assert [r[2] for r in found] == [9.5, 9.5, 9.5]
    assert [r[3] for r in found] == [None, 0.0, 0.0]


def test_events_on_days_without_session(bars, spark):
    rows = [(1, 20240102, Decimal("20")), (1, 20240108, Decimal("10"))]
    quotes = spark.createDataFrame(rows, "id_acao int, id_data int, vl_fechamento decimal(18,4)")
    splits = spark.createDataFrame([(1, 20240105, Decimal("2"))], SPLIT)
    assert [r[2] for r in rows_of(corporate.adjusted_prices(quotes, splits, None), "id_data")] == [10, 10]


def test_several_events_and_impossible_dividends(bars, spark):
    found = adjusted(
        bars, spark, ["40", "40", "10"], splits=[(20240104, "2"), (20240104, "2")], dividends=[("2024-01-02", "50"), (None, "1")]
    )
    assert [r[2] for r in found] == [10, 10, 10]


def test_thousands_of_events_do_not_break_the_factor(spark, bars):
    days = [20200101 + i for i in range(6000)]
    splits = spark.createDataFrame([(1, d, Decimal("9999")) for d in days], SPLIT)
    found = rows_of(corporate.adjusted_prices(bars({1: ["10", "11"]}), splits, None), "id_data")
    assert [r[2] for r in found] == [10, 11]
    early = spark.createDataFrame([(1, 20190101, Decimal("10"))], "id_acao int, id_data int, vl_fechamento decimal(18,4)")
    assert rows_of(corporate.adjusted_prices(early, splits, None))[0][2] == 0.0


def test_trailing_dividends_against_brute_force(spark):
    from datetime import date, timedelta

    rng = random.Random(3)
    start = date(2020, 1, 1)
    paid = [(1, start + timedelta(days=rng.randrange(1200)), Decimal(rng.randrange(1, 500)) / 100) for _ in range(40)]
    days = [start + timedelta(days=d) for d in range(0, 1300, 7)]
    key = lambda d: d.year * 10000 + d.month * 100 + d.day
    quotes = spark.createDataFrame([(1, key(d)) for d in days], "id_acao int, id_data int")
    dividends = spark.createDataFrame([(s, key(d), a) for s, d, a in paid], "id_acao int, id_data int, vl_dividendo decimal(18,6)")
    found = rows_of(corporate.with_trailing_dividends(quotes, dividends), "id_data")
    for (_, _, total), d in zip(found, days):
        assert total == float(sum(a for _, p, a in paid if d - timedelta(days=364) <= p <= d))


def test_rolling_risk_forgets_a_huge_return(spark):
    rows = [(1, i, "9999.000000" if i == 0 else ("0.000100" if i % 2 else "-0.000100")) for i in range(40)]
    df = spark.createDataFrame(rows, "id_acao int, id_data int, r string").select("id_acao", "id_data", F.col("r").cast("decimal(10,6)").alias("vl_retorno_diario"))
    risk = returns.with_rolling_risk(df, window=10).filter("id_data > 12").select("vl_volatilidade").distinct()
    assert rows_of(risk) == [(0.001673,)]


def test_returns_out_of_range_are_found(bars):
    assert rows_of(returns.returns_out_of_range(bars({1: ["0.0001", "2.0000", "2.0000"]})).select("id_data")) == [(20240103,)]
