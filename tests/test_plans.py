"""What the physical plans must keep: pushed filters, pruned columns, few shuffles."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture
def fact(spark, tmp_path):
    """Stored quotes and splits, as a warehouse holds them."""
    from catalogue.roles import Market

    m = Market(spark, SF)
    quotes = m.quotes.select("id_acao", "id_data", "vl_fechamento", "vl_volume", "vl_retorno_diario")
    quotes.write.parquet(str(tmp_path / "q"))
    return m, spark.read.parquet(str(tmp_path / "q"))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_date_bounds_reach_the_scan(fact):
    from quotewell.plans.market import rate_against_sector

    m, quotes = fact
    text = plan(rate_against_sector(quotes, m.acao, m.empresa, m.setor, m.macro, m.indicators, "1996-01-01", "1996-12-31", "EUROPE"))
    scan = next(line for line in text.splitlines() if "FileScan" in line and "vl_retorno_diario" in line)
    assert "GreaterThanOrEqual(id_data,19960101)" in scan
    assert "ReadSchema: struct<id_acao:bigint,id_data:int,vl_retorno_diario:decimal(10,6)>" in scan


def test_two_windows_take_one_scan_and_one_shuffle(fact):
    from quotewell.plans.market import two_period_returns

    _, quotes = fact
    text = plan(two_period_returns(quotes, ("1997-01-01", "1997-12-31"), ("1998-01-01", "1998-12-31")))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1 and "partial_product" in text


def test_adjustment_shuffles_quotes_once_and_sorts_each_way_once(fact):
    from quotewell.operators.corporate import adjusted_prices

    m, quotes = fact
    text = plan(adjusted_prices(quotes.select("id_acao", "id_data", "vl_fechamento"), m.splits, m.dividends))
    assert text.count("Sort ") == 2
    assert text.count("hashpartitioning(id_acao#") == 3  # the union by share; splits and dividends by share and day


def test_rolling_risk_is_one_shuffle_and_one_sort(fact):
    from quotewell.operators.returns import with_rolling_risk

    text = plan(with_rolling_risk(fact[1].select("id_acao", "id_data", "vl_retorno_diario")))
    assert text.count("Exchange") == 1 and text.count("Sort ") == 1


def test_first_row_per_key_thins_before_the_shuffle(spark):
    from quotewell.operators.joins import keep_first

    lines = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_orderkey", "l_linenumber")
    text = plan(keep_first(lines, ["l_orderkey"], [F.desc("l_linenumber")]))
    assert "Partial" in text and text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_no_cross_joins_in_any_market_query(spark):
    import __spark_entry__ as entry

    for name in ("an1_rate_vs_sector_return", "an2_resilience", "an8_indicator_fact", "an11_crisis_phases", "j9_period_tag", "j10_asof_statement"):
        text = plan(entry.queries()[name](spark, SF))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
        assert "ArrowEvalPython" not in text and "BatchEvalPython" not in text, name
