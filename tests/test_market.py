from __future__ import annotations

from decimal import Decimal

from conftest import day, rows_of
from pyspark.sql import functions as F

from quotewell.plans import market


def dimensions(spark, tickers):
    setor = spark.createDataFrame([(1, "FIN", "Financeiro")], "id_setor int, cd_setor string, ds_setor string")
    empresa = spark.createDataFrame([(10, 1)], "id_empresa int, id_setor int")
    acao = spark.createDataFrame([(i, t, 10, True) for i, t in enumerate(tickers, 1)], "id_acao int, cd_ticker string, id_empresa int, fl_ativa boolean")
    return acao, empresa, setor


def test_rate_against_sector(spark):
    acao, empresa, setor = dimensions(spark, "AB")
    returns = [(1, 20200102, "0.01"), (1, 20200103, "0.02"), (2, 20200102, None), (1, 20200203, "0.5"), (1, 20171229, "9")]
    quotes = spark.createDataFrame([(a, d, r and Decimal(r)) for a, d, r in returns], "id_acao int, id_data int, vl_retorno_diario decimal(10,6)")
    indicators = spark.createDataFrame([(1, "SELIC")], "id_indicador int, cd_indicador string")
    macro = spark.createDataFrame([(1, 20200102, Decimal("0.017089")), (1, 20170102, Decimal("9"))], "id_indicador int, id_data int, vl_indicador decimal(18,6)")
    found = rows_of(market.rate_against_sector(quotes, acao, empresa, setor, macro, indicators), "nr_ano", "nr_mes")
    assert found == [(2020, 1, 31.5, 0.0171, 31.4829)]
    scaled = rows_of(market.rate_against_sector(quotes, acao, empresa, setor, macro, indicators, compound_rate=True))
    assert scaled == [(2020, 1, 31.5, 0.3589, 31.1411)]


def test_resilience_rows(spark):
    acao, empresa, setor = dimensions(spark, "ABCDE")
    years = {1: ("0.10", "0.02"), 2: ("-0.20", "-0.10"), 3: ("-0.20", "-0.16"), 4: ("0.50", "-0.01"), 5: (None, "0.30")}
    rows = [(a, d, Decimal(r)) for a, pair in years.items() for d, r in zip((20190601, 20200601), pair) if r]
    quotes = spark.createDataFrame(rows, "id_acao int, id_data int, vl_retorno_diario decimal(10,6)")
    classified = market.resilience(quotes, acao, empresa, setor)
    assert classified.columns[2:4] == ["retorno_2019_pct", "retorno_2020_pct"]
    assert rows_of(classified.drop("ds_setor"), F.desc("variacao")) == [
        ("B", -20.0, -10.0, 10.0, "Resiliente"),
        ("C", -20.0, -16.0, 4.0, "Impactada"),
        ("A", 10.0, 2.0, -8.0, "Alta na crise"),
        ("D", 50.0, -1.0, -51.0, "Impactada"),
    ]
    by_sector = rows_of(market.sector_resilience(classified), "classificacao")
    assert by_sector == [("Financeiro", "Alta na crise", 1, -8.0), ("Financeiro", "Impactada", 2, -23.5), ("Financeiro", "Resiliente", 1, 10.0)]


def test_phases_are_as_long_as_the_crisis(spark):
    periods = spark.createDataFrame([("x", day("2024-01-11"), day("2024-01-20"))], "ds_crise string, dt_inicio date, dt_fim date")
    found = {r.fase: (str(r.dt_inicio), str(r.dt_fim)) for r in market.crisis_phases(periods).collect()}
    assert found == {
        "antes": ("2024-01-01", "2024-01-10"),
        "durante": ("2024-01-11", "2024-01-20"),
        "depois": ("2024-01-21", "2024-01-30"),
    }


def test_return_function_in_sql(spark):
    rows = [("A", day("2020-01-02"), Decimal("0.1")), ("A", day("2020-01-03"), Decimal("-0.1")), ("A", day("2020-01-06"), None)]
    spark.createDataFrame(rows, "cd_ticker string, dt_data date, vl_retorno_diario decimal(10,6)").createOrReplaceTempView("q_test")
    market.register_return_function(spark, "q_test", "fn_teste")
    found = spark.sql("SELECT fn_teste('A', DATE '2020-01-01', DATE '2020-12-31'), fn_teste('B', DATE '2020-01-01', DATE '2020-12-31')").first()
    assert round(found[0], 9) == -0.01 and found[1] is None
