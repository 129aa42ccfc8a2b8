"""Every registered query against its SQL counterpart on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from catalogue.base import QUERIES
from tools.check_queries import TABLES, cells

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def sql_tables():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql_tables, name):
    mine = entry.queries()[name](spark, SF).toPandas()
    theirs = sql_tables.execute(entry.oracle_sql()[name]).df()
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert cells(mine) == cells(theirs)


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
