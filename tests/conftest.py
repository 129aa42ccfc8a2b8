from __future__ import annotations

import os
import sys
from datetime import date
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quotewell.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        4,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def bars(spark):
    """Builds quotes (id_acao, id_data, vl_fechamento) from {share: [closes from 2024-01-02 on, day by day]}."""

    def build(closes: dict[int, list[str]]):
        rows = [
            (share, 20240102 + i, Decimal(close)) for share, series in closes.items() for i, close in enumerate(series)
        ]
        return spark.createDataFrame(rows, "id_acao int, id_data int, vl_fechamento decimal(18,4)")

    return build


def day(text: str) -> date:
    return date.fromisoformat(text)


def rows_of(df, *order):
    """Rows as tuples; decimals as float."""
    ordered = df.orderBy(*order) if order else df
    return [tuple(float(v) if isinstance(v, Decimal) else v for v in r) for r in ordered.collect()]
