from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    def make(ddl: str, *rows):
        return spark.createDataFrame(list(rows), ddl)

    return make


def column(df, name, order):
    return [r[name] for r in df.orderBy(*([order] if isinstance(order, str) else order)).collect()]
