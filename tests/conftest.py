from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from fleetgauge.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", app="fleetgauge-tests", **{"spark.sql.shuffle.partitions": "4"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Evaluate an expression over the values of one column."""

    def evaluate(values, kind, expression):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
        return [r.y for r in df.select("i", expression.alias("y")).orderBy("i").collect()]

    return evaluate
