from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from staylens.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate a column expression over a list of inputs."""

    def evaluate(values, kind, expression):
        from pyspark.sql import functions as F

        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"i INT, x {kind}")
        result = df.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()
        return [r.y for r in result]

    return evaluate
