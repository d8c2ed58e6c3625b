import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Evaluate one expression over a column of literals."""

    def run(items, build, kind="string"):
        from pyspark.sql import functions as F

        rows = [(i, v) for i, v in enumerate(items)]
        df = spark.createDataFrame(rows, f"i int, v {kind}")
        return [r[0] for r in df.orderBy("i").select(build(F.col("v"))).collect()]

    return run
