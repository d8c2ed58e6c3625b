"""Session settings for the library's own entry points and tests."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "ledgerloom", **conf: str) -> SparkSession:
    """A session with adaptive execution on; ``master`` is left to spark-submit when not given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(cpus: int | None = None) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    n = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    return build_session(
        f"local[{n}]",
        **{"spark.sql.shuffle.partitions": str(n), "spark.driver.memory": "8g",
           "spark.sql.parquet.aggregatePushdown": "true"},
    )
