"""Sinks: partitioned tables; a write becomes visible as a whole by the commit protocol."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

TICKER_BUCKETS = 512


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition: str | None = None, buckets: int | None = None) -> str:
    """Write a table, partitioned by a column or, for many tickers, by a hash bucket of the ticker.

    Rows of a partition are written where they are: no shuffle gathers a large company in one task.
    """
    out = df
    keys = [partition] if partition else []
    if buckets:
        out = df.withColumn("ticker_bucket", F.pmod(F.xxhash64("ticker"), F.lit(buckets)).cast("int"))
        keys = ["ticker_bucket"]
    writer = out.write.mode("overwrite").format(fmt)
    if keys:
        writer = writer.partitionBy(*keys)
    writer.save(path)
    return path
