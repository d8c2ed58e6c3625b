"""Positions inside groups of any size."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.sources.landing import shared_folder


def landed(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder and read again."""
    place = shared_folder(df.sparkSession, "running")
    df.write.parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)


def running(
    df: DataFrame, keys: list[str], order: list[Column], position: str | None = None, sums: dict[str, Column] | None = None,
    folds: dict[str, Column] | None = None, store: Callable[[DataFrame], DataFrame] = landed,
) -> DataFrame:
    """Row number, running sums and running exclusive-or inside ``keys`` in ``order``, each row itself included.

    The rows are dealt out by measured ranges of keys and order (Spark samples the boundaries), so a group with a third of
    all rows spans many ranges, whether its order values lie close together or far apart. The ranges are written once:
    both the totals of each range and the rows inside it are taken from what was written. A group has at most one row of
    totals per range. ``order`` has to decide between all rows that differ; keys and order values may be missing.
    """
    sums = {**({} if position is None else {position: F.lit(1).cast("bigint")}), **(sums or {})}
    folds = folds or {}
    values = {**sums, **folds}
    cut = [F.col(k).asc() for k in keys] + order
    dealt = df.select("*", *[v.alias(f"_value_{n}") for n, v in values.items()]).repartitionByRange(*cut)
    rows = store(dealt.withColumn("_range", F.spark_partition_id()))

    def total(name: str) -> Column:
        return (F.sum if name in sums else F.bit_xor)(f"_value_{name}")

    def put_together(name: str, a: Column, b: Column) -> Column:
        return a + b if name in sums else a.bitwiseXOR(b)

    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    per_range = rows.groupBy(*keys, "_range").agg(*[total(n).alias(f"_value_{n}") for n in values])
    zero = F.lit(0).cast("bigint")
    before = per_range.select(
        *[F.col(k).alias(f"_its_{k}") for k in [*keys, "_range"]], *[F.coalesce(total(n).over(earlier), zero).alias(f"_before_{n}") for n in values]
    )
    inside = Window.partitionBy(*keys, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = rows.select("*", *[total(n).over(inside).alias(f"_here_{n}") for n in values])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_its_{k}")) for k in [*keys, "_range"]])
    return here.join(before, same).select(
        *[F.col(c) for c in df.columns], *[put_together(n, F.col(f"_here_{n}"), F.col(f"_before_{n}")).alias(n) for n in values]
    )


def running_position(
    df: DataFrame, keys: list[str], bucket: list[Column], order: list[Column], name: str = "position",
    store: Callable[[DataFrame], DataFrame] = landed,
) -> DataFrame:
    """Row number inside ``keys``, worked out bucket by bucket.

    ``bucket`` columns must order rows the way ``order`` does, coarser. Rows are numbered inside their
    bucket, and the rows of the earlier buckets are added from per-bucket counts, which are combined
    before the shuffle. So a group holding a large part of all rows is spread over its buckets; the
    counts themselves are one row per bucket. The rows are written once, since both the counts and the
    numbers are taken from them: what they are made from is not worked out a second time.
    """
    cols = [f"_bucket_{i}" for i in range(len(bucket))]
    tagged = store(df.select("*", *[b.alias(c) for b, c in zip(bucket, cols)]))
    before = Window.partitionBy(*keys).orderBy(*cols).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        tagged.groupBy(*keys, *cols).agg(F.count("*").alias("_n"))
        .select(*keys, *cols, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy(*keys, *cols).orderBy(*order)
    numbered = tagged.withColumn("_inside", F.row_number().over(inside))
    # Null keys and buckets are groups like others, so the join takes them for equal.
    names = [*keys, *cols]
    its = offsets.select(*[F.col(c).alias(f"_its_{c}") for c in names], "_offset")
    same = reduce(lambda a, b: a & b, [numbered[c].eqNullSafe(its[f"_its_{c}"]) for c in names])
    return (
        numbered.join(its, same)
        .withColumn(name, F.col("_inside") + F.col("_offset"))
        .drop(*cols, *[f"_its_{c}" for c in names], "_inside", "_offset")
    )
