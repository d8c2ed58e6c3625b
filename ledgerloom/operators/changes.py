"""Differences between two versions of a table of values."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def flatten_values(rows: DataFrame, keys: list[str], fields: dict[str, str]) -> DataFrame:
    """Long form (keys, path, value, kind) of the given fields; ``fields`` maps columns to paths."""
    kinds = dict(rows.dtypes)
    leaves = F.array(
        *[
            F.struct(
                F.lit(path).alias("path"), F.col(c).cast("string").alias("value"),
                F.when(F.col(c).isNull(), "null").otherwise(kinds[c]).alias("kind"),
            )
            for c, path in fields.items()
        ]
    )
    return rows.select(*keys, F.explode(leaves).alias("leaf")).select(*keys, "leaf.*")


def snapshot_diff(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Added, removed and changed leaves; a change of kind counts as changed.

    Both versions hold a leaf once, so they are tagged and grouped instead of joined outright. Leaves are many times as long as the rows they
    come from: they are dealt out in pieces of bounded size before the grouping sorts them, whatever the size of the tasks before.
    """
    tag = lambda df, side: df.select(*keys, "path", F.lit(side).alias("side"), "value", "kind")
    of = lambda side: F.max(F.when(F.col("side") == side, F.struct("kind", "value")))
    leaves = tag(old, 0).unionByName(tag(new, 1))
    dealt = leaves.withColumn("_leaf", F.xxhash64(*keys, "path")).hint("rebalance", "_leaf")
    paired = dealt.groupBy(*keys, "path").agg(of(0).alias("o"), of(1).alias("n"))
    change = (
        F.when(F.col("o").isNull(), "added").when(F.col("n").isNull(), "removed")
        .when(~F.col("o").eqNullSafe(F.col("n")), "changed")
    )
    return paired.select(*keys, "path", change.alias("change"), F.col("o.value").alias("old"), F.col("n.value").alias("new")).filter(
        F.col("change").isNotNull()
    )


def diff_summary(diffs: DataFrame, keys: list[str]) -> DataFrame:
    return diffs.groupBy(*keys).agg(
        F.count("*").alias("changes"), *[F.count_if(F.col("change") == c).alias(c) for c in ("added", "removed", "changed")]
    )


def first_diffs(diffs: DataFrame, keys: list[str], order: list[str], n: int = 10) -> DataFrame:
    """First ``n`` differences per key in path order; the rank filter is applied before the shuffle too."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return diffs.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
