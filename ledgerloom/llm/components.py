"""Connected components by alternating large-star and small-star over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.common import stored


def _with_least(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with the least neighbour of u, itself included; the minimum is combined before the shuffle, and a
    node with very many edges is split by the adaptive skew join."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least, "u").select("u", "v", F.least("u", "m").alias("m"))


def large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked with the node's least neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Every node, and each of its smaller neighbours, is linked with the least of them. Edges run from larger to smaller."""
    seen = _with_least(edges)
    each = seen.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
    return each.select("e.*").where("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node that has an edge; ``component`` is the least id reachable.

    Edges are rows (u, v). Each round is written to the shared folder, so lineage stays short; two figures of the edge
    table reach the driver and tell when nothing changes any more. Self-links and repeated edges do no harm.
    """
    now = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = _state(now)
    while state[0]:
        now = stored(small_star(large_star(now)), "edges")
        before, state = state, _state(now)
        if before == state:
            break
    roots = now.groupBy(F.col("v").alias("id")).agg(F.min("v").alias("component"))
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
