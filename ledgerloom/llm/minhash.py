"""Near-duplicate documents by MinHash: many universal hash minima, banding, verification, connected components.

A document's set holds the distinct hashes of its runs of ``k`` words; a text of fewer words, but not none, is one run;
a text without words has an empty set and is linked with nothing. Two documents are linked when
``100 * intersection >= percent * union`` of their full sets.

Equal sets are one class, represented by its least id, so copies cost one row each and no pairs. Classes that agree in all
minima of a band meet in a bucket. A bucket of any size gives one candidate per member, the pair with the bucket's least id;
links are confirmed on the full sets and gathered into components. For members of a bucket that are then still in different
components an exact join looks for every link left, so none between members of a bucket is lost; see :func:`_rejoined`. With ``bands`` from :func:`banding` a pair at the threshold
misses every bucket with a probability under one in a million.

Repeated rows are copies of each other. Rows without an id keep to themselves: their component is null. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.common import stored, workspace
from ledgerloom.llm.components import components
from ledgerloom.llm.wordhash import many_word_hashes, mix, shingles

ROWS_PER_BAND = 6
MISS = 1e-6
SEED = 20240501


def banding(percent: int, rows: int = ROWS_PER_BAND) -> int:
    """Bands needed so that a pair at the threshold shares a bucket but for a chance of ``MISS``."""
    return math.ceil(math.log(MISS) / math.log(1 - (percent / 100) ** rows))


def _minima(found: np.ndarray, factors: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The least value of every universal hash over a set, in blocks so that memory stays bounded."""
    low = (found >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(factors), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 2048):
        np.minimum(least, (factors[:, None] * low[None, at : at + 2048] + offsets[:, None]).min(axis=1), out=least)
    return least


def _sketcher(k: int, percent: int):
    bands = banding(percent)
    random = np.random.default_rng(SEED)
    factors = random.integers(0, 1 << 32, bands * ROWS_PER_BAND, np.uint32) | np.uint32(1)
    offsets = random.integers(0, 1 << 32, bands * ROWS_PER_BAND, np.uint32)
    powers = (random.integers(0, 1 << 63, ROWS_PER_BAND, np.uint64) << np.uint64(1)) | np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(v.as_py() or b"").lower() for v in batch.column(1)]
            sizes, firsts, seconds, keys = [], [], [], []
            for words in many_word_hashes(texts):
                found = shingles(words, k)
                sizes.append(len(found))
                if not len(found):
                    firsts.append(0), seconds.append(0), keys.append(None)
                    continue
                mixed = mix(found)
                firsts.append(int(found.sum().view(np.int64)))
                seconds.append(int(np.bitwise_xor.reduce(mixed).view(np.int64)))
                least = _minima(mixed, factors, offsets).reshape(bands, ROWS_PER_BAND).astype(np.uint64)
                key = mix((least * powers).sum(axis=1, dtype=np.uint64) + np.arange(bands, dtype=np.uint64))
                keys.append(key.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(sizes, pa.int64()), pa.array(firsts, pa.int64()), pa.array(seconds, pa.int64()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                ["id", "n", "h1", "h2", "bands"],
            )

    return run


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(docs[id_col].cast("bigint").alias("id"), docs[text_col].cast("string").cast("binary").alias("text"))


def _packed(k: int):
    """Adds the full set of each text, as the bytes of its sorted hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(v.as_py() or b"").lower() for v in batch.column(1)]
            sets = [shingles(words, k).tobytes() for words in many_word_hashes(texts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary()), batch.column(2)], ["id", "s", "leader"])

    return run


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                least, most = sorted((len(x), len(y)))
                if 100 * least < percent * most:
                    keep.append(False)
                    continue
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return run


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose full sets are similar enough."""
    left = sets.select(F.col("id").alias("u"), F.col("s").alias("a"))
    right = sets.select(F.col("id").alias("v"), F.col("s").alias("b"))
    rows = pairs.join(left, "u").join(right, "v").select("u", "v", "a", "b")
    return rows.mapInArrow(_confirm(percent), "u bigint, v bigint")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_shingles``, ``component_id`` and ``kept`` of every row; only the id and the text are read."""
    with workspace(docs.sparkSession) as keep:
        return keep(_near_duplicates(docs, k, percent, id_col, text_col), "near-duplicates")


def representatives(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, of one document for each group; rows without an id stay."""
    kept = near_duplicates(docs, k, percent, id_col, text_col).where(F.col("kept") & F.col(id_col).isNotNull())
    # Repeated rows of a kept id are one document: the groups are as small as an id is often.
    once = docs.join(kept.select(id_col).distinct(), id_col, "left_semi").dropDuplicates([id_col])
    return once.unionByName(docs.where(docs[id_col].isNull()))


def _near_duplicates(docs: DataFrame, k: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    texts = _texts(docs, id_col, text_col)
    sketches = stored(
        texts.mapInArrow(_sketcher(k, percent), "id bigint, n bigint, h1 bigint, h2 bigint, bands array<bigint>"), "sketches"
    )
    filled = sketches.where("n > 0 AND id IS NOT NULL")
    classes = stored(filled.groupBy("h1", "h2", "n").agg(F.min("id").alias("rep")), "classes")
    reps = filled.join(classes.select(F.col("rep").alias("id")).distinct(), "id", "left_semi")
    rows = reps.select("id", F.explode("bands").alias("key"))
    least = rows.groupBy("key").agg(F.min("id").alias("leader"), F.max("id").alias("last"), F.count("*").alias("held")).where("leader <> last")
    members = stored(rows.join(least, "key").select("key", "id", "leader", "held"), "buckets")
    wanted = members.groupBy("id").agg(F.min(F.when(F.col("id") != F.col("leader"), F.col("leader"))).alias("leader"))
    sets = stored(
        texts.join(wanted, "id").select("id", "text", "leader").mapInArrow(_packed(k), "id bigint, s binary, leader bigint"), "sets"
    )
    # Each class with the least leader of its buckets.
    first = sets.where("leader IS NOT NULL").select(F.col("id").alias("u"), F.col("s").alias("a"), F.col("leader").alias("v"))
    leaders = sets.select(F.col("id").alias("v"), F.col("s").alias("b"))
    links = stored(first.join(leaders, "v").select("u", "v", "a", "b").mapInArrow(_confirm(percent), "u bigint, v bigint"), "links")
    found = stored(components(links), "components")
    # Members of a bucket that are still apart.
    here = members.join(found, "id", "left").select("key", "id", "leader", "held", F.coalesce("component", "id").alias("component"))
    mixed = here.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("key")
    apart = stored(here.join(mixed, "key"), "apart")
    if not apart.isEmpty():
        found = _rejoined(apart, sets, found, percent)
    # Every row's component: through its class, then through the class's representative.
    c = classes.join(found.withColumnRenamed("id", "rep"), "rep", "left")
    c = c.select("h1", "h2", "n", F.coalesce("component", "rep").alias("component_id"))
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    out = sketches.select("id", "n", "h1", "h2").join(c, ["h1", "h2", "n"], "left")
    out = out.select("id", "n", F.when(F.col("id").isNotNull(), own).alias("component_id"))
    return out.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )


def _deltas(percent: int):
    """Each set as its difference from the family's pivot: what it lacks and what it has besides, as tagged elements.

    With I the intersection of x and y, P the pivot's size, L what a set lacks and t the common tagged elements,
    I = P - L(x) - L(y) + t. So 100 I >= percent (x + y - I) reads 2 (100 + percent) t >= a(x) + a(y), where
    a(x) = 2 percent |x| + 2 (100 + percent) L(x) - (100 + percent) P.
    """
    lack_tag = np.uint64(0x5851F42D4C957F2D)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            need, tagged = [], []
            for own, pivot in zip(batch.column(3), batch.column(4)):
                x, p = np.frombuffer(own.as_buffer(), np.uint64), np.frombuffer(pivot.as_buffer(), np.uint64)
                lacks, more = np.setdiff1d(p, x, assume_unique=True), np.setdiff1d(x, p, assume_unique=True)
                need.append(2 * percent * len(x) + (100 + percent) * (2 * len(lacks) - len(p)))
                tagged.append(np.concatenate((more, mix(lacks ^ lack_tag))).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(need, pa.int64()), pa.array(tagged, pa.list_(pa.int64()))],
                ["id", "family", "component", "a", "t"],
            )

    return run


def _rejoined(apart: DataFrame, sets: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """Components after every link between bucket members of different components is added.

    Members that meet in buckets form families. A family's sets are written as differences from its most central member,
    see :func:`_deltas`. If a(x) + a(y) <= 0 the two are linked whatever their differences, and then both are linked with the
    member of the least a, so one edge per member says all of these. Any other link needs common tagged elements:
    a prefix filter over the differences, rarest first, finds the pairs, and the full sets confirm them. What most
    members have in common never enters, so a family of thousands of near copies gives few pairs.
    """
    edges = apart.where("id <> leader").select(F.col("id").alias("u"), F.col("leader").alias("v"))
    family = components(edges).withColumnRenamed("component", "family")
    own = apart.groupBy("id").agg(F.sum("held").alias("met"), F.min("component").alias("component"))
    in_family = stored(own.join(family, "id"), "families")
    pivots = in_family.groupBy("family").agg(F.max(F.struct("met", (-F.col("id")).alias("col2"))).alias("p")).select("family", (-F.col("p")["col2"]).alias("pivot"))
    pivot_sets = pivots.join(sets.select(F.col("id").alias("pivot"), F.col("s").alias("p")), "pivot").select("family", "p")
    rows = in_family.select("id", "family", "component").join(sets.select("id", "s"), "id").join(pivot_sets, "family")
    deltas = stored(
        rows.select("id", "family", "component", "s", "p")
        .mapInArrow(_deltas(percent), "id bigint, family bigint, component bigint, a bigint, t array<bigint>"),
        "deltas",
    )
    unit = 2 * (100 + percent)
    center = deltas.groupBy("family").agg(F.min(F.struct("a", "id")).alias("c")).select("family", F.col("c.a").alias("a0"), F.col("c.id").alias("center"))
    placed = deltas.join(center, "family").withColumn("core", F.col("a") + F.col("a0") <= 0)
    sure = placed.where("core AND id <> center").select(F.col("id").alias("u"), F.col("center").alias("v"))
    outer = placed.where("NOT core").groupBy("family").agg(F.min("a").alias("a1"))
    # Families without outer members are settled by the sure links. Common elements that a pair needs at least:
    judged = placed.join(outer, "family")
    to_core = F.ceil((F.col("a") + F.col("a0")) / unit)
    to_outer = F.greatest(F.lit(1), F.ceil((F.col("a") + F.col("a1")) / unit))
    sized = judged.select("id", "family", "component", "core", "t", to_core.alias("to_core"), to_outer.alias("to_outer"))
    each = sized.select("id", "family", F.explode("t").alias("e"))
    often = each.groupBy("family", "e").agg(F.count("*").alias("f"))
    order = (
        each.join(often, ["family", "e"]).groupBy("family", "id").agg(F.sort_array(F.collect_list(F.struct("f", "e"))).alias("o"))
    )
    ordered = stored(sized.drop("t").join(order, ["family", "id"]), "ordered")

    def prefix(rows: DataFrame, least: str, side: str) -> DataFrame:
        length = F.greatest(F.lit(0), F.size("o") - F.col(least).cast("int") + 1)
        posts = rows.select("family", "id", "component", F.explode(F.slice("o", F.lit(1), length)).alias("x")).where("x.f > 1")
        return posts.select("family", F.col("x.e").alias("e"), F.col("id").alias(side), F.col("component").alias(f"c{side}"))

    core, rest = ordered.where("core"), ordered.where("NOT core")
    across = prefix(rest, "to_core", "u").join(prefix(core, "to_outer", "v"), ["family", "e"])
    within = prefix(rest, "to_outer", "u").join(prefix(rest, "to_outer", "v"), ["family", "e"]).where("u > v")
    pairs = across.unionByName(within).where("cu <> cv").select("u", "v").distinct()
    new = stored(_verified(pairs, sets, percent).unionByName(sure), "links")
    known = found.where("id <> component").select(F.col("id").alias("u"), F.col("component").alias("v"))
    return stored(components(known.unionByName(new)), "components")
