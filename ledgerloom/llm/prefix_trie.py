"""A trie of conversation prefixes by SQL ROLLUP over positional turn ids.

Turns are narrow rows here: conversation, position, a digest of role and text, and the length of the text. A conversation is cut into blocks of
``WIDTH`` turns. A block is one row whose columns t1, t2, ... are the turn ids at its positions, and its key is the node that the prior
blocks lead to. ``GROUP BY block, key, ROLLUP(t1, ..., t8)`` then aggregates all prefixes of all conversations in one job: a level of the rollup is a
depth, and ``grouping`` tells which. Longer conversations need no further rounds: a node's number is the exclusive-or of two 64-bit hashes
of (position, turn) over its path, so the key of every block is a running fold over the blocks before it.

Counting whole subtrees takes a second rollup over the same rows. A node belongs to its smallest member; the nodes of a conversation
are then the end of its path, a chain that begins below another conversation's node. The weight of all nodes in a subtree is the weight of
the chains of its members, but for the part of its own conversation's chain above it; and the childless nodes of a subtree are
the members whose chain ends where no other chain begins.

Rows without a conversation id belong to no conversation and are left out. A missing turn number comes first, a missing role or text is
empty; turns of equal number are ordered by the digest of role and text, so the order is the same in every run, and repeated rows are
repeated turns. A conversation with very many turns is dealt out by ranges (``ranking.running``), a conversation or first turn shared by very many
is combined before the shuffle. The digest over the members that end at a node takes their ids in order, as a stream: one task reads
them, but holds none. Texts of any length are one digest. An empty table has no conversation and gives no node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm.common import stored, workspace
from ledgerloom.operators.ranking import running

WIDTH = 8
TURN_COLUMNS = [f"t{j}" for j in range(1, WIDTH + 1)]


def _running(df: DataFrame, keys: list[str], order: list[Column], **how) -> DataFrame:
    return running(df, keys, order, store=lambda rows: stored(rows, "trie-ranges"), **how)


def ordered_turns(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(conv, pos, m, n): position from 1, digest of role and text, code points of the text."""
    role = F.coalesce(conversations[role_col].cast("string"), F.lit(""))
    text = F.coalesce(conversations[text_col].cast("string"), F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)))
    rows = conversations.where(conversations[conv_col].isNotNull()).select(
        conversations[conv_col].cast("bigint").alias("conv"), conversations[turn_col].alias("turn"), digest.alias("m"),
        F.char_length(text).cast("bigint").alias("n"),
    )
    numbered = _running(rows, ["conv"], [F.col("turn").asc_nulls_first(), F.col("m").asc()], position="pos")
    return numbered.select("conv", "pos", "m", "n")


def with_shared_heads(turns: DataFrame, group: int = 100, most: int = 5) -> DataFrame:
    """Conversations rebuilt on the head of their group's first one, as rows of ``ordered_turns`` and, for every conversation, a row at position 0.

    Conversation c gets the first h turns of conversation ``c - c % group``, fewer if it has fewer, and then its own turns after
    its first h; h is the CRC-32 of the decimal c modulo ``most + 1``. Every row carries the rebuilt length as ``size``.
    """
    h = lambda c: (F.crc32(c.cast("string").cast("binary")) % (most + 1)).cast("bigint")
    sizes = turns.groupBy("conv").agg(F.max("pos").alias("own"))
    first = turns.where((F.col("pos") <= most) & (F.col("conv") % group == 0))
    heads = first.groupBy(F.col("conv").alias("base")).agg(F.sort_array(F.collect_list(F.struct("pos", "m", "n"))).alias("head"))
    none = F.array().cast("array<struct<pos: bigint, m: binary, n: bigint>>")
    its = sizes.withColumn("base", F.col("conv") - F.col("conv") % group).join(heads, "base", "left")
    its = its.select("conv", "own", h(F.col("conv")).alias("h"), F.coalesce("head", none).alias("head"))
    its = its.withColumn("head", F.slice("head", F.lit(1), F.col("h").cast("int")))
    size = F.size("head") + F.greatest(F.col("own") - F.col("h"), F.lit(0))
    its = stored(its.select("conv", "h", "head", size.alias("size")), "trie-heads")
    zero = F.struct(F.lit(0).cast("bigint").alias("pos"), F.lit(None).cast("binary").alias("m"), F.lit(0).cast("bigint").alias("n"))
    shared = its.select("conv", "size", F.explode(F.concat(F.array(zero), "head")).alias("t")).select("conv", "size", "t.*")
    rest = turns.where(F.col("pos") > h(F.col("conv"))).join(its.select("conv", "h", F.size("head").alias("k"), "size"), "conv")
    rest = rest.select("conv", "size", (F.col("pos") - F.col("h") + F.col("k")).alias("pos"), "m", "n")
    return shared.unionByName(rest)


def as_they_are(turns: DataFrame) -> DataFrame:
    """The conversations unchanged, in the shape of ``with_shared_heads``."""
    sizes = turns.groupBy("conv").agg(F.max("pos").alias("size"))
    zero = sizes.select("conv", "size", F.lit(0).cast("bigint").alias("pos"), F.lit(None).cast("binary").alias("m"), F.lit(0).cast("bigint").alias("n"))
    return turns.join(sizes, "conv").select(*zero.columns).unionByName(zero)


def _blocks(turns: DataFrame) -> DataFrame:
    """(conv, block, k1, k2, t1 ... t8, ends, e1, e2): the turn ids of a block behind the node of the prior blocks; e1 and e2
    number the node after the block, and ``ends`` tells whether the conversation ends there."""
    hashed = turns.select(
        "conv", "size", "pos", "n", F.xxhash64("pos", "m").alias("a"), F.xxhash64("m", "pos", F.lit(1)).alias("b"),
        F.floor(F.greatest(F.col("pos") - 1, F.lit(0)) / WIDTH).cast("bigint").alias("block"),
    )
    real = F.col("pos") > 0
    zero = F.lit(0).cast("bigint")
    rows = hashed.groupBy("conv", "block").agg(
        F.sort_array(F.collect_list(F.when(real, F.struct("pos", "a", "b", "n")))).alias("t"), F.max("size").alias("size"),
        F.bit_xor(F.when(real, F.col("a")).otherwise(zero)).alias("xa"), F.bit_xor(F.when(real, F.col("b")).otherwise(zero)).alias("xb"),
    )
    keyed = _running(rows, ["conv"], [F.col("block").asc()], folds={"e1": F.col("xa"), "e2": F.col("xb")})
    ids = [F.get("t", F.lit(j)).alias(c) for j, c in enumerate(TURN_COLUMNS)]
    keyed = keyed.select("*", *ids)
    return keyed.select(
        "conv", "block", F.col("e1").bitwiseXOR(F.col("xa")).alias("k1"), F.col("e2").bitwiseXOR(F.col("xb")).alias("k2"),
        *[F.when(F.col(c).isNotNull(), F.struct(F.col(f"{c}.a"), F.col(f"{c}.b"), F.col(f"{c}.n"))).alias(c) for c in TURN_COLUMNS],
        (F.col("size") <= (F.col("block") + 1) * WIDTH).alias("ends"), "e1", "e2",
    )


def _rolled(blocks: DataFrame, measures: str) -> DataFrame:
    """One row per node: depth, number (i1, i2), the parent's number (p1, p2), length of the last text and the measures."""
    columns = ", ".join(TURN_COLUMNS)
    level = f"{WIDTH} - ({' + '.join(f'grouping({c})' for c in TURN_COLUMNS)})"
    rolled = blocks.sparkSession.sql(
        f"SELECT block, k1, k2, {columns}, {level} AS level, {measures} FROM {{blocks}} GROUP BY block, k1, k2, ROLLUP({columns})", blocks=blocks
    )
    last = F.coalesce(*[F.when(F.col("level") == j, F.col(c)) for j, c in enumerate(TURN_COLUMNS, 1)])
    # The upper edge of a block is the last node of the block before; only the root has no such block.
    nodes = rolled.withColumn("last", last).where((F.col("last").isNotNull()) | ((F.col("level") == 0) & (F.col("block") == 0)))

    def number(key: str, part: str) -> Column:
        out = F.col(key)
        for c in TURN_COLUMNS:
            out = out.bitwiseXOR(F.coalesce(F.col(f"{c}.{part}"), F.lit(0).cast("bigint")))
        return out

    made = nodes.select(
        (F.col("block") * WIDTH + F.col("level")).cast("bigint").alias("depth"), number("k1", "a").alias("i1"), number("k2", "b").alias("i2"),
        "last", *[c for c in nodes.columns if c not in {"block", "k1", "k2", "level", "last", *TURN_COLUMNS}],
    )
    return made.select(
        "*", F.col("i1").bitwiseXOR(F.col("last.a")).alias("p1"), F.col("i2").bitwiseXOR(F.col("last.b")).alias("p2"),
        F.coalesce("last.n", F.lit(0).cast("bigint")).alias("n"),
    ).drop("last")


def _member_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the comma-joined ids of each node, from rows in order of node and id."""
    node, digest, size = None, None, 0

    def finished() -> pa.RecordBatch:
        names = ["i1", "i2", "n_ends", "ends_sha256"]
        return pa.RecordBatch.from_arrays([pa.array([v]) for v in (*node, size, digest.hexdigest())], names=names)

    for batch in batches:
        if not batch.num_rows:
            continue
        i1, i2 = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
        ids = pc.cast(batch.column(2), pa.string())
        cuts = np.flatnonzero((i1[1:] != i1[:-1]) | (i2[1:] != i2[:-1])) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(i1)]):
            here = (int(i1[a]), int(i2[a]))
            if here != node:
                if node is not None:
                    yield finished()
                node, digest, size = here, hashlib.sha256(), 0
            digest.update(("," * (size > 0) + ",".join(ids.slice(a, b - a).to_pylist())).encode())
            size += b - a
    if node is not None:
        yield finished()


def trie(turns: DataFrame) -> DataFrame:
    """Per node: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 and n_ends.

    ``turns`` come from ``with_shared_heads`` or ``as_they_are``. ``saved_tokens`` is the sum over the node's subtree of members less one, times the code
    points of the node's last text; ``ends_sha256`` is the digest of the ids, in order, of the members that end at the node.
    """
    with workspace(turns.sparkSession) as keep:
        return keep(_trie(turns), "prefix-trie")


def _trie(turns: DataFrame) -> DataFrame:
    blocks = stored(_blocks(turns), "trie-blocks")
    nodes = _rolled(blocks, "count(*) AS n_convs, min(conv) AS conv_id").withColumn("weight", (F.col("n_convs") - 1) * F.col("n"))
    nodes = stored(nodes, "trie-nodes")
    # Minima and maxima of numbers by depth, so that they are combined in hash tables.
    by_depth = {"p1": F.min_by("p1", "depth"), "p2": F.min_by("p2", "depth"), "l1": F.max_by("i1", "depth"), "l2": F.max_by("i2", "depth")}
    chains = nodes.groupBy("conv_id").agg(
        F.min("depth").alias("top"), F.max("depth").alias("bottom"), F.sum("weight").alias("weight"), *[c.alias(n) for n, c in by_depth.items()]
    )
    chains = stored(chains, "trie-chains")
    begun = chains.where("top > 0").groupBy(F.col("p1").alias("b1"), F.col("p2").alias("b2")).agg(F.count("*").alias("begun"))
    ended = chains.join(begun, (F.col("l1") == F.col("b1")) & (F.col("l2") == F.col("b2")), "left")
    its = ended.select(F.col("conv_id").alias("conv"), F.col("weight").alias("w"), F.col("begun").isNull().cast("bigint").alias("leaf"))
    weighted = blocks.join(its, "conv", "left").select("block", "k1", "k2", *TURN_COLUMNS, "conv", "w", "leaf")
    whole = _rolled(weighted, "count(*) AS n_convs, min(conv) AS conv_id, coalesce(sum(w), 0) AS all_weight, coalesce(sum(leaf), 0) AS n_leaves")
    above = _running(nodes.select("conv_id", "depth", "weight"), ["conv_id"], [F.col("depth").asc()], sums={"to_here": F.col("weight")})
    above = above.select("conv_id", "depth", (F.col("to_here") - F.col("weight")).alias("above"))
    parents = chains.where("top > 0").join(
        nodes.select(F.col("i1").alias("p1"), F.col("i2").alias("p2"), F.col("conv_id").alias("parent")), ["p1", "p2"]
    )
    lines = chains.select("conv_id", "top", "bottom").join(parents.select("conv_id", "parent"), "conv_id", "left")
    members = blocks.where("ends").select(F.col("e1").alias("i1"), F.col("e2").alias("i2"), "conv")
    members = members.repartition("i1", "i2").sortWithinPartitions("i1", "i2", "conv")
    ends = members.mapInArrow(_member_digests, "i1 bigint, i2 bigint, n_ends bigint, ends_sha256 string")
    out = whole.join(above, ["conv_id", "depth"]).join(lines, "conv_id")
    out = out.join(begun.select(F.col("b1").alias("i1"), F.col("b2").alias("i2"), "begun"), ["i1", "i2"], "left").join(ends, ["i1", "i2"], "left")
    zero = F.lit(0).cast("bigint")
    return out.select(
        "conv_id", "depth", F.when(F.col("depth") == F.col("top"), F.col("parent")).otherwise(F.col("conv_id")).alias("parent_conv_id"), "n_convs",
        (F.coalesce("begun", zero) + (F.col("depth") < F.col("bottom")).cast("bigint")).alias("n_children"), "n_leaves",
        (F.col("all_weight") - F.col("above")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"), F.coalesce("n_ends", zero).alias("n_ends"),
    )
