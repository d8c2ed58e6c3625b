"""Mixing sources to target weights by capped water-filling.

Each source gets a share of a budget by weight, clamped at ``max_epochs`` times its own size; what a clamp leaves over
goes to the open sources by weight, until no target is above its clamp. A target becomes whole repetitions of
every document and one fractional repetition, which is made of whole documents: in seeded order, documents that fit into the
missing words are taken until the next one does not fit, and the room that is left is offered to the smaller ones behind it, ``ROUNDS`` times. So
a source's words come to its target but for a room that few documents fit into. What is taken is told by a few limits per source, so
texts are never shuffled for it.

A missing text has size 0. A missing source is a source of its own, last in order. Repeated rows are mixed one by one; in the
fractional repetition rows of equal id and size are taken together. Very long documents are taken whole or not at all. An empty table gives an empty mix. An
input column named ``repetition`` is replaced by the number of the repetition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.llm.common import WORD, noted, stored, workspace
from ledgerloom.operators.ranking import running

# Weights by place of the source in code-point order, and the budget as a share of all sizes.
WEIGHTS = (3, 1, 2)
BUDGET = (3, 2)
MAX_EPOCHS = 2
SEED = "mix-1"
ROUNDS = 4


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def place_of(doc_id: Column, size: Column, seed: str) -> Column:
    """A seeded place in the order of documents."""
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), size.cast("string")))


def water_fill(sources: DataFrame, max_epochs: int = MAX_EPOCHS, budget: tuple[int, int] = BUDGET) -> DataFrame:
    """Adds ``target`` to rows of (place, weight, source_size).

    Sources are ordered by the level at which they reach their clamp. The first k of them are clamped, for the smallest k
    at which the next one stays at or below its clamp; all sums are whole numbers until the one division. The table
    has one row per source.
    """
    cap = F.col("source_size") * max_epochs
    up, down = budget
    order = Window.orderBy((cap / F.col("weight")).asc(), F.col("place"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = sources.select(
        "*",
        cap.alias("cap"),
        F.coalesce(F.sum(cap).over(before), F.lit(0)).alias("cap_before"),
        F.coalesce(F.sum("weight").over(before), F.lit(0)).alias("weight_before"),
        F.sum("source_size").over(everything).alias("all_size"),
        F.sum("weight").over(everything).alias("all_weight"),
    )
    # With k sources clamped, the level is (budget - cap_before) / (all_weight - weight_before); times ``down`` to stay whole.
    left = F.col("all_size") * up - F.col("cap_before") * down
    open_weight = (F.col("all_weight") - F.col("weight_before")) * down
    stays = F.col("weight") * left <= F.col("cap") * open_weight
    judged = ranked.select("*", left.alias("left"), open_weight.alias("open_weight"), stays.alias("stays"))
    first = F.min_by(
        F.when(F.col("stays"), F.struct("left", "open_weight")),
        F.when(F.col("stays"), F.struct(cap / F.col("weight"), F.col("place"))),
    ).over(everything)
    level = judged.select("*", first.alias("level"))
    share = (F.col("weight") * F.col("level.left")).cast("double") / F.col("level.open_weight").cast("double")
    clamped = F.col("level").isNull() | (F.col("weight") * F.col("level.left") > F.col("cap") * F.col("level.open_weight"))
    return level.select(
        "source", "place", "weight", "source_size",
        F.when(clamped, F.col("cap").cast("double")).otherwise(share).alias("target"),
    )


def plan(sized: DataFrame, max_epochs: int = MAX_EPOCHS, budget: tuple[int, int] = BUDGET) -> DataFrame:
    """One row per source: size, target, whole repetitions, and the limits of the fractional one as ``rounds``: an array of (room, after, upto).

    ``sized`` has (source, at, size) and is read several times. Running sums go over measured ranges of the order, so a
    source of any size is dealt out; what is left in the end is one row per source.
    """
    units = sized.groupBy("source", "at", "size").agg(F.sum("size").cast("bigint").alias("words"))
    by_size = units.groupBy("source").agg(F.sum("words").cast("bigint").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*(F.lit(w).cast("bigint") for w in WEIGHTS)), (F.col("place") % len(WEIGHTS) + 1).cast("int"))
    targets = water_fill(by_size.withColumn("place", place).withColumn("weight", weight), max_epochs, budget)
    size = F.col("source_size")
    whole = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(F.lit(0)).cast("bigint")
    targets = targets.select("source", "source_size", "target", whole.alias("whole"))
    room = F.floor(F.col("target") - F.col("whole") * size).cast("bigint")
    limits = "array<struct<room: bigint, after: string, upto: string>>"
    now = noted(targets.select("*", room.alias("room"), F.lit("").alias("after"), F.array().cast(limits).alias("rounds")), "mixing-plan")
    for _ in range(ROUNDS):
        its = now.select(F.col("source").alias("its"), "room", "after")
        open_units = units.join(its, units["source"].eqNullSafe(its["its"]))
        open_units = open_units.where((F.col("size") > 0) & (F.col("at") > F.col("after")) & (F.col("size") <= F.col("room")))
        narrow = open_units.select("source", "at", "words", "room")
        summed = running(narrow, ["source"], [F.col("at").asc()], sums={"sum": F.col("words")}, store=lambda rows: noted(rows, "mixing-ranges"))
        taken = summed.where(F.col("sum") <= F.col("room")).groupBy(F.col("source").alias("its")).agg(F.max("at").alias("upto"), F.max("sum").alias("sum"))
        step = now.join(taken, now["source"].eqNullSafe(taken["its"]), "left")
        upto = F.coalesce("upto", "after")
        now = noted(step.select(
            "source", "source_size", "target", "whole", (F.col("room") - F.coalesce("sum", F.lit(0))).alias("room"), upto.alias("after"),
            F.concat("rounds", F.array(F.struct("room", "after", upto.alias("upto")))).alias("rounds"),
        ), "mixing-plan")
    return now.select("source", "source_size", "target", "whole", "rounds")


def _placed(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str) -> DataFrame:
    size = word_count(docs[text_col].cast("string"))
    return docs.select(docs[id_col].alias("id"), docs[source_col].cast("string").alias("source"), size.alias("size"), place_of(docs[id_col], size, seed).alias("at"))


def _with_plan(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows with their source's plan and the words of the fractional repetition, all or none, as ``part``.

    The plan has a row per source; Spark joins it by its own size check, and otherwise the adaptive skew join splits a
    source that holds a third of all rows.
    """
    p = sources.withColumnRenamed("source", "its")
    within = lambda r: (F.col("at") > r["after"]) & (F.col("at") <= r["upto"]) & (F.col("size") <= r["room"])
    part = F.when(F.exists("rounds", within), F.col("size")).otherwise(F.lit(0))
    return rows.join(p, rows["source"].eqNullSafe(p["its"])).withColumn("part", part.cast("bigint"))


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    seed: str = SEED, max_epochs: int = MAX_EPOCHS, budget: tuple[int, int] = BUDGET,
) -> DataFrame:
    """``id_col``, ``size``, ``source_size``, ``target``, ``taken`` and how it is made up: ``whole`` repetitions and ``part`` words.

    The narrow table of sizes is written once, so that words are counted once.
    """
    with workspace(docs.sparkSession) as keep:
        sized = stored(_placed(docs, id_col, text_col, source_col, seed), "mixing-sizes")
        mixed = _with_plan(sized, plan(sized, max_epochs, budget)).select(
            F.col("id").alias(id_col), "size", "source_size", "target",
            (F.col("whole") * F.col("size") + F.col("part")).cast("bigint").alias("taken"), "whole", "part",
        )
        return keep(mixed, "mixing")


def repetitions(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    seed: str = SEED, max_epochs: int = MAX_EPOCHS, budget: tuple[int, int] = BUDGET,
) -> DataFrame:
    """The mix itself: all columns of ``docs``, one row with the whole document for each repetition taken, numbered in ``repetition``."""
    with workspace(docs.sparkSession) as keep:
        sized = stored(_placed(docs, id_col, text_col, source_col, seed), "mixing-sizes")
        sources = keep(plan(sized, max_epochs, budget), "mixing-plan")
    size = word_count(docs[text_col].cast("string"))
    placed = docs.select(
        F.struct(*(docs[c] for c in docs.columns)).alias("doc"), docs[source_col].cast("string").alias("source"),
        size.alias("size"), place_of(docs[id_col], size, seed).alias("at"),
    )
    rows = _with_plan(placed, sources)
    times = F.col("whole") + (F.col("part") > 0).cast("bigint")
    each = F.when(times > 0, F.sequence(F.lit(1).cast("bigint"), times))
    taken = rows.select("doc", F.explode(each).alias("n"))
    columns = [F.col("doc")[c].alias(c) for c in docs.columns if c != "repetition"]
    return taken.select(*columns, F.col("n").alias("repetition"))
