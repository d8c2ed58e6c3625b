"""The corpus pipeline: documents through five stages, each written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import decontamination, line_dedup, minhash, mixing, quality_rules
from ledgerloom.llm.common import discard, table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the newest policy, with all their columns; the rest goes."""
    return quality_rules.accepted(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that an earlier line matches; documents that lose every word go."""
    return line_dedup.deduplicated(docs, least_words=line_dedup.EVERY_LINE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: runs of five words, similarity 0.8 or more."""
    return minhash.representatives(docs, k=5, percent=80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of the benchmark."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per repetition that the mix takes: the columns of documents and the number of the repetition."""
    return mixing.repetitions(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("near duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("mixing", mixed),
]

# Near duplicates are found by hashes that SQL does not have; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each stage's rows are written to the shared folder and read by the next one."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        place = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        docs = spark.read.parquet(place)
        if before is not None:
            discard(spark, before)
        before = place
    return STAGES[-1][1](spark, docs, sf_dir)
