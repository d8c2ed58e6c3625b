"""Risk items from narrative text, their counts and the report's risk table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.display import shorten
from ledgerloom.functions.text import risk_judgement, split_paragraphs
from ledgerloom.rules import lexicons as L

_SEVERITY_RANK = {"high": 3, "medium": 2, "low": 1}


def paragraphs(texts: DataFrame) -> DataFrame:
    """One row per paragraph with its place in the text."""
    return texts.select(
        *[c for c in texts.columns if c != "text"], F.posexplode(split_paragraphs(F.col("text"))).alias("place", "text")
    )


def risk_items(
    texts: DataFrame, keywords: dict[str, list[str]] = L.RISK_KEYWORDS,
    high: list[str] = L.SEVERITY_HIGH, low: list[str] = L.SEVERITY_LOW,
) -> DataFrame:
    """Paragraphs with risk category and severity, both from one pass over the paragraph."""
    judged = paragraphs(texts).select("*", risk_judgement(F.col("text"), keywords, high, low).alias("risk"))
    return judged.select(*[c for c in judged.columns if c != "risk"], "risk.category", "risk.severity")


def risk_summary(items: DataFrame) -> DataFrame:
    """Counts per company: all, by category (zero filled) and by severity."""
    return items.groupBy("ticker").agg(
        F.count("*").alias("total_risks"),
        *[F.count_if(F.col("category") == c).alias(c) for c in L.RISK_CATEGORIES],
        *[F.count_if(F.col("severity") == s).alias(s) for s in _SEVERITY_RANK],
    )


def risk_level_table(items: DataFrame) -> DataFrame:
    """Per company and category: highest severity, count and first text.

    The required categories are always shown, the extra one only when it has items. The items are reduced to one row per
    company and category, then to one row per company with its few categories, from which the shown ones are taken: the texts
    are read and split once. Only the shown part of a text travels.
    """
    rank = F.create_map(*[F.lit(x) for kv in _SEVERITY_RANK.items() for x in kv])
    names = F.create_map(*[F.lit(x) for kv in L.SEVERITY_LABELS.items() for x in kv])
    found = items.groupBy("ticker", "category").agg(
        F.max(F.try_element_at(rank, F.col("severity"))).alias("rank"), F.count("*").alias("items"),
        F.min(F.struct("seq", "place", shorten(F.col("text")).alias("factor")))["factor"].alias("factor"),
    )
    its = found.groupBy("ticker").agg(F.map_from_entries(F.collect_list(F.struct("category", F.struct("rank", "items", "factor")))).alias("its"))
    required, extra = (F.array(*[F.lit(c) for c in labels]) for labels in (L.REQUIRED_RISK_LABELS, L.EXTRA_RISK_LABELS))
    shown = F.concat(required, F.filter(extra, lambda c: F.map_contains_key("its", c)))
    rows = its.select("ticker", "its", F.explode(shown).alias("category")).select("ticker", "category", F.try_element_at("its", F.col("category")).alias("r"))
    labels = {**L.REQUIRED_RISK_LABELS, **L.EXTRA_RISK_LABELS}
    label_map = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])
    by_rank = F.create_map(*[F.lit(x) for k, v in _SEVERITY_RANK.items() for x in (v, k)])
    return rows.select(
        "ticker", "category", F.try_element_at(label_map, F.col("category")).alias("label"),
        F.coalesce(F.try_element_at(names, F.try_element_at(by_rank, F.col("r.rank"))), F.lit("-")).alias("level"),
        F.coalesce("r.items", F.lit(0)).alias("items"),
        F.when(F.col("r").isNull(), "(該当データなし)").otherwise(F.col("r.factor")).alias("factor"),
    )
