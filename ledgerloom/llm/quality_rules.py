"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; the ledger keeps the measurements and one bit per failed rule. A policy is
a named mask over the bits, so a new version of a policy, or what it would keep without one of its rules, comes from
the ledger by bitwise operations and never reads a text again.

A missing or empty text has no words and fails ``few_words``. Long texts are measured whole. Repeated rows get a ledger
row each, equal texts get equal measurements.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerloom.llm.wordhash import BASE, many_word_hashes, mix

# Characters that count as symbols, and the bounds of the rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

MEASURES = ("n_words", "word_chars", "n_symbols", "n_upper", "n_lines", "n_dup_lines", "n_repeat_words")

# Rule name and failure condition over the measurements; a rule's bit is its place in this list.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", f"n_words < {MIN_WORDS}"),
    ("repeated_words", f"100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"),
    ("symbols", "10 * n_symbols > 3 * n_words"),
    ("repeated_lines", "10 * n_dup_lines > 4 * n_lines"),
    ("capitals", "10 * n_upper > 4 * word_chars"),
    ("word_length", "word_chars < 2 * n_words OR word_chars > 14 * n_words"),
)
# Policy versions: the rules that reject a document.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols", "repeated_lines"),
    "v2": ("few_words", "repeated_words", "symbols", "repeated_lines", "capitals", "word_length"),
}

_CLASS = np.full(256, 4, np.uint8)
_CLASS[[0x20, 9, 10, 11, 12, 13]] = 0
_CLASS[0x80:0xC0] = 1  # later bytes of a code point
_CLASS[[ord(c) for c in SYMBOLS]] = 2
_CLASS[0x41:0x5B] = 3


def mask_of(rules: tuple[str, ...]) -> int:
    names = [name for name, _ in RULES]
    return sum(1 << names.index(rule) for rule in rules)


def _repeated(words: np.ndarray) -> int:
    """Words inside runs of three that occur at least twice."""
    n = len(words)
    if n < 4:
        return 0
    runs = mix(mix(words[:-2]) * BASE + mix(words[1:-1] + BASE) + words[2:])
    ordered = np.sort(runs)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    hit = np.isin(runs, twice)
    inside = np.zeros(n, bool)
    for i in range(3):
        inside[i : n - 2 + i] |= hit
    return int(inside.sum())


def _lines(text: bytes) -> tuple[int, int]:
    """Lines that hold a word, and those of them equal to an earlier line."""
    held = [line for line in text.split(b"\n") if line.split(None, 1)]
    return len(held), len(held) - len(set(held))


@F.arrow_udf(T.StructType([T.StructField(m, T.LongType()) for m in MEASURES]))
def _measure(texts: pa.Array) -> pa.Array:
    held = [v.as_py() or b"" for v in texts]
    rows = []
    for text, words in zip(held, many_word_hashes(held)):
        kinds = np.bincount(_CLASS[np.frombuffer(text, np.uint8)], minlength=5)
        rows.append((len(words), kinds[2] + kinds[3] + kinds[4], kinds[2], kinds[3], *_lines(text), _repeated(words)))
    columns = np.array(rows, np.int64).reshape(len(rows), len(MEASURES)).T
    return pa.StructArray.from_arrays([pa.array(c) for c in columns], list(MEASURES))


def measured(text: Column) -> Column:
    """Struct of all measurements of a text: one Arrow pass, the rest of the row stays where it is."""
    return _measure(text.cast("string").cast("binary"))


def failure_bits(rules: tuple[tuple[str, str], ...] = RULES) -> Column:
    """One bit for each rule that fails, over the measurement columns."""
    bits = F.lit(0).cast("bigint")
    for i, (_, fails) in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(fails), F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    return bits


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, measurements and ``failed`` bits of every row: one pass over the texts, no shuffle."""
    rows = docs.select(docs[id_col].alias(id_col), measured(docs[text_col]).alias("m"))
    return rows.select(id_col, "m.*").withColumn("failed", failure_bits())


def accepted(docs: DataFrame, policy: str = "v2", text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, that pass a policy."""
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("doc"), measured(docs[text_col]).alias("m"))
    judged = rows.select("doc", "m.*").withColumn("failed", failure_bits())
    return judged.where(passes(policy)).select("doc.*")


def passes(policy: str, failed: str = "failed") -> Column:
    return F.col(failed).bitwiseAND(F.lit(mask_of(POLICIES[policy])).cast("bigint")) == 0


def ablations(rows: DataFrame, failed: str = "failed") -> DataFrame:
    """For each policy and each of its rules: documents, kept ones, and kept ones if the rule were dropped.

    Rows are first counted by their bits (at most one row per combination of rules), so the rest is small.
    """
    counts = rows.groupBy(F.col(failed).alias("bits")).agg(F.count("*").alias("n"))
    cases = [(p, r, mask_of(POLICIES[p]), mask_of((r,))) for p in POLICIES for r in POLICIES[p]]
    case = F.explode(F.array(*(
        F.struct(F.lit(p).alias("policy"), F.lit(r).alias("rule"), F.lit(m).cast("bigint").alias("mask"), F.lit(b).cast("bigint").alias("bit"))
        for p, r, m, b in cases
    ))).alias("c")
    each = counts.select("bits", "n", case)
    left = F.col("bits").bitwiseAND(F.col("c.mask"))
    return each.groupBy("c.policy", "c.rule").agg(
        F.sum("n").alias("n_docs"),
        F.sum(F.when(left == 0, F.col("n")).otherwise(0)).alias("n_kept"),
        F.sum(F.when(left.bitwiseAND(F.bitwise_not(F.col("c.bit"))) == 0, F.col("n")).otherwise(0)).alias("n_kept_without"),
    )
