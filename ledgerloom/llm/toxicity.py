"""Toxicity scores by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are presence flags of hashed words, neighbouring pairs and pairs with one or two words between. Each coordinate has
its own learning rate; the L1 term keeps most weights at exactly zero, so what travels to the tasks is a short list of
(index, weight) and never more than ``DIMENSIONS`` of them.

The model is fitted on a bounded sample of the labelled rows: for each label the ``SAMPLE`` rows that come first by a seeded
hash of their id. A missing or empty text has no features and gets the score of the intercept. Long texts are scored whole.
Repeated rows are scored each. Without labelled rows of both kinds every score is the intercept's 0.5 or the label's share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.wordhash import BASE, many_word_hashes, mix

DIMENSIONS = 1 << 22
SAMPLE = 3000
ALPHA, BETA, L1, L2 = 4.0, 1.0, 4.0, 0.0
PASSES = 6
# A coordinate is learnt once this many sampled rows have it; rarer ones only tell single rows apart.
LEAST_ROWS = 4


def features(words: np.ndarray) -> np.ndarray:
    """Distinct feature indices of one text from the hashes of its lower-cased words."""
    grams = [words]
    for gap in (1, 2, 3):
        if len(words) > gap:
            grams.append(mix(words[:-gap] * BASE + words[gap:] + np.uint64(gap)))
    return np.unique((np.concatenate(grams) % np.uint64(DIMENSIONS)).astype(np.int32))


def _texts(column: pa.Array) -> list[bytes]:
    return [(v.as_py() or b"").lower() for v in column]


def _featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [features(words) for words in many_word_hashes(_texts(batch.column(1)))]
        ends = np.concatenate(([0], np.cumsum([len(f) for f in found]))).astype(np.int32)
        values = np.concatenate(found) if found else np.empty(0, np.int32)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(values))], ["toxic", "f"])


def sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic", size: int = SAMPLE) -> DataFrame:
    """Label and text of the first ``size`` rows of each label by a seeded hash of the id: at most ``2 * size`` rows."""
    known = labels.where(labels[label_col].isin(0, 1) & labels[id_col].isNotNull())
    known = known.groupBy(known[id_col].alias("id")).agg(F.max(label_col).cast("int").alias("toxic"))
    first = [known.where(F.col("toxic") == label).orderBy(F.xxhash64(F.lit(17), "id"), "id").limit(size) for label in (0, 1)]
    few = first[0].unionByName(first[1])
    texts = docs.select(docs[id_col].alias("id"), docs["text"].cast("string").cast("binary").alias("text"))
    # At most 2 * size ids, so the broadcast has a fixed bound and the other texts are not shuffled. Of an id's rows the greatest text
    # is taken, so the sample is one row per id however often the id is repeated.
    found = texts.join(F.broadcast(few), "id")
    return found.groupBy("id").agg(F.max("toxic").alias("toxic"), F.max("text").alias("text")).select("toxic", "text", "id")


class Model:
    """Weights by feature index; nearly all are zero and are not kept."""

    def __init__(self, index: np.ndarray, weight: np.ndarray, bias: float):
        self.index, self.weight, self.bias = index, weight, bias

    def dense(self) -> np.ndarray:
        full = np.zeros(DIMENSIONS)
        full[self.index] = self.weight
        return full


def fit(rows: list[tuple[int, np.ndarray]], passes: int = PASSES) -> Model:
    """FTRL-proximal over (label, feature indices) in the given order."""
    seen = np.zeros(DIMENSIONS, np.int32)
    for _, at in rows:
        seen[at] += 1
    rows = [(label, at[seen[at] >= LEAST_ROWS]) for label, at in rows]
    z, n = np.zeros(DIMENSIONS), np.zeros(DIMENSIONS)
    zb = nb = 0.0

    def weights(zs, ns):
        active = np.abs(zs) > L1
        return np.where(active, -(zs - np.sign(zs) * L1) / ((BETA + np.sqrt(ns)) / ALPHA + L2), 0.0)

    def step(square, gradient):
        return (np.sqrt(square + gradient * gradient) - np.sqrt(square)) / ALPHA

    bias = 0.0
    for _ in range(passes):
        for label, at in rows:
            zs, ns = z[at], n[at]
            w = weights(zs, ns)
            g = 1.0 / (1.0 + np.exp(-np.clip(w.sum() + bias, -35, 35))) - label
            z[at] = zs + g - step(ns, g) * w
            n[at] = ns + g * g
            zb += g - step(nb, g) * bias
            nb += g * g
            bias = -zb / ((BETA + np.sqrt(nb)) / ALPHA)
    w = weights(z, n)
    kept = np.flatnonzero(w)
    return Model(kept, w[kept], float(bias))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic", size: int = SAMPLE) -> Model:
    """Features are made in the tasks; at most ``2 * size`` index lists reach the driver, in a seeded order."""
    chosen = sample(docs, labels, id_col, label_col, size)
    made = chosen.orderBy(F.xxhash64(F.lit(29), "id"), "id").select(F.col("toxic"), "text").mapInArrow(_featurize, "toxic int, f array<int>")
    rows = made.toArrow()
    lists = rows.column("f").combine_chunks()
    values, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
    return fit([(t, values[a:b]) for t, a, b in zip(rows.column("toxic").to_pylist(), offsets[:-1], offsets[1:])])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id") -> DataFrame:
    """``id_col`` and ``score`` of every row; only the id and the text are read. No shuffle."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, bias = held.value.dense(), held.value.bias
        for batch in batches:
            sums = [weight[features(words)].sum() for words in many_word_hashes(_texts(batch.column(1)))]
            scores = 1.0 / (1.0 + np.exp(-np.clip(np.array(sums) + bias, -35, 35)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["id", "score"])

    rows = docs.select(docs[id_col].alias("id"), docs["text"].cast("string").cast("binary").alias("text"))
    out = rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, score double")
    return out.withColumnRenamed("id", id_col)


def held_out(doc_id, folds: int = 5):
    """Rows that are kept from learning: the checksum of the id as text is a multiple of ``folds``."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))
