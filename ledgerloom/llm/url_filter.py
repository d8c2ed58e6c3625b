"""URL verdicts: rules by host and path, and a classifier of hashed character n-grams for everything else.

The host runs from the first ``://`` to the next ``/``, ``?``, ``#`` or the end, with A-Z lower-cased; the path runs from there
to ``?``, ``#`` or the end. A missing url, or one without ``://``, has empty host and path. A rule fits its host and all
subdomains if the path starts with the rule's path; the longest fitting rule decides. Urls that no rule fits are
judged by logistic regression, trained on a small labelled table of urls (``url_labels``, or any other with the same columns); the
rules' own verdicts are not labels. Without labelled urls of both kinds the method says what the labels say, or allow.

Repeated urls and rows are judged each and alike. Of rules of one length the first by host and path decides, and a score of just one half blocks. Very
long urls are read whole: work grows with their length, memory with their distinct n-grams, at most ``DIMENSIONS``. An empty
table gives no rows. Only the id and the url are read, so other columns may have any name. No shuffle.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerloom.llm.common import UPPER
from ledgerloom.llm.url_labels import labelled_urls

DIMENSIONS = 1 << 14
GRAMS = (2, 3, 4, 5)
ROUNDS, RATE, L2 = 200, 2.0, 1e-4

# Fixed values: (host, path, verdict).
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path columns; ``(?s)`` lets line ends be ordinary characters."""
    found = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.coalesce(F.regexp_extract(url, found, 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(url, found, 2), F.lit(""))
    return F.translate(host, UPPER, UPPER.lower()), path


def fitting_rule(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, or null; a handful of rules are tests in one expression."""
    chosen = None
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        value = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        chosen = F.when(fits, value) if chosen is None else chosen.when(fits, value)
    return chosen


def features(host: str, path: str) -> np.ndarray:
    """Distinct hashed n-grams of host and path, each with its side and its edges marked."""
    found = set()
    for side, text in (("h", f"^{host}$"), ("p", f"^{path}$")):
        data = text.encode()
        seed = zlib.crc32(side.encode())
        for n in GRAMS:
            for i in range(len(data) - n + 1):
                found.add(zlib.crc32(data[i : i + n], seed + n) % DIMENSIONS)
    return np.fromiter(sorted(found), np.int64, len(found))


def known_urls(spark: SparkSession) -> DataFrame:
    """The small labelled table (host, path, verdict) that comes with the package; any other of these columns does as well."""
    rows = spark.createDataFrame(labelled_urls(), "url string, verdict string")
    host, path = split_url(rows["url"])
    return rows.select(host.alias("host"), path.alias("path"), "verdict")


def fit(rows: list[tuple[str, str, str]]) -> tuple[np.ndarray, float]:
    """Full-batch logistic regression; both verdicts weigh alike, whatever their number."""
    rows = sorted(rows)
    y = np.array([v == "block" for _, _, v in rows], float)
    if not rows or y.all() or not y.any():
        return np.zeros(DIMENSIONS), 35.0 if rows and y.all() else -35.0
    lists = [features(h, p) for h, p, _ in rows]
    index = np.concatenate(lists)
    row = np.repeat(np.arange(len(rows)), [len(a) for a in lists])
    value = 1.0 / np.sqrt(np.array([len(a) for a in lists]))[row]
    share = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    w, b, speed = np.zeros(DIMENSIONS), 0.0, np.full(DIMENSIONS, 1e-8)
    for _ in range(ROUNDS):
        s = np.bincount(row, w[index] * value, len(rows)) + b
        g = (1 / (1 + np.exp(-np.clip(s, -35, 35))) - y) * share
        grad = np.bincount(index, g[row] * value, DIMENSIONS) + L2 * w
        speed += grad * grad
        w -= RATE * grad / np.sqrt(speed)
        b -= RATE * g.sum()
    return w, b


def judge(
    urls: DataFrame, known: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES,
) -> DataFrame:
    """``id_col``, host, path, rule, verdict and the method's block score of every row; only the id and the url are read.

    ``known`` is the labelled table (host, path, verdict), small by definition and no part of the corpus: it goes to the driver, and
    the weights it gives are a fixed ``DIMENSIONS`` numbers.
    """
    w, b = fit([tuple(r) for r in known.select("host", "path", "verdict").collect()])
    held = urls.sparkSession.sparkContext.broadcast((w, b))
    host, path = split_url(urls[url_col].cast("string"))
    rows = urls.select(urls[id_col].alias("id"), host.alias("host"), path.alias("path"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, bias = held.value
        for batch in batches:
            scores = []
            for h, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                at = features(h, p)
                scores.append(float(weight[at].sum() / np.sqrt(max(1, len(at))) + bias))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(1 / (1 + np.exp(-np.clip(np.array(scores, float), -35, 35))), pa.float64())],
                ["id", "host", "path", "block_score"],
            )

    out = rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, host string, path string, block_score double")
    rule = fitting_rule(F.col("host"), F.col("path"), rules)
    return out.select(
        F.col("id").alias(id_col), "host", "path", rule["rule"].alias("rule"),
        F.coalesce(rule["verdict"], F.when(F.col("block_score") >= 0.5, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        "block_score",
    )
