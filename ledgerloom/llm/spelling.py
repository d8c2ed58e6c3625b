"""Spelling variants by asymmetric q-chunks.

Words are counted over all texts; words with exactly one inserted, deleted or replaced code point between them are near. To find
near words, a word of L code points contributes two disjoint chunks, its first half and the rest, and every word contributes positional
grams of the same lengths. One edit lies in one of the two chunks, so the other chunk stands whole in the near word, at its own
place or shifted by one. The same holds once more inside the chunk that is hit: it has two disjoint halves, and one of them stands
whole too. So each pair meets in a join by (L, quarter that is hit, letters of the chunk and the half that stand). As the first word
is the one that is not longer, the places at which its chunks can stand after one edit are known: what is before the hit quarter at its own place,
what is behind it shifted by the difference in length, which is none or one. Only those grams are posted. A chunk alone would do for the
result, but words of a large vocabulary share halves by the thousand, and three quarters seldom. The edit distance is verified inside the join, so no
unverified pair is written.

A word's form is its near word with the largest count (ties: the smallest in code-point order), if that count is at least
``RATIO`` times the word's own. Counts grow along the forms, so they are chains without a circle whose length is at most the logarithm of
the largest count; their ends are found by pointer doubling, each round written to the shared folder.

Texts are read in Arrow batches and pieces of a megabyte. Words are counted inside the task before anything is shuffled, and the table of
counts of a task is emitted whenever it holds ``HELD`` words, so memory is bounded and a frequent word is a few rows per task.

A missing or empty text has no words; a missing id counts as the empty string in the deletion hash. Repeated rows count again. Very long
runs of letters are words like others. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm.common import pieces, stored, workspace

LEAST_LETTERS = 5
LEAST_COUNT = 3
RATIO = 2
HELD = 200_000
# A word is a run of these letters after A-Z are lower-cased; one in 97 loses a letter.
_RUN = re.compile(r"[a-zÀ-ÿ]{%d,}" % LEAST_LETTERS)
ONE_IN = 97


def _dropped(word: str, mark: int) -> str:
    """The word without a letter, if its mark says so."""
    if mark % ONE_IN:
        return word
    at = mark % len(word)
    return word[:at] + word[at + 1 :]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter[str] = Counter()

    def emitted() -> pa.RecordBatch:
        words = [w for w in held if len(w) >= LEAST_LETTERS]
        out = pa.RecordBatch.from_pydict({"word": pa.array(words, pa.string()), "n": pa.array([held[w] for w in words], pa.int64())})
        held.clear()
        return out

    for batch in batches:
        for doc, text in zip(batch.column(0), batch.column(1)):
            if not text.is_valid:
                continue
            start = zlib.crc32(f"{doc.as_py() if doc.is_valid else ''}:".encode())
            for piece in pieces(text.as_buffer().to_pybytes()):
                # Bytes are lower-cased in A-Z only.
                for word, n in Counter(_RUN.findall(piece.lower().decode())).items():
                    held[_dropped(word, zlib.crc32(word.encode(), start))] += n
                if len(held) >= HELD:
                    yield emitted()
    if held:
        yield emitted()


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of all words that occur ``least`` times or more."""
    rows = docs.select(docs[id_col].cast("string").alias("id"), docs[text_col].cast("string").alias("text"))
    counts = rows.mapInArrow(_count, "word string, n bigint")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _grams(size: Column, shift: int) -> list[tuple[Column, int, Column]]:
    """(L, quarter, letters) of the places where the chunks of a word of ``size`` letters stand if that quarter is hit and the word
    is longer by ``shift``."""
    word = F.col("word")
    half = F.floor(size / 2).cast("int")
    ends = [F.lit(0), F.floor(half / 2).cast("int"), half, half + F.floor((size - half) / 2).cast("int"), size]
    out = []
    for hit in range(4):
        whole = [(ends[q], ends[q + 1], 0 if q < hit else shift) for q in range(4) if q != hit]
        out.append((size, hit, F.concat_ws("|", *(F.substring(word, a + moved + 1, b - a) for a, b, moved in whole))))
    return out


def _posted(words: DataFrame, places: list[tuple[Column, int, Column]], side: str) -> DataFrame:
    """One row per place (L, quarter, letters) of a word."""
    each = F.array(*(F.struct(size.alias("size"), F.lit(hit).alias("hit"), gram.alias("gram")) for size, hit, gram in places))
    rows = words.select(F.col("word").alias(f"word{side}"), F.col("n").alias(f"n{side}"), F.explode(each).alias("c"))
    return rows.select("c.*", f"word{side}", f"n{side}")


def near_pairs(words: DataFrame) -> DataFrame:
    """(worda, na, wordb, nb): every pair of near words once, the shorter one, or of equal length the smaller one, first."""
    length = F.char_length("word")
    a = _posted(words, _grams(length, 0), "a")
    b = _posted(words, _grams(length, 0) + _grams(length - 1, 1), "b")
    same = [a[c] == b[c] for c in ("size", "hit", "gram")]
    once = (F.char_length("wordb") > F.char_length("worda")) | (F.col("worda") < F.col("wordb"))
    # Spark sizes the posted rows by the stored words, as if each of them were posted once and as short as in the file; it would take
    # millions of rows for a table to copy through the driver.
    pairs = a.join(b.hint("merge"), [*same, once, F.levenshtein("worda", "wordb", 1) == 1])
    # An edit inside a run of equal letters can be seen in two quarters.
    return pairs.select("worda", "na", "wordb", "nb").distinct()


def _ends(links: DataFrame) -> DataFrame:
    """(word, up) with ``up`` the last word of the chain of links that begins at ``word``."""
    now = stored(links, "spelling-links")
    while True:
        # As long as the words, and in the file a tenth of its size in memory: nothing to copy through the driver.
        further = now.select(F.col("word").alias("mid"), F.col("up").alias("far")).hint("merge")
        step = now.join(further, now["up"] == further["mid"], "left")
        step = stored(step.select("word", F.coalesce("far", "up").alias("up"), F.col("far").isNotNull().alias("moved")), "spelling-links")
        now = step.select("word", "up")
        if step.where("moved").isEmpty():
            return now


def variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_COUNT, ratio: int = RATIO
) -> DataFrame:
    """Per word: ``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n``; words that share a root are one group."""
    with workspace(docs.sparkSession) as keep:
        words = stored(word_counts(docs, id_col, text_col, least), "spelling-words")
        pairs = near_pairs(words)
        sides = F.array(
            F.struct(F.col("worda").alias("word"), F.col("wordb").alias("other"), F.col("nb").alias("m")),
            F.struct(F.col("wordb").alias("word"), F.col("worda").alias("other"), F.col("na").alias("m")),
        )
        each = pairs.select(F.explode(sides).alias("s")).select("s.*")
        best = F.min(F.struct((-F.col("m")).alias("less"), F.col("other").alias("other")))
        its = each.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
        taken = -F.col("best.less") >= F.col("n") * ratio
        formed = words.join(its, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), F.when(taken, F.col("best.other")).alias("form"),
            F.when(taken, -F.col("best.less")).alias("form_n"),
        )
        formed = stored(formed, "spelling-forms")
        ends = _ends(formed.where("form IS NOT NULL").select("word", F.col("form").alias("up")))
        out = formed.join(ends.hint("merge"), "word", "left")
        return keep(out.select("word", "form", F.coalesce("up", "word").alias("root"), "n", "n_near", "form_n"), "spelling-variants")
