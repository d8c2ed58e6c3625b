"""Token counts of whole texts under a byte-level BPE vocabulary.

Method: which vocabulary strings encode alone as one token is proved once, on the driver, by running the merges
over every vocabulary string. A pre-token that is such a string counts 1 by one lookup; only the rest is
merged, and its counts are remembered in a bounded table per worker.

A missing text counts as empty. Strings of special tokens inside a text are one token each, as the library does by
default. No truncation: texts of any length are counted whole. Rows keep their number, repeated rows are counted each.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

# Letters and digits that Unicode assigned after version 16, which the tokenizer's tables still hold as
# other signs; first and last code point of each range.
LATE_LETTERS = (
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F), (0x209D, 0x209F),
    (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1),
    (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A),
    (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1), (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686),
    (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20),
    (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6),
    (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2),
    (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E),
    (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
)
KEPT_COUNTS = 1 << 19


@functools.lru_cache(maxsize=1)
def splitters() -> tuple[re.Pattern, re.Pattern]:
    """The split pattern of byte-level vocabularies, for ASCII texts and for all texts.

    Classes are written out as ranges, built from the Unicode properties less the late ones.
    """
    late = {c for a, b in LATE_LETTERS for c in range(a, b + 1)}
    every = "".join(chr(c) for c in range(0x110000) if c not in late and not 0xD800 <= c < 0xE000)
    spans = {
        name: "".join(f"\\U{ord(m[0][0]):08X}-\\U{ord(m[0][-1]):08X}" for run in regex.findall(rf"{prop}+", every) for m in _runs(run))
        for name, prop in (("L", r"\p{L}"), ("N", r"\p{N}"), ("S", r"\s"))
    }

    def build(letter: str, digit: str, space: str) -> re.Pattern:
        return re.compile(
            f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{digit}]+| ?[^{space}{letter}{digit}]+|[{space}]+(?![^{space}])|[{space}]+"
        )

    return build("A-Za-z", "0-9", r"\t-\r "), build(spans["L"], spans["N"], spans["S"])


def _runs(text: str) -> Iterator[tuple[str]]:
    """Parts of ``text`` whose code points follow each other."""
    start = 0
    for i in range(1, len(text) + 1):
        if i == len(text) or ord(text[i]) != ord(text[i - 1]) + 1:
            yield (text[start:i],)
            start = i


def pre_tokens(text: str) -> list[str]:
    plain, full = splitters()
    return (plain if text.isascii() else full).findall(text)




def byte_letters() -> dict[int, str]:
    """The printable stand-in of every byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in table:
            table[b] = chr(0x100 + len(table) - len(plain))
    return table


def merge_count(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """Tokens left of ``symbols`` when the lowest-ranked neighbouring pair is merged again and again."""
    n = len(symbols)
    if n < 200:
        none = 1 << 60
        rank = [ranks.get(pair, none) for pair in zip(symbols, symbols[1:])]
        while rank and (best := min(rank)) < none:
            i = rank.index(best)
            symbols[i] += symbols.pop(i + 1)
            del rank[i]
            if i:
                rank[i - 1] = ranks.get((symbols[i - 1], symbols[i]), none)
            if i < len(rank):
                rank[i] = ranks.get((symbols[i], symbols[i + 1]), none)
        return len(symbols)
    # Long pre-tokens: a heap of pairs over a linked list, so that the work stays n log n.
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if (r := ranks.get((a, b))) is not None]
    heapq.heapify(heap)
    left = n
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i]
        if symbols[i] != a or j >= n or symbols[j] != b:
            continue
        symbols[i], symbols[j] = a + b, ""
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        left -= 1
        for x, y in ((before[i], i), (i, after[i])):
            if x >= 0 and y < n and (r := ranks.get((symbols[x], symbols[y]))) is not None:
                heapq.heappush(heap, (r, x, symbols[x], symbols[y]))
    return left


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> tuple[dict[tuple[str, str], int], frozenset[str], tuple[str, ...]]:
    """Merge ranks, the texts proved to be one token alone, and the special strings of a tokenizer file."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    pairs = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
    ranks = {tuple(m): i for i, m in enumerate(pairs)}
    specials = tuple(t["content"] for t in spec["added_tokens"])
    to_byte = {c: b for b, c in byte_letters().items()}
    whole = set()
    for piece in spec["model"]["vocab"]:
        if any(c not in to_byte for c in piece):
            continue
        try:
            text = bytes(to_byte[c] for c in piece).decode()
        except UnicodeDecodeError:
            continue
        if pre_tokens(text) == [text] and merge_count(list(piece), ranks) == 1:
            whole.add(text)
    return ranks, frozenset(whole), specials


class _Counts(dict):
    """Token count by pre-token: whole tokens first, the rest by merging."""

    def __init__(self, ranks, whole):
        super().__init__(dict.fromkeys(whole, 1))
        self.ranks, self.whole, self.letters = ranks, whole, byte_letters()

    def __missing__(self, piece: str) -> int:
        n = merge_count([self.letters[b] for b in piece.encode()], self.ranks)
        if len(self) >= KEPT_COUNTS:
            self.clear()
            self.update(dict.fromkeys(self.whole, 1))
        if len(piece) < 64:
            self[piece] = n
        return n


_COUNTERS: dict[int, tuple] = {}


def _counter(shared):
    """The worker's counter for a broadcast vocabulary, kept while the worker lives."""
    if shared.id not in _COUNTERS:
        ranks, whole, specials = shared.value
        cut = regex.compile("|".join(map(regex.escape, sorted(specials, key=len, reverse=True)))) if specials else None
        _COUNTERS.clear()
        _COUNTERS[shared.id] = (_Counts(ranks, whole), cut)
    return _COUNTERS[shared.id]


class _Shared:
    """A broadcast with a name by which a worker finds what it has built from it."""

    def __init__(self, held, name: str):
        self.held, self.id = held, name

    @property
    def value(self):
        return self.held.value


def count_text(text: str, counts: _Counts, cut) -> int:
    parts = cut.split(text) if cut else [text]
    return len(parts) - 1 + sum(sum(map(counts.__getitem__, pre_tokens(p))) for p in parts)


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024) -> DataFrame:
    """``id_col``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every row; other columns are not read.

    The vocabulary is as large as its file, whatever the data, so it is broadcast. No shuffle.
    """
    shared = _Shared(docs.sparkSession.sparkContext.broadcast(vocabulary(path)), path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, cut = _counter(shared)
        for batch in batches:
            texts = batch.column(1)
            n_bytes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            tokens = [0 if t is None else count_text(t, counts, cut) for t in (v.as_py() for v in texts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), n_bytes, pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())],
                ["id", "n_bytes", "n_tokens", "over_limit"],
            )

    rows = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
    return out.withColumnRenamed("id", id_col)
