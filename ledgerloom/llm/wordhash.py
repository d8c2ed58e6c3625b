"""Vectorised 64-bit hashes of the words of many texts, for use inside Arrow tasks.

A word is a run of bytes other than space and \\x09-\\x0D. Its hash is a polynomial of its bytes, taken from
prefix sums over a whole buffer, so no Python loop runs over words. Buffers are cut at white space, so the
memory is bounded by ``PIECE`` bytes (or by the longest single word).
"""

from __future__ import annotations

import numpy as np

PIECE = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get("up")
    if have is None or len(have) < n:
        size = max(n, PIECE + 1)
        for name, base in (("up", int(BASE)), ("down", pow(int(BASE), -1, 1 << 64))):
            steps = np.full(size, np.uint64(base))
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


def _hash_piece(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and start offsets of the words of one buffer."""
    space = _SPACE[data]
    edge = np.diff(np.concatenate(([True], space, [True])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return np.empty(0, np.uint64), starts
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts]), starts


def _pieces(data: bytes):
    """Cuts of at most PIECE bytes that end at white space, or one word longer than that."""
    at = 0
    while at < len(data):
        end = min(len(data), at + PIECE)
        if end < len(data):
            cut = max(data.rfind(bytes((c,)), at, end) for c in (0x20, 0x0A))
            if cut > at:
                end = cut + 1
            else:
                view = np.frombuffer(data, np.uint8, offset=end)
                later = np.flatnonzero(_SPACE[view])
                end = end + int(later[0]) + 1 if len(later) else len(data)
        yield np.frombuffer(data, np.uint8, end - at, at)
        at = end


def word_hashes(data: bytes) -> np.ndarray:
    """Hashes of the words of one text, in order."""
    parts = [_hash_piece(piece)[0] for piece in _pieces(data)]
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def many_word_hashes(texts: list[bytes | None]):
    """Yield the word hashes of each text; short texts are hashed together, a missing text has no words."""
    held: list[bytes] = []
    size = 0

    def flush():
        joined = b"\n".join(held)
        hashes, starts = _hash_piece(np.frombuffer(joined, np.uint8)) if joined else (np.empty(0, np.uint64), np.empty(0, int))
        begins = np.concatenate(([0], np.cumsum([len(t) + 1 for t in held])))
        cuts = np.searchsorted(starts, begins)
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield hashes[a:b]

    for text in texts:
        text = text or b""
        if len(text) > PIECE // 2:
            yield from flush() if held else ()
            held, size = [], 0
            yield word_hashes(text)
            continue
        if size + len(text) > PIECE:
            yield from flush()
            held, size = [], 0
        held.append(text)
        size += len(text) + 1
    if held:
        yield from flush()


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``k`` words; a text of fewer words, but not none, is one run."""
    n = len(words)
    if n == 0:
        return words
    width = min(k, n)
    total = np.zeros(n - width + 1, np.uint64)
    for i in range(width):
        total = mix(total * BASE + words[i : n - width + 1 + i] + np.uint64(1))
    return np.unique(total + np.uint64(width if n < k else k))
