"""Whole Arrow batches of texts as numpy arrays: words, word hashes and shingle hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

_powers: dict[str, np.ndarray] = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False
ALNUM = np.zeros(256, dtype=bool)  # ASCII letters and digits, and every byte of a longer character
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse, modulo 2**64, for i < n at least."""
    if len(_powers.get("up", ())) < n:
        size = max(n, CHUNK_BYTES + 1)
        for name, base in (("up", BASE), ("down", INVERSE)):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            _powers[name] = np.multiply.accumulate(p)
    return _powers["up"], _powers["down"]


def text_chunks(column: pa.Array, chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of pieces of a string column; null is empty.

    A piece holds whole texts, up to ``chunk_bytes`` unless one text alone is longer.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + chunk_bytes, "right")) - 1)
        yield at, end, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end
    pa.default_memory_pool().release_unused()  # two workers share an executor's memory with its JVM


def find_words(data: np.ndarray, offsets: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text) of every maximal run of ``kept`` bytes within a text."""
    inside = kept[data]
    firsts, lasts = inside.copy(), inside.copy()
    firsts[1:] &= ~inside[:-1]
    lasts[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    firsts[edges] = inside[edges]
    lasts[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(firsts), np.flatnonzero(lasts) + 1
    return starts, ends, np.searchsorted(offsets[1:], starts, "right")


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, wherever it stands."""
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingles(hashes: np.ndarray, text: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text, first word) of every k-word shingle; a text of fewer words is one shingle."""
    n = len(hashes)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.r_[0, np.flatnonzero(np.diff(text)) + 1]
    length = np.diff(np.r_[first, n])
    whole = np.flatnonzero(text[: n - k + 1] == text[k - 1 :]) if n >= k else np.zeros(0, np.int64)
    h = np.zeros(len(whole), np.uint64)
    for j in range(k):
        h = mix(h * BASE + hashes[whole + j])
    short = np.flatnonzero(length < k)
    s = np.zeros(len(short), np.uint64)
    for j in range(k - 1):
        has = length[short] > j
        s[has] = mix(s[has] * BASE + hashes[first[short][has] + j])
    at = np.r_[whole, first[short]]
    order = np.argsort(at, kind="stable")
    return np.r_[h, mix(s + length[short].astype(np.uint64))][order], text[at][order], at[order]
