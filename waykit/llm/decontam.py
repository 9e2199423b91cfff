"""Benchmark decontamination: SimHashes of item-sized windows looked up in Hamming blocks, candidates compared exactly."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waykit.llm import textvec as tv
from waykit.llm.common import DOCUMENT, pick

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 31  # of 128 bits, at most
BLOCKS = 16  # of 8 bits: within RADIUS some block differs in at most RADIUS // BLOCKS = 1 bit
BLOCK_BYTES = 16 << 20  # benchmark text held by a task at once
VOTES = 1 << 16  # shingles whose votes are held at once
SCHEMA = "doc_id bigint, item_id bigint, start_word bigint, n_words bigint, hamming int, similarity double, found_by string"
_SALT = np.uint64(0xD1B54A32D192ED03)


def occurrences(windows: np.ndarray) -> np.ndarray:
    """Each row's shingles numbered, as hashes of (shingle, how often it has come before), so that a bag becomes a set."""
    order = np.sort(windows, axis=1)
    place = np.arange(order.shape[1])
    fresh = np.ones(order.shape, bool)
    fresh[:, 1:] = order[:, 1:] != order[:, :-1]
    number = place - np.maximum.accumulate(np.where(fresh, place, 0), axis=1)
    return tv.mix(order + number.astype(np.uint64) * tv.BASE)


def fingerprints(windows: np.ndarray) -> np.ndarray:
    """128-bit SimHash, as 16 bytes, of each row of shingle hashes; one vote per (shingle, occurrence)."""
    out = np.empty((len(windows), BLOCKS), np.uint8)
    width = windows.shape[1]
    step = max(1, VOTES // max(width, 1))
    for r in range(0, len(windows), step):
        marks = occurrences(windows[r : r + step])
        votes = np.zeros((len(marks), 128), np.int64)
        for c in range(0, width, VOTES):
            part = marks[:, c : c + VOTES]
            halves = np.stack([part, tv.mix(part ^ _SALT)], axis=-1)
            votes += np.unpackbits(halves.view(np.uint8), axis=-1).sum(axis=1, dtype=np.int64)
        out[r : r + step] = np.packbits(2 * votes > width, axis=-1)
    return out


def radius(size: int) -> int:
    """Bits that fingerprints of sets of ``size`` may differ in at a similarity of ``SIMILARITY``.

    Two such sets share at least 2 * 0.8 / 1.8 of their votes; a bit of sums with that correlation differs with
    probability arccos / pi. The radius is three deviations above the mean, and 0 where sets must be equal.
    """
    share = min(1.0, np.ceil(2 * SIMILARITY / (1 + SIMILARITY) * size - 1e-9) / size)
    p = np.arccos(share) / np.pi
    return min(RADIUS, int(128 * p + 3 * np.sqrt(128 * p * (1 - p))))


@dataclass
class HammingBlocks:
    """Fingerprints of the items of one size, listed under every value that a block has or is one bit away from."""

    items: np.ndarray
    prints: np.ndarray
    radius: int
    starts: np.ndarray
    members: np.ndarray

    @classmethod
    def build(cls, items: np.ndarray, prints: np.ndarray, reach: int) -> HammingBlocks:
        near = np.r_[0, 1 << np.arange(8)].astype(np.uint8)
        value = prints[:, :, None] ^ near  # item, block, change
        slot = (np.arange(BLOCKS)[None, :, None] * 256 + value).ravel()
        order = np.argsort(slot, kind="stable")
        starts = np.r_[0, np.cumsum(np.bincount(slot, minlength=256 * BLOCKS))]
        return cls(items, prints, reach, starts.astype(np.int32), (order // (BLOCKS * 9)).astype(np.int32))

    def within(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, member) of all pairs of a row of ``found`` and a fingerprint within the radius; none is missed."""
        slot = np.arange(BLOCKS) * 256 + found.astype(np.int64)
        row, at = expand(self.starts, slot.ravel())
        pairs = np.unique(row // BLOCKS * len(self.items) + self.members[at])
        row, member = pairs // len(self.items), pairs % len(self.items)
        stays = np.bitwise_count(found[row] ^ self.prints[member]).sum(axis=1) <= self.radius
        return row[stays], member[stays]


def expand(starts: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index in ``wanted``, place) of all places of the lists ``wanted``, where list k is at starts[k] to starts[k + 1]."""
    low = starts[wanted].astype(np.int64)
    n = starts[wanted + 1] - low
    row = np.repeat(np.arange(len(wanted)), n)
    return row, np.arange(len(row)) - np.repeat(np.r_[0, np.cumsum(n)][:-1], n) + np.repeat(low, n)


@dataclass
class BenchmarkIndex:
    """One block of items: Hamming blocks per item size, and their shingles with the items that hold them, as arrays.

    ``holders[holder_at[k] : holder_at[k + 1]]`` are the items with shingle k, ``counts`` how often they have it.
    Items of fewer words than a shingle are only in ``short``: by their number of words, under the hash of all of them.
    """

    ids: list[int | None]
    n_words: np.ndarray
    sizes: np.ndarray
    prints: np.ndarray
    blocks: dict[int, HammingBlocks]
    shingles: np.ndarray
    holder_at: np.ndarray
    holders: np.ndarray
    counts: np.ndarray
    short: dict[int, dict[int, list[int]]]

    @classmethod
    def build(cls, items: list[tuple[int | None, str | None]]) -> BenchmarkIndex:
        ids, words, lists, short = [], [], [], {}
        for item_id, text in items:
            hashes, n = shingle_list(text or "")
            if n == 0:
                continue
            if n < SHINGLE:
                short.setdefault(n, {}).setdefault(int(hashes[0]), []).append(len(ids))
                hashes = hashes[:0]
            ids.append(item_id)
            words.append(n)
            lists.append(hashes)
        sizes = np.array([len(x) for x in lists], np.int64)
        prints = np.zeros((len(lists), BLOCKS), np.uint8)
        blocks = {}
        for size in np.unique(sizes[sizes > 0]).tolist():
            same = np.flatnonzero(sizes == size)
            for i in same.tolist():
                prints[i] = fingerprints(lists[i][None, :])[0]
            blocks[size] = HammingBlocks.build(same, prints[same], radius(size))
        values = np.concatenate([np.zeros(0, np.uint64), *lists])
        owner = np.repeat(np.arange(len(lists), dtype=np.int32), sizes)
        order = np.lexsort((owner, values))
        values, owner = values[order], owner[order]
        first = np.flatnonzero(np.r_[True, (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])]) if len(values) else np.zeros(0, np.int64)
        counts = np.diff(np.r_[first, len(values)]).astype(np.int32)
        shingles, holder_at = np.unique(values[first], return_index=True)
        holder_at = np.r_[holder_at, len(first)].astype(np.int32)
        return cls(ids, np.array(words, np.int64), sizes, prints, blocks, shingles, holder_at, owner[first], counts, short)

    def nbytes(self) -> int:
        tables = [self.prints, self.shingles, self.holder_at, self.holders, self.counts]
        return sum(a.nbytes for a in tables + [a for b in self.blocks.values() for a in (b.items, b.prints, b.starts, b.members)])


def shingle_list(text: str) -> tuple[np.ndarray, int]:
    """Shingle hashes in order, and the number of words: runs of letters and digits, A-Z lower-cased."""
    column = pa.array([text])
    for _, _, data, offsets in tv.text_chunks(column):
        hashes, owner, _ = word_hashes(data, offsets)
        return tv.shingles(hashes, owner, SHINGLE)[0], len(hashes)
    return np.zeros(0, np.uint64), 0


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    starts, ends, owner = tv.find_words(data, offsets, tv.ALNUM)
    return tv.span_hashes(tv.LOWER[data], starts, ends), owner, starts


def best_window(places: np.ndarray, values: np.ndarray, wanted: np.ndarray, length: int, last: int) -> tuple[int, int]:
    """(shared shingles, start) of the window that shares most with an item, the first of equal ones; exact.

    ``places`` are where a text has shingles of the item, in order, ``values`` those shingles, ``wanted`` how often the item
    has them. A window of ``length`` starts at ``last`` at most. One at p counts in the windows that hold it and fewer earlier
    equal ones than the item has, which is one span of starts; so all windows are counted from the ends of the spans.
    """
    order = np.argsort(values, kind="stable")
    same, at = values[order], places[order]
    full = np.arange(len(same)) - wanted[order]  # the last equal one that a window must have left behind
    behind = np.maximum(full, 0)
    after = np.where((full >= 0) & (same[behind] == same), at[behind] + 1, 0)
    low = np.maximum(after, np.maximum(at - length + 1, 0))
    fits = (low <= last) & (low <= at)
    low, high = np.sort(low[fits]), np.sort(at[fits])
    starts = np.unique(low)  # the count rises nowhere else
    shared = np.searchsorted(low, starts, "right") - np.searchsorted(high, starts, "left")
    k = int(np.argmax(shared))
    return int(shared[k]), int(starts[k])


def block_candidates(hashes: np.ndarray, known: np.ndarray, index: BenchmarkIndex, sizes: list[int]) -> set[int]:
    """Items whose fingerprint is within the radius of that of some window of their size, by Hamming blocks.

    Windows with too few benchmark shingles for a similarity of ``SIMILARITY`` with any item are passed over; no
    matching window is.
    """
    found: set[int] = set()
    held = np.r_[0, np.cumsum(known >= 0)]
    for size in sizes:
        length = min(size, len(hashes))
        inside = held[length:] - held[: len(held) - length]
        starts = np.flatnonzero(inside >= SIMILARITY / (1 + SIMILARITY) * (length + size) - 1e-9)
        table = index.blocks[size]
        step = max(1, VOTES // length)
        for at in range(0, len(starts), step):
            windows = hashes[starts[at : at + step, None] + np.arange(length)]
            found.update(table.items[table.within(fingerprints(windows))[1]].tolist())
    return found


def match_text(hashes: np.ndarray, known: np.ndarray, index: BenchmarkIndex) -> Iterator[tuple[int, int, int, int, float, str]]:
    """(item, start, words, hamming, similarity, found by) of the best window of each item that the text leaks.

    Candidates come from the Hamming blocks. A radius cannot keep every window of the similarity, so the items of which
    the text has enough shingles for a match, and that no block has listed, are candidates too (found by ``shingles``).
    All are compared exactly, over all windows of the text.
    """
    at = np.flatnonzero(known >= 0)
    row, spot = expand(index.holder_at, known[at])
    order = np.argsort(index.holders[spot], kind="stable")
    item, places, wanted = index.holders[spot][order], at[row][order], index.counts[spot][order]
    heads = np.flatnonzero(np.r_[True, item[1:] != item[:-1]]) if len(item) else np.zeros(0, np.int64)
    ends = np.r_[heads[1:], len(item)]
    # A window shares at most as many shingles with an item as the text has of the item.
    enough = (ends - heads) >= SIMILARITY * index.sizes[item[heads]] - 1e-9
    if not enough.any():
        return
    listed = block_candidates(hashes, known, index, np.unique(index.sizes[item[heads[enough]]]).tolist())
    for low, high in zip(heads[enough].tolist(), ends[enough].tolist(), strict=True):
        i, held = int(item[low]), places[low:high]
        size = int(index.sizes[i])
        length = min(size, len(hashes))
        shared, start = best_window(held, hashes[held], wanted[low:high], length, len(hashes) - length)
        similarity = shared / (length + size - shared)
        if similarity >= SIMILARITY - 1e-12:
            window = fingerprints(hashes[None, start : start + length])[0]
            apart = int(np.bitwise_count(window ^ index.prints[i]).sum())
            yield i, start, length + SHINGLE - 1, apart, similarity, "blocks" if i in listed else "shingles"


def leaks(column: pa.Array, bench: BenchmarkIndex) -> Iterator[tuple[int, int, int, int, int, float, str]]:
    """(row, item, start, words, hamming, similarity, found by) of the items that the texts of a batch leak."""
    for first, _, data, offsets in tv.text_chunks(column):
        words, owner, _ = word_hashes(data, offsets)
        h, text, _ = tv.shingles(words, owner, SHINGLE)
        known = np.full(len(h), -1)
        if len(bench.shingles):
            spot = np.minimum(np.searchsorted(bench.shingles, h), len(bench.shingles) - 1)
            known = np.where(bench.shingles[spot] == h, spot, -1)
        for t in np.unique(text[known >= 0]).tolist():
            low, high = np.searchsorted(text, [t, t + 1])
            for found in match_text(h[low:high], known[low:high], bench):
                yield first + t, *found
        for n, wanted in bench.short.items():
            seen = set()
            for at, key in enumerate(sequences(words, owner, n).tolist()):
                for i in wanted.get(key, ()):
                    t = int(owner[at])
                    if (t, i) not in seen:
                        seen.add((t, i))
                        yield first + t, i, at - int(np.searchsorted(owner, t)), n, 0, 1.0, "sequence"


def matcher(index):
    """A map over Arrow batches (doc_id, text) to their leaks of the broadcast ``index``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bench: BenchmarkIndex = index.value
        for batch in batches:
            ids = batch.column(0).to_pylist()
            out = [(ids[row], bench.ids[i], *found) for row, i, *found in leaks(batch.column(1), bench)]
            columns = list(zip(*out, strict=True)) or [[]] * len(ARROW)
            yield pa.record_batch([pa.array(list(c), kind) for c, kind in zip(columns, ARROW.types, strict=True)], schema=ARROW)

    return run


def cleaner(index):
    """A map over batches with the text in the second column that leaves out the rows that leak an item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stays = np.ones(batch.num_rows, bool)
            stays[[row for row, *_ in leaks(batch.column(1), index.value)]] = False
            yield batch.filter(pa.array(stays))

    return run


def sequences(words: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` words (0 across texts), equal to that of a text of just these words."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    h = np.zeros(len(words) - n + 1, np.uint64)
    for j in range(n):
        h = tv.mix(h * tv.BASE + words[j : len(words) - n + 1 + j])
    h = tv.mix(h + np.uint64(n))
    h[owner[: len(h)] != owner[n - 1 :]] = 0
    return h


ARROW = pa.schema(
    [("doc_id", pa.int64()), ("item_id", pa.int64()), ("start_word", pa.int64()), ("n_words", pa.int64()),
     ("hamming", pa.int32()), ("similarity", pa.float64()), ("found_by", pa.string())]
)


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, start_word, n_words, hamming, similarity, found_by): the best window of every item that a text leaks.

    Words are runs of letters and digits, A-Z lower-cased; shingles have five of them. A window has as many words as
    the item (the whole text where that is shorter). Its 128-bit SimHash, one vote per (shingle, occurrence), is looked up
    among the items of that size: 16 blocks of 8 bits, each with all values one bit away, list every fingerprint
    within a radius that follows from the size (31 at most). Items so found are compared exactly and leak where the
    weighted Jaccard of the shingle bags is at least 0.8 (``found_by`` blocks). No radius keeps all windows of that
    similarity, so items of which the text holds enough shingles, but that no block lists, are compared
    as well (``found_by`` shingles). Items of fewer than five words match as exact sequences (``found_by`` sequence).

    Nothing is shuffled: the benchmark is broadcast in blocks of at most 16 MB of text (``BLOCK_BYTES``, measured
    first), one pass over the texts per block. Null and empty texts and items match nothing, null ids stay null,
    repeated rows and items each give their matches, other columns are ignored.
    """
    texts = pick(docs, doc_id="bigint", text="string")
    found = docs.sparkSession.createDataFrame([], SCHEMA)
    for index in benchmark_blocks(benchmark):
        found = found.unionByName(texts.mapInArrow(matcher(index), SCHEMA))
    return found


def benchmark_blocks(benchmark: DataFrame) -> Iterator[Broadcast]:
    """The items, broadcast in blocks of bounded size."""
    spark = benchmark.sparkSession
    items = pick(benchmark, item_id="bigint", text="string").where("text IS NOT NULL").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 if size <= BLOCK_BYTES else 2 * -(-size // BLOCK_BYTES)
    for b in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        yield spark.sparkContext.broadcast(BenchmarkIndex.build([(r["item_id"], r["text"]) for r in part]))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that leak no item, with the columns of documents; nothing is shuffled."""
    left = pick(docs, **DOCUMENT)
    schema = ", ".join(f"{n} {t}" for n, t in DOCUMENT.items())
    for index in benchmark_blocks(benchmark):
        left = left.mapInArrow(cleaner(index), schema)
    return left


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return find_leaks(docs, benchmark)
