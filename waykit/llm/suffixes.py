"""Removal of repeated byte strings by column-wise construction of a collection's Burrows-Wheeler transform."""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waykit.llm import textvec as tv
from waykit.llm.common import pick, stored

LENGTH = 200  # bytes of a repeated string
GRAM = 50  # bytes of an anchor
CLASS = 16  # consecutive windows that one collection string covers
COLLECTION_BYTES = 256 << 10
PART_BYTES = 2 << 20  # strings a task holds
SPANS = "array<struct<first: int, last: int>>"
HEAVY = 20_000  # occurrences of an anchor beyond which its windows are counted one by one
_LOW = np.uint64((1 << 24) - 1)
_REACH = 1 << 20  # bytes of a text looked at together; positions must fit 24 bits
_PIECE = 1 << 18  # bytes of short texts looked at together: two workers share an executor's memory with its JVM


# --- windows by anchor ---------------------------------------------------------------------------


def _sums(data: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * tv.powers(len(data) + 1)[0][: len(data)], out=sums[1:])
    return sums


def _spans(sums: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return tv.mix((sums[b] - sums[a]) * tv.powers(len(sums))[1][a] + (b - a).astype(np.uint64))


def anchor_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, start, windows, anchor, at, content hash) of runs of windows with one anchor.

    A window's anchor is its leftmost ``GRAM`` bytes of smallest hash, so equal windows have equal anchors at
    equal places. A run is a stretch of consecutive windows that share the anchor's place; it spans ``windows + LENGTH - 1`` bytes
    from ``start``, with the anchor ``at`` bytes into it.
    """
    if len(data) < LENGTH:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.int64, np.uint64))
    sums = _sums(data)
    grams = np.arange(len(data) - GRAM + 1)
    hashes = _spans(sums, grams, grams + GRAM)
    width = LENGTH - GRAM + 1
    key = (hashes & ~_LOW) | grams.astype(np.uint64)
    rows = np.r_[key, np.full(-len(key) % width, np.uint64(2**64 - 1))].reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(data) - LENGTH + 1
    place = (np.minimum(behind[:n], ahead[width - 1 : width - 1 + n]) & _LOW).astype(np.int64)
    start = np.arange(n)
    text = np.searchsorted(offsets[1:], start, "right")
    inside = start + LENGTH <= offsets[text + 1]
    start, text, place = start[inside], text[inside], place[inside]
    fresh = np.r_[True, (place[1:] != place[:-1]) | (text[1:] != text[:-1])] if len(start) else np.zeros(0, bool)
    first = np.flatnonzero(fresh)
    windows = np.diff(np.r_[first, len(start)])
    begin = start[first]
    content = _spans(sums, begin, begin + windows + LENGTH - 1)
    return text[first], begin - offsets[text[first]], windows, hashes[place[first]], place[first] - begin, content


def text_runs(column: pa.Array) -> Iterator[tuple[int, tuple[np.ndarray, ...]]]:
    """(first row, runs) of pieces of a column; texts beyond ``_REACH`` bytes are cut with overlap."""
    for first, _, data, offsets in tv.text_chunks(column, _PIECE):
        if len(data) <= _REACH:
            yield first, anchor_runs(data, offsets)
            continue
        for at in range(0, len(data), _REACH):  # one text
            part = data[at : at + _REACH + LENGTH - 1]
            text, start, *rest = anchor_runs(part, np.array([0, len(part)]))
            yield first, (text, start + at, *rest)


def all_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, prints = batch.column(0), batch.column(1)
        for first, (text, start, windows, anchor, at, content) in text_runs(batch.column(2)):
            row = pa.array(first + text)
            yield pa.record_batch(
                [ids.take(row), prints.take(row), pa.array(start), pa.array(windows.astype(np.int32)),
                 pa.array(anchor.view(np.int64)), pa.array(at.astype(np.int32)), pa.array(content.view(np.int64))],
                ["doc_id", "print", "start", "windows", "anchor", "at", "content"],
            )


# --- column-wise construction --------------------------------------------------------------------


def range_minima(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Minimum of ``values[low..high]``, both ends included."""
    order = np.argsort(low, kind="stable")
    ends = np.empty(2 * len(low), np.int64)
    ends[0::2], ends[1::2] = low[order], high[order] + 1
    out = np.empty(len(low), values.dtype)
    if len(low):
        out[order] = np.minimum.reduceat(np.r_[values, values[:1]], ends)[::2]
    return out


class Columns:
    """The sorted suffixes of a collection, as a sequential file that every round reads and writes anew.

    Per suffix eight bytes: the common prefix with the suffix before it (up to 250), the symbol before it (the
    transform; 0 at a string's start), and its number (string * stride + length).
    """

    def __init__(self, folder: str) -> None:
        self.file = open(f"{folder}/columns", "w+b", buffering=0)  # noqa: SIM115
        self.count = 0

    def write(self, rows: np.ndarray) -> None:
        os.pwrite(self.file.fileno(), rows, 0)
        self.count = len(rows)

    def read(self) -> np.ndarray:
        rows = np.empty(self.count, np.uint64)
        os.preadv(self.file.fileno(), [rows.view(np.uint8)], 0)
        return rows

    def close(self) -> None:
        self.file.close()


def packed_rows(who: np.ndarray, bwt: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    return who.astype(np.uint64) << np.uint64(16) | bwt.astype(np.uint64) << np.uint64(8) | lcp.astype(np.uint64)


def sort_collection(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, folder: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, suffix length, common prefix with the one before) of all suffixes, in order.

    Round j inserts the suffix of length j of every string that has one. Its place follows from the place of the suffix one
    shorter: among the suffixes that start with the new symbol, those whose rest stands before it come
    first. Its common prefix with its neighbours is one more than the least between their rests.
    """
    stride = int(lengths.max()) + 1
    ends = starts + lengths
    symbol = lambda who, j: np.where(j <= lengths[who], data[np.maximum(ends[who] - j, starts[who])] + np.uint8(1), 0).astype(np.uint8)
    everyone = np.arange(len(starts))
    last = symbol(everyone, 1)
    singles = np.cumsum(np.bincount(last, minlength=256))
    order = np.argsort(last, kind="stable")
    place = np.empty(len(starts), np.int64)
    place[order] = everyone
    common = np.zeros(len(starts), np.uint8)
    common[1:] = last[order][1:] == last[order][:-1]
    files = Columns(folder)
    files.write(packed_rows(order * stride + 1, symbol(order, 2), common))
    for j in range(2, stride):
        rows = files.read()
        lcp, bwt = np.ascontiguousarray(rows.view(np.uint8).reshape(-1, 8)[:, :2].T)
        new = np.flatnonzero(lengths >= j)
        at = place[new]
        c = bwt[at]
        by_symbol = np.argsort(bwt, kind="stable")
        newest = np.zeros(len(rows), bool)
        newest[at] = True
        rank = np.empty(len(new), np.int64)
        rank[np.lexsort((at, c))] = np.flatnonzero(newest[by_symbol])
        goes = rank - np.count_nonzero(bwt == 0) + singles[c]
        before = by_symbol[np.maximum(rank - 1, 0)]
        has = (rank > 0) & (bwt[before] == c)
        fresh = (singles[c] > singles[c.astype(np.int64) - 1]).astype(np.int64)  # after a string's single last symbol
        fresh[has] = np.minimum(range_minima(lcp, before[has] + 1, at[has]).astype(np.int64) + 1, 250)
        after = by_symbol[np.minimum(rank + 1, len(rows) - 1)]
        has = (rank + 1 < len(rows)) & (bwt[after] == c)
        less = np.minimum(range_minima(lcp, at[has] + 1, after[has]).astype(np.int64) + 1, 250)
        old = np.ones(len(rows) + len(new), bool)
        old[goes] = False
        merged_rows = np.empty(len(old), np.uint64)
        merged_rows[old] = rows
        merged_rows[goes] = packed_rows(new * stride + j, symbol(new, j + 1), fresh)
        merged_rows.view(np.uint8).reshape(-1, 8)[goes[has] + 1, 0] = less  # the next suffix with the symbol follows
        place[new] = goes
        files.write(merged_rows)
    rows = files.read()
    files.close()
    who = (rows >> np.uint64(16)).astype(np.int64)
    return who // stride, who % stride, (rows & np.uint64(255)).astype(np.uint8)


def repeated_windows(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, copies: np.ndarray) -> np.ndarray:
    """Which windows occur at least twice in the collection, copies counted, string after string."""
    with tempfile.TemporaryDirectory() as folder:
        string, length, lcp = sort_collection(data, starts, lengths, folder)
    group = np.cumsum(lcp < LENGTH)
    full = length >= LENGTH
    string, length, group = string[full], length[full], group[full]
    first = np.r_[0, np.cumsum(lengths - LENGTH + 1)]
    flags = np.zeros(first[-1], bool)
    flags[first[string] + lengths[string] - length] = np.bincount(group, weights=copies[string])[group] > 1
    return flags


def stretches(flags: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, last, run) of every maximal stretch of true inside each run; ``offsets`` says where runs begin in ``flags``."""
    run = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    true = np.flatnonzero(flags)
    if not len(true):
        return (np.zeros(0, np.int64),) * 3
    fresh = np.r_[True, (np.diff(true) > 1) | (run[true[1:]] != run[true[:-1]])]
    heads = np.flatnonzero(fresh)
    first, last = true[heads], true[np.r_[heads[1:] - 1, len(true) - 1]]
    return first - offsets[run[first]], last - offsets[run[last]], run[first]


def judge(anchor: np.ndarray, copies: np.ndarray, at: np.ndarray, windows: np.ndarray, blocks: list[bytes]) -> list[np.ndarray]:
    """Per run content: which of its windows occur at least twice among all given.

    Windows whose anchor stands at about the same place share their middle. They are compared only where the
    middle is equal; a middle with one string around it needs no sorting, the others form the collections.
    """
    data = np.frombuffer(b"".join(blocks), np.uint8)
    begin = np.r_[0, np.cumsum(windows + LENGTH - 1)][:-1]
    low, high = (at - windows + 1) // CLASS, at // CLASS
    run = np.repeat(np.arange(len(at)), high - low + 1)
    klass = np.arange(len(run)) - np.repeat(np.r_[0, np.cumsum(high - low + 1)][:-1], high - low + 1) + low[run]
    first = np.maximum(0, at[run] - klass * CLASS - CLASS + 1)
    last = np.minimum(windows[run] - 1, at[run] - klass * CLASS)
    sums = _sums(data)
    middle = begin[run] + at[run] - klass * CLASS
    core = tv.mix(_spans(sums, middle, middle + LENGTH - CLASS + 1) + tv.mix(anchor[run] + klass.astype(np.uint64)))
    body = _spans(sums, begin[run] + first, begin[run] + last + LENGTH)
    order = np.lexsort((body, core))
    new_core = np.r_[True, core[order][1:] != core[order][:-1]]
    new_body = new_core | np.r_[True, body[order][1:] != body[order][:-1]]
    kind = np.cumsum(new_body) - 1  # distinct strings, in order of core
    total = np.bincount(kind, weights=copies[run][order])
    heads = np.flatnonzero(new_body)
    group = np.cumsum(new_core)[heads]
    alone = np.bincount(group)[group] == 1
    size = (last - first + LENGTH)[order][heads]
    held_at = np.r_[0, np.cumsum(size - LENGTH + 1)]
    flags = np.repeat(alone & (total > 1), size - LENGTH + 1)
    contested = np.flatnonzero(~alone)
    where = (begin[run] + first)[order][heads]
    for w in collections(group[contested], size[contested]):
        k = contested[w]
        part = np.concatenate([data[a : a + n] for a, n in zip(where[k], size[k], strict=True)])
        settled = repeated_windows(part, np.r_[0, np.cumsum(size[k])][:-1], size[k], total[k])
        flags[np.repeat(held_at[k] - np.r_[0, np.cumsum(size[k] - LENGTH + 1)][:-1], size[k] - LENGTH + 1) + np.arange(len(settled))] = settled
    offsets = np.r_[0, np.cumsum(windows)]
    n = (last - first + 1)[order]
    inner = np.arange(n.sum()) - np.repeat(np.r_[0, np.cumsum(n)][:-1], n)
    out = np.zeros(offsets[-1], bool)
    out[np.repeat((offsets[:-1][run] + first)[order], n) + inner] = flags[np.repeat(held_at[:-1][kind], n) + inner]
    return np.split(out, offsets[1:-1])


def collections(group: np.ndarray, size: np.ndarray) -> Iterator[np.ndarray]:
    """Strings, in order of their group, as collections of whole groups; each ends with the group that fills it."""
    waiting, held = 0, 0
    for end in [*(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist(), len(group)]:
        held = int(size[waiting:end].sum())
        if held and (held >= COLLECTION_BYTES or end == len(group)):
            yield np.arange(waiting, end)
            waiting = end


def judge_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, content, spans): stretches (first, last) of repeated windows of every run content, anchor by anchor."""

    def settle(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(rows)
        num = lambda c: t.column(c).to_numpy().astype(np.int64)
        anchor, content = num("anchor"), num("content")
        found = judge(anchor.view(np.uint64), num("copies"), num("at"), num("windows"), t.column("block").to_pylist())
        first, last, run = stretches(np.concatenate(found), np.r_[0, np.cumsum(num("windows"))])
        counts = np.bincount(run, minlength=len(anchor))
        spans = pa.StructArray.from_arrays([pa.array(first, pa.int32()), pa.array(last, pa.int32())], ["first", "last"])
        spans = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)], pa.int32()), spans)
        made = pa.record_batch([pa.array(anchor), pa.array(content), spans], ["anchor", "content", "spans"])
        return made.filter(pa.array(counts > 0))

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.nbytes
        if size >= 4 * PART_BYTES:
            # Rows come in order of the anchor: the last anchor may go on in the next batch.
            whole = pa.Table.from_batches(held).combine_chunks()
            anchor = whole.column("anchor").to_numpy()
            cut = int(np.searchsorted(anchor, anchor[-1]))
            if cut:
                yield settle(whole.slice(0, cut).to_batches())
                held = whole.slice(cut).to_batches()
                size = sum(b.nbytes for b in held)
    if held:
        yield settle(held)


# --- texts -----------------------------------------------------------------------------------------


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed, as they are moved and stored."""
    press = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        packed = [press.compress(t.as_buffer() if t.is_valid else b"") for t in batch.column(2).cast(pa.binary())]
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], ["doc_id", "print", "packed"])


def cut_blocks(heavy: bool):
    """The wanted run contents of each text; of heavy anchors a hash pair per window instead."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            for packed, wanted in zip(batch.column(0), batch.column(1), strict=True):
                rows = [w for w in wanted.as_py() or () if w["heavy"] == heavy]
                if not rows:
                    continue
                text = unpress.decompress(packed.as_py())
                if not heavy:
                    columns = [[w[c] for w in rows] for c in ("anchor", "content", "copies", "at", "windows")]
                    blocks = [text[w["start"] : w["start"] + w["windows"] + LENGTH - 1] for w in rows]
                    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
                    yield pa.record_batch(
                        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)] + [pa.array(blocks, pa.binary())],
                        ["anchor", "content", "copies", "at", "windows", "block"],
                    )
                    continue
                data = np.frombuffer(text, np.uint8)
                sums, twin = _sums(data), _sums(data ^ np.uint8(0xA5))
                for w in rows:
                    s = w["start"] + np.arange(w["windows"])
                    fill = lambda v, n=len(s): pa.array(np.full(n, v, np.int64))
                    yield pa.record_batch(
                        [fill(w["anchor"]), fill(w["content"]), fill(w["copies"]), pa.array((s - w["start"]).astype(np.int32)),
                         pa.array(_spans(sums, s, s + LENGTH).view(np.int64)), pa.array(_spans(twin, s, s + LENGTH).view(np.int64))],
                        ["anchor", "content", "copies", "w", "h1", "h2"],
                    )

    return run


def without(text: bytes, low: np.ndarray, high: np.ndarray) -> tuple[bytes, int]:
    """What stays of ``text`` outside the spans [low, high), and the number of maximal removed runs."""
    order = np.argsort(low, kind="stable")
    low, high = low[order], np.maximum.accumulate(high[order])
    fresh = np.r_[True, low[1:] > high[:-1]]
    low, high = low[fresh], high[np.r_[np.flatnonzero(fresh)[1:] - 1, len(high) - 1]]
    return b"".join(text[a:b] for a, b in zip([0, *high.tolist()], [*low.tolist(), len(text)], strict=True)), len(low)


def finish(with_kept: bool):
    """A map over (doc_id, print, packed, marks) that cuts the marked bytes out of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            removed, spans, kept, digests = [], [], [], []
            for packed, marks in zip(batch.column(2), batch.column(3), strict=True):
                text = unpress.decompress(packed.as_py())
                low, high = marks.values.flatten()
                left, runs = without(text, low.to_numpy(), high.to_numpy())
                removed.append(len(text) - len(left))
                spans.append(runs)
                kept.append(left if with_kept else None)
                digests.append(hashlib.sha256(left).hexdigest())
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.string())
            made = [pa.array(c, k) for c, k in zip((removed, spans, kept, digests), kinds, strict=True)]
            yield pa.record_batch([batch.column(0), batch.column(1), *made], ["doc_id", "print", "n_removed", "n_spans", "kept", "kept_sha256"])

    return run


# --- on Spark --------------------------------------------------------------------------------------


def _same_row(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["print"] == b["print"])


def merged(windows: Column) -> Column:
    """Stretches of consecutive numbers of a sorted array."""
    at = lambda i: F.get(windows, i)
    first = F.filter(windows, lambda w, i: (i == 0) | (at(i - 1) < w - 1))
    last = F.filter(windows, lambda w, i: (i == F.size(windows) - 1) | (at(i + 1) > w + 1))
    return F.arrays_zip(first.alias("first"), last.alias("last"))


def repeated_spans(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Compressed texts that hold repeats, and lists of the byte spans (begin, end) to remove from each."""
    runs = texts.select("doc_id", "print", "text").mapInArrow(
        all_runs, "doc_id bigint, print bigint, start bigint, windows int, anchor bigint, at int, content bigint"
    )
    runs = stored(runs, "all-runs", row_group=32 << 20)
    shared = (
        runs.groupBy("anchor")
        .agg(F.count("*").alias("n"), F.min("content").alias("one"), F.max("content").alias("other"))
        .where("n > 1")
        .select("anchor", (F.col("one") != F.col("other")).alias("contested"), (F.col("n") > HEAVY).alias("heavy"))
    )
    # Written down, so that Spark sees both sides of the join as they are and splits what is skewed.
    shared = stored(shared, "repeat-anchors")
    runs = stored(runs.join(shared, "anchor"), "repeat-runs")
    rep = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "print", "start"))
    contents = (
        runs.where("contested")
        .groupBy("anchor", "content")
        .agg(F.count("*").alias("copies"), rep.alias("rep"), F.first("windows").alias("windows"), F.first("at").alias("at"), F.first("heavy").alias("heavy"))
        .select("anchor", "content", "copies", "windows", "at", "heavy", "rep.doc_id", "rep.print", "rep.start")
    )
    wanted = contents.groupBy("doc_id", "print").agg(
        F.collect_list(F.struct("anchor", "content", "copies", "at", "windows", "start", "heavy")).alias("wanted")
    )
    # Every text with a repeat once, and with it the contents that are read from it.
    marked = runs.select("doc_id", "print").distinct()
    marked = marked.join(wanted, _same_row(marked, wanted), "left").select(marked["doc_id"], marked["print"], "wanted")
    packed = texts.select("doc_id", "print", "text").mapInArrow(pack, "doc_id bigint, print bigint, packed binary")
    held = packed.join(marked, _same_row(packed, marked)).select(packed["doc_id"], packed["print"], "packed", "wanted")
    held = stored(held, "repeat-texts")

    plain = held.where("wanted IS NOT NULL").select("packed", "wanted")
    total = contents.agg(F.sum(F.col("windows") + LENGTH), F.max(F.col("heavy").cast("int"))).first()
    parts = max(1, -(-(total[0] or 0) // PART_BYTES))
    blocks = plain.mapInArrow(cut_blocks(False), "anchor bigint, content bigint, copies bigint, at int, windows int, block binary")
    found = (
        blocks.repartition(parts, "anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(judge_partition, f"anchor bigint, content bigint, spans {SPANS}")
    )
    if total[1]:
        each = plain.mapInArrow(cut_blocks(True), "anchor bigint, content bigint, copies bigint, w int, h1 bigint, h2 bigint")
        twice = each.groupBy("h1", "h2").agg(F.sum("copies").alias("n")).where("n > 1").select("h1", "h2")
        found = found.unionByName(
            each.join(twice, ["h1", "h2"]).groupBy("anchor", "content").agg(merged(F.sort_array(F.collect_set("w"))).cast(SPANS).alias("spans"))
        )
    # One row per run content, so that the join makes one row per run.
    span = lambda a, b: F.struct((F.col("start") + a).alias("begin"), (F.col("start") + b + LENGTH).alias("end"))
    spans = (
        runs.where("contested")
        .join(stored(found, "repeat-windows"), ["anchor", "content"])
        .select("doc_id", "print", F.transform("spans", lambda s: span(s["first"], s["last"])).alias("spans"))
        .unionByName(runs.where("NOT contested").select("doc_id", "print", F.array(span(F.lit(0), F.col("windows") - 1)).alias("spans")))
    )
    return held.select("doc_id", "print", "packed"), spans


def remove_repeats(docs: DataFrame, with_kept: bool = True) -> DataFrame:
    """(doc_id, kept, n_bytes, n_removed, n_spans, kept_sha256) per row of ``docs``; ``kept`` is the bytes that stay
    (left out unless ``with_kept``).

    Every byte goes that is covered by a 200-byte string which also starts anywhere else, in the same document or
    another; all are judged on the input.

    1. Windows are grouped by anchor and written down once. Anchors that occur once hold no repeat and are dropped after a count.
    2. Runs of windows with equal content are combined. An anchor with one content repeats as it stands.
    3. The other contents are sorted in collections, column by column (``sort_collection``), in tasks of bounded size;
       neighbours with a common prefix of 200 bytes are repeats. An anchor with more than ``HEAVY`` occurrences would be too
       large for a task: its windows are counted one by one, by 128-bit hashes.
    4. A content's repeats are merged to stretches, one row per content, before its runs meet them.
    5. Spans are gathered per document and cut out of its text. Texts travel compressed, and only those with repeats twice.

    Null and empty text has no bytes. Rows that repeat a doc_id are documents of their own; equal rows too. Null doc_id
    is allowed. Other columns are ignored.
    """
    base = pick(docs, doc_id="bigint", text="string").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    texts = base.select("doc_id", F.xxhash64("text").alias("print"), "text")
    held, spans = repeated_spans(texts)
    marks = spans.groupBy("doc_id", "print").agg(F.flatten(F.collect_set("spans")).alias("marks"))
    once = held.dropDuplicates(["doc_id", "print"])
    cut = once.join(marks, _same_row(once, marks)).select(once["doc_id"], once["print"], "packed", "marks")
    results = cut.mapInArrow(
        finish(with_kept), "doc_id bigint, print bigint, n_removed bigint, n_spans bigint, kept binary, kept_sha256 string"
    )
    results = stored(results, "repeat-results")
    columns = ["doc_id", "print", F.octet_length("text").cast("bigint").alias("n_bytes"), F.sha2("text", 256).alias("whole")]
    whole = texts.select(*columns, *([F.col("text").cast("binary").alias("all")] if with_kept else []))
    joined = whole.join(results, _same_row(whole, results), "left")
    return joined.select(
        whole["doc_id"],
        *([F.coalesce("kept", "all").alias("kept")] if with_kept else []),
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"),
    )


def digest(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs, with_kept=False)


ORACLE = r"""
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b, strlen(coalesce(text, '')) AS n FROM documents),
w AS (SELECT doc_id, i, md5(array_slice(b, i + 1, i + 200)) AS s FROM (SELECT doc_id, b, unnest(range(0, n - 199)) AS i FROM d)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY s) AS c FROM w) WHERE c > 1),
g AS (SELECT *, i > 200 + lag(i, 1, -1000) OVER (PARTITION BY doc_id ORDER BY i) AS fresh FROM r),
k AS (SELECT *, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM g),
s AS (SELECT doc_id, k, min(i) AS a, max(i) + 200 AS e FROM k GROUP BY ALL),
c AS (SELECT doc_id, a, e, lag(e, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS from_ FROM s),
x AS (SELECT c.doc_id, count(*) AS n_spans, sum(e - a) AS n_removed, max(e) AS tail,
    string_agg(substr(hex(b), 2 * from_ + 1, 2 * (a - from_)), '' ORDER BY a) AS head FROM c JOIN d USING (doc_id) GROUP BY c.doc_id)
SELECT d.doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  CASE WHEN n_spans IS NULL THEN sha256(b) ELSE sha256(unhex(head || substr(hex(b), 2 * tail + 1))) END AS kept_sha256
FROM d LEFT JOIN x USING (doc_id)
"""
