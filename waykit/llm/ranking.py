"""Exact ranked lexical search: sparse ball trees over documents, searched best-first for the largest inner products."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waykit.llm import textvec as tv
from waykit.llm.common import pick, stored

TOP = 50
BLOCK_BYTES = 1 << 20  # of item text that is searched for at a time
LEAF = 32  # documents
TREE_ROWS = 8192  # documents of a tree at most
TREE_CELLS = 8 << 20  # of the centroids of a tree: fewer documents where items have very many different terms
SALTS = 64  # first merges of an item's candidates
NULL_KEY = -(1 << 64)  # of a document without id, which comes last among equal scores

VECTORS = "doc_id bigint, n bigint, terms array<int>, tf array<int>"
VECTORS_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tf", pa.list_(pa.int32()))]
)
HITS = "item int, doc_id bigint, score bigint"
HITS_ARROW = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])


def term_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of every term: runs of letters, digits and characters beyond ASCII, A-Z lower-cased."""
    starts, ends, owner = tv.find_words(data, offsets, tv.ALNUM)
    return tv.span_hashes(tv.LOWER[data], starts, ends), owner


def item_terms(texts: list[str]) -> list[np.ndarray]:
    """The distinct term hashes of each text."""
    out = []
    for _, end, data, offsets in tv.text_chunks(pa.array(texts, pa.string())):
        hashes, owner = term_hashes(data, offsets)
        out += [np.unique(hashes[owner == i]) for i in range(len(offsets) - 1)]
    return out


def vectors(vocabulary):
    """A map over batches (doc_id, text) to every text with a term: its length and how often it has each known term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        width = max(len(known), 1)
        for batch in batches:
            for first, end, data, offsets in tv.text_chunks(batch.column(1)):
                hashes, owner = term_hashes(data, offsets)
                n = np.bincount(owner, minlength=end - first)
                spot = np.minimum(np.searchsorted(known, hashes), width - 1)
                met = known[spot] == hashes if len(known) else np.zeros(len(hashes), bool)
                cells, tf = np.unique(owner[met] * width + spot[met], return_counts=True)
                rows = np.flatnonzero(n)
                ends = np.r_[0, np.searchsorted(cells, (rows + 1) * width)]
                ends = pa.array(ends, pa.int32())
                yield pa.record_batch(
                    [
                        batch.column(0).slice(first, end - first).take(pa.array(rows)),
                        pa.array(n[rows]),
                        pa.ListArray.from_arrays(ends, pa.array(cells % width, pa.int32())),
                        pa.ListArray.from_arrays(ends, pa.array(tf, pa.int32())),
                    ],
                    schema=VECTORS_ARROW,
                )

    return run


def term_weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """What each occurrence count adds per unit of term weight; ``n`` is its document's length. All in whole numbers."""
    if 50 * documents * int(n.max(initial=0)) >= 1 << 63:
        m = np.array([50 + 50 * int(x) * documents // length for x in n], dtype=np.int64)
    else:
        m = 50 + 50 * n * documents // max(length, 1)
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


@dataclass
class Rows:
    """Sparse vectors of some documents; none is empty."""

    keys: np.ndarray  # of the documents
    starts: np.ndarray
    cols: np.ndarray
    vals: np.ndarray

    def part(self, chosen: np.ndarray) -> Rows:
        lengths = np.diff(np.r_[self.starts, len(self.cols)])
        cells = np.repeat(chosen, lengths)
        starts = np.r_[0, np.cumsum(lengths[chosen])[:-1]]
        return Rows(self.keys[chosen], starts, self.cols[cells], self.vals[cells])

    def dot(self, dense: np.ndarray) -> np.ndarray:
        return np.add.reduceat(dense[self.cols] * self.vals, self.starts)


class BallTree:
    """Documents in nested balls. Centroids are whole numbers and radii are rounded up, so that bounds hold exactly."""

    def __init__(self, rows: Rows, width: int) -> None:
        self.width = width
        self.radius: list[int] = []
        self.children: list[list[int] | None] = []
        self.leaves: list[Rows | None] = []
        centroids: list[np.ndarray] = []
        reaches: list[np.ndarray] = []
        todo = [(rows, -1, 0)]
        while todo:
            part, parent, side = todo.pop()
            node = len(centroids)
            if parent >= 0:
                self.children[parent][side] = node
            halves = self._grow(part, centroids, reaches)
            self.children.append([0, 0] if halves else None)
            self.leaves.append(None if halves else part)
            if halves:
                todo += [(half, node, k) for k, half in enumerate(halves)]
        self.centroids, self.reaches = np.array(centroids), np.array(reaches)

    def _grow(self, part: Rows, centroids: list[np.ndarray], reaches: list[np.ndarray]) -> tuple[Rows, Rows] | None:
        """Adds the ball of these rows; their two halves unless it is a leaf."""
        count = len(part.keys)
        centroid = np.bincount(part.cols, weights=part.vals, minlength=self.width).astype(np.int64) // count
        squares = np.add.reduceat(part.vals * part.vals, part.starts)
        apart = squares - 2 * part.dot(centroid) + int(centroid @ centroid)
        centroids.append(centroid.astype(np.int32))
        reach = np.zeros(self.width, np.int32)
        np.maximum.at(reach, part.cols, part.vals.astype(np.int32))
        reaches.append(reach - centroids[-1])
        self.radius.append(math.isqrt(int(apart.max())) + 1)
        if count <= LEAF or int(apart.max()) == 0:
            return None
        one = self._distances(part, squares, int(np.argmax(apart)))
        other = self._distances(part, squares, int(np.argmax(one)))
        left = np.zeros(count, bool)
        left[np.argpartition(one - other, count // 2)[: count // 2]] = True
        return part.part(left), part.part(~left)

    def _distances(self, part: Rows, squares: np.ndarray, row: int) -> np.ndarray:
        dense = np.zeros(self.width, np.int64)
        end = part.starts[row + 1] if row + 1 < len(part.starts) else len(part.cols)
        cells = slice(part.starts[row], end)
        dense[part.cols[cells]] = part.vals[cells]
        return squares - 2 * part.dot(dense) + squares[row]

    def bound(self, node: int, query: Query) -> int:
        """No document of the ball scores more than its centroid does, plus what its distance from there can add.

        By Cauchy and Schwarz that is the radius times the query's norm. The radius counts all terms, though, and a query has
        few; term by term no document goes further above the centroid than the ball's reach in that term. The less counts.
        """
        middle = int(self.centroids[node, query.terms] @ query.weights)
        return middle + min(query.norm * self.radius[node], int(self.reaches[node, query.terms] @ query.weights))

    def search(self, query: Query) -> int:
        """Offers the query every document that may be among its best; the number of leaves looked into."""
        open_balls = [(-self.bound(0, query), 0)]
        looked = 0
        while open_balls:
            bound, node = heapq.heappop(open_balls)
            if -bound < query.least:
                break  # balls come by falling bound, and equal scores are still to be told apart by document
            if self.children[node]:
                for child in self.children[node]:
                    b = self.bound(child, query)
                    if b >= query.least:
                        heapq.heappush(open_balls, (-b, child))
            else:
                looked += 1
                query.offer(self.leaves[node].keys, self.leaves[node].dot(query.dense))
        return looked


class Query:
    """One item: its weighted terms and the best documents so far."""

    def __init__(self, terms: np.ndarray, weights: np.ndarray, width: int, top: int) -> None:
        self.terms, self.weights, self.top = terms, weights, top
        self.norm = math.isqrt(sum(int(w) ** 2 for w in weights)) + 1
        self.dense = np.zeros(width, np.int64)
        self.dense[terms] = weights
        self.least = 1  # a lower score cannot enter any more
        self.best: list[tuple[int, int]] = []  # (score, minus doc_id), the worst first

    def offer(self, keys: np.ndarray, scores: np.ndarray) -> None:
        for i in np.flatnonzero(scores >= self.least).tolist():
            found = (int(scores[i]), int(keys[i]))
            if len(self.best) < self.top:
                heapq.heappush(self.best, found)
            elif found > self.best[0]:
                heapq.heapreplace(self.best, found)
        if len(self.best) == self.top:
            self.least = max(self.best[0][0], 1)


def trees(batches: Iterator[pa.RecordBatch], documents: int, length: int, width: int) -> Iterator[BallTree]:
    """Ball trees of bounded numbers of documents, one after the other."""
    most = min(TREE_ROWS, max(2 * LEAF, TREE_CELLS // max(width, 1) * LEAF // 2))
    for batch in batches:
        for at in range(0, batch.num_rows, most):
            piece = batch.slice(at, most)
            lengths = np.diff(np.asarray(piece.column(2).offsets))
            held = np.flatnonzero(lengths)
            if not len(held):
                continue
            n = np.repeat(np.asarray(piece.column(1)), lengths)
            tf = np.asarray(piece.column(3).flatten()).astype(np.int64)
            keys = [NULL_KEY if d is None else -d for d in piece.column(0).take(pa.array(held)).to_pylist()]
            starts = np.r_[0, np.cumsum(lengths[held])[:-1]]
            cols = np.asarray(piece.column(2).flatten())
            yield BallTree(Rows(np.array(keys, dtype=object), starts, cols, impacts(tf, n, documents, length)), width)


def searcher(items, documents: int, length: int, width: int, top: int):
    """A map over stored vectors to the best documents of every item among those of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = [Query(terms, weights, width, top) for terms, weights in items.value]
        for tree in trees(batches, documents, length, width):
            for query in queries:
                if len(query.terms):
                    tree.search(query)
        found = [(i, None if k == NULL_KEY else -k, s) for i, q in enumerate(queries) for s, k in q.best]
        columns = list(zip(*found, strict=True)) or [[], [], []]
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, HITS_ARROW.types, strict=True)], schema=HITS_ARROW)

    return run


def best_of(hits: DataFrame, top: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def item_blocks(items: DataFrame) -> Iterator[list[tuple[int | None, str]]]:
    """The different items with text, in blocks of bounded size."""
    known = pick(items, item_id="bigint", text="string").where("text IS NOT NULL").distinct()
    size = known.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 if size <= BLOCK_BYTES else 2 * -(-size // BLOCK_BYTES)
    for b in range(blocks):
        rows = known.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        yield [(r["item_id"], r["text"]) for r in rows]


def rank_documents(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of every item by score, those above 0; ties by smaller doc_id.

    Terms are runs of letters, digits and characters beyond ASCII, A-Z lower-cased. A document is a vector over terms
    (how much each count adds, which saturates and is damped by the text's length), an item the vector of its terms'
    inverse document frequencies; the score is their inner product, in whole numbers throughout.

    Texts are read once per block of items (1 MB of item text) and cut to the terms of that block; these narrow
    vectors are stored. Tasks then build ball trees of at most 8,192 vectors, one at a time, and search each
    for all items, best balls first, with what the task has found so far as the least score. A ball's bound is its
    centroid's score plus the less of its radius times the item's norm and its reach in the item's terms; centroids are whole
    numbers and both roots are rounded up, so no document is lost. A task gives at most ``top`` rows per item, and only these are shuffled. Memory per task is
    bounded by a batch of texts and one tree.

    Texts without a term, null and empty ones are no documents. Rows that repeat count and rank each; a row without
    doc_id ranks last among equals. Items without terms or text have no rows, equal item rows count once, and
    different texts under one item_id rank apart. Terms are compared by 64-bit hashes. Other columns are ignored.
    """
    spark = docs.sparkSession
    texts = pick(docs, doc_id="bigint", text="string")
    ranked = None
    for block in item_blocks(items):
        hashes = item_terms([text for _, text in block])
        vocabulary = np.unique(np.concatenate([*hashes, np.zeros(0, np.uint64)]))
        known = spark.sparkContext.broadcast(vocabulary)
        held = stored(texts.mapInArrow(vectors(known), VECTORS), "term-vectors")
        totals = held.agg(F.count("*").alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
        df = dict(map(tuple, held.select(F.explode("terms").alias("term")).groupBy("term").count().collect()))
        weights = np.array([term_weight(totals["documents"], df.get(t, 0)) for t in range(len(vocabulary))], dtype=np.int64)
        places = [np.searchsorted(vocabulary, h) for h in hashes]
        wanted = spark.sparkContext.broadcast([(p, weights[p]) for p in places])
        search = searcher(wanted, totals["documents"], totals["length"], len(vocabulary), top)
        hits = held.mapInArrow(search, HITS).withColumn("salt", F.spark_partition_id() % SALTS)
        best = best_of(best_of(hits, top, "item", "salt"), top, "item")
        ids = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(block)], "item int, item_id bigint")
        named = best.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")  # a block's items
        ranked = named if ranked is None else ranked.unionByName(named)
    return ranked


def digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    return rank_documents(docs, items)


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE = rf"""
WITH i AS (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL),
q AS (SELECT DISTINCT item_id, text, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term FROM i),
d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_TERM}') AS terms FROM documents WHERE text IS NOT NULL),
s AS (SELECT count(*) AS docs, sum(len(terms))::BIGINT AS length FROM d WHERE len(terms) > 0),
t AS (SELECT doc_id, term, count(*) AS tf, any_value(n) AS n FROM (SELECT doc_id, unnest(terms) AS term, len(terms) AS n FROM d)
  SEMI JOIN q USING (term) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT AS weight
  FROM (SELECT term, count(*) AS df FROM t GROUP BY term), s),
p AS (SELECT doc_id, term, weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // length))) AS part FROM t JOIN w USING (term), s),
r AS (SELECT item_id, q.text, doc_id, sum(part)::BIGINT AS score FROM q JOIN p USING (term) GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id) AS rank FROM r WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM k WHERE rank <= {TOP}
"""
