"""Hard negatives by a multiway hyperplane tree that rules out siblings by the ranges of their distances."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waykit.llm.common import pick, stored

SCALE = 256  # components become floor(SCALE * x)
ROOTS = 16  # split points of the root
SPLITS = 8  # split points of an inner node
LEAF = 128  # rows
BLOCK_ROWS = 4096  # of a subtree that a task searches at a time, on average
CHUNK_QUERIES = 1024  # anchors that meet a block at a time, on average
POSITIVES, NEGATIVES = 5, 3
LOWEST, HIGHEST = 50, 95  # per cent of the positive's score
SLACK = 1e-6  # on distances, more than their rounding
EXACT = 1 << 53  # scores below it are exact in doubles
LAST = np.iinfo(np.int64).max  # place of a row without vec_id among equal scores


def dense(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows, shorter ones filled with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(np.asarray(column.offsets))
    out = np.zeros((len(column), width))
    if lengths.sum():
        row = np.repeat(np.arange(len(column)), lengths)
        out[row, np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = np.asarray(column.flatten())
    return out


def longest(column: pa.Array | pa.ChunkedArray) -> int:
    return max((len(v) for v in column), default=0) if len(column) else 0


def norms(rows: np.ndarray) -> np.ndarray:
    """Squared lengths; raises where they, or what is made of them, would not be exact."""
    squares = np.einsum("ij,ij->i", rows, rows)
    if squares.max(initial=0) >= EXACT / 4:
        raise OverflowError("vectors so long that their inner products are not exact in 53 bits")
    return squares


def distances(a: np.ndarray, a2: np.ndarray, b: np.ndarray, b2: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(a2[:, None] + b2[None, :] - 2 * (a @ b.T), 0))


@dataclass
class Splits:
    """Split points with, for each pair, the range of distances from one to the subtree of the other."""

    points: np.ndarray
    squares: np.ndarray
    low: np.ndarray  # [point, subtree]
    high: np.ndarray
    least: np.ndarray  # squared length of the rows of each subtree
    most: np.ndarray

    def apart(self, vectors: np.ndarray, squares: np.ndarray) -> np.ndarray:
        return distances(vectors, squares, self.points, self.squares)

    def reaches(self, subtree: int, apart: np.ndarray, squares: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether a subtree may hold rows whose score with a query lies in its window.

        Such rows lie in an annulus around the query, since the squared distance is both squared lengths less twice
        the score. By the triangle inequality they then lie in a range of distances from every split point.
        """
        outer = squares + self.most[subtree] - 2 * low
        inner = np.sqrt(np.maximum(squares + self.least[subtree] - 2 * high, 0))
        far = np.sqrt(np.maximum(outer, 0))[:, None] + SLACK
        near = np.maximum(apart - far, inner[:, None] - SLACK - apart)
        met = (self.low[:, subtree] <= apart + far) & (self.high[:, subtree] >= near)
        return (outer >= 0) & met.all(axis=1)


@dataclass
class Queries:
    """Windows of scores around anchors, and the best rows found in each so far."""

    vectors: np.ndarray  # of the anchors
    squares: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    anchor: np.ndarray  # of each window
    low: np.ndarray
    high: np.ndarray
    top: int
    same: bool  # rows of the anchor's label are wanted, else those of others
    scores: np.ndarray = field(init=False)
    rows: np.ndarray = field(init=False)
    row_ids: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        shape = (len(self.anchor), self.top)
        self.scores, self.rows, self.row_ids = np.full(shape, -np.inf), np.full(shape, -1), np.full(shape, LAST)

    def least(self, chosen: np.ndarray) -> np.ndarray:
        """What a row must score to enter: the window's lower end, later the worst of the best."""
        return np.maximum(self.low[chosen], self.scores[chosen, -1])

    def offer(self, chosen: np.ndarray, rows: np.ndarray, vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        anchor = self.anchor[chosen]
        used, back = np.unique(anchor, return_inverse=True)
        score = (self.vectors[used] @ vectors.T)[back]
        wanted = (labels[None, :] == self.labels[anchor][:, None]) == self.same
        wanted &= ids[None, :] != self.ids[anchor][:, None]
        wanted &= (score >= self.least(chosen)[:, None]) & (score <= self.high[chosen][:, None])
        some = np.flatnonzero(wanted.any(axis=1))
        if not len(some):
            return
        q = chosen[some]
        wide = (len(q), len(rows))
        scores = np.hstack([self.scores[q], np.where(wanted[some], score[some], -np.inf)])
        numbers = np.hstack([self.rows[q], np.broadcast_to(rows, wide)])
        named = np.hstack([self.row_ids[q], np.broadcast_to(ids, wide)])
        best = np.lexsort((named, -scores), axis=-1)[:, : self.top]
        self.scores[q] = np.take_along_axis(scores, best, 1)
        self.rows[q] = np.take_along_axis(numbers, best, 1)
        self.row_ids[q] = np.take_along_axis(named, best, 1)


class Tree:
    """A multiway hyperplane tree of rows: each goes to the nearest split point of its node."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        self.vectors, self.ids, self.labels = vectors, ids, labels
        self.squares = norms(vectors)
        self.seen = 0  # pairs of a window and a row that were compared
        self.root = self._grow(np.arange(len(vectors)))

    def _grow(self, rows: np.ndarray):
        """A leaf is an array of rows, an inner node its splits and children."""
        if len(rows) <= LEAF:
            return rows
        points = self._split_points(rows)
        apart = distances(self.vectors[rows], self.squares[rows], self.vectors[points], self.squares[points])
        side = np.argmin(apart, axis=1)
        held = [np.flatnonzero(side == j) for j in range(len(points))]
        held = [h for h in held if len(h)]
        if len(held) < 2:
            return rows  # nothing tells them apart; a block bounds their number
        splits = split_ranges(self.vectors[points], self.squares[points], [(apart[h], self.squares[rows[h]]) for h in held])
        return splits, [self._grow(rows[h]) for h in held]

    def _split_points(self, rows: np.ndarray) -> np.ndarray:
        """Rows far from each other: of some candidates always the one farthest from those chosen."""
        candidates = rows[:: max(1, len(rows) // (3 * SPLITS))][: 3 * SPLITS]
        gaps = distances(self.vectors[candidates], self.squares[candidates], self.vectors[candidates], self.squares[candidates])
        chosen, nearest = [0], gaps[0].copy()
        while len(chosen) < min(SPLITS, len(candidates)):
            chosen.append(int(np.argmax(nearest)))
            nearest = np.minimum(nearest, gaps[chosen[-1]])
        return candidates[chosen]

    def search(self, queries: Queries) -> None:
        self._visit(self.root, np.arange(len(queries.anchor)), queries)

    def _visit(self, node, alive: np.ndarray, queries: Queries) -> None:
        if not len(alive):
            return
        if isinstance(node, np.ndarray):
            self.seen += len(alive) * len(node)
            queries.offer(alive, node, self.vectors[node], self.ids[node], self.labels[node])
            return
        splits, children = node
        anchor = queries.anchor[alive]
        squares = queries.squares[anchor]
        apart = splits.apart(queries.vectors[anchor], squares)
        for j, child in enumerate(children):
            reached = splits.reaches(j, apart, squares, queries.least(alive), queries.high[alive])
            self._visit(child, alive[reached], queries)


def split_ranges(points: np.ndarray, squares: np.ndarray, subtrees: list[tuple[np.ndarray, np.ndarray]]) -> Splits:
    """``subtrees``: the distances of each one's rows from all split points, and their squared lengths."""
    return Splits(
        points,
        squares,
        np.array([apart.min(axis=0) for apart, _ in subtrees]).T,
        np.array([apart.max(axis=0) for apart, _ in subtrees]).T,
        np.array([own.min() for _, own in subtrees]),
        np.array([own.max() for _, own in subtrees]),
    )


ROWS = "vec_id bigint, label bigint, q array<bigint>, cell int, square bigint, apart array<double>"
HITS = pa.schema([("anchor_id", pa.int64()), ("key", pa.int64()), ("w", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])


def participants(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, q) of the rows that take part: noisy labels, components in whole numbers."""
    base = pick(embeddings, vec_id="bigint", embedding="array<double>", label="bigint")
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = F.transform("embedding", lambda x: F.floor(x * SCALE))
    return base.where("label IS NOT NULL AND embedding IS NOT NULL").where(sound).select(
        "vec_id", noisy.alias("label"), whole.alias("q")
    )


def placer(points: list[list[int]]):
    """A map over (vec_id, label, q) to the root's subtree of each row, with its distances from all split points."""
    width = max(map(len, points))
    roots = dense(pa.array(points, pa.list_(pa.int64())), width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wide = max(width, longest(batch.column(2)))
            vectors, p = dense(batch.column(2), wide), np.pad(roots, ((0, 0), (0, wide - width)))
            squares = norms(vectors)
            apart = distances(vectors, squares, p, norms(p))
            flat = pa.array(apart.ravel())
            ends = pa.array(np.arange(len(apart) + 1) * len(p), pa.int32())
            cell = np.argmin(apart, axis=1) if len(apart) else np.zeros(0)
            yield pa.record_batch(
                [*batch.columns, pa.array(cell, pa.int32()), pa.array(squares.astype(np.int64)), pa.ListArray.from_arrays(ends, flat)],
                ["vec_id", "label", "q", "cell", "square", "apart"],
            )

    return run


@dataclass
class Root:
    """The topmost node: its split points, ranges, and the rows of each subtree."""

    splits: Splits
    cells: list[int]  # of the subtrees
    counts: dict[int, int]

    @classmethod
    def measure(cls, placed: DataFrame, points: list[list[int]]) -> Root:
        """From one row per subtree; there are at most ROOTS of them, with as many ranges each."""
        each = range(len(points))
        stats = placed.groupBy("cell").agg(
            F.count("*").alias("n"),
            F.min("square").alias("least"),
            F.max("square").alias("most"),
            *[f(F.get("apart", F.lit(i))).alias(f"{name}_{i}") for i in each for name, f in (("low", F.min), ("high", F.max))],
        )
        rows = sorted(stats.collect(), key=lambda r: r["cell"])
        vectors = dense(pa.array(points, pa.list_(pa.int64())), max(map(len, points)))
        splits = Splits(
            vectors,
            norms(vectors),
            np.array([[r[f"low_{i}"] for r in rows] for i in each]),
            np.array([[r[f"high_{i}"] for r in rows] for i in each]),
            np.array([r["least"] for r in rows], dtype=float),
            np.array([r["most"] for r in rows], dtype=float),
        )
        return cls(splits, [r["cell"] for r in rows], {r["cell"]: r["n"] for r in rows})

    def router(self, skip_own: bool):
        """A map over queries that adds the subtrees which some window of theirs reaches."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                names = batch.schema.names
                apart = dense(batch.column(names.index("apart")), len(self.splits.points))
                squares = np.asarray(batch.column(names.index("square"))).astype(float)
                owner, low, high = windows(batch.column(names.index("low")), batch.column(names.index("high")))
                reached = np.zeros((batch.num_rows, len(self.cells)), bool)
                for j in range(len(self.cells)):
                    hit = self.splits.reaches(j, apart[owner], squares[owner], low, high)
                    reached[owner[hit], j] = True
                if skip_own:
                    own = np.asarray(batch.column(names.index("cell")))
                    reached[np.array(self.cells)[None, :] == own[:, None]] = False
                ends = pa.array(np.r_[0, np.cumsum(reached.sum(axis=1))], pa.int32())
                cells = pa.array(np.array(self.cells)[np.nonzero(reached)[1]], pa.int32())
                yield pa.record_batch([*batch.columns, pa.ListArray.from_arrays(ends, cells)], [*names, "cells"])

        return run


def windows(low: pa.Array, high: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, lower end, upper end) of all windows; a null end is open."""
    low, high = (c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in (low, high))
    owner = np.repeat(np.arange(len(low)), np.diff(np.asarray(low.offsets)))
    ends = [c.flatten().cast(pa.float64()).fill_null(v) for c, v in ((low, -np.inf), (high, np.inf))]
    return owner, np.asarray(ends[0]), np.asarray(ends[1])


def block_search(top: int, same: bool):
    """A map over one block of rows and one chunk of queries to the best rows of each window."""

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        if not rows.num_rows or not queries.num_rows:
            return HITS.empty_table()
        width = max(longest(rows["q"]), longest(queries["q"]))
        ids = rows["vec_id"].combine_chunks()
        tree = Tree(dense(rows["q"], width), np.asarray(ids.fill_null(LAST)), np.asarray(rows["label"]))
        vectors = dense(queries["q"], width)
        owner, low, high = windows(queries["low"], queries["high"])
        found = Queries(
            vectors, norms(vectors), np.asarray(queries["vec_id"]), np.asarray(queries["label"]), owner, low, high, top, same
        )
        tree.search(found)
        w, k = np.nonzero(found.scores > -np.inf)
        first = np.searchsorted(owner, owner)  # of the query's windows
        return pa.table(
            [
                pa.array(found.ids[owner[w]]),
                queries["key"].combine_chunks().take(pa.array(owner[w])),
                pa.array((w - first[w]).astype(np.int32)),
                ids.take(pa.array(found.rows[w, k])),
                pa.array(found.scores[w, k].astype(np.int64)),
            ],
            schema=HITS,
        )

    return run


def search(queries: DataFrame, placed: DataFrame, root: Root, chunks: int, top: int, same: bool) -> DataFrame:
    """The best rows of every window in the subtrees that its query visits (``cells``), block by block."""
    blocks = F.element_at(F.create_map(*[F.lit(v) for c, n in root.counts.items() for v in (c, -(-n // BLOCK_ROWS))]), F.col("cell"))
    left = placed.select(
        "cell",
        F.pmod(F.xxhash64("slot"), blocks).alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"),
        "vec_id",
        "label",
        "q",
    )
    visits = queries.select(
        "vec_id", "label", "q", "key", "low", "high", F.pmod(F.xxhash64("vec_id", "key"), F.lit(chunks)).cast("int").alias("chunk"),
        F.explode("cells").alias("cell"),
    )
    right = visits.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), (blocks - 1).cast("bigint"))))
    keys = ["cell", "block", "chunk"]
    met = left.groupBy(*keys).cogroup(right.groupBy(*keys))
    return met.applyInArrow(block_search(top, same), "anchor_id bigint, key bigint, w int, vec_id bigint, score bigint")


def best_of(hits: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("anchor_id", "key", "w").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def mine(
    embeddings: DataFrame,
    is_anchor: Column | None = None,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    lowest: int = LOWEST,
    highest: int = HIGHEST,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for every anchor and positive.

    Anchors are the rows for which ``is_anchor`` holds (by default vec_id divisible by 50). Their positives are the
    first ``positives`` other rows of their label by score, the integer inner product, ties by smaller vec_id; negatives
    the first rows of other labels whose score is ``lowest`` to ``highest`` per cent of the positive's.

    The root of the tree is spread: 16 rows, chosen by hash, are its split points, every row goes to the nearest, and the
    ranges of distances from each split point to each subtree are one aggregate. A subtree, however large, is cut
    into blocks of about 4,096 rows; a block holds the rest of its tree. Anchors first look for positives in
    their own subtree; the worst of those is the window with which they visit the others that its annulus
    meets. The windows of negatives are known by then. Anchors meet a block in chunks of about 1,024, so no task holds more
    than a block and a chunk. Leaves are compared exactly.

    A row takes no part if its label or vector is null or a component is null, NaN or infinite. Shorter vectors count as
    filled with zeros; an empty one scores 0. Rows that repeat take their places each, but none with the anchor's
    vec_id is its partner, and equal anchor rows count once; anchors that share a vec_id but differ are searched apart. A row without
    vec_id is no anchor and comes last among equal scores. Without rows, positives or negatives nothing is returned. Vectors
    so long that scores are not exact in doubles (2**51 squared) raise OverflowError. Other columns are ignored.
    """
    spark = embeddings.sparkSession
    result = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    rows = participants(embeddings)
    points = [r["q"] for r in rows.orderBy(F.xxhash64("vec_id", "q"), "vec_id", "label").limit(ROOTS).collect()]
    if not points:
        return spark.createDataFrame([], result)
    placed = stored(rows.mapInArrow(placer(points), ROWS).withColumn("slot", F.monotonically_increasing_id()), "placed-vectors")
    root = Root.measure(placed, points)

    chosen = is_anchor if is_anchor is not None else F.col("vec_id") % 50 == 0
    anchors = placed.where(chosen & F.col("vec_id").isNotNull()).drop("slot").distinct().withColumn("key", F.xxhash64("label", "q"))
    chunks = max(1, -(-anchors.count() // CHUNK_QUERIES))
    open_end = F.array(F.lit(None).cast("bigint"))

    at_home = anchors.withColumn("low", open_end).withColumn("high", open_end).withColumn("cells", F.array("cell"))
    first = stored(best_of(search(at_home, placed, root, chunks, positives, True), positives).drop("rank"), "positives-at-home")
    worst = first.groupBy("anchor_id", "key").agg(F.min("score").alias("least"), F.count("*").alias("n"))
    floor = F.when(F.col("n") >= positives, F.col("least"))
    bounded = anchors.join(worst.withColumnRenamed("anchor_id", "vec_id"), ["vec_id", "key"], "left")
    bounded = bounded.withColumn("low", F.array(floor)).withColumn("high", open_end).drop("n", "least")
    away = routed(bounded, root, skip_own=True)
    later = search(away, placed, root, chunks, positives, True)
    found = stored(best_of(first.unionByName(later), positives).drop("w"), "positives")

    # Positive scores s give windows ceil(lowest * s / 100) to floor(highest * s / 100).
    aims = found.groupBy("anchor_id", "key").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("aims"))
    low = F.transform("aims", lambda a: -_floor_div(-a["score"] * lowest, 100))
    high = F.transform("aims", lambda a: _floor_div(a["score"] * highest, 100))
    aimed = anchors.join(aims.withColumnRenamed("anchor_id", "vec_id"), ["vec_id", "key"])
    aimed = routed(aimed.withColumn("low", low).withColumn("high", high).drop("aims"), root, skip_own=False)
    hits = best_of(search(aimed, placed, root, chunks, negatives, False), negatives)
    of = found.select("anchor_id", "key", (F.col("rank") - 1).alias("w"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    joined = hits.join(of, ["anchor_id", "key", "w"])
    return joined.select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def _floor_div(a: Column, b: int) -> Column:
    """Whole division, rounded down."""
    divisor = F.lit(b).cast("bigint")
    return F.call_function("div", a - F.pmod(a, divisor), divisor)


def routed(queries: DataFrame, root: Root, skip_own: bool) -> DataFrame:
    schema = ", ".join([*(f"`{n}` {t}" for n, t in queries.dtypes), "cells array<int>"])
    return queries.mapInArrow(root.router(skip_own), schema)


def digest(embeddings: DataFrame) -> DataFrame:
    return mine(embeddings)


ORACLE = rf"""
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS q FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT a.vec_id AS anchor_id, e.vec_id, a.label = e.label AS same, list_dot_product(a.q, e.q)::BIGINT AS score
  FROM e AS a JOIN e ON a.vec_id % 50 = 0 AND e.vec_id <> a.vec_id),
g AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS k FROM p WHERE same) WHERE k <= {POSITIVES}),
n AS (SELECT g.anchor_id, g.vec_id AS positive_id, p.vec_id AS negative_id, g.score AS positive_score, p.score AS negative_score,
    row_number() OVER (PARTITION BY g.anchor_id, g.vec_id ORDER BY p.score DESC, p.vec_id) AS rank
  FROM g JOIN p ON g.anchor_id = p.anchor_id AND NOT p.same AND {LOWEST} * g.score <= 100 * p.score AND 100 * p.score <= {HIGHEST} * g.score)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= {NEGATIVES}
"""
