"""Travel times as blocks of the matrix, bucketed by route, so that look-ups and packing move no edge.

One row holds the matrix of a route: departure stops, arrival stops, and a list of times per departure stop, null where
there is no usable entry. A route with more than ``BLOCK_EDGES`` entries is cut by departure stop into several
rows, each with a place of its own, so its blocks lie in different buckets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waykit.functions import clock_math as cm
from waykit.session import task_count
from waykit.sources import tables

BLOCK_EDGES = 1_000_000  # 8 MB of times
BUCKET_EDGES = 25_000_000  # 200 MB
# A reader decodes a row group's rows at once, into eight bytes and its levels for each time, however well they were encoded.
ROW_GROUP = {"parquet.block.size": 1 << 21, "parquet.block.row.count.limit": 512, "parquet.page.size.row.check.min": 4}
SCHEMA = "place STRING, route_id STRING, from_ids ARRAY<STRING>, to_ids ARRAY<STRING>, times ARRAY<ARRAY<BIGINT>>"
SPREAD = "route_id STRING, parts BIGINT"


@dataclass(frozen=True)
class TravelBlocks:
    """The stored blocks, in how many parts the routes are that have several, and the number of buckets (0: not bucketed)."""

    blocks: DataFrame
    spread: DataFrame
    any_spread: bool
    buckets: int = 0

    def placed(self, rows: DataFrame, stop: str) -> DataFrame:
        """Rows with the place of their departure stop's block."""
        if not self.any_spread:
            return rows.withColumn("place", F.col("route_id"))
        joined = rows.join(tables.broadcast_if_small(self.spread), "route_id", "left")
        return joined.withColumn("place", _place(F.col(stop))).drop("parts")

    def lookup(self, legs: DataFrame) -> DataFrame:
        """``travel_us`` of every leg (stop_id, next_stop_id); null where there is none. Only the legs are shuffled."""
        at = lambda ids, stop: F.array_position(ids, F.col(stop)).cast("int") - 1
        us = F.get(F.get("times", at("from_ids", "stop_id")), at("to_ids", "next_stop_id"))
        joined = self.placed(legs, "stop_id").join(self.blocks.drop("route_id"), "place", "left")
        return joined.select(*legs.columns, us.alias("travel_us"))

    def leaving(self, heads: DataFrame) -> DataFrame:
        """(route_id, to_stop_id, us): the edges that leave heads (route_id, stop_id). Only the heads are shuffled."""
        at = F.array_position("from_ids", F.col("stop_id")).cast("int") - 1
        joined = self.placed(heads.select("route_id", "stop_id"), "stop_id").join(self.blocks.drop("route_id"), "place")
        rows = joined.select("route_id", "to_ids", F.get("times", at).alias("us"))
        return rows.select("route_id", F.explode(F.arrays_zip("to_ids", "us")).alias("e")).select(
            "route_id", F.col("e.to_ids").alias("to_stop_id"), F.col("e.us").alias("us")
        )

    def matrices(self, headers: DataFrame) -> DataFrame:
        """(route_id, matrix_us) of the routes whose matrix is one block: row-major, in the order of ``stop_ids``.

        Missing entries are left out, so an incomplete matrix is short. Only the headers are shuffled.
        """
        at = lambda ids, stop: F.array_position(ids, stop).cast("int") - 1
        row = lambda s: F.get("times", at("from_ids", s))
        picked = F.transform(
            "stop_ids", lambda s: F.transform("stop_ids", lambda t: F.get(row(s), at("to_ids", t)))
        )
        as_stored = (F.col("from_ids") == F.col("stop_ids")) & (F.col("to_ids") == F.col("stop_ids"))
        matrix = F.flatten(F.when(as_stored, F.col("times")).otherwise(picked))
        joined = headers.select("route_id", "stop_ids").join(
            self.blocks.drop("route_id").withColumnRenamed("place", "route_id"), "route_id"
        )
        return joined.select("route_id", F.filter(matrix, lambda x: x.isNotNull()).alias("matrix_us"))

    def semi(self, keep: DataFrame) -> TravelBlocks:
        return TravelBlocks(self.blocks.join(keep, "route_id", "left_semi"), self.spread, self.any_spread)


def _place(stop: Column) -> Column:
    """A route's id, or for one in several parts that of the part; no id holds the separator and a part."""
    part = F.pmod(F.xxhash64(stop), F.col("parts"))
    cut = F.concat_ws("\x1f", "route_id", part.cast("string"))
    return F.when(F.col("parts").isNull(), F.col("route_id")).otherwise(cut)


def matrix_blocks(travel: DataFrame, spread: DataFrame, buckets: int) -> DataFrame:
    """One row per place. Edges are shuffled once; all groupings reuse that partitioning.

    A repeated edge keeps its smallest time before anything is collected.
    """
    usable = travel.where("route_id IS NOT NULL AND from_stop_id IS NOT NULL AND to_stop_id IS NOT NULL")
    placed = usable.join(tables.broadcast_if_small(spread), "route_id", "left").select(
        _place(F.col("from_stop_id")).alias("place"),
        "route_id",
        F.col("from_stop_id").alias("origin"),
        F.col("to_stop_id").alias("to"),
        cm.seconds_to_micros(F.col("travel_seconds")).alias("us"),
    )
    edges = placed.repartition(buckets, "place").groupBy("place", "route_id", "origin", "to").agg(F.min("us").alias("us"))
    listed = F.sort_array(F.collect_list(F.struct("to", "us"))).alias("r")
    rows = edges.groupBy("place", "route_id", "origin").agg(listed).select(
        "place", "route_id", F.struct("origin", F.col("r")["to"].alias("to"), F.col("r")["us"].alias("us")).alias("row")
    )
    blocks = rows.groupBy("place", "route_id").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    first = F.get("rows", F.lit(0))["to"]
    alike = F.forall("rows", lambda r: r["to"] == first)
    ids = F.when(alike, first).otherwise(F.sort_array(F.array_distinct(F.flatten(F.col("rows")["to"]))))
    spot = lambda r, t: F.array_position(r["to"], t).cast("int") - 1
    aligned = lambda r: F.when(r["to"] == F.col("to_ids"), r["us"]).otherwise(
        F.transform("to_ids", lambda t: F.get(r["us"], spot(r, t)))
    )
    return blocks.withColumn("to_ids", ids).select(
        "place", "route_id", F.col("rows")["origin"].alias("from_ids"), "to_ids", F.transform("rows", aligned).alias("times")
    )


def _table(path: str) -> str:
    return f"waykit_blocks_{hashlib.md5(path.encode()).hexdigest()[:16]}"


def bucket_count(spark: SparkSession, sizes: DataFrame) -> int:
    """Buckets, or tasks, for routes of ``n`` edges: as many as solvers want at least, so that those need no exchange."""
    edges = sizes.agg(F.sum("n")).first()[0] or 0
    return max(task_count(spark), -(-edges // BUCKET_EDGES))


def _write_spread(sizes: DataFrame, path: str, block_edges: int) -> DataFrame:
    parts = F.ceil(F.col("n") / block_edges).cast("bigint").alias("parts")
    tables.write_overwrite(sizes.where(F.col("n") > block_edges).select("route_id", parts), f"{path}/spread")
    return sizes.sparkSession.read.schema(SPREAD).parquet(f"{path}/spread")


def _store(blocks: DataFrame, path: str, buckets: int) -> None:
    spark = blocks.sparkSession
    tables.write_bucketed(blocks, _table(path), f"{path}/blocks", buckets, ("place",), **ROW_GROUP)
    tables.write_overwrite(spark.range(1).select(F.lit(buckets).alias("buckets")), f"{path}/layout")


def write_blocks(travel: DataFrame, path: str, buckets: int | None = None, block_edges: int = BLOCK_EDGES) -> None:
    """Store the blocks of a travel table below ``path``: a bucketed table, its layout, and the routes in several parts."""
    sizes = travel.groupBy("route_id").agg(F.count("*").alias("n"))
    spread = _write_spread(sizes, path, block_edges)
    buckets = buckets or bucket_count(travel.sparkSession, sizes)
    _store(matrix_blocks(travel, spread, buckets), path, buckets)


def write_matrices(
    stops: DataFrame,
    matrices: Callable[[DataFrame, int], DataFrame],
    path: str,
    buckets: int | None = None,
    block_edges: int = BLOCK_EDGES,
) -> None:
    """Store the blocks of whole matrices, as ``write_blocks`` does those of their edges, without an edge in any shuffle.

    ``matrices`` maps the stops (route_id, stop_id) of routes and a number of tasks to (route_id, stop_ids, seconds): one row per
    route, its stop ids in order and once each, and a list of times per departure stop in that order; a column ``times`` holds
    them as whole microseconds (``micros``), if there is one. Routes of more than ``block_edges`` entries go as edges.
    """
    usable = stops.where("route_id IS NOT NULL AND stop_id IS NOT NULL")
    sizes = usable.groupBy("route_id").agg(F.count("*").alias("m")).select("route_id", (F.col("m") * F.col("m")).alias("n"))
    spread = _write_spread(sizes, path, block_edges)
    buckets = buckets or bucket_count(stops.sparkSession, sizes)
    if spread.isEmpty():
        _store(_as_blocks(matrices(usable, buckets)), path, buckets)
        return
    wide = tables.broadcast_if_small(spread.select("route_id"))
    blocks = _as_blocks(matrices(usable.join(wide, "route_id", "left_anti"), buckets))
    edges = matrix_edges(matrices(usable.join(wide, "route_id", "left_semi"), buckets))
    _store(blocks.unionByName(matrix_blocks(edges, spread, buckets)), path, buckets)


def micros(seconds: np.ndarray) -> pa.Array:
    """``clock_math.seconds_to_micros`` of many values at once."""
    unusable = ~(np.abs(seconds) <= cm.LONGEST)
    whole = np.rint(np.where(unusable, 0.0, seconds) * cm.MICROS).astype(np.int64)
    return pa.array(whole, mask=unusable if unusable.any() else None)


def _as_blocks(matrices: DataFrame) -> DataFrame:
    converted = F.transform("seconds", lambda row: F.transform(row, cm.seconds_to_micros))
    times = F.col("times") if "times" in matrices.columns else converted
    return matrices.select(
        F.col("route_id").alias("place"),
        "route_id",
        F.col("stop_ids").alias("from_ids"),
        F.col("stop_ids").alias("to_ids"),
        times.alias("times"),
    )


def matrix_edges(matrices: DataFrame) -> DataFrame:
    """The edges of whole matrices (route_id, stop_ids, seconds)."""
    rows = matrices.select("route_id", "stop_ids", F.explode(F.arrays_zip("stop_ids", "seconds")).alias("r"))
    cells = rows.select("route_id", F.col("r.stop_ids").alias("from_stop_id"), F.explode(F.arrays_zip("stop_ids", "r.seconds")).alias("c"))
    return cells.select(
        "route_id", "from_stop_id", F.col("c.stop_ids").alias("to_stop_id"), F.col("c.seconds").alias("travel_seconds")
    )


def load_blocks(spark: SparkSession, path: str) -> TravelBlocks | None:
    """The blocks below ``path``; none where no load finished there (the layout is written last).

    Buckets are known to a catalog only, so a session that did not write the table declares it over the files.
    """
    if not tables.path_exists(spark, f"{path}/layout"):
        return None
    buckets = spark.read.parquet(f"{path}/layout").first()["buckets"]
    name = _table(path)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({SCHEMA}) USING parquet LOCATION '{path}/blocks'"
        f" CLUSTERED BY (place) SORTED BY (place) INTO {buckets} BUCKETS"
    )
    spark.catalog.refreshTable(name)
    spread = spark.read.schema(SPREAD).parquet(f"{path}/spread")
    return TravelBlocks(spark.table(name), spread, not spread.isEmpty(), buckets)
