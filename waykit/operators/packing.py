"""One row per route with everything a solver needs; with travel stored as blocks no edge is shuffled, else once.

Only routes of at most ``max_stops`` stops are packed, so a row never exceeds a known size; longer
routes go through ``long_routes`` instead, which gives the same results without packing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waykit import schemas
from waykit.functions import clock_math as cm
from waykit.operators.clock import route_facts, stop_service, stop_windows
from waykit.session import task_count
from waykit.sources.tables import broadcast_if_small

MAX_PACKED_STOPS = 1000  # an 8 MB matrix


def num_stops(stops: DataFrame) -> DataFrame:
    """Stop rows per route, the station included."""
    return stops.groupBy("route_id").agg(F.count("*").cast("int").alias("num_stops"))


def station_routes(stops: DataFrame) -> DataFrame:
    """The depot of each route that has one; the smallest id where several are marked."""
    return (
        stops.where(F.col("stop_type") == schemas.STATION)
        .groupBy("route_id")
        .agg(F.min("stop_id").alias("start_stop_id"))
    )


def first_station(stops: DataFrame) -> DataFrame:
    """The stop row of each route's depot: its id and where it lies."""
    depots = stops.where(F.col("stop_type") == schemas.STATION).groupBy("route_id")
    return depots.agg(F.min(F.struct("stop_id", "lat", "lng")).alias("s")).select("route_id", "s.stop_id", "s.lat", "s.lng")


def join_optional_packages(routes: DataFrame, packages: DataFrame) -> DataFrame:
    """Packages per route; routes without any have 0."""
    counts = packages.groupBy("route_id").agg(F.count("*").alias("packages"))
    joined = routes.select("route_id").join(counts, "route_id", "left")
    return joined.select("route_id", F.coalesce("packages", F.lit(0)).cast("bigint").alias("packages"))


def skipped_routes(stops: DataFrame) -> DataFrame:
    """Routes without a depot, which cannot be solved."""
    return stops.select("route_id").distinct().join(station_routes(stops), "route_id", "left_anti")


def long_route_ids(silver, max_stops: int = MAX_PACKED_STOPS) -> DataFrame:
    """Routes whose stop list or driven sequence is too long to pack."""
    rows = silver.stops.select("route_id", F.lit(1).alias("stop"), F.lit(0).alias("visit")).unionByName(
        silver.sequences.select("route_id", F.lit(0).alias("stop"), F.lit(1).alias("visit"))
    )
    counts = rows.groupBy("route_id").agg(F.sum("stop").alias("stops"), F.sum("visit").alias("visits"))
    tall = counts.where(F.greatest("stops", "visits") > max_stops).select("route_id")
    blocks = getattr(silver, "blocks", None)
    if blocks and blocks.any_spread:  # their matrix is not one row either
        tall = tall.union(blocks.spread.select("route_id")).distinct()
    return tall


class RouteCut:
    """Splits tables into routes short enough to pack and the long rest.

    The ids of long routes are looked up once from the (small) per-route counts. With none, tables
    pass unchanged; a few are broadcast; many are joined without a hint.
    """

    def __init__(self, silver, max_stops: int = MAX_PACKED_STOPS) -> None:
        self.max_stops = max_stops
        self.ids = long_route_ids(silver, max_stops)
        self.any_long = not self.ids.isEmpty()
        self._side = broadcast_if_small(self.ids) if self.any_long else self.ids

    def short(self, df: DataFrame) -> DataFrame:
        return df.join(self._side, "route_id", "left_anti") if self.any_long else df

    def long(self, df: DataFrame) -> DataFrame:
        return df.join(self._side, "route_id", "left_semi") if self.any_long else df.limit(0)


def route_headers(stops: DataFrame) -> DataFrame:
    """Stop list in id order, stop count and depot of each route with a depot."""
    return (
        stops.groupBy("route_id")
        .agg(
            F.count("*").cast("int").alias("num_stops"),
            F.sort_array(F.collect_set("stop_id")).alias("stop_ids"),
            F.min(F.when(F.col("stop_type") == schemas.STATION, F.col("stop_id"))).alias("start_stop_id"),
        )
        .where("start_stop_id IS NOT NULL")
        .withColumn("n", F.size("stop_ids"))
        .withColumn("start", (F.array_position("stop_ids", F.col("start_stop_id")) - 1).cast("int"))
    )


def travel_lookup(travel: DataFrame, headers: DataFrame, partitions: int) -> DataFrame:
    """(route_id, matrix_us): row-major n*n travel times in stop order; shorter where edges are missing.

    Edges to foreign stops become one and a repeated edge keeps its smallest time before anything is
    collected, so a row has at most n + 1 times; rows of foreign stops are dropped before they meet. The edges
    are shuffled once, on route; both header joins and all groupings reuse that partitioning.
    """
    place = lambda stop: (F.array_position("stop_ids", F.col(stop)) - 1).cast("int")
    index = headers.select("route_id", "stop_ids")
    known = travel.repartition(partitions, "route_id").join(index, "route_id").select(
        "route_id",
        "from_stop_id",
        place("to_stop_id").alias("to_k"),
        cm.seconds_to_micros(F.col("travel_seconds")).alias("travel_us"),
    )
    edges = known.groupBy("route_id", "from_stop_id", "to_k").agg(F.min("travel_us").alias("travel_us"))
    # Foreign targets are one entry, -1, by now. A filter on to_k would be moved into the join and look every stop up twice.
    collected = F.sort_array(F.collect_list(F.struct("to_k", "travel_us")))
    rows = edges.groupBy("route_id", "from_stop_id").agg(collected.alias("t")).select(
        "route_id", "from_stop_id", F.filter("t", lambda t: t["to_k"] >= 0).alias("times")
    )
    placed = rows.join(index, "route_id").select("route_id", place("from_stop_id").alias("k"), "times").where("k >= 0")
    matrix = placed.groupBy("route_id").agg(F.sort_array(F.collect_list(F.struct("k", "times"))).alias("rows"))
    return matrix.select(
        "route_id", F.flatten(F.transform("rows", lambda r: r["times"]["travel_us"])).alias("matrix_us")
    )


def packages_by_stop(packages: DataFrame) -> DataFrame:
    """Service and distinct windows (with counts) grouped per route and stop."""
    windows = stop_windows(packages).groupBy("route_id", "stop_id").agg(
        F.sort_array(F.collect_list(F.struct("opens_us", "closes_us", "packages"))).alias("windows")
    )
    return stop_service(packages).join(windows, ["route_id", "stop_id"], "left")


def packed_packages(packages: DataFrame, headers: DataFrame) -> DataFrame:
    """Per route: service per stop in stop order, and windows with their stop index."""
    index = headers.select("route_id", F.posexplode("stop_ids").alias("k", "stop_id"))
    joined = index.join(packages_by_stop(packages), ["route_id", "stop_id"], "left")
    per_stop = joined.select(
        "route_id",
        "k",
        F.coalesce("service_us", F.lit(0)).cast("bigint").alias("service_us"),
        F.transform(
            F.coalesce("windows", F.array().cast("array<struct<opens_us:bigint,closes_us:bigint,packages:bigint>>")),
            lambda w: F.struct(
                F.col("k").alias("k"),
                w["opens_us"].alias("opens_us"),
                w["closes_us"].alias("closes_us"),
                w["packages"].alias("packages"),
            ),
        ).alias("windows"),
    )
    packed = per_stop.groupBy("route_id").agg(
        F.sort_array(F.collect_list(F.struct("k", "service_us", "windows"))).alias("stops")
    )
    return packed.select(
        "route_id",
        F.col("stops")["service_us"].alias("service_us"),
        F.flatten(F.col("stops")["windows"]).alias("windows"),
    )


def relative_windows(packed: DataFrame) -> DataFrame:
    """Window bounds as offsets from the route's departure."""
    shifted = F.transform(
        "windows",
        lambda w: F.struct(
            w["k"].cast("int").alias("k"),
            (w["opens_us"] - F.col("departure_us")).alias("opens_us"),
            (w["closes_us"] - F.col("departure_us")).alias("closes_us"),
            w["packages"].alias("packages"),
        ),
    )
    return packed.withColumn("windows", shifted)


def actual_route_list(sequences: DataFrame) -> DataFrame:
    """The driver's order as one array per route."""
    ordered = F.sort_array(F.collect_list(F.struct("actual_sequence_position", "stop_id")))
    return sequences.groupBy("route_id").agg(ordered.alias("o")).select(
        "route_id", F.col("o")["stop_id"].alias("actual_route")
    )


def pack_all(silver, cut: RouteCut | None = None) -> DataFrame:
    """Packed routes with a ``reject_reason``, null where the route can be solved."""
    cut = cut or RouteCut(silver)
    headers = route_headers(cut.short(silver.stops))
    packages = packed_packages(cut.short(silver.packages), headers)
    facts = route_facts(cut.short(silver.routes), cut.short(silver.packages))
    small = headers.join(packages, "route_id", "left").join(facts, "route_id", "left")
    blocks = getattr(silver, "blocks", None)
    if blocks:
        # Dealt as the blocks lie, so only the small side is shuffled. The join also keeps Spark from working the matrix
        # out anew wherever a solver reads a cell.
        packed = small.join(blocks.matrices(headers), "route_id", "left")
    else:
        partitions = task_count(silver.stops.sparkSession)
        # Headers are dealt like the matrices, so that routes stay spread over all tasks of the solvers that follow.
        matrix = travel_lookup(cut.short(silver.travel), headers, partitions)
        packed = small.repartition(partitions, "route_id").join(matrix, "route_id", "left")
    complete = (F.size("matrix_us") == F.col("n") * F.col("n")) & F.forall(
        "matrix_us", lambda x: x.isNotNull()
    )
    reason = F.when(~F.coalesce(complete, F.col("n") == 1), "MISSING_EDGE").when(
        F.col("departure_us").isNull(), "BAD_DEPARTURE"
    ).otherwise(F.col("fault"))
    return relative_windows(packed.withColumn("reject_reason", reason).drop("fault"))


def pack_routes(silver, cut: RouteCut | None = None) -> DataFrame:
    """Packed rows of the routes that can be solved."""
    return pack_all(silver, cut).where("reject_reason IS NULL").drop("reject_reason")


def packing_rejects(silver, cut: RouteCut | None = None) -> DataFrame:
    return pack_all(silver, cut).where("reject_reason IS NOT NULL").select("route_id", "reject_reason")
