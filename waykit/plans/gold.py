"""Gold: every route solved and compared with its baseline and with the order really driven."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waykit import schemas
from waykit.functions.clock_math import micros_to_seconds
from waykit.operators import long_routes
from waykit.operators.nearest import nearest_neighbor
from waykit.operators.packing import (
    MAX_PACKED_STOPS,
    RouteCut,
    actual_route_list,
    num_stops,
    pack_routes,
    packing_rejects,
    route_headers,
    station_routes,
    travel_lookup,
)
from waykit.operators.two_opt import MAX_PASSES, score_two_opt_moves, two_opt_constrained
from waykit.session import task_count


def _with_actual(packed: DataFrame, sequences: DataFrame) -> DataFrame:
    """The driven order as stop indexes; -1 marks a stop the route does not have."""
    joined = packed.join(actual_route_list(sequences), "route_id", "left")
    index = F.transform(
        "actual_route", lambda s: (F.array_position(F.col("stop_ids"), s) - 1).cast("int")
    )
    known = ~F.array_contains(index, -1)
    return joined.withColumn("actual", F.when(known, index)).drop("actual_route")


def solve_routes(
    silver,
    max_passes: int = MAX_PASSES,
    max_stops: int = MAX_PACKED_STOPS,
    cells: int = long_routes.CELLS,
) -> DataFrame:
    """Baseline, improved and driven score and the routes themselves, one row per depot route."""
    cut = RouteCut(silver, max_stops)
    packed = _with_actual(pack_routes(silver, cut), cut.short(silver.sequences))
    solved = two_opt_constrained(nearest_neighbor(packed), max_passes)
    if cut.any_long:
        solved = solved.unionByName(long_routes.solve(silver, cut, max_passes, cells))
    return solved


def nearest_routes(silver, max_stops: int = MAX_PACKED_STOPS, cells: int = long_routes.CELLS) -> DataFrame:
    """(route_id, stop_ids, nn_route) of every depot route that can be solved, of any length."""
    cut = RouteCut(silver, max_stops)
    found = nearest_neighbor(pack_routes(silver, cut)).select("route_id", "stop_ids", "nn_route")
    if cut.any_long:
        found = found.unionByName(long_routes.nearest_routes(long_routes.prepare(silver, cut, cells)))
    return found


def score_driven_moves(silver, max_stops: int = MAX_PACKED_STOPS, cells: int = long_routes.CELLS) -> DataFrame:
    """Every legal move on the driven order of every route that can be solved, per segment start.

    The order must visit every stop once: moves are not defined for other sequences.
    """
    cut = RouteCut(silver, max_stops)
    packed = _with_actual(pack_routes(silver, cut), cut.short(silver.sequences)).where(
        "size(actual) = n AND size(array_distinct(actual)) = n"
    )
    scored = score_two_opt_moves(packed, "actual")
    if cut.any_long:
        prepared = long_routes.prepare(silver, cut, cells)
        scored = scored.unionByName(long_routes.score_moves(prepared, long_routes.driven_orders(prepared)))
    return scored


def score_solved_moves(silver, solved: DataFrame, max_stops: int = MAX_PACKED_STOPS, cells: int = long_routes.CELLS) -> DataFrame:
    """Every legal move on the improved routes of ``solved``."""
    cut = RouteCut(silver, max_stops)
    orders = solved.select("route_id", "algo_route")
    scored = score_two_opt_moves(pack_routes(silver, cut).join(orders, "route_id"), "algo_route")
    if cut.any_long:
        prepared = long_routes.prepare(silver, cut, cells)
        long_orders = prepared.headers.select("route_id", "n").join(orders.withColumnRenamed("algo_route", "route"), "route_id")
        scored = scored.unionByName(long_routes.score_moves(prepared, long_orders))
    return scored


def packed_digests(silver, max_stops: int = MAX_PACKED_STOPS, cells: int = long_routes.CELLS) -> DataFrame:
    """What a solver gets of every route that can be solved, in numbers, packed or held as rows."""
    cut = RouteCut(silver, max_stops)
    zero = F.lit(0).cast("bigint")
    weighted = F.transform("matrix_us", lambda x, k: x * (k + 1))
    loads = [
        F.aggregate("service_us", zero, lambda a, x: a + x).alias("service_us"),
        F.aggregate("windows", zero, lambda a, w: a + w["packages"]).alias("windowed_packages"),
        F.aggregate("windows", zero, lambda a, w: a + w["opens_us"] * w["packages"] * (w["k"] + 1)).alias("windows_digest"),
    ]
    head = ["route_id", "n", "num_stops", "start", F.element_at("stop_ids", -1).alias("last_stop_id")]
    digest = F.coalesce(F.aggregate(weighted, zero, lambda a, x: a + x), zero).alias("digest")  # one stop needs no edge
    found = pack_routes(silver, cut).select(*head, digest, *loads)
    if cut.any_long:
        p = long_routes.prepare(silver, cut, cells)
        held = p.headers.select(*head).join(_row_digests(p.rows).drop("cells"), "route_id", "left")
        held = held.withColumn("digest", F.coalesce("digest", F.lit(0))).join(p.loads.select("route_id", *loads), "route_id")
        found = found.unionByName(held)
    return found


def _row_digests(rows: DataFrame) -> DataFrame:
    """(route_id, cells, digest) of matrix rows."""
    placed = F.transform("times", lambda x, to: x * (F.col("k").cast("bigint") * F.col("n") + to + 1))
    total = F.aggregate(placed, F.lit(0).cast("bigint"), lambda a, x: a + x)
    parts = rows.select("route_id", F.size("times").alias("cells"), total.alias("digest"))
    return parts.groupBy("route_id").agg(F.sum("cells").cast("int").alias("cells"), F.sum("digest").alias("digest"))


def matrix_digests(silver, max_stops: int = MAX_PACKED_STOPS) -> DataFrame:
    """(route_id, cells, digest) of the travel matrix of every depot route, packed or held as rows."""
    cut = RouteCut(silver, max_stops)
    zero = F.lit(0).cast("bigint")
    headers = route_headers(cut.short(silver.stops))
    blocks = getattr(silver, "blocks", None)
    if blocks:
        matrix = blocks.matrices(headers)
    else:
        matrix = travel_lookup(cut.short(silver.travel), headers, task_count(silver.stops.sparkSession))
    weighted = F.transform("matrix_us", lambda x, k: x * (k + 1))
    found = matrix.select(
        "route_id", F.size("matrix_us").alias("cells"), F.aggregate(weighted, zero, lambda a, x: a + x).alias("digest")
    )
    if cut.any_long:
        rows = long_routes.matrix_rows(cut.long(silver.travel), route_headers(cut.long(silver.stops)))
        found = found.unionByName(_row_digests(rows))
    return found


def rejected_routes(silver, max_stops: int = MAX_PACKED_STOPS) -> DataFrame:
    """Depot routes left out of the comparison and why; nothing is dropped without a row here."""
    cut = RouteCut(silver, max_stops)
    unsolved = packing_rejects(silver, cut)
    if cut.any_long:
        unsolved = unsolved.unionByName(long_routes.rejects(silver, cut))
    depots = station_routes(silver.stops).select("route_id")
    undriven = depots.join(silver.sequences, "route_id", "left_anti").withColumn(
        "reject_reason", F.lit("NO_SEQUENCE")
    )
    unknown = (
        silver.sequences.join(silver.stops, ["route_id", "stop_id"], "left_anti")
        .select("route_id")
        .distinct()
        .join(depots, "route_id", "left_semi")
        .withColumn("reject_reason", F.lit("UNKNOWN_STOP"))
    )
    every = unsolved.unionByName(undriven).unionByName(unknown)
    return every.groupBy("route_id").agg(F.min("reject_reason").alias("reject_reason"))


def comparison_rows(solved: DataFrame) -> DataFrame:
    rows = solved.where("actual_us IS NOT NULL").select(
        "route_id",
        "num_stops",
        micros_to_seconds(F.col("nn_us")).alias("nn_time_seconds"),
        "nn_violations",
        micros_to_seconds(F.col("algo_us")).alias("algo_time_seconds"),
        "algo_violations",
        micros_to_seconds(F.col("actual_us")).alias("actual_time_seconds"),
        "actual_violations",
        "algo_passes_run",
    )
    return schemas.conform(rows, schemas.ROUTE_COMPARISON)


def route_comparison(
    silver, sample: DataFrame | None = None, max_passes: int = MAX_PASSES, max_stops: int = MAX_PACKED_STOPS
) -> DataFrame:
    """The gold table for all routes, or for a sample of them."""
    chosen = silver if sample is None else silver.semi(sample)
    return comparison_rows(solve_routes(chosen, max_passes, max_stops))


def join_variants(scored: DataFrame, stops: DataFrame) -> DataFrame:
    """Scores of the variants nn, algo and actual side by side, one row per route having all three."""

    def of(variant: str, value: str):
        return F.max(F.when(F.col("variant") == variant, F.col(value)))

    columns = []
    for variant in ("nn", "algo", "actual"):
        columns.append(of(variant, "total_seconds").alias(f"{variant}_time_seconds"))
        columns.append(of(variant, "violations").alias(f"{variant}_violations"))
    wide = scored.groupBy("route_id").agg(*columns)
    complete = wide.where(
        "nn_time_seconds IS NOT NULL AND algo_time_seconds IS NOT NULL AND actual_time_seconds IS NOT NULL"
    )
    joined = complete.join(num_stops(stops), "route_id").withColumn("algo_passes_run", F.lit(1))
    return schemas.conform(joined, schemas.ROUTE_COMPARISON)
