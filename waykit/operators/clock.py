"""The route clock: travel and service along a sequence, arrivals, broken windows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waykit.functions import clock_math as cm
from waykit.operators.sequences import KEYS, SEGMENT, back_legs, measured, prefix_sum, route_legs
from waykit.session import kept
from waykit.sources.travel_blocks import TravelBlocks


def stop_service(packages: DataFrame) -> DataFrame:
    """Service time per stop over all its packages, combined before the shuffle."""
    return packages.groupBy("route_id", "stop_id").agg(
        F.sum(cm.seconds_to_micros(F.col("planned_service_time_seconds"))).alias("service_us")
    )


def parse_windows(packages: DataFrame) -> DataFrame:
    return packages.select(
        "route_id",
        "stop_id",
        "package_id",
        cm.window_timestamp(F.col("time_window_start")).alias("opens"),
        cm.window_timestamp(F.col("time_window_end")).alias("closes"),
    )


def valid_windows(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("opens").isNotNull() & F.col("closes").isNotNull())


def package_faults(packages: DataFrame) -> DataFrame:
    """(route_id, fault) of routes with a package whose service time or window cannot be read.

    A route that counted such a window as none would look better than it is, so it is rejected instead.
    """
    return _package_faults(packages).groupBy("route_id").agg(F.min("fault").alias("fault"))


def _package_faults(packages: DataFrame) -> DataFrame:

    def unreadable(name: str):
        return cm.clean_missing(F.col(name)).isNotNull() & cm.window_timestamp(F.col(name)).isNull()

    service = F.col("planned_service_time_seconds")
    fault = F.when(service.isNotNull() & cm.seconds_to_micros(service).isNull(), "BAD_SERVICE").when(
        unreadable("time_window_start") | unreadable("time_window_end"), "BAD_WINDOW"
    )
    return packages.select("route_id", fault.alias("fault")).where("fault IS NOT NULL")


def stop_windows(packages: DataFrame) -> DataFrame:
    """Distinct windows per stop with their package counts, combined before the shuffle."""
    valid = valid_windows(parse_windows(packages))
    return valid.groupBy(
        "route_id",
        "stop_id",
        cm.epoch_micros(F.col("opens")).alias("opens_us"),
        cm.epoch_micros(F.col("closes")).alias("closes_us"),
    ).agg(F.count("*").alias("packages"))


def parse_departure(routes: DataFrame) -> DataFrame:
    return routes.select(
        "route_id",
        cm.departure_timestamp(F.col("date"), F.col("departure_time_utc")).alias("departure"),
    )


@dataclass(frozen=True)
class Loads:
    """What packages add to a sequence: service per stop, and distinct windows per stop with their package counts."""

    service: DataFrame
    windows: DataFrame


def loads(packages: DataFrame, tasks: int = 0) -> Loads:
    """Both from one scan and one shuffle: packages are combined by stop and window first, then dealt by stop.

    With ``tasks`` they are dealt by route, to as many tasks, as blocks of whole routes lie.
    """
    parsed = packages.select(
        "route_id",
        "stop_id",
        cm.epoch_micros(cm.window_timestamp(F.col("time_window_start"))).alias("opens_us"),
        cm.epoch_micros(cm.window_timestamp(F.col("time_window_end"))).alias("closes_us"),
        cm.seconds_to_micros(F.col("planned_service_time_seconds")).alias("us"),
    )
    windowed = F.col("opens_us").isNotNull() & F.col("closes_us").isNotNull()
    bound = lambda name: F.when(windowed, F.col(name)).alias(name)
    combined = parsed.groupBy("route_id", "stop_id", bound("opens_us"), bound("closes_us")).agg(
        F.sum("us").alias("us"), F.count("*").alias("packages")
    )
    spread = combined.repartition(tasks, "route_id") if tasks else combined.repartition("route_id", "stop_id")
    return Loads(
        spread.groupBy("route_id", "stop_id").agg(F.sum("us").alias("service_us")),
        spread.where("opens_us IS NOT NULL").drop("us"),
    )


def tasks_by_route(silver) -> int:
    """In how many tasks routes stay whole from their sequence to their score, where ``session.kept_by_route`` holds and their
    blocks lie so; else 0."""
    times = silver.times
    if not isinstance(times, TravelBlocks) or times.any_spread or not kept(times.blocks.sparkSession):
        return 0
    return times.buckets


def join_leg_travel(legs: DataFrame, travel: DataFrame | TravelBlocks) -> DataFrame:
    """Travel time of each leg; null on the last stop and where the matrix has no entry.

    A repeated edge counts once, with its smallest time, as everywhere. With blocks only the legs are shuffled; with an
    edge table both sides are, and the join's partitioning serves the grouping too.
    """
    if isinstance(travel, TravelBlocks):
        return travel.lookup(legs)
    edges = travel.select(
        "route_id",
        F.col("from_stop_id").alias("stop_id"),
        F.col("to_stop_id").alias("next_stop_id"),
        cm.seconds_to_micros(F.col("travel_seconds")).alias("travel_us"),
    )
    joined = legs.join(edges, ["route_id", "stop_id", "next_stop_id"], "left")
    return joined.groupBy(*legs.columns).agg(F.min("travel_us").alias("travel_us"))


def join_stop_service(seq: DataFrame, packages: DataFrame | Loads) -> DataFrame:
    service = packages.service if isinstance(packages, Loads) else stop_service(packages)
    joined = seq.join(service, ["route_id", "stop_id"], "left")
    return joined.withColumn("service_us", F.coalesce("service_us", F.lit(0)).cast("bigint"))


def leg_costs(
    seq: DataFrame,
    travel: DataFrame | TravelBlocks,
    packages: DataFrame | Loads,
    segment: int = SEGMENT,
    long: bool | None = None,
) -> DataFrame:
    """Per position: travel to the next stop plus service here, both counted on leaving.

    Staying at a stop takes no time where the matrix has no entry for it.
    """
    legs = join_stop_service(join_leg_travel(route_legs(seq, segment, long), travel), packages)
    stays = F.when(F.col("stop_id") == F.col("next_stop_id"), F.lit(0))
    cost = F.when(
        F.col("next_stop_id").isNotNull(), F.coalesce("travel_us", stays) + F.col("service_us")
    ).otherwise(F.lit(0))
    return legs.withColumn("cost_us", cost.cast("bigint"))


def arrival_times(
    seq: DataFrame,
    travel: DataFrame | TravelBlocks,
    packages: DataFrame | Loads,
    segment: int = SEGMENT,
    long: bool | None = None,
) -> DataFrame:
    """Arrival offset from departure, in microseconds, at each position."""
    seq, long = measured(seq, segment, long)
    costs = lambda s: leg_costs(s, travel, packages, segment, long)
    return prefix_sum(seq, costs, "cost_us", "offset_us", False, segment, long)


def reverse_prefix(
    seq: DataFrame, travel: DataFrame | TravelBlocks, packages: DataFrame | Loads, segment: int = SEGMENT
) -> DataFrame:
    """Running cost of driving the sequence backwards: service plus travel to the stop before."""
    seq, long = measured(seq, segment, None)

    def backward(s: DataFrame) -> DataFrame:
        costed = join_stop_service(join_leg_travel(back_legs(s, segment, long), travel), packages)
        cost = F.when(
            F.col("next_stop_id").isNotNull(), F.col("service_us") + F.col("travel_us")
        ).otherwise(F.lit(0))
        return costed.withColumn("back_us", cost.cast("bigint"))

    return prefix_sum(seq, backward, "back_us", "reverse_us", True, segment, long)


def join_route_info(arrivals: DataFrame, routes: DataFrame) -> DataFrame:
    """Absolute arrival, as microseconds since 1970, from the route's departure."""
    departures = parse_departure(routes).select(
        "route_id", cm.epoch_micros(F.col("departure")).alias("departure_us")
    )
    return arrivals.join(departures, "route_id", "left").withColumn(
        "arrival_us", F.col("departure_us") + F.col("offset_us")
    )


def join_arrival_windows(arrivals: DataFrame, packages: DataFrame | Loads, how: str = "inner") -> DataFrame:
    """Windowed packages met at each arrival, with the verdict."""
    windows = packages.windows if isinstance(packages, Loads) else stop_windows(packages)
    joined = arrivals.join(windows, ["route_id", "stop_id"], how)
    return joined.withColumn(
        "broken", cm.window_broken(F.col("arrival_us"), F.col("opens_us"), F.col("closes_us"))
    )


def _broken_packages():
    return F.sum(F.when(F.col("broken"), F.col("packages")).otherwise(0))


def route_timeline(seq: DataFrame, silver, segment: int = SEGMENT) -> DataFrame:
    """Arrival and cumulative violations at each position."""
    seq, long = measured(seq, segment, None)
    packages = loads(silver.packages)

    def counted(s: DataFrame) -> DataFrame:
        timed = join_route_info(arrival_times(s, silver.times, packages, segment, long), silver.routes)
        met = join_arrival_windows(timed, packages, "left")
        of_position = [F.max(c).alias(c) for c in ("stop_id", "offset_us", "departure_us", "arrival_us")]
        return met.groupBy(*KEYS, "pos").agg(*of_position, _broken_packages().cast("bigint").alias("violations"))

    return prefix_sum(seq, counted, "violations", "violations_so_far", True, segment, long)


def route_violations(seq: DataFrame, silver, segment: int = SEGMENT) -> DataFrame:
    """Broken packages per sequence, zero included."""
    packages = loads(silver.packages)
    timed = join_route_info(arrival_times(seq, silver.times, packages, segment), silver.routes)
    met = join_arrival_windows(timed, packages, "left")
    return met.groupBy(*KEYS).agg(_broken_packages().cast("bigint").alias("violations"))


def route_total_time(seq: DataFrame, travel: DataFrame | TravelBlocks, packages: DataFrame | Loads) -> DataFrame:
    """Departure to arrival at the last stop; null when a leg is missing from the matrix."""
    costs = leg_costs(seq, travel, packages)
    return costs.groupBy(*KEYS).agg(
        F.sum("cost_us").cast("bigint").alias("_sum"), F.count_if(F.col("cost_us").isNull()).alias("missing_legs")
    ).select(
        *KEYS, F.when(F.col("missing_legs") == 0, F.col("_sum")).alias("total_us"), "missing_legs"
    )


def route_facts(routes: DataFrame, packages: DataFrame) -> DataFrame:
    """(route_id, departure_us, fault): departure, null where unreadable, and the packages' fault, by one grouping."""
    departures = parse_departure(routes).select("route_id", cm.epoch_micros(F.col("departure")).alias("departure_us"))
    faults = _package_faults(packages).select("route_id", F.lit(None).cast("bigint").alias("departure_us"), "fault")
    both = departures.withColumn("fault", F.lit(None).cast("string")).unionByName(faults)
    return both.groupBy("route_id").agg(F.max("departure_us").alias("departure_us"), F.min("fault").alias("fault"))


def score_sequences(seq: DataFrame, silver, segment: int = SEGMENT) -> DataFrame:
    """Violations and total per sequence in one pass over the legs; rejects keep their reason.

    A stop's distinct windows repeat its position, so everything but the broken packages is taken by functions that do not
    mind repeats.
    """
    seq, long = measured(seq, segment, None)
    packages = loads(silver.packages, 0 if long else tasks_by_route(silver))
    arrivals = arrival_times(seq, silver.times, packages, segment, long)
    timed = arrivals.join(route_facts(silver.routes, silver.packages), "route_id", "left").withColumn(
        "arrival_us", F.col("departure_us") + F.col("offset_us")
    )
    scored = join_arrival_windows(timed, packages, "left").groupBy(*KEYS).agg(
        _broken_packages().cast("int").alias("violations"),
        F.max_by("offset_us", "pos").alias("total_us"),
        F.bool_or(F.col("cost_us").isNull()).alias("_missing"),
        F.bool_or(F.col("departure_us").isNull()).alias("_undated"),
        F.max("fault").alias("fault"),
    )
    reason = F.when(F.col("_missing"), "MISSING_EDGE").when(F.col("_undated"), "BAD_DEPARTURE").otherwise(F.col("fault"))
    return scored.select(*KEYS, "violations", "total_us", reason.alias("reject_reason"))


def evaluate_routes(seq: DataFrame, silver, segment: int = SEGMENT) -> DataFrame:
    """(route_id, variant, violations, total_seconds) of every sequence that can be driven."""
    scored = score_sequences(seq, silver, segment).where("reject_reason IS NULL")
    return scored.select(
        *KEYS, "violations", cm.micros_to_seconds(F.col("total_us")).alias("total_seconds")
    )


def rejected_sequences(seq: DataFrame, silver, segment: int = SEGMENT) -> DataFrame:
    scored = score_sequences(seq, silver, segment)
    return scored.where("reject_reason IS NOT NULL").select(*KEYS, "reject_reason")


def duplicate_visits(seq: DataFrame) -> DataFrame:
    """Stops a sequence visits more than once (each visit is evaluated)."""
    visits = seq.groupBy(*KEYS, "stop_id").agg(F.count("*").alias("visits"))
    return visits.where("visits > 1")
