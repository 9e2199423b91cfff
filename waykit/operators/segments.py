"""Stop lists of routes of any length: long tables, shown as rows of at most ``SEGMENT`` stops.

A list of a whole route in one row is as long as the route. Here orders stay tables of (route, position, stop); what is
done to a list is done to positions, and lists are gathered per segment of positions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waykit.operators.clock import stop_service
from waykit.operators.sequences import SEGMENT, actual_sequence, with_positions


def listed(seq: DataFrame, *more: str, segment: int = SEGMENT) -> DataFrame:
    """(route_id, segment, entries): the rows of ``seq`` in order of position, as structs of (stop_id, *more)."""
    number = F.floor(F.col("pos") / segment).cast("bigint").alias("segment")
    entry = F.struct(F.col("pos"), F.struct("stop_id", *more).alias("entry"))
    gathered = seq.groupBy("route_id", number).agg(F.sort_array(F.collect_list(entry)).alias("e"))
    return gathered.select("route_id", "segment", F.col("e")["entry"].alias("entries"))


def in_id_order(stops: DataFrame, *more: str, segment: int = SEGMENT) -> DataFrame:
    """(route_id, pos, stop_id, *more): stops ranked by id within their route; equal rows stay apart."""
    plain = stops.select("route_id", "stop_id", F.lit(0).cast("bigint").alias("order"))
    ranked = with_positions(plain, "order", "stops", segment)
    if not more:
        return ranked.drop("variant")
    facts = stops.groupBy("route_id", "stop_id").agg(F.sort_array(F.collect_list(F.struct(*more))).alias("facts"))
    first = ranked.groupBy("route_id", "stop_id").agg(F.min("pos").alias("pos"))
    each = first.join(facts, ["route_id", "stop_id"]).select("route_id", "stop_id", "pos", F.posexplode("facts").alias("k", "fact"))
    return each.select("route_id", (F.col("pos") + F.col("k")).alias("pos"), "stop_id", *[F.col(f"fact.{m}") for m in more])


def actual_route_list(sequences: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """The driver's order."""
    return listed(actual_sequence(sequences), segment=segment)


def stops_by_route(stops: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """The stops with their types, in id order."""
    return listed(in_id_order(stops, "stop_type", segment=segment), "stop_type", segment=segment)


def unvisited(stops: DataFrame, visited: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """The stops (once each) that are not among the (route_id, stop_id) visited, in id order."""
    left = stops.select("route_id", "stop_id").distinct().join(visited, ["route_id", "stop_id"], "left_anti")
    return listed(in_id_order(left, segment=segment), segment=segment)


def reversed_between(seq: DataFrame, i: Column, j: Column) -> DataFrame:
    """The sequence with positions i..j driven backwards: only positions change, nothing is moved."""
    turned = F.when(F.col("pos").between(i, j), i + j - F.col("pos")).otherwise(F.col("pos"))
    return seq.withColumn("pos", turned.cast("bigint"))


def halves(seq: DataFrame) -> DataFrame:
    """(route_id, half): half of a route's visits, rounded down."""
    return seq.groupBy("route_id").agg(F.floor(F.count("*") / 2).cast("bigint").alias("half"))


def permutation_check(seq: DataFrame, stops: DataFrame) -> DataFrame:
    """(route_id, is_permutation): whether a sequence visits every stop of its route exactly once.

    Visits and stops are counted per stop, which spreads one route over all tasks; routes without stops or without a
    sequence are left out.
    """
    one, none = F.lit(1), F.lit(0)
    both = seq.select("route_id", "stop_id", one.alias("visit"), none.alias("stop")).unionByName(
        stops.select("route_id", "stop_id", none.alias("visit"), one.alias("stop"))
    )
    counts = both.groupBy("route_id", "stop_id").agg(F.sum("visit").alias("visits"), F.sum("stop").alias("stops"))
    judged = counts.groupBy("route_id").agg(
        F.bool_and((F.col("visits") == 1) & (F.col("stops") == 1)).alias("is_permutation"),
        F.sum("visits").alias("visits"),
        F.sum("stops").alias("stops"),
    )
    return judged.where("visits > 0 AND stops > 0").select("route_id", "is_permutation")


def service_by_stop(packages: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """(route_id, segment, services): maps from stop to service time, at most ``segment`` stops in one."""
    served = stop_service(packages)
    gathered = listed(in_id_order(served, "service_us", segment=segment), "service_us", segment=segment)
    return gathered.select("route_id", "segment", F.map_from_entries("entries").alias("services"))
