"""Failure cases of similar size.

What is similar depends on the stop count alone. So the band is worked out per distinct stop count
instead of per route pair: each failing route is listed under the (at most 41) stop counts it is
similar to, and the counts come from the histogram of stop counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BAND = 20


def failure_routes(gold: DataFrame) -> DataFrame:
    """Gold rows with remaining violations."""
    return gold.where("algo_violations > 0").select(
        "route_id",
        "num_stops",
        "algo_violations",
        "algo_time_seconds",
        "actual_time_seconds",
        "algo_passes_run",
    )


def _reached(num_stops: Column, band: int) -> Column:
    return F.explode(F.sequence(num_stops - band, num_stops + band))


def similar_cases(gold: DataFrame, failures: DataFrame, band: int = BAND) -> DataFrame:
    """Failure records under every stop count of ``gold`` they are similar to.

    A route's similar cases are the rows whose ``for_num_stops`` is its own stop count; a failing
    route is its own case too.
    """
    wanted = gold.select(F.col("num_stops").alias("for_num_stops")).distinct()
    listed = failures.select(_reached(F.col("num_stops"), band).alias("for_num_stops"), *failures.columns)
    return listed.join(wanted, "for_num_stops", "left_semi")


def cases_by_stop_count(failures: DataFrame, band: int = BAND) -> DataFrame:
    """(num_stops, num_similar_cases_found) of every stop count with a similar failure."""
    histogram = failures.groupBy("num_stops").agg(F.count("*").alias("cases"))
    return (
        histogram.select(_reached(F.col("num_stops"), band).alias("num_stops"), "cases")
        .groupBy("num_stops")
        .agg(F.sum("cases").alias("num_similar_cases_found"))
    )


def similar_case_count(gold: DataFrame, failures: DataFrame, band: int = BAND) -> DataFrame:
    """Number of similar failure cases per route, zero included."""
    around = cases_by_stop_count(failures, band)
    joined = gold.select("route_id", "num_stops").join(around, "num_stops", "left")
    return joined.select(
        "route_id",
        "num_stops",
        F.coalesce("num_similar_cases_found", F.lit(0)).cast("bigint").alias("num_similar_cases_found"),
    )
