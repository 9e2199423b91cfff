"""The four route look-ups as table operations, with the safety guardrail in every row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waykit.functions.clock_math import round_tenth
from waykit.operators.similar import cases_by_stop_count
from waykit.sources.tables import broadcast_if_small

GOLD_COLUMNS = (
    "num_stops",
    "nn_time_seconds",
    "nn_violations",
    "algo_time_seconds",
    "algo_violations",
    "actual_time_seconds",
    "actual_violations",
    "algo_passes_run",
)


def guardrail_passed() -> Column:
    return F.col("algo_violations") <= F.col("nn_violations")


def guardrail_status() -> Column:
    return (
        F.when(F.col("algo_violations") == 0, "SAFE")
        .when(guardrail_passed(), "GUARDRAIL_OK_BUT_UNRESOLVED")
        .otherwise("GUARDRAIL_FAILED")
    )


def review_label(status: Column) -> Column:
    """Display label; an unknown status shows as it is."""
    return (
        F.when(status == "SAFE", "SAFE")
        .when(status == "GUARDRAIL_OK_BUT_UNRESOLVED", "NEEDS REVIEW")
        .when(status == "GUARDRAIL_FAILED", "GUARDRAIL FAILED")
        .otherwise(status)
    )


def request_lookup(requests: DataFrame, gold: DataFrame) -> DataFrame:
    """Requested ids with their gold record, or the error for unknown ids."""
    found = gold.withColumn("_found", F.lit(True))
    joined = requests.select("route_id").join(found, "route_id", "left")
    message = F.concat(F.lit("No route found with id "), F.col("route_id"))
    return joined.withColumn("error", F.when(F.col("_found").isNull(), message)).drop("_found")


def route_summary(requests: DataFrame, gold: DataFrame) -> DataFrame:
    """The full record per requested route."""
    return request_lookup(requests, gold).select("route_id", *GOLD_COLUMNS, "error")


def validation_columns() -> list[Column]:
    return [
        F.col("algo_violations"),
        F.col("nn_violations").alias("baseline_violations"),
        guardrail_passed().alias("guardrail_passed"),
        guardrail_status().alias("status"),
    ]


def comparison_columns() -> list[Column]:
    difference = (F.col("actual_time_seconds") - F.col("algo_time_seconds")) / 60
    return [
        round_tenth(F.col("algo_time_seconds") / 60).alias("algorithm_minutes"),
        round_tenth(F.col("actual_time_seconds") / 60).alias("actual_driver_minutes"),
        round_tenth(difference).alias("minutes_saved_by_algorithm"),
        (difference > 0).alias("algorithm_was_faster"),
    ]


def validate_routes(gold: DataFrame) -> DataFrame:
    return gold.select("route_id", *validation_columns())


def status_counts(gold: DataFrame) -> DataFrame:
    return gold.groupBy(guardrail_status().alias("status")).agg(F.count("*").alias("routes"))


def compare_to_actual(gold: DataFrame) -> DataFrame:
    return gold.select("route_id", *comparison_columns())


def investigation_report(requests: DataFrame, gold: DataFrame, failures: DataFrame) -> DataFrame:
    """One nested row per requested route: record, guardrail, comparison, similar-case count.

    The similar cases themselves are listed once per stop count by ``similar_cases``; the row's
    ``summary.num_stops`` is the key into that table.
    """
    similar = broadcast_if_small(cases_by_stop_count(failures))
    counted = F.coalesce("num_similar_cases_found", F.lit(0)).cast("bigint")
    checked = gold.select(
        "*",
        F.struct(*validation_columns()).alias("validation"),
        F.struct(*comparison_columns()).alias("comparison"),
    ).join(similar, "num_stops", "left").withColumn("num_similar_cases_found", counted)
    looked_up = request_lookup(requests, checked)
    unresolved = F.col("validation.status") != "SAFE"
    return looked_up.select(
        "route_id",
        F.when(F.col("error").isNull(), F.struct(*GOLD_COLUMNS)).alias("summary"),
        "validation",
        "comparison",
        F.when(unresolved, F.col("num_similar_cases_found")).alias("num_similar_cases_found"),
        review_label(F.col("validation.status")).alias("label"),
        "error",
    )
