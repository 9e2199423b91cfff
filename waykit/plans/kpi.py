"""Summary indicators and chart datasets over the gold table.

Means and sums of seconds are taken over whole microseconds and divided once, so they do not
depend on the order rows arrive in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waykit.functions.clock_math import MICROS, one_decimal, seconds_to_micros

HISTOGRAM_BINS = 25
SUCCESS_PERCENT = 95


def _micros(column: str) -> Column:
    return seconds_to_micros(F.col(column))


def _mean_minutes(micros: Column) -> Column:
    return F.try_divide(F.sum(micros).cast("double"), F.count(micros)) / F.lit(60.0 * MICROS)


def _percent(condition: Column) -> Column:
    return F.try_divide(F.count_if(condition).cast("double"), F.count("*")) * 100


def minutes_saved(gold: DataFrame) -> DataFrame:
    """Positive where the improved route is faster than the driver."""
    return gold.withColumn(
        "minutes_saved", (F.col("actual_time_seconds") - F.col("algo_time_seconds")) / 60
    )


def final_findings(gold: DataFrame) -> DataFrame:
    """Here the difference is improved minus driven, the opposite sign of ``minutes_saved``."""
    return gold.agg(
        F.count("*").alias("total_routes"),
        _mean_minutes(_micros("algo_time_seconds") - _micros("actual_time_seconds")).alias(
            "avg_time_diff_minutes"
        ),
        F.count_if(F.col("algo_time_seconds") < F.col("actual_time_seconds")).alias("routes_algo_faster"),
        F.count_if(F.col("algo_violations") == 0).alias("routes_zero_violations"),
    )


def kpi_summary(gold: DataFrame) -> DataFrame:
    return gold.agg(
        F.count("*").alias("total_routes"),
        _mean_minutes(_micros("actual_time_seconds") - _micros("algo_time_seconds")).alias(
            "avg_minutes_saved"
        ),
        _percent(F.col("algo_time_seconds") < F.col("actual_time_seconds")).alias("pct_algo_faster"),
        _percent(F.col("algo_violations") == 0).alias("pct_zero_violations"),
        F.sum("nn_violations").alias("nn_total"),
        F.sum("algo_violations").alias("algo_total"),
    )


def kpi_verdict(gold: DataFrame) -> DataFrame:
    reached = F.col("pct_zero_violations") >= SUCCESS_PERCENT
    return kpi_summary(gold).select(
        "pct_zero_violations",
        F.when(reached, "success").otherwise("warning").alias("verdict"),
        F.concat(
            one_decimal(F.col("pct_zero_violations")), F.lit("% of routes finished with zero violations.")
        ).alias("message"),
    )


def violation_reduction(gold: DataFrame) -> DataFrame:
    """Percent fewer violations than the baseline; null unless there are fewer."""
    nn, algo = F.col("nn_total"), F.col("algo_total")
    return kpi_summary(gold).select(
        "nn_total",
        "algo_total",
        F.when(algo < nn, (nn - algo).cast("double") / nn * 100).alias("reduction_pct"),
    )


def violation_bars(gold: DataFrame) -> DataFrame:
    totals = kpi_summary(gold)
    return totals.select(
        F.stack(F.lit(2), F.lit("Unconstrained"), F.col("nn_total"), F.lit("Constrained"), F.col("algo_total")).alias(
            "label", "total"
        )
    )


def scatter_points(gold: DataFrame) -> DataFrame:
    return minutes_saved(gold).select(
        "route_id",
        (F.col("algo_time_seconds") / 60).alias("algo_minutes"),
        (F.col("actual_time_seconds") / 60).alias("actual_minutes"),
        "num_stops",
        "minutes_saved",
        "algo_violations",
    )


def axis_max(gold: DataFrame) -> DataFrame:
    """Upper end of both scatter axes."""
    return gold.agg(
        F.greatest(F.max(F.col("algo_time_seconds") / 60), F.max(F.col("actual_time_seconds") / 60)).alias(
            "axis_max"
        )
    )


def saved_histogram(gold: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Minutes saved in equal-width bins between the extremes, empty bins included.

    With no spread all rows fall into bin 0.
    """
    saved = minutes_saved(gold).select("minutes_saved")
    low = saved.agg(F.min("minutes_saved")).scalar()
    high = saved.agg(F.max("minutes_saved")).scalar()
    width = (high - low) / bins
    bounded = saved.select("minutes_saved", low.alias("low"), width.alias("width"))
    index = F.when(F.col("width") > 0, F.floor((F.col("minutes_saved") - F.col("low")) / F.col("width"))).otherwise(0)
    counts = (
        bounded.select(F.least(index, F.lit(bins - 1)).cast("bigint").alias("bin"))
        .groupBy("bin")
        .agg(F.count("*").alias("routes"))
    )
    edges = gold.sparkSession.range(bins).select(
        F.col("id").alias("bin"),
        (low + F.col("id") * width).alias("bin_start"),
        (low + (F.col("id") + 1) * width).alias("bin_end"),
    )
    return edges.join(counts, "bin", "left").select(
        "bin", "bin_start", "bin_end", F.coalesce("routes", F.lit(0)).cast("bigint").alias("routes")
    )
