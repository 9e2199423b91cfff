"""Ordered stop sequences and prefix sums over them, safe for very long routes.

A window partitioned by route alone would put a whole route in one task. Sequences of at most ``SEGMENT``
positions go through one window each. Longer ones are cut into segments: they are written down
once, windows run per segment, and a second step carries totals from segment to segment.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from waykit.sources.tables import broadcast_if_small, written

SEGMENT = 4096
KEYS = ("route_id", "variant")


def _segment(pos: Column, length: int) -> Column:
    return F.floor(pos / F.lit(length)).cast("bigint")


def _carry(totals: DataFrame, value: str, out: str) -> DataFrame:
    """Sum of ``value`` over the earlier segments of the same sequence: one row per segment."""
    earlier = W.partitionBy(*KEYS).orderBy("_seg").rowsBetween(W.unboundedPreceding, -1)
    return totals.select(*KEYS, "_seg", F.coalesce(F.sum(value).over(earlier), F.lit(0)).alias(out))


def with_positions(stops: DataFrame, order_col: str, variant: str, segment: int = SEGMENT) -> DataFrame:
    """(route_id, variant, pos, stop_id) with dense positions from 0; ties go by stop id.

    Routes of more than ``segment`` rows are ranked by splitters instead of in one task: see ``ranked_by_range``.
    """
    rows = stops.select(
        "route_id", F.lit(variant).alias("variant"), "stop_id", F.col(order_col).alias("_order")
    )
    sizes = stops.groupBy("route_id").agg(F.count("*").alias("n")).where(F.col("n") > segment)
    long_rows = sizes.agg(F.sum("n")).first()[0]
    whole = W.partitionBy(*KEYS).orderBy("_order", "stop_id")
    if not long_rows:
        return _ranked(rows, whole)
    side = broadcast_if_small(sizes.select("route_id"))
    short = _ranked(rows.join(side, "route_id", "left_anti"), whole)
    return short.unionByName(ranked_by_range(rows.join(side, "route_id", "left_semi"), -(-long_rows // segment)))


def _ranked(rows: DataFrame, window) -> DataFrame:
    pos = (F.row_number().over(window) - 1).cast("bigint")
    return rows.select(*KEYS, pos.alias("pos"), "stop_id")


def ranked_by_range(rows: DataFrame, parts: int) -> DataFrame:
    """Positions of the rows of long routes, in about ``parts`` tasks of equal size.

    The splitters between tasks are quantiles of the whole sort key (order, stop id, and a number that tells repeated rows
    apart), so neither ties nor a narrow range of values fill a task. The rows are written down with the number of
    their task, since ranks and the counts that offset them must come from one and the same cut.
    """
    numbered = rows.withColumn("_row", F.monotonically_increasing_id())
    cut = numbered.repartitionByRange(max(parts, 1), *KEYS, "_order", "stop_id", "_row")
    held = written(cut.withColumn("_seg", F.spark_partition_id().cast("bigint")).drop("_row"), "ranks")
    counts = held.groupBy(*KEYS, "_seg").agg(F.count("*").alias("_n"))
    local = W.partitionBy(*KEYS, "_seg").orderBy("_order", "stop_id")
    placed = held.withColumn("_rank", F.row_number().over(local)).join(_carry(counts, "_n", "_before"), [*KEYS, "_seg"])
    return placed.select(*KEYS, (F.col("_before") + F.col("_rank") - 1).cast("bigint").alias("pos"), "stop_id")


def actual_sequence(sequences: DataFrame) -> DataFrame:
    """The order the driver drove."""
    return with_positions(sequences, "actual_sequence_position", "actual")


def array_sequence(routes: DataFrame, column: str, variant: str) -> DataFrame:
    """A packed ``ARRAY<STRING>`` route as a long sequence."""
    exploded = routes.select("route_id", F.posexplode(column).alias("pos", "stop_id"))
    return exploded.select(
        "route_id", F.lit(variant).alias("variant"), F.col("pos").cast("bigint").alias("pos"), "stop_id"
    )


def measured(seq: DataFrame, segment: int, long: bool | None) -> tuple[DataFrame, bool]:
    """The sequences, and whether any is longer than a segment; such sequences are read from a table from here on."""
    if long is not None:
        return seq, long
    sizes = seq.groupBy(*KEYS).agg(F.count("*").alias("n"))  # needs no positions, so nothing is sorted or moved for it
    long = not sizes.where(F.col("n") > segment).isEmpty()
    return (written(seq, "sequences"), True) if long else (seq, False)


def route_legs(seq: DataFrame, segment: int = SEGMENT, long: bool | None = None) -> DataFrame:
    """Consecutive pairs; the last stop has a null ``next_stop_id``."""
    return _beside(seq, 1, "next_stop_id", segment, long)


def back_legs(seq: DataFrame, segment: int = SEGMENT, long: bool | None = None) -> DataFrame:
    """Each stop with the one before it as ``next_stop_id``; null at the first."""
    return _beside(seq, -1, "next_stop_id", segment, long)


def _beside(seq: DataFrame, step: int, out: str, segment: int, long: bool | None) -> DataFrame:
    """The stop one position on (``step`` 1) or back (-1).

    Within a segment it is found by a window; across a border of segments by joining one row per border.
    """
    seq, long = measured(seq, segment, long)
    if not long:
        return seq.withColumn(out, F.lead("stop_id", step).over(W.partitionBy(*KEYS).orderBy("pos")))
    cut = seq.withColumn("_seg", _segment(F.col("pos"), segment))
    inside = cut.withColumn(out, F.lead("stop_id", step).over(W.partitionBy(*KEYS, "_seg").orderBy("pos")))
    border = F.col("pos") % segment == (0 if step > 0 else segment - 1)
    over = cut.where(border).select(*KEYS, (F.col("_seg") - step).alias("_seg"), F.col("stop_id").alias("_over"))
    last = F.col("pos") % segment == (segment - 1 if step > 0 else 0)
    joined = inside.join(over, [*KEYS, "_seg"], "left")
    return joined.withColumn(out, F.when(last, F.col("_over")).otherwise(F.col(out))).drop("_seg", "_over")


def prefix_sum(
    seq: DataFrame,
    valued: Callable[[DataFrame], DataFrame],
    value: str,
    out: str,
    inclusive: bool,
    segment: int = SEGMENT,
    long: bool | None = None,
) -> DataFrame:
    """Running sum of ``value`` by position, added to the rows of ``valued(seq)``, which is evaluated once.

    Without sequences longer than a segment this is one window. Else the valued rows are written down; segment
    totals and the sums inside segments are taken from there, and a segment adds the totals before it.
    """
    end = 0 if inclusive else -1
    seq, long = measured(seq, segment, long)
    detail = valued(seq)
    if not long:
        so_far = W.partitionBy(*KEYS).orderBy("pos").rowsBetween(W.unboundedPreceding, end)
        return detail.withColumn(out, F.coalesce(F.sum(value).over(so_far), F.lit(0)).cast("bigint"))
    detail = written(detail.withColumn("_seg", _segment(F.col("pos"), segment)), "scan")
    local = W.partitionBy(*KEYS, "_seg").orderBy("pos").rowsBetween(W.unboundedPreceding, end)
    inside = detail.withColumn("_local", F.coalesce(F.sum(value).over(local), F.lit(0)))
    totals = detail.groupBy(*KEYS, "_seg").agg(F.sum(value).alias("_n"))
    summed = inside.join(_carry(totals, "_n", "_before"), [*KEYS, "_seg"])
    return summed.withColumn(out, (F.col("_local") + F.col("_before")).cast("bigint")).drop("_seg", "_local", "_before")
