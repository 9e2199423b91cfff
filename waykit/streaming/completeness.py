"""Restartable load of routes whose parts land apart: a route is evaluated when its last part has landed.

Each landed record is one part of one route: its stops, its packages, its driven order or its travel matrix, in a folder
per part. The parts may land in any order, at different times and more than once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from waykit import schemas
from waykit.session import scratch_dir
from waykit.sources import silver_store, tables

PARTS: dict[str, T.DataType] = {
    "routes": schemas.ROUTE_DOC,
    "packages": schemas.PACKAGE_DOC,
    "sequences": schemas.SEQUENCE_DOC,
    "travel": schemas.TRAVEL_DOC,
}
ALL_PARTS = (1 << len(PARTS)) - 1


def part_schema(part: str) -> T.StructType:
    return T.StructType([T.StructField("route_id", T.StringType()), T.StructField("doc", PARTS[part])])


def land(docs: DataFrame, landing: str, part: str) -> None:
    """Add records (route_id, doc) to a part's folder."""
    schemas.conform(docs.select("route_id", "doc"), part_schema(part)).write.mode("append").parquet(f"{landing}/{part}")


def landed_parts(spark: SparkSession, landing: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """A stream of (route_id, seen): which parts of a route have landed, one bit each.

    The state is one number per route. Only route ids are read here.
    """
    bits = []
    for k, part in enumerate(PARTS):
        folder = f"{landing}/{part}"
        if not tables.path_exists(spark, folder):
            spark.createDataFrame([], part_schema(part)).write.parquet(folder)
        stream = spark.readStream.schema(part_schema(part)).option("maxFilesPerTrigger", max_files_per_trigger)
        bits.append(stream.parquet(folder).select("route_id", F.lit(1 << k).alias("bit")))
    every = bits[0]
    for more in bits[1:]:
        every = every.unionByName(more)
    return every.where("route_id IS NOT NULL").groupBy("route_id").agg(F.bit_or("bit").alias("seen"))


def landed_documents(spark: SparkSession, landing: str, ids: DataFrame) -> dict[str, DataFrame]:
    """The records of some routes, of each part the one that landed last; by file name where times are equal."""
    keep = tables.broadcast_if_small(ids.select("route_id"))
    last = Window.partitionBy("route_id").orderBy(F.desc("landed"), F.desc("file"))
    found = {}
    for part in PARTS:
        docs = spark.read.schema(part_schema(part)).parquet(f"{landing}/{part}")
        marked = docs.select(
            "route_id",
            "doc",
            F.col("_metadata.file_modification_time").alias("landed"),
            F.col("_metadata.file_path").alias("file"),
        )
        ranked = marked.join(keep, "route_id", "left_semi").withColumn("_k", F.row_number().over(last))
        found[part] = ranked.where("_k = 1").select("route_id", "doc")
    return found


def evaluate_complete(
    spark: SparkSession,
    landing: str,
    target: str,
    checkpoint: str,
    evaluate: Callable[[silver_store.Silver], DataFrame],
    schema: T.StructType = schemas.ROUTE_COMPARISON,
    max_files_per_trigger: int = 1000,
) -> StreamingQuery:
    """Process what has landed since the last run, then stop: rows of ``evaluate`` for every route that is now complete.

    A batch's routes are flattened to silver tables once; ``evaluate`` maps those to rows of ``schema``. The target is read
    by ``tables.read_slices``. A batch replaces its own slice of it, so one replayed after a lost driver adds nothing twice;
    routes that other batches hold are not evaluated again, also when a part of them lands once more.
    """

    def load(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        here = (F.col("load") == "stream") & (F.col("slice") == number)
        done = tables.stored_slices(session, target, schema).where(~here)
        ready = tables.pending(batch.where(F.col("seen") == ALL_PARTS).select("route_id"), done)
        ready = tables.written(ready, "complete-routes")
        if ready.isEmpty():
            return
        root = scratch_dir(session, "batch-silver")
        docs = landed_documents(session, landing, ready)
        silver_store.write_silver(silver_store.silver_from_documents(docs), root)
        rows = evaluate(silver_store.load_silver(session, root))
        tables.replace_slice(schemas.conform(rows, schema), target, "stream", number)

    return (
        landed_parts(spark, landing, max_files_per_trigger)
        .writeStream.outputMode("update")
        .foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
