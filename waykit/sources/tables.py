"""Tables and CSV in, tables out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waykit import schemas
from waykit.session import scratch_dir, shuffles_freed


def read_table(spark: SparkSession, name: str, columns: list[str], fmt: str = "parquet") -> DataFrame:
    """Scan of a path, or of a catalog table where ``name`` has no slash, with a column list.

    Pruning and pushdown reach the files.
    """
    scan = spark.read.format(fmt).load(name) if "/" in name else spark.read.table(name)
    return scan.select(*columns)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with header and a fixed schema, no inference pass."""
    return spark.read.csv(path, header=True, schema=schema)


def write_overwrite(
    df: DataFrame, name: str, fmt: str = "parquet", partition_by: list[str] | None = None
) -> None:
    """Replace the files at a path, or a catalog table where ``name`` has no slash."""
    writer = df.write.format(fmt).mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with shuffles_freed(df.sparkSession):
        writer.save(name) if "/" in name else writer.saveAsTable(name)


def write_bucketed(
    df: DataFrame, table: str, path: str, buckets: int, keys: tuple[str, ...] = ("route_id",), **options: object
) -> None:
    """Store a catalog table bucketed on its join keys, so later joins on them need no shuffle; ``options`` are the writer's."""
    writer = df.write.format("parquet").mode("overwrite").options(path=path, **options)
    with shuffles_freed(df.sparkSession):
        writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once in the shared scratch folder and read again: what follows does not evaluate it anew."""
    path = scratch_dir(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pending(df: DataFrame, done: DataFrame, key: str = "route_id") -> DataFrame:
    """Rows whose key is not stored yet."""
    return df.join(done.select(key).distinct(), key, "left_anti")


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """The stored rows; none where nothing was written yet, or where a lost write left no data files."""
    try:
        return spark.read.format(fmt).schema(schema).load(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def path_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def write_append_resumable(
    df: DataFrame, path: str, key: str = "route_id", fmt: str = "parquet"
) -> None:
    """Append only the keys the target does not hold; a second run adds nothing.

    The commit is per job, so a lost run leaves the target as it was. For progress that survives see
    ``append_in_slices``.
    """
    df = pending(df, read_or_empty(df.sparkSession, path, df.schema, fmt), key)
    df.write.format(fmt).mode("append").save(path)


SLICES_DONE = "keys BIGINT, digest BIGINT, load STRING, slice INT"


def append_in_slices(
    keys: DataFrame,
    evaluate: Callable[[DataFrame], DataFrame],
    path: str,
    schema: T.StructType,
    slices: int = 16,
    key: str = "route_id",
    fmt: str = "parquet",
    load: str = "0",
) -> None:
    """Evaluate the keys that the target lacks, slice by slice of their hash; each slice replaces itself as a whole.

    The target is partitioned by (load, slice). A slice is written by dynamic partition overwrite, so one that a lost run
    left half committed is replaced, never added to; then it is noted beside the target with the number and a
    fingerprint of its keys. The next run with the same ``load`` skips the slices noted, also those whose keys gave no rows, and
    does again those torn or with other keys than noted. Keys that other loads hold are left alone. ``evaluate`` maps a slice
    of keys to rows of ``schema``; ``read_slices`` reads the target.
    """
    spark = keys.sparkSession
    load = f"{load}-{slices}"  # with another number of slices the same keys lie elsewhere
    noted = f"{path}.slices"
    cut = F.pmod(F.xxhash64(key), F.lit(slices)).cast("int").alias("slice")
    elsewhere = stored_slices(spark, path, schema, fmt).where(F.col("load") != load)
    todo = pending(keys.select(key).where(F.col(key).isNotNull()).distinct(), elsewhere, key).select(key, cut)
    todo = written(todo.repartition("slice"), "slices")
    digest = F.sum(F.xxhash64(F.lit(1), key) % (1 << 32)).alias("digest")
    wanted = {r["slice"]: (r["n"], r["digest"]) for r in todo.groupBy("slice").agg(F.count("*").alias("n"), digest).collect()}
    done = read_or_empty(spark, noted, T.StructType.fromDDL(SLICES_DONE), fmt).where(F.col("load") == load)
    last = {r["slice"]: (r["keys"], r["digest"]) for r in done.collect()}
    for number, found in sorted(wanted.items()):
        if last.get(number) == found:
            continue
        rows = schemas.conform(evaluate(todo.where(F.col("slice") == number).select(key)), schema)
        replace_slice(rows, path, load, number, fmt)
        replace_slice(spark.createDataFrame([found], "keys BIGINT, digest BIGINT"), noted, load, number, fmt)


def replace_slice(rows: DataFrame, path: str, load: str, number: int, fmt: str = "parquet") -> None:
    """Write rows in place of whatever the (load, slice) partition holds; other partitions stay."""
    (
        rows.withColumns({"load": F.lit(load), "slice": F.lit(number)})
        .write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("load", "slice")
        .save(path)
    )


def stored_slices(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """The rows of a target with the load and slice that hold them."""
    whole = T.StructType([*schema.fields, T.StructField("load", T.StringType()), T.StructField("slice", T.IntegerType())])
    return read_or_empty(spark, path, whole, fmt)


def read_slices(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """The rows that ``append_in_slices`` stored."""
    return stored_slices(spark, path, schema, fmt).select(*schema.names)


def empty_gold(spark: SparkSession) -> DataFrame:
    """The typed, empty target table."""
    return spark.createDataFrame([], schemas.ROUTE_COMPARISON)


def gold_schema(df: DataFrame) -> DataFrame:
    """Conform any comparison rows to the contract of the target table."""
    return schemas.conform(df, schemas.ROUTE_COMPARISON)


def distinct_routes(df: DataFrame) -> DataFrame:
    return df.select("route_id").distinct()


BROADCAST_ROWS = 10_000


def broadcast_if_small(ids: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint for a narrow side found to have at most ``limit`` rows, none beyond that.

    The look-up reads at most ``limit + 1`` rows.
    """
    return F.broadcast(ids) if len(ids.take(limit + 1)) <= limit else ids


def filter_sample(df: DataFrame, sample: DataFrame) -> DataFrame:
    """Rows of the sampled routes."""
    return df.join(broadcast_if_small(sample.select("route_id")), "route_id", "left_semi")
