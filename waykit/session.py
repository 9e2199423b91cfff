"""Session helpers: a local session for tests and benches, and the scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Settings that suit the packing stage where executors have memory to spare: the hash aggregate that
# collects matrix rows then falls back to sorting later than Spark's default of 128 groups, and joins
# hash a side instead of sorting both where every partition of it has been measured to be small.
TUNING = {
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "16384",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
}

_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"
_HASHED = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"

_local_scratch: dict[str, tempfile.TemporaryDirectory] = {}  # removed when the process ends


def local_session(app: str = "waykit", cores: int | str = 8, memory: str = "12g") -> SparkSession:
    """A session for tests and benches; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in TUNING.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder path for a written intermediate.

    The cluster names the shared root in ``spark.checkpoint.dir``; a folder set by ``setCheckpointDir``
    counts too. Only a local session without either gets a temporary folder, removed at its end: on a
    cluster, executors would each write to a disk of their own.
    """
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if not root:
        if context.master.partition("[")[0] != "local":
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        app = context.applicationId
        if app not in _local_scratch:
            _local_scratch[app] = tempfile.TemporaryDirectory(prefix="waykit-", ignore_cleanup_errors=True)
        root = _local_scratch[app].name
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")


@contextmanager
def kept_by_route(spark: SparkSession) -> Iterator[None]:
    """While this holds, joins on route and stop leave rows where they are if both sides are dealt by route already.

    A side whose every partition has been measured to be small is hashed, so the other side also keeps its order.
    """
    with _set(spark, {_ALL_KEYS: "false", _HASHED: TUNING[_HASHED]}):
        yield


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """While this holds, a write that has ended removes the shuffle files it made, which otherwise stay until the driver
    happens to collect its garbage. For tables that are read from their files from then on."""
    with _set(spark, {_FREED: "true"}):
        yield


@contextmanager
def _set(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def kept(spark: SparkSession) -> bool:
    return spark.conf.get(_ALL_KEYS) == "false"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point reliable checkpoints at the scratch root unless one is already set."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(spark.conf.get(CHECKPOINT_CONF, None) or scratch_dir(spark, "checkpoints"))


def task_count(spark: SparkSession, per_core: int = 4) -> int:
    """Partitions for CPU-bound stages: enough tasks to level uneven routes on every core."""
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(shuffle, per_core * spark.sparkContext.defaultParallelism)
