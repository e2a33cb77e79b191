"""Session settings and the shared scratch folder."""

import contextvars
import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.mergeSchema": "false",
    "spark.sql.parquet.compression.codec": "snappy",
}


def build_session(app_name: str = "zonepulse", master: str | None = None,
                  **settings: str) -> SparkSession:
    """A session with this package's settings; ``settings`` override them (dots as ``__``)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    chosen = SETTINGS | {key.replace("__", "."): value for key, value in settings.items()}
    for key, value in chosen.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder path under the cluster's shared ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster, executors
    could not see it and losing one would lose the data.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="zonepulse-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{_RUN.get() or root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


_RUN: contextvars.ContextVar[str | None] = contextvars.ContextVar("run", default=None)


@contextmanager
def run_scratch(spark: SparkSession) -> Iterator[str]:
    """Scratch folders made inside the block lie in one folder, which goes at its end; frames read from them end with it.

    A failed run's folder stays for inspection.
    """
    outer, path = _RUN.get(), scratch_dir(spark, "run")
    token = _RUN.set(path)
    try:
        yield path
    finally:
        _RUN.reset(token)
    if outer is None:
        location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(location, True)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def without_shuffle_files(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of actions inside the block go at their end; else they stay until the driver happens to collect its garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to shared storage and read it back: cuts lineage, survives lost executors. Its shuffle files go at the write's end."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    with without_shuffle_files(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


TASK_ROWS = 1 << 15             # rows of a task that passes over them again and again,
FEW_TASKS, MOST_ROWS = 256, 1 << 20     # up to so many rows once there are so many tasks


def tasks_for(rows: int) -> int:
    """Tasks for a frame that a fit reads hundreds of times: by its rows, as few bytes of it are work for a core."""
    return max(min(-(-rows // TASK_ROWS), max(FEW_TASKS, -(-rows // MOST_ROWS))), 1)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the path exists, in whatever file system it names."""
    jvm = spark.sparkContext._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(location)


MB = 1024 ** 2
TASK_BYTES = 256 * MB           # wanted per reduce task; AQE merges what turns out smaller
MAX_REDUCERS = 20_000
MAX_MAPPERS = 100_000           # above it, scan tasks get larger splits
SPLIT_BYTES = (128 * MB, 1024 * MB)


def sizes_for(input_bytes: int) -> tuple[int, int]:
    """(shuffle partitions, scan split bytes) that suit an input.

    Reduce tasks stay near ``TASK_BYTES`` until their number is capped, and mappers times
    reducers, which a shuffle's bookkeeping grows with, stays bounded.
    """
    reducers = min(math.ceil(input_bytes / TASK_BYTES), MAX_REDUCERS)
    small, large = SPLIT_BYTES
    return reducers, min(max(small, math.ceil(input_bytes / MAX_MAPPERS)), large)


@contextmanager
def sized_for(spark: SparkSession, input_bytes: int) -> Iterator[None]:
    """Run actions with sizes for a large input; a setting is only ever raised, then restored."""
    shuffle, split = "spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes"
    before = {key: spark.conf.get(key) for key in (shuffle, split)}
    reducers, split_bytes = sizes_for(input_bytes)
    if reducers > int(before[shuffle]):
        spark.conf.set(shuffle, str(reducers))
    if split_bytes > SPLIT_BYTES[0]:
        spark.conf.set(split, str(split_bytes))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
