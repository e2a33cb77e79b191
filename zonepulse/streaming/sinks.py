"""Streaming sinks that can be replayed."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from zonepulse import rules
from zonepulse.sources import serving


DATE = "event_date"
CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
#: Large state: kept on local disk by RocksDB, checkpointed as changes; a batch's cost follows what it changes. All stores of an executor
#: share one bounded memory, however many partitions it holds, and a change isn't preceded by a look-up that only counts rows.
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    CHANGELOG: "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def batch_folder_sink(path: str, transform: Callable[[DataFrame], DataFrame] | None = None,
                      files: int | None = None, dated_by: str | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that owns one folder per query and batch id and overwrites it.

    The query's id lives in its checkpoint: a restarted query replays into its own folders, and a
    query with a new checkpoint, whose batch ids begin at 0 again, gets others. An error fails the
    query, so the batch is retried instead of lost. ``files`` bounds the files of a batch; the
    stage before keeps its own number of tasks. ``dated_by``: a time column; its date becomes a folder below the batch's.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        out = transform(batch) if transform else batch
        if files:
            out = out.repartition(files)
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not query:
            raise RuntimeError("the sink must be called by a streaming query")
        writer = out.write.mode("overwrite")
        if dated_by:
            writer = out.withColumn(DATE, F.to_date(dated_by)).write.mode("overwrite").partitionBy(DATE)
        writer.parquet(f"{path}/query_id={query}/batch_id={batch_id}")

    return write


def jdbc_sink(table: str, url: str | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that appends over JDBC. A replayed batch is appended again
    unless the table's key, e.g. (zone_id, window_start), rejects it."""
    return lambda batch, batch_id: serving.append_jdbc(batch, table, url)


def read_batches(spark: SparkSession, path: str, schema) -> DataFrame:
    """All batches of all queries that :func:`batch_folder_sink` wrote, with their ``batch_id`` and, of dated ones, ``event_date``."""
    return spark.read.schema(schema).option("basePath", path).parquet(path).drop("query_id")


def read_state(spark: SparkSession, checkpoint: str, operator: int = 0, variable: str | None = None) -> DataFrame:
    """Rows (key, value, partition_id) of a query's state as of its last batch; ``variable``: of a processor's state."""
    reader = spark.read.format("statestore").option("operatorId", operator)
    return (reader.option("stateVarName", variable) if variable else reader).load(checkpoint)


def start(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
          once: bool = False, trigger: str = rules.TRIGGER,
          state_partitions: int | None = None, rocksdb: bool = False, changelog: bool = True) -> StreamingQuery:
    """Start an append-mode query. ``once`` drains what is available and stops.

    The number of state partitions and the state store (``rocksdb``: for large state and for processors) are fixed by a query's first
    batch, so they are set here for this query alone: a started query keeps its own copy of the session settings.
    Without ``changelog``, RocksDB checkpoints whole snapshots: cheaper where a batch changes most of the state, as a restart then replays nothing.
    """
    spark = df.sparkSession
    writer = (df.writeStream.outputMode("append")
                .option("checkpointLocation", checkpoint)
                .foreachBatch(write))
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=trigger)
    own = ROCKSDB | {CHANGELOG: str(changelog).lower()} if rocksdb else {}
    if state_partitions is not None:
        own = own | {"spark.sql.shuffle.partitions": str(state_partitions)}
    before = {key: spark.conf.get(key, None) for key in own}
    for key, value in own.items():
        spark.conf.set(key, value)
    try:
        return writer.start()
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def drain(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
          state_partitions: int | None = None, rocksdb: bool = False, changelog: bool = True) -> StreamingQuery:
    """Process all available input, then return; raises if the query failed."""
    query = start(df, write, checkpoint, once=True, state_partitions=state_partitions, rocksdb=rocksdb,
                  changelog=changelog)
    query.awaitTermination()
    return query
