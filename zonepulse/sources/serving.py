"""Serving tables: zone metrics, stream windows, model performance."""

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from zonepulse import schemas
from zonepulse.session import materialize, path_exists

BATCH_COLUMNS = ("zone_id", "timestamp", "avg_speed", "trip_count",
                 "congestion_level", "hour_of_day", "day_of_week")


def batch_projection(grid: DataFrame) -> DataFrame:
    """The seven grid columns that the serving table takes from a batch run."""
    return grid.select(*BATCH_COLUMNS)


def with_serving_defaults(metrics: DataFrame) -> DataFrame:
    """All zone-metrics columns in serving types: missing ones null, ``is_hotspot`` false,
    ``created_at`` now. The row key is (zone_id, timestamp)."""
    def value(field):
        have = F.col(field.name) if field.name in metrics.columns else F.lit(None)
        if field.name == "is_hotspot":
            have = F.coalesce(have.cast("boolean"), F.lit(False))
        elif field.name == "created_at":
            have = F.coalesce(have.cast("timestamp"), F.current_timestamp())
        return have.cast(field.dataType).alias(field.name)

    return metrics.select(*(value(f) for f in schemas.ZONE_METRICS))


def with_created_at(df: DataFrame) -> DataFrame:
    return df.withColumn("created_at", F.current_timestamp())


KEY = ("zone_id", "timestamp")
SCORED = "predicted_delay_minutes"      # not null in rows that were scored; their level is a predicted one
LEVEL = "congestion_level"


def write_zone_metrics(metrics: DataFrame, path: str, period: str = "month") -> None:
    """Merge into the table by key (zone_id, timestamp); files lie by time period.

    Rows of the batch replace rows of the same key and, in columns that the batch does not have
    (predictions, flags, weather), keep the stored values; so do the levels of scored rows unless the batch
    has predictions itself. All other stored rows stay, also
    in periods that the batch touches with a few stray rows only. Of the stored table only the touched
    periods are read and rewritten; the merged rows are stored first, as what is overwritten is
    also what is read. One table keeps one period.
    """
    spark = metrics.sparkSession
    dated = metrics.withColumn("metric_period", F.date_trunc(period, "timestamp").cast("date"))
    if path_exists(spark, path):
        dated = materialize(dated, "serving-batch")
        touched = [r[0] for r in dated.select("metric_period").distinct().collect()]     # calendar periods
        stored = read_zone_metrics(spark, path).where(F.col("metric_period").isin(touched))
        missing = [c for c in stored.columns if c not in dated.columns]
        scored = F.when(F.col(SCORED).isNotNull(), F.col(LEVEL)).alias("_level")
        kept = dated.join(stored.select(*KEY, *missing, scored), list(KEY), "left")
        if LEVEL in dated.columns and SCORED not in dated.columns:
            kept = kept.withColumn(LEVEL, F.coalesce("_level", LEVEL))
        kept = kept.drop("_level")
        others = stored.join(dated.select(*KEY), list(KEY), "left_anti")
        dated = materialize(kept.unionByName(others, allowMissingColumns=True), "serving-merged")
    complete = with_serving_defaults(dated).withColumn(
        "metric_period", F.date_trunc(period, "timestamp").cast("date"))
    (complete.hint("rebalance", F.col("metric_period"))
             .sortWithinPartitions("metric_period", "timestamp", "zone_id")
             .write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic")
             .option("compression", "snappy")
             .partitionBy("metric_period")
             .parquet(path))


def read_zone_metrics(spark: SparkSession, path: str) -> DataFrame:
    """``metric_period`` (first day of the period) stays available: filters on it prune folders."""
    return spark.read.parquet(path)


def append_model_performance(metrics: DataFrame, path: str) -> None:
    metrics.select(*schemas.MODEL_PERFORMANCE.fieldNames()).write.mode("append").parquet(path)


def jdbc_options(table: str, url: str | None = None) -> dict[str, str]:
    """JDBC options from the environment; credentials are never written in code."""
    url = url or os.environ["SERVING_JDBC_URL"]
    options = {"url": url, "dbtable": table}
    for option, variable in (("user", "SERVING_JDBC_USER"),
                             ("password", "SERVING_JDBC_PASSWORD"),
                             ("driver", "SERVING_JDBC_DRIVER")):
        if variable in os.environ:
            options[option] = os.environ[variable]
    return options


def append_jdbc(df: DataFrame, table: str, url: str | None = None, connections: int = 16) -> None:
    """Append over JDBC with a bounded number of connections. A rerun appends again unless the
    table has a unique key; failures raise. Needs the driver's jar on the class path. The rows are
    dealt out anew, so the stage before keeps its own number of tasks."""
    (df.repartition(connections)
       .write.format("jdbc").options(**jdbc_options(table, url)).mode("append").save())
