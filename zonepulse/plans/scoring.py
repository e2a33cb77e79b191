"""Scoring plans: fill the serving table's prediction columns, in batch and per micro-batch."""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from zonepulse import rules
from zonepulse.models.scoring import Models
from zonepulse.operators.features import feature_matrix
from zonepulse.operators.joins import write_back
from zonepulse.session import materialize
from zonepulse.sources import serving
from zonepulse.streaming import sinks
from zonepulse.streaming.live import live_features


def score_metrics(metrics: DataFrame, features: DataFrame, models: Models) -> DataFrame:
    """Metrics with predicted delay, congestion level and hotspot flag where features exist."""
    return write_back(metrics, models.predict(features))


def score_serving(spark: SparkSession, grid: DataFrame, model_folder: str,
                  serving_path: str, rescore: bool = False) -> None:
    """Load the models and score the serving table's periods that hold rows without predictions; ``rescore``: all periods.

    Features need a zone's history, so they are made of the whole grid; only rows of these periods are predicted, read and rewritten.
    """
    models = Models.load(spark, model_folder)
    table = serving.read_zone_metrics(spark, serving_path)
    features = feature_matrix(grid)
    if not rescore:
        pending = table.where(F.col(serving.SCORED).isNull()).agg(
            F.collect_set("metric_period"), F.min("metric_period"), F.date_add(F.last_day(F.max("metric_period")), 1)).first()
        periods, first, end = pending                                          # calendar periods
        if not periods:
            return
        table = table.where(F.col("metric_period").isin(periods))
        features = features.where((F.col("hour_bucket") >= F.lit(first)) & (F.col("hour_bucket") < F.lit(end)))
    # Stored first: the periods being overwritten are also being read.
    scored = materialize(score_metrics(table.drop("metric_period"), features, models), "scored")
    serving.write_zone_metrics(scored, serving_path)


def score_stream(features: DataFrame, models: Models, path: str, checkpoint: str,
                 once: bool = False) -> StreamingQuery:
    """Score every micro-batch of a stream of feature rows into its own batch folder."""
    return sinks.start(features, sinks.batch_folder_sink(path, models.predict), checkpoint, once)


def score_trip_stream(trips: DataFrame, models: Models, path: str, checkpoint: str, once: bool = False,
                      state_partitions: int | None = None, watermark: str = rules.WATERMARK) -> StreamingQuery:
    """Score a stream of raw trips: each zone's hours once the watermark has closed them."""
    return sinks.start(live_features(trips, watermark), sinks.batch_folder_sink(path, models.predict), checkpoint, once,
                       state_partitions=state_partitions, rocksdb=True)
