"""Apply the saved models to feature rows."""

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from zonepulse.models.boosting import SoftmaxModel
from zonepulse.models.forest import HotspotForest

NAMES = ("congestion_classifier", "delay_regressor", "hotspot_detector")
SCRATCH = ["raw_features", "features", "rawPrediction", "probability", "prediction"]


@dataclass
class Models:
    congestion: SoftmaxModel
    delay: PipelineModel
    hotspots: HotspotForest

    def save(self, folder: str) -> None:
        spark = self.hotspots.nodes.sparkSession
        self.congestion.save(spark, f"{folder}/{NAMES[0]}")
        self.delay.write().overwrite().save(f"{folder}/{NAMES[1]}")
        self.hotspots.save(f"{folder}/{NAMES[2]}")

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> "Models":
        return cls(SoftmaxModel.load(spark, f"{folder}/{NAMES[0]}"),
                   PipelineModel.load(f"{folder}/{NAMES[1]}"),
                   HotspotForest.load(spark, f"{folder}/{NAMES[2]}"))

    def predict(self, features: DataFrame) -> DataFrame:
        """Serving predictions per (zone_id, timestamp); works on batch and micro-batch frames.

        All three models run in one narrow pass. A predicted delay is never negative.
        """
        level = (self.congestion.transform(features)
                 .withColumn("_level", F.col("prediction").cast("int")).drop(*SCRATCH))
        delay = (self.delay.transform(level)
                 .withColumn("_delay", F.greatest(F.lit(0.0), "prediction")).drop(*SCRATCH))
        return self.hotspots.transform(delay).select(
            "zone_id", F.col("hour_bucket").alias("timestamp"),
            F.col("_delay").alias("predicted_delay_minutes"),
            F.col("_level").alias("congestion_level"), "is_hotspot")
