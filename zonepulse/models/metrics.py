"""Model metrics as aggregates."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from zonepulse import rules, schemas


def _ratio(part, whole):
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def _per_class(predictions: DataFrame, label: str, prediction: str) -> DataFrame:
    """Hits, true and predicted rows per class. Only the confusion counts are regrouped."""
    confusion = predictions.groupBy(
        F.col(label).cast("int").alias("label"),
        F.col(prediction).cast("int").alias("prediction")).agg(F.count("*").alias("n"))
    hits = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    none = F.lit(0).cast("long")
    sides = confusion.select(F.explode(F.array(
        F.struct(F.col("label").alias("class"), hits.alias("hit"), F.col("n").alias("support"),
                 none.alias("predicted")),
        F.struct(F.col("prediction").alias("class"), none.alias("hit"), none.alias("support"),
                 F.col("n").alias("predicted")))).alias("s")).select("s.*")
    totals = sides.groupBy("class").agg(
        *(F.sum(c).alias(c) for c in ("hit", "support", "predicted")))
    return totals.withColumns({
        "precision": _ratio(F.col("hit"), F.col("predicted")),
        "recall": _ratio(F.col("hit"), F.col("support")),
        "f1": _ratio(2 * F.col("hit"), F.col("support") + F.col("predicted")),
    })


def classification_report(predictions: DataFrame, label: str = "congestion_level",
                          prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per congestion class."""
    names = F.array(*(F.lit(n) for n in rules.CLASS_NAMES))
    return _per_class(predictions, label, prediction).select(
        "class", F.get(names, F.col("class")).alias("class_name"),
        "precision", "recall", "f1", "support")


def classification_scores(predictions: DataFrame, label: str = "congestion_level",
                          prediction: str = "prediction") -> DataFrame:
    """Accuracy, support-weighted F1 and plain mean F1."""
    return _per_class(predictions, label, prediction).agg(
        _ratio(F.sum("hit"), F.sum("support")).alias("accuracy"),
        _ratio(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("weighted_f1"),
        F.avg("f1").alias("macro_f1"))


def regression_scores(predictions: DataFrame, label: str = "delay_minutes",
                      prediction: str = "prediction") -> DataFrame:
    """RMSE, MAE and R² in one aggregate."""
    error = F.col(label) - F.col(prediction)
    spread = F.var_pop(label) * F.count(label)
    return predictions.agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.try_divide(F.sum(error * error), spread)).alias("r2"))


def class_weights(df: DataFrame, label: str = "congestion_level") -> DataFrame:
    """Rows per class and the balanced weight rows / (classes · class rows)."""
    counts = df.groupBy(label).agg(F.count("*").alias("class_rows"))
    totals = counts.agg(F.collect_list(F.struct(label, "class_rows")).alias("classes"))
    total = F.aggregate("classes", F.lit(0).cast("long"), lambda sum_, c: sum_ + c["class_rows"])
    return (totals.withColumn("share", total / F.size("classes"))
                  .select("share", F.inline("classes"))
                  .select(label, "class_rows",
                          (F.col("share") / F.col("class_rows")).alias("weight")))


def with_class_weights(df: DataFrame, label: str = "congestion_level") -> DataFrame:
    """Add ``weight``. There is one weight per class, so they become a literal map, not a join."""
    weights = {row[label]: row["weight"] for row in class_weights(df, label).collect()}
    pairs = [F.lit(x) for pair in weights.items() for x in pair]
    return df.withColumn("weight", F.create_map(*pairs)[F.col(label)])


def performance_rows(spark: SparkSession, model: str, scores: dict[str, float],
                     dataset_size: int, when: datetime, notes: str = "") -> DataFrame:
    """One long-format row per metric."""
    return spark.createDataFrame(
        [(model, name, float(value), when, dataset_size, notes)
         for name, value in scores.items()], schemas.MODEL_PERFORMANCE)
