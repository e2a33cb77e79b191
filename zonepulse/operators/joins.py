"""Enrichment joins: zone lookup, as-of weather, prediction write-back.

No join carries a broadcast hint. A side is broadcast when its measured size is below
``spark.sql.autoBroadcastJoinThreshold`` (statically or by AQE); beyond that Spark
shuffles and AQE splits skewed partitions.
"""

from pyspark.sql import DataFrame, Window, functions as F


def attach_zone_names(facts: DataFrame, zones: DataFrame, on: str = "zone_id") -> DataFrame:
    """Left join of a zone table; facts of unknown zones keep nulls."""
    return facts.join(zones, on, "left")


def as_of(left: DataFrame, right: DataFrame, time: str, values: list[str],
          by: tuple[str, ...] = (), bucket: str = "month") -> DataFrame:
    """Add to each left row the ``values`` of the latest right row at or before its time.

    Rows are matched per (by, time bucket), so a hot key is spread over its buckets; a
    bucket's opening value comes from one summary row per earlier bucket. Left times are
    made distinct first, so the work depends on the number of different times. Of right
    rows with equal time, the one with the greatest values wins. Both inputs are read more
    than once; pass stored frames.
    """
    slot = F.date_trunc(bucket, time).alias("_slot")
    row = F.struct(*values)
    best = F.max_by(row, F.struct(time, *values))

    # Only the last reading of each instant can match.
    readings = right.groupBy(*by, time).agg(F.max(row).alias("_row")).withColumn("_is_left", F.lit(False))
    asked = left.select(*by, time).distinct().withColumn("_is_left", F.lit(True))
    mixed = asked.unionByName(readings, allowMissingColumns=True).select("*", slot)
    # At equal times readings come first (false < true).
    inside = (Window.partitionBy(*by, "_slot").orderBy(time, "_is_left")
                    .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    seen = mixed.withColumn("_row", F.last("_row", ignorenulls=True).over(inside)).filter("_is_left")

    # One row per (by, bucket): the calendar bounds how many a key can have.
    closing = right.groupBy(*by, slot).agg(best.alias("_close"))
    slots = (asked.select(*by, slot).distinct()
                  .unionByName(closing, allowMissingColumns=True)
                  .groupBy(*by, "_slot").agg(F.first("_close", ignorenulls=True).alias("_close")))
    earlier = (Window.partitionBy(*by).orderBy("_slot")
                     .rowsBetween(Window.unboundedPreceding, -1))
    opening = slots.select(*by, "_slot", F.last("_close", ignorenulls=True).over(earlier).alias("_open"))

    matched = (seen.join(opening, [*by, "_slot"], "left")
                   .withColumn("_row", F.coalesce("_row", "_open"))
                   .select(*by, time, *(F.col(f"_row.{v}").alias(v) for v in values)))
    return left.join(matched, [*by, time], "left")


def attach_weather(metrics: DataFrame, weather: DataFrame) -> DataFrame:
    """City-wide weather as of each metric's time."""
    return as_of(metrics.drop("weather_condition", "temperature"), weather, "timestamp",
                 ["weather_condition", "temperature"])


def write_back(metrics: DataFrame, predictions: DataFrame,
               key: tuple[str, ...] = ("zone_id", "timestamp")) -> DataFrame:
    """Replace the metrics' prediction columns where a prediction for the key exists."""
    columns = [c for c in predictions.columns if c not in key]
    renamed = predictions.select(*key, *(F.col(c).alias(f"_{c}") for c in columns))
    joined = metrics.join(renamed, list(key), "left")
    return joined.withColumns({
        c: F.coalesce(f"_{c}", c) if c in metrics.columns else F.col(f"_{c}") for c in columns
    }).drop(*(f"_{c}" for c in columns))
