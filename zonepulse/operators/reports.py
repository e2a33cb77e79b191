"""Serving queries on the zone metrics."""

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from zonepulse import rules

RECENT_COLUMNS = ("zone_id", "timestamp", "avg_speed", "trip_count", "congestion_level",
                  "predicted_delay_minutes", "is_hotspot", "hour_of_day", "day_of_week")
ALERT_COLUMNS = ("zone_id", "avg_speed", "trip_count", "predicted_delay_minutes", "timestamp")


def recent_window(metrics: DataFrame, as_of: datetime | Column | None = None,
                  hours: int = rules.RECENT_HOURS) -> DataFrame:
    """All rows of the last ``hours`` up to ``as_of`` (default: the newest row): what aggregates read.

    On the serving table's layout a bound on ``metric_period`` prunes folders, and the newest row is looked
    for in the newest period alone: a period that contains the start begins at most 31 days before it.
    """
    periods = "metric_period" in metrics.columns
    if as_of is None:
        newest = metrics
        if periods:
            newest = metrics.filter(F.col("metric_period") == metrics.agg(F.max("metric_period")).scalar())
        end = newest.agg(F.max("timestamp")).scalar()
    else:
        end = as_of if isinstance(as_of, Column) else F.lit(as_of)
    start = end - F.make_dt_interval(hours=F.lit(hours))
    recent = metrics.filter((F.col("timestamp") >= start) & (F.col("timestamp") <= end))
    if periods:
        recent = recent.filter(F.col("metric_period") >= F.date_sub(F.to_date(start), 31))
    return recent.select(*RECENT_COLUMNS)


def recent_metrics(metrics: DataFrame, as_of: datetime | Column | None = None,
                   hours: int = rules.RECENT_HOURS, limit: int = rules.RECENT_LIMIT) -> DataFrame:
    """The list of recent rows, newest first, up to the query's own limit; ties at the cut resolve by zone."""
    return (recent_window(metrics, as_of, hours)
            .orderBy(F.desc("timestamp"), "zone_id").limit(limit))


def only_zones(metrics: DataFrame, zones: Sequence[int] = ()) -> DataFrame:
    """No zones given means all zones."""
    return metrics.filter(F.col("zone_id").isin(list(zones))) if zones else metrics


def kpis(metrics: DataFrame) -> DataFrame:
    """Counts of metric rows (not of distinct zones) by state, one pass."""
    level = F.col("congestion_level")
    return metrics.agg(
        F.count_if(level == 0).alias("free_flow"),
        F.count_if(level == 1).alias("moderate"),
        F.count_if(level >= 2).alias("congested"),
        F.count_if("is_hotspot").alias("hotspots"),
    )


def zone_summary(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy("zone_id").agg(
        F.avg("congestion_level").alias("congestion_level"),
        F.avg("avg_speed").alias("avg_speed"),
        F.sum("trip_count").alias("trip_count"),
    )


def histogram(metrics: DataFrame, column: str = "predicted_delay_minutes",
              bins: int = rules.HISTOGRAM_BINS) -> DataFrame:
    """Counts in equal-width bins between the column's extremes; empty bins are left out.

    Both extremes come from one scalar subquery, so rows are counted where they are.
    """
    extremes = metrics.agg(F.struct(F.min(column).alias("low"), F.max(column).alias("high"))).scalar()
    low, high = extremes["low"], extremes["high"]
    width = (high - low) / F.lit(float(bins))
    # The maximum belongs to the last bin; a constant column has one bin.
    at = F.coalesce(F.floor(F.try_divide(F.col(column) - low, width)), F.lit(0))
    binned = (metrics.filter(F.col(column).isNotNull())
              .select(F.least(at, F.lit(bins - 1)).cast("int").alias("bin")))
    counts = binned.groupBy("bin").agg(F.count("*").alias("rows"))
    return counts.select(
        "bin",
        (low + F.col("bin") * width).alias("bin_start"),
        (low + (F.col("bin") + 1) * width).alias("bin_end"),
        "rows")


def congestion_by_hour(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy("hour_of_day").agg(F.avg("congestion_level").alias("congestion_level"))


def hotspot_alerts(metrics: DataFrame, limit: int = rules.ALERT_LIMIT) -> DataFrame:
    """The busiest hotspots; ties go to the newer row, then the lower zone."""
    return (metrics.filter("is_hotspot")
                   .orderBy(F.desc("trip_count"), F.desc("timestamp"), "zone_id")
                   .limit(limit)
                   .select(*ALERT_COLUMNS))


def zone_hourly(metrics: DataFrame) -> DataFrame:
    """Speed, trips and congestion per zone and hour of the day."""
    return metrics.groupBy("zone_id", "hour_of_day").agg(
        F.avg("avg_speed").alias("avg_speed"),
        F.sum("trip_count").alias("trip_count"),
        F.avg("congestion_level").alias("congestion_level"),
    )


def dataset_summary(grid: DataFrame) -> DataFrame:
    """Rows and zones: counted per zone first, so no zone list is built."""
    per_zone = grid.groupBy("zone_id").agg(F.count("*").alias("rows"))
    return per_zone.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
                        F.count("zone_id").alias("zones"))
