"""Model features and targets from the zone-hour grid."""

import logging

from pyspark.sql import DataFrame, Window, functions as F

from zonepulse import rules
from zonepulse.functions import (
    congestion_ratio, cyclic, delay_minutes, is_overnight, is_rush_hour, trips_per_minute)
from zonepulse.operators.fill import fill_gaps
from zonepulse.operators.grid import by_zone_hour

log = logging.getLogger(__name__)

NULLABLE = ["speed_stddev", "speed_delta", "lag1_speed", "lag2_speed", "lag1_trips"]


def add_clock_features(grid: DataFrame) -> DataFrame:
    hour_sin, hour_cos = cyclic(F.col("hour_of_day"), 24)
    dow_sin, dow_cos = cyclic(F.col("day_of_week"), 7)
    return grid.withColumns({
        "is_rush_hour": is_rush_hour(F.col("hour_of_day")),
        "is_overnight": is_overnight(F.col("hour_of_day")),
        "hour_sin": hour_sin, "hour_cos": hour_cos,
        "dow_sin": dow_sin, "dow_cos": dow_cos,
    })


def add_history_features(grid: DataFrame, history: str = "whole") -> DataFrame:
    """Lags, rolling mean and ratio to the zone's mean: one shuffle and one sort by zone.

    ``history="running"``: the mean of the zone's rows so far, as a stream knows it.
    """
    if history not in ("whole", "running"):
        raise ValueError(f"unknown history: {history!r}")
    past = by_zone_hour()
    last_three = past.rowsBetween(-2, Window.currentRow)
    whole_zone = (Window.partitionBy("zone_id") if history == "whole"
                  else past.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return grid.withColumns({
        "lag1_speed": F.lag("avg_speed", 1).over(past),
        "lag2_speed": F.lag("avg_speed", 2).over(past),
        "lag1_trips": F.lag("trip_count", 1).over(past).cast("double"),
        "rolling_avg_speed_3h": F.avg("avg_speed").over(last_three),
        "speed_to_zone_avg":
            F.col("avg_speed") / (F.avg("avg_speed").over(whole_zone) + F.lit(rules.EPSILON)),
    })


def add_density_features(grid: DataFrame) -> DataFrame:
    return grid.withColumns({
        "trips_per_minute": trips_per_minute(F.col("trip_count")),
        "congestion_ratio": congestion_ratio(F.col("trip_count"), F.col("avg_speed")),
    })


def add_delay_target(grid: DataFrame) -> DataFrame:
    return grid.withColumn(
        "delay_minutes", delay_minutes(F.col("avg_duration"), F.col("avg_distance")))


def select_available(df: DataFrame, wanted: list[str]) -> DataFrame:
    """The wanted columns that exist; missing ones are logged, not an error."""
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        log.warning("columns not available: %s", ", ".join(missing))
    return df.select(*(c for c in wanted if c in df.columns))


def feature_matrix(grid: DataFrame, fill: str = "back", scope: str = "frame",
                   horizon: int = 0, history: str = "whole") -> DataFrame:
    """22 features, both targets and the row key (zone_id, hour_bucket).

    ``fill`` and ``scope``: see :func:`fill_gaps`. ``horizon=h`` replaces both targets by
    those of the zone's h-th next row, which makes the label a real forecast; rows
    without such a successor are dropped.
    """
    full = (grid.transform(add_clock_features)
                .transform(add_history_features, history)
                .transform(add_density_features)
                .transform(add_delay_target))
    if horizon:
        full = full.withColumns({
            t: F.lead(t, horizon).over(by_zone_hour()) for t in rules.TARGETS
        }).dropna(subset=list(rules.TARGETS))
    present = select_available(
        full, ["zone_id", "hour_bucket", *rules.FEATURES, *rules.TARGETS])
    return fill_gaps(present, [c for c in NULLABLE if c in present.columns], fill, scope)
