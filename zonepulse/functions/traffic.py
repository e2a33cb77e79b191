"""Trip and traffic expressions (all built-in, no UDF)."""

from pyspark.sql import Column, functions as F

from zonepulse import rules


def duration_minutes(start, end) -> Column:
    """Minutes between two timestamps, counted in whole seconds."""
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / F.lit(60.0)


def speed_mph(distance: Column, minutes: Column) -> Column:
    """Null, not an error, for a zero duration: filter order must not matter under ANSI."""
    return F.try_divide(distance, minutes / F.lit(60.0))


def congestion_level(speed: Column) -> Column:
    """0 free … 3 gridlock; a null speed counts as gridlock."""
    free, moderate, heavy = rules.CONGESTION_SPEEDS
    return F.when(speed >= free, 0).when(speed >= moderate, 1).when(speed >= heavy, 2).otherwise(3)


def delay_minutes(duration: Column, distance: Column) -> Column:
    """Minutes lost against driving the distance at free-flow speed, never negative."""
    return F.greatest(F.lit(0.0), duration - distance / F.lit(rules.FREE_FLOW_MPH) * F.lit(60.0))


def trips_per_minute(trips: Column) -> Column:
    return trips / F.lit(60.0)


def congestion_ratio(trips: Column, speed: Column) -> Column:
    return trips / (speed + F.lit(rules.EPSILON))


def occupancy_pct(vehicles: Column) -> Column:
    share = vehicles / F.lit(float(rules.SENSOR_CAPACITY)) * F.lit(100.0)
    return F.round(F.least(F.lit(100.0), share), 1)
