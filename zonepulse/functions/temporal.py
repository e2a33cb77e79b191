"""Clock and calendar expressions (all built-in, no UDF)."""

import math

from pyspark.sql import Column, functions as F

from zonepulse import rules


def day_of_week(ts) -> Column:
    """1 = Sunday … 7 = Saturday."""
    return F.dayofweek(ts)


def is_weekend(dow: Column) -> Column:
    return dow.isin(1, 7)


def _in_rush(hour: Column) -> Column:
    morning, evening = rules.RUSH_HOURS
    return hour.between(*morning) | hour.between(*evening)


def is_rush_hour(hour: Column) -> Column:
    return _in_rush(hour).cast("int")


def is_overnight(hour: Column) -> Column:
    start, end = rules.OVERNIGHT_HOURS
    return ((hour >= start) | (hour < end)).cast("int")


def cyclic(value: Column, period: int) -> tuple[Column, Column]:
    """(sin, cos) of ``value`` as a phase of ``period``."""
    angle = value * F.lit(2 * math.pi) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def demand_factor(hour: Column) -> Column:
    """Expected demand relative to daytime: rush, night (22–5) or neither."""
    return (F.when(_in_rush(hour), rules.DEMAND_FACTORS["rush"])
             .when(is_overnight(hour) == 1, rules.DEMAND_FACTORS["night"])
             .otherwise(rules.DEMAND_FACTORS["day"]))
