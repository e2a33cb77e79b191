"""Exact order statistics without sorting or collecting the column."""

import math

from pyspark.sql import DataFrame, functions as F

BUCKETS = 4096


def kth_smallest(df: DataFrame, column: str, k: int, buckets: int = BUCKETS) -> float:
    """The k-th smallest (from 0) non-null value.

    Each pass counts rows per equal-width bucket and continues inside the bucket that holds
    the k-th value, until that bucket has one value. At most ``buckets`` rows reach the
    driver per pass, whatever the data; equal values cost nothing.
    """
    values = df.select(F.col(column).cast("double").alias("v")).filter("v IS NOT NULL")
    low, high = values.agg(F.min("v"), F.max("v")).first()
    if low is None:
        raise ValueError(f"{column} has no values")
    while low < high:
        width = (high - low) / buckets
        bucket = F.least(F.floor((F.col("v") - low) / width), F.lit(buckets - 1))
        counts = (values.filter(F.col("v").between(low, high))
                  .groupBy(bucket.alias("bucket"))
                  .agg(F.count("*").alias("rows"), F.min("v").alias("low"), F.max("v").alias("high"))
                  .orderBy("bucket").collect())
        for found in counts:
            if k < found["rows"]:
                break
            k -= found["rows"]
        else:
            raise ValueError(f"{column} has too few values")
        low, high = found["low"], found["high"]
    return low


def quantile(df: DataFrame, column: str, q: float) -> float:
    """Linearly interpolated quantile of the non-null values."""
    n = df.select(F.count(column)).first()[0]
    if not n:
        raise ValueError(f"{column} has no values")
    position = (n - 1) * q
    k = math.floor(position)
    value = kth_smallest(df, column, k)
    if position == k:
        return value
    covered, following = df.agg(
        F.count_if(F.col(column) <= value),
        F.min(F.when(F.col(column) > value, F.col(column).cast("double")))).first()
    above = value if covered > k + 1 else following
    return value + (position - k) * (above - value)
