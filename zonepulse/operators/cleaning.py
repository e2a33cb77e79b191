"""Trip cleaning: validity rules, derived columns, deduplication, retention."""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from zonepulse import rules, schemas
from zonepulse.functions import day_of_week, duration_minutes, is_weekend, speed_mph

TRIP_COLUMNS = tuple(schemas.RAW_TRIP.fieldNames())
REQUIRED = TRIP_COLUMNS[:5]
DEDUP_KEY = ("tpep_pickup_datetime", "PULocationID", "trip_distance")


def _duration() -> Column:
    return duration_minutes("tpep_pickup_datetime", "tpep_dropoff_datetime")


def _moving() -> Column:
    """Duration and speed bounds, straight from the input columns."""
    speed = speed_mph(F.col("trip_distance"), _duration())
    return _duration().between(*rules.DURATION_BOUNDS) & (speed < rules.SPEED_LIMIT)


def _strictly_between(name: str, bounds: tuple[float, float]) -> Column:
    low, high = bounds
    return (F.col(name) > low) & (F.col(name) < high)


# One predicate per rule. They are plain column comparisons wherever possible, so that
# everything but the duration and speed rules reaches the Parquet scan.
def _known() -> Column:
    return reduce(and_, (F.col(c).isNotNull() for c in REQUIRED))


def _in_city() -> Column:
    return reduce(and_, (F.col(c).between(*rules.ZONE_BOUNDS)
                         for c in ("PULocationID", "DOLocationID")))


def _plausible() -> Column:
    return (_strictly_between("trip_distance", rules.DISTANCE_BOUNDS)
            & _strictly_between("fare_amount", rules.FARE_BOUNDS)
            & F.col("passenger_count").between(*rules.PASSENGER_BOUNDS))


def drop_incomplete(trips: DataFrame) -> DataFrame:
    return trips.filter(_known())


def keep_city_zones(trips: DataFrame) -> DataFrame:
    return trips.filter(_in_city())


def keep_plausible(trips: DataFrame) -> DataFrame:
    """Distance, fare and passenger bounds; a null fare or passenger count fails them."""
    return trips.filter(_plausible())


def add_duration(trips: DataFrame) -> DataFrame:
    return trips.withColumn("trip_duration_min", _duration())


def keep_valid_durations(trips: DataFrame) -> DataFrame:
    return trips.filter(F.col("trip_duration_min").between(*rules.DURATION_BOUNDS))


def add_speed(trips: DataFrame) -> DataFrame:
    return trips.withColumn(
        "avg_speed_mph", speed_mph(F.col("trip_distance"), F.col("trip_duration_min")))


def keep_possible_speeds(trips: DataFrame) -> DataFrame:
    return trips.filter(F.col("avg_speed_mph") < rules.SPEED_LIMIT)


def add_time_parts(trips: DataFrame) -> DataFrame:
    pickup = F.col("tpep_pickup_datetime")
    return trips.withColumns({
        "hour_of_day": F.hour(pickup),
        "day_of_week": day_of_week(pickup),
        "month": F.month(pickup),
        "is_weekend": is_weekend(day_of_week(pickup)),
    })


def deduplicate(trips: DataFrame, key: tuple[str, ...] = DEDUP_KEY) -> DataFrame:
    """One row per key: the one whose other columns hash lowest.

    Written as an aggregate so that copies collapse before the shuffle, however many
    rows share a key, and so that a recomputed task picks the same survivor. ``min_by``
    over a bigint keeps fixed-width columns on hash aggregation; with a string column among
    them Spark sorts instead.
    """
    rest = [c for c in trips.columns if c not in key]
    if not rest:
        return trips.distinct()
    # The hash skips nulls, so where they are is hashed too.
    ranked = trips.withColumn("_rank", F.xxhash64(*rest, *(F.col(c).isNull() for c in rest)))
    return (ranked.groupBy(*key)
                  .agg(*(F.min_by(c, "_rank").alias(c) for c in rest))
                  .select(*trips.columns))


#: The rules in the order in which they are applied; a row counts for the first one it fails.
RULES = ("incomplete", "outside_city", "implausible", "bad_duration", "bad_speed")


def rejected_by() -> Column:
    """Name of the first rule that a row fails; null if it is valid."""
    fails = (_known(), _in_city(), _plausible(), _duration().between(*rules.DURATION_BOUNDS), _moving())
    named = F
    for name, holds in zip(RULES, fails):
        named = named.when(~F.coalesce(holds, F.lit(False)), name)
    return named


def rejection_counts(trips: DataFrame) -> DataFrame:
    """(rule, rows): one row for every rule, and one of a null rule for valid rows, before deduplication."""
    totals = trips.select(rejected_by().alias("rule")).agg(
        *(F.count_if(F.col("rule") == name).alias(name) for name in RULES),
        F.count_if(F.col("rule").isNull()).alias("valid"))
    pairs = [F.struct(F.lit(name).alias("rule"), F.col(name).alias("rows")) for name in RULES]
    return totals.select(F.inline(F.array(*pairs, F.struct(F.lit(None).cast("string").alias("rule"), F.col("valid").alias("rows")))))


def surplus_rows(trips: DataFrame, row: str, stored: DataFrame | None = None,
                 key: tuple[str, ...] = DEDUP_KEY) -> DataFrame:
    """(key, winner, rows, stored) of keys with several rows, or with a row in ``stored`` already.

    ``row`` names a unique bigint column; ``winner`` is that of the row whose other columns hash lowest. Everything
    aggregated is of fixed width, whatever columns there are, so nothing is sorted, copies collapse before the
    shuffle, and no row is shuffled whole.
    """
    rest = [c for c in trips.columns if c not in (*key, row)]
    rank = F.xxhash64(*rest, *(F.col(c).isNull() for c in rest)) if rest else F.lit(0).cast("bigint")
    keys = trips.select(*key, F.col(row).alias("_row"), rank.alias("_rank"), F.lit(False).alias("_stored"))
    if stored is not None:
        nothing = F.lit(None).cast("bigint")
        keys = keys.unionByName(stored.select(*key, nothing.alias("_row"), nothing.alias("_rank"), F.lit(True).alias("_stored")))
    groups = keys.groupBy(*key).agg(F.min_by("_row", "_rank").alias("winner"), F.count("_row").alias("rows"),
                                    F.max("_stored").alias("stored"))
    return groups.where((F.col("rows") > 1) | (F.col("stored") & (F.col("rows") > 0)))


def without_surplus(trips: DataFrame, row: str, surplus: DataFrame, key: tuple[str, ...] = DEDUP_KEY) -> DataFrame:
    """The rows that neither lose against another of their key nor are stored already; ``row`` is dropped."""
    joined = trips.join(surplus.select(*key, "winner", "stored"), list(key), "left")
    new = F.col("stored").isNull() | (~F.col("stored") & (F.col(row) == F.col("winner")))
    return joined.where(new).select(*(c for c in trips.columns if c != row))


def add_derived(trips: DataFrame) -> DataFrame:
    """Duration, speed and time parts."""
    return trips.transform(add_duration).transform(add_speed).transform(add_time_parts)


def valid_trips(trips: DataFrame) -> DataFrame:
    """All row-level rules, no derived columns kept: a scan-side filter only."""
    kept = trips.transform(drop_incomplete).transform(keep_city_zones).transform(keep_plausible)
    return kept.filter(_moving())


def clean_trips(trips: DataFrame, keep: tuple[str, ...] | str = ()) -> DataFrame:
    """Valid, distinct trips with duration, speed and time parts.

    ``keep`` names further input columns to carry through ("*" for all of them). Derived
    columns are added after the deduplication, so only input columns are shuffled.
    """
    extra = [c for c in (trips.columns if keep == "*" else keep) if c not in TRIP_COLUMNS]
    narrow = trips.select(*TRIP_COLUMNS, *extra)
    return narrow.transform(valid_trips).transform(deduplicate).transform(add_derived)


def retention_report(trips: DataFrame) -> DataFrame:
    """``raw_count``, ``clean_count`` and ``retention_pct`` in one pass over the raw trips.

    Rejected rows share one null key, which partial aggregation collapses per task.
    """
    valid = F.coalesce(
        _known() & _in_city() & _plausible() & _moving(), F.lit(False))
    flagged = trips.select(valid.alias("valid"), *DEDUP_KEY)
    keyed = flagged.select(
        "valid", *(F.when(F.col("valid"), F.col(c)).alias(c) for c in DEDUP_KEY))
    per_key = keyed.groupBy("valid", *DEDUP_KEY).agg(F.count("*").alias("rows"))
    totals = per_key.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("raw_count"),
        F.count_if("valid").alias("clean_count"))
    return totals.withColumn(
        "retention_pct",
        F.try_divide(F.col("clean_count") * F.lit(100.0), F.col("raw_count")))
