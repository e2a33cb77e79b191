from datetime import datetime, timedelta

import pytest

from helpers import GOOD, trip, trips
from zonepulse.operators import cleaning


def kept(spark, step, column, values, **fixed):
    out = step(trips(spark, *(trip(**fixed, **{column: v}) for v in values)))
    return [r[column] for r in out.collect()]


def test_null_pair_leaves_one(spark):
    empty = trip(tpep_pickup_datetime=None, tpep_dropoff_datetime=None)
    full = trip(tpep_pickup_datetime=datetime(2023, 1, 1, 8),
                tpep_dropoff_datetime=datetime(2023, 1, 1, 8, 20))
    assert cleaning.drop_incomplete(trips(spark, empty, full)).count() == 1


@pytest.mark.parametrize("column", cleaning.REQUIRED)
def test_each_required_column(spark, column):
    assert cleaning.drop_incomplete(trips(spark, trip(**{column: None}))).count() == 0


@pytest.mark.parametrize("column", ["fare_amount", "passenger_count"])
def test_null_fare_and_passengers_fail_bounds(spark, column):
    rows = trips(spark, trip(**{column: None}))
    assert cleaning.drop_incomplete(rows).count() == 1
    assert cleaning.keep_plausible(rows).count() == 0


@pytest.mark.parametrize("column", ["PULocationID", "DOLocationID"])
def test_zone_bounds(spark, column):
    assert kept(spark, cleaning.keep_city_zones, column, [0, 1, 263, 264]) == [1, 263]


@pytest.mark.parametrize("column,values,expected", [
    ("trip_distance", [0.1, 0.11, 99.99, 100.0], [0.11, 99.99]),
    ("fare_amount", [2.50, 2.51, 499.99, 500.0], [2.51, 499.99]),
    ("passenger_count", [0, 1, 6, 7], [1, 6]),
])
def test_range_bounds(spark, column, values, expected):
    assert kept(spark, cleaning.keep_plausible, column, values) == expected


def test_duration_bounds(spark):
    rows = trips(spark, *(trip(minutes=m) for m in (-5, 0, 59 / 60, 1, 180, 180 + 1 / 60)))
    out = cleaning.keep_valid_durations(cleaning.add_duration(rows))
    assert sorted(r.trip_duration_min for r in out.collect()) == [1.0, 180.0]


def test_duration_counts_whole_seconds(spark):
    start = datetime(2023, 1, 2, 8, 0, 0, 900000)
    row = trip(tpep_pickup_datetime=start,
               tpep_dropoff_datetime=datetime(2023, 1, 2, 8, 1, 0, 100000))
    assert cleaning.add_duration(trips(spark, row)).first().trip_duration_min == 1.0


def test_speed_bound_and_zero_duration(spark):
    rows = trips(spark, trip(minutes=60, trip_distance=79.99), trip(minutes=60, trip_distance=80.0),
                 trip(minutes=0))
    timed = cleaning.add_speed(cleaning.add_duration(rows))
    assert timed.filter("avg_speed_mph IS NULL").count() == 1
    out = cleaning.keep_possible_speeds(timed).collect()
    assert [round(r.avg_speed_mph, 2) for r in out] == [79.99]


def test_time_parts_use_sunday_as_one(spark):
    days = [datetime(2023, 1, d, 23, 59) for d in range(1, 8)]  # 2023-01-01 is a Sunday
    out = cleaning.add_time_parts(trips(spark, *(trip(tpep_pickup_datetime=d) for d in days)))
    got = [(r.day_of_week, r.is_weekend, r.hour_of_day, r.month) for r in out.collect()]
    assert got == [(d, d in (1, 7), 23, 1) for d in range(1, 8)]


def near_duplicates(spark, n=200):
    rows = [trip(fare_amount=5.0 + i, DOLocationID=i % 9 + 1,
                 tpep_dropoff_datetime=GOOD["tpep_dropoff_datetime"] + timedelta(minutes=i % 7))
            for i in range(n)]
    return trips(spark, *rows, trip(PULocationID=9), trip(PULocationID=9))


def test_dedup_keeps_one_real_row_whatever_the_partitioning(spark):
    rows = near_duplicates(spark)
    originals = {tuple(r) for r in rows.collect()}
    results = []
    for parts in (1, 3, 8):
        out = cleaning.deduplicate(rows.repartition(parts)).collect()
        assert len(out) == 2 and {tuple(r) for r in out} <= originals
        results.append(sorted(tuple(r) for r in out))
    assert results[0] == results[1] == results[2]


def test_dedup_on_key_only_columns(spark):
    rows = near_duplicates(spark).select(*cleaning.DEDUP_KEY)
    assert cleaning.deduplicate(rows).count() == 2


def test_dedup_handles_null_payload(spark):
    rows = trips(spark, trip(fare_amount=None), trip(fare_amount=None))
    assert [r.fare_amount for r in cleaning.deduplicate(rows).collect()] == [None]


def test_one_key_with_a_third_of_all_rows(spark):
    from pyspark.sql import functions as F
    n = 30000
    base = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), "id")
    rows = base.select(
        F.timestamp_seconds(1700000000 + F.col("k")).alias("tpep_pickup_datetime"),
        F.timestamp_seconds(1700000600 + F.col("k")).alias("tpep_dropoff_datetime"),
        F.lit(5).cast("long").alias("PULocationID"), F.lit(6).cast("long").alias("DOLocationID"),
        F.lit(2.0).alias("trip_distance"), (F.col("id") % 90 + 3.0).alias("fare_amount"),
        F.lit(1).cast("long").alias("passenger_count"))
    assert cleaning.clean_trips(rows).count() == n - n // 3 + 1
    report = cleaning.retention_report(rows).first()
    assert (report.raw_count, report.clean_count) == (n, n - n // 3 + 1)


def test_clean_keeps_requested_columns(spark):
    from pyspark.sql import functions as F
    rows = trips(spark, trip()).withColumns({"vendor": F.lit("a"), "tip": F.lit(1.0)})
    assert "vendor" not in cleaning.clean_trips(rows).columns
    assert cleaning.clean_trips(rows, ("vendor",)).first().vendor == "a"
    assert {"vendor", "tip"} <= set(cleaning.clean_trips(rows, "*").columns)


def test_retention_of_nothing(spark):
    report = cleaning.retention_report(trips(spark)).first()
    assert (report.raw_count, report.clean_count, report.retention_pct) == (0, 0, None)


def test_retention_counts_invalid_rows(spark):
    report = cleaning.retention_report(trips(
        spark, trip(), trip(), trip(trip_distance=None), trip(minutes=0), trip(PULocationID=3)))
    row = report.first()
    assert (row.raw_count, row.clean_count, row.retention_pct) == (5, 2, 40.0)


@pytest.mark.parametrize("sf,steps,cells", [
    ("sf0.001", (1020, 652), 596), ("sf0.01", (10200, 6440), 3362), ("sf0.1", (102000, 64588), 4320)])
def test_measured_counts(spark, sf, steps, cells):
    from zonepulse.operators.grid import zone_hour_aggregates
    from zonepulse.sources import event_trips
    raw = event_trips.raw_trips(spark, f"/root/testdata/{sf}")
    report = cleaning.retention_report(raw).first()
    assert (report.raw_count, report.clean_count) == steps
    assert zone_hour_aggregates(cleaning.clean_trips(raw)).count() == cells
