import math
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import trip, trips
from zonepulse import rules
from zonepulse.functions import (
    congestion_level, delay_minutes, demand_factor, is_overnight, is_rush_hour, occupancy_pct)
from zonepulse.operators import features, fill, grid
from zonepulse.operators.cleaning import clean_trips

H0 = datetime(2023, 3, 1)


def hours(spark, expression):
    rows = spark.range(24).select("id", expression(F.col("id")).alias("x")).orderBy("id").collect()
    return [r.x for r in rows]


def test_congestion_limits(spark):
    speeds = [None, 7.99, 8.0, 14.99, 15.0, 24.99, 25.0, 60.0]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(speeds)], "i int, s double")
    got = [r.l for r in df.orderBy("i").select(congestion_level(F.col("s")).alias("l")).collect()]
    assert got == [3, 3, 2, 2, 1, 1, 0, 0]


def test_clock_bands(spark):
    assert [h for h, x in enumerate(hours(spark, is_rush_hour)) if x] == [7, 8, 9, 17, 18, 19]
    assert [h for h, x in enumerate(hours(spark, is_overnight)) if x] == [0, 1, 2, 3, 4, 5, 22, 23]
    factors = hours(spark, demand_factor)
    assert factors == [0.3] * 6 + [1.0] + [2.5] * 3 + [1.0] * 7 + [2.5] * 3 + [1.0] * 2 + [0.3] * 2


def test_delay_and_occupancy(spark):
    df = spark.createDataFrame([(10.0, 2.0, 10), (3.0, 2.0, 200)], "d double, m double, v int")
    got = df.select(delay_minutes(F.col("d"), F.col("m")).alias("x"),
                    occupancy_pct(F.col("v")).alias("o")).collect()
    assert [(r.x, r.o) for r in got] == [(6.0, 12.5), (0.0, 100.0)]


def test_grid_of_hand_made_trips(spark):
    at = datetime(2023, 1, 7, 10, 59, 59)  # a Saturday
    rows = trips(spark,
                 trip(tpep_pickup_datetime=at, minutes=60, trip_distance=10.0),
                 trip(tpep_pickup_datetime=at, minutes=60, trip_distance=20.0),
                 trip(tpep_pickup_datetime=at + timedelta(hours=5), minutes=60, trip_distance=30.0))
    first, second = grid.zone_hour_grid(clean_trips(rows)).orderBy("hour_bucket").collect()
    assert first.hour_bucket == datetime(2023, 1, 7, 10) == first.timestamp
    assert (first.trip_count, first.avg_speed, first.total_passengers) == (2, 15.0, 4)
    assert first.speed_stddev == pytest.approx(math.sqrt(50))
    assert (first.hour_of_day, first.day_of_week, first.is_weekend) == (10, 7, True)
    assert (first.congestion_level, first.prev_hour_speed, first.speed_delta) == (1, None, None)
    # The gap of five hours is not filled: "previous" is the previous present hour.
    assert (second.speed_stddev, second.prev_hour_speed, second.prev_hour_trips) == (None, 15.0, 2)
    assert (second.speed_delta, second.congestion_level) == (15.0, 0)


def random_cells(seed, zones=7, span=40):
    rng = np.random.default_rng(seed)
    keys = [(z, H0 + timedelta(hours=int(h)))
            for z in range(1, zones + 1) for h in np.flatnonzero(rng.random(span) < 0.4)]
    frame = pd.DataFrame(keys, columns=["zone_id", "hour_bucket"])
    for name, share in (("a", 0.6), ("b", 0.95), ("c", 1.0)):
        values = rng.normal(size=len(frame)).round(3)
        frame[name] = np.where(rng.random(len(frame)) < share, np.nan, values)
    return frame


def to_spark(spark, frame):
    rows = [(r.zone_id, r.hour_bucket.to_pydatetime(),
             *(None if math.isnan(v) else v for v in (r.a, r.b, r.c)))
            for r in frame.itertuples(index=False)]
    return spark.createDataFrame(rows, "zone_id int, hour_bucket timestamp, a double, b double, c double")


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("direction", ["back", "forward"])
@pytest.mark.parametrize("scope", ["frame", "zone"])
def test_fill_equals_whole_frame_fill(spark, seed, direction, scope):
    frame = random_cells(seed).sort_values(["zone_id", "hour_bucket"])
    names = ["a", "b", "c"]
    source = frame.groupby("zone_id")[names] if scope == "zone" else frame[names]
    expected = (source.bfill() if direction == "back" else source.ffill()).fillna(0)
    out = fill.fill_gaps(to_spark(spark, frame).repartition(5), names, direction, scope)
    got = out.orderBy("zone_id", "hour_bucket").select(*names).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in expected.itertuples(index=False)]


def test_fill_crosses_zone_borders(spark):
    df = spark.createDataFrame(
        [(1, H0, None), (2, H0, None), (3, H0, 5.0), (4, H0, None)],
        "zone_id int, hour_bucket timestamp, a double")
    got = fill.fill_gaps(df, ["a"]).orderBy("zone_id").collect()
    assert [r.a for r in got] == [5.0, 5.0, 5.0, 0.0]


def test_unknown_fill_is_an_error(spark):
    with pytest.raises(ValueError):
        fill.fill_gaps(to_spark(spark, random_cells(1)), ["a"], "sideways")


def looped_features(cells, direction):
    """Every feature from a plain loop over each zone's rows; then the fill over the whole frame."""
    rows = sorted((dict(r) for r in cells.drop(columns=["timestamp"]).to_dict("records")),
                  key=lambda r: (r["zone_id"], r["hour_bucket"]))
    for r in rows:
        zone = [x for x in rows if x["zone_id"] == r["zone_id"]]
        at = next(i for i, x in enumerate(zone) if x is r)
        r["lag1_speed"] = zone[at - 1]["avg_speed"] if at >= 1 else None
        r["lag2_speed"] = zone[at - 2]["avg_speed"] if at >= 2 else None
        r["lag1_trips"] = zone[at - 1]["trip_count"] if at >= 1 else None
        last = [x["avg_speed"] for x in zone[max(0, at - 2):at + 1]]
        r["rolling_avg_speed_3h"] = sum(last) / len(last)
        r["speed_to_zone_avg"] = r["avg_speed"] / (sum(x["avg_speed"] for x in zone) / len(zone) + rules.EPSILON)
        r["congestion_ratio"] = r["trip_count"] / (r["avg_speed"] + rules.EPSILON)
    order = reversed(rows) if direction == "back" else rows
    seen = {}
    for r in order:
        for name, value in r.items():
            missing = value is None or value != value
            r[name] = seen.get(name, 0) if missing else value
            seen[name] = r[name] if not missing or name in seen else None
            if seen[name] is None:
                del seen[name]
    return pd.DataFrame(rows)


@pytest.mark.parametrize("direction", ["back", "forward"])
def test_feature_matrix_equals_brute_force(spark, sf_dir, direction):
    from zonepulse.catalog.queries import grid_lake
    cells = grid_lake(spark, sf_dir)
    expected = looped_features(cells.toPandas(), direction)
    got = features.feature_matrix(cells, fill=direction).toPandas().sort_values(
        ["zone_id", "hour_bucket"]).reset_index(drop=True)
    assert [c for c in got.columns if c in rules.FEATURES] == list(rules.FEATURES)
    for c in ["speed_stddev", "speed_delta", "lag1_speed", "lag2_speed", "lag1_trips",
              "rolling_avg_speed_3h", "speed_to_zone_avg", "congestion_ratio"]:
        np.testing.assert_allclose(got[c].astype(float), expected[c].astype(float), rtol=1e-9, err_msg=c)


def test_missing_columns_are_skipped(spark, sf_dir, caplog):
    from zonepulse.catalog.queries import grid_lake
    cells = grid_lake(spark, sf_dir).drop("total_passengers")
    out = features.feature_matrix(cells)
    assert "total_passengers" not in out.columns and "avg_speed" in out.columns
    assert "total_passengers" in caplog.text


def test_forecast_drops_rows_without_successor(spark, sf_dir):
    from zonepulse.catalog.queries import grid_lake
    cells = grid_lake(spark, sf_dir)
    zones = cells.select("zone_id").distinct().count()
    assert features.feature_matrix(cells, horizon=1).count() == cells.count() - zones
