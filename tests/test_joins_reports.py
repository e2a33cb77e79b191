from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest

from zonepulse.operators import hotspots, joins, reports
from zonepulse.sources import serving

T0 = datetime(2023, 5, 30)


@pytest.mark.parametrize("bucket", ["hour", "day", "month"])
@pytest.mark.parametrize("by", [(), ("zone",)])
def test_as_of_equals_brute_force(spark, bucket, by):
    rng = np.random.default_rng(5)
    left = pd.DataFrame({"zone": rng.integers(0, 3, 300),
                         "t": [T0 + timedelta(minutes=int(m)) for m in rng.integers(0, 9000, 300)]})
    left["n"] = range(300)
    right = pd.DataFrame({"zone": rng.integers(0, 3, 25),
                          "t": [T0 + timedelta(minutes=int(m)) for m in rng.integers(2000, 7000, 25)]})
    right["w"] = [f"w{i:02d}" for i in range(25)]
    ldf = spark.createDataFrame(left)
    rdf = spark.createDataFrame(right if by else right.drop(columns="zone"))
    got = {r.n: r.w for r in joins.as_of(ldf, rdf, "t", ["w"], by, bucket).collect()}

    def best(row):
        ok = right[(right.t <= row.t) & ((right.zone == row.zone) if by else True)]
        return None if ok.empty else max(zip(ok.t, ok.w))[1]
    assert got == {row.n: best(row) for row in left.itertuples()}


def test_write_back_replaces_only_predicted_rows(spark):
    metrics = spark.createDataFrame(
        [(1, T0, 2, None), (2, T0, 3, 9.0)], "zone_id int, timestamp timestamp, level int, delay double")
    predictions = spark.createDataFrame(
        [(1, T0, 0, 4.5), (7, T0, 1, 1.0)], "zone_id int, timestamp timestamp, level int, delay double")
    out = joins.write_back(metrics, predictions).orderBy("zone_id").collect()
    assert [(r.zone_id, r.level, r.delay) for r in out] == [(1, 0, 4.5), (2, 3, 9.0)]


def metrics(spark, rows):
    frame = spark.createDataFrame(
        rows, "zone_id int, timestamp timestamp, avg_speed double, trip_count int, "
              "congestion_level int, predicted_delay_minutes double, is_hotspot boolean, "
              "hour_of_day int, day_of_week int")
    return serving.with_serving_defaults(frame)


def row(zone, minutes_ago, level=0, trips=5, delay=1.0, hot=False):
    return (zone, T0 - timedelta(minutes=minutes_ago), 10.0, trips, level, delay, hot, 3, 4)


def test_recent_window_is_inclusive_and_newest_first(spark):
    m = metrics(spark, [row(1, 0), row(2, 120), row(3, 121), row(4, 60), row(5, 60)])
    assert [r.zone_id for r in reports.recent_metrics(m).collect()] == [1, 4, 5, 2]
    later = T0 + timedelta(hours=1)
    assert [r.zone_id for r in reports.recent_metrics(m, as_of=later).collect()] == [1, 4, 5]
    assert [r.zone_id for r in reports.recent_metrics(m, limit=2).collect()] == [1, 4]


def test_recent_over_midnight_on_the_stored_table(spark, tmp_path):
    path = str(tmp_path / "serving")
    serving.write_zone_metrics(metrics(spark, [row(1, 0), row(2, 90), row(3, 500)]), path)
    stored = serving.read_zone_metrics(spark, path)
    assert [r.zone_id for r in reports.recent_metrics(stored).collect()] == [1, 2]


def test_kpis_count_rows_and_ignore_null_flags(spark):
    m = metrics(spark, [row(1, 0, 0), row(1, 5, 1), row(1, 9, 2, hot=True), row(2, 0, 3, hot=None)])
    assert tuple(reports.kpis(m).first()) == (1, 1, 2, 1)


def test_zone_filter(spark):
    m = metrics(spark, [row(1, 0), row(2, 0)])
    assert reports.only_zones(m, [2]).count() == 1
    assert reports.only_zones(m, []).count() == 2


@pytest.mark.parametrize("values", [[0.0, 1.0, 2.9, 3.0], [2.0, 2.0], [1.0, None, 4.0]])
def test_histogram_equals_numpy(spark, values):
    m = metrics(spark, [row(i, 0, delay=v) for i, v in enumerate(values)])
    got = {r.bin: r.rows for r in reports.histogram(m, bins=3).collect()}
    known = [v for v in values if v is not None]
    if len(set(known)) == 1:
        assert got == {0: len(known)}
    else:
        counts, _ = np.histogram(known, 3)
        assert got == {i: n for i, n in enumerate(counts) if n}


def test_alerts_order_and_limit(spark):
    m = metrics(spark, [row(z, z % 3, trips=z % 5, hot=z != 4) for z in range(1, 20)])
    got = [(r.trip_count, r.zone_id) for r in reports.hotspot_alerts(m).collect()]
    assert len(got) == 10 and all(z != 4 for _, z in got)
    expected = sorted((z for z in range(1, 20) if z != 4), key=lambda z: (-(z % 5), z % 3, z))[:10]
    assert [z for _, z in got] == expected


def test_rule_needs_spike_and_slowdown(spark):
    rows = [(1, T0 + timedelta(hours=i), i, d) for i, d in zip(range(1, 21), [1.0, -1.0] * 10)]
    cells = spark.createDataFrame(rows, "zone_id int, hour_bucket timestamp, trip_count long, speed_delta double")
    hot = [r.trip_count for r in hotspots.rule_hotspots(cells).filter("is_hotspot").collect()]
    assert hot == [20]
    assert hotspots.detection_rate(hotspots.rule_hotspots(cells)).first().hotspot_pct == 5.0


def test_detection_scores(spark):
    df = spark.createDataFrame([(True, True)] * 3 + [(True, False)] + [(False, True)] * 2,
                               "is_hotspot boolean, truth boolean")
    s = hotspots.detection_scores(df, "truth").first()
    assert (s.precision, s.recall) == (0.75, 0.6) and s.f1 == pytest.approx(2 / 3)
    none = hotspots.detection_scores(df.filter("1 = 0"), "truth").first()
    assert (none.precision, none.recall, none.f1) == (0.0, 0.0, 0.0)
