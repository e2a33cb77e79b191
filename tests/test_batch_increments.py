"""A delivery costs what it brings: grid and serving table are brought up to date cell by cell."""

from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from helpers import plan, trip, trips
from zonepulse.operators import cleaning, grid
from zonepulse.plans import batch
from zonepulse.plans.batch import run_batch
from zonepulse.session import run_scratch, scratch_dir
from zonepulse.sources import grid_lake, lake, serving

GRID = ["zone_id", "hour_bucket", "trip_count", "avg_speed", "prev_hour_speed", "prev_hour_trips", "speed_delta", "congestion_level"]


@pytest.fixture
def folders(tmp_path):
    return [str(tmp_path / n) for n in ("clean", "grid", "serving")]


class Deliveries:
    def __init__(self, spark, tmp_path, folders):
        self.spark, self.tmp_path, self.folders, self.rows = spark, tmp_path, folders, []

    def __call__(self, *rows):
        path = str(self.tmp_path / f"raw{len(list(self.tmp_path.glob('raw*')))}")
        trips(self.spark, *rows).withColumn("vendor", F.lit("v")).write.parquet(path)
        self.rows += rows
        return run_batch(self.spark, [path], *self.folders)

    def check(self):
        """The grid, and the borders beside it, are what one run over everything would give."""
        whole = grid.zone_hour_grid(cleaning.clean_trips(trips(self.spark, *self.rows)))
        found = lake.read_grid(self.spark, self.folders[1])
        assert rows_of(found) == rows_of(whole)
        borders = self.spark.read.parquet(grid_lake.borders_path(self.folders[1]))
        expected = grid_lake.borders(found)
        assert sorted(map(str, borders.select(*expected.columns).collect())) == sorted(map(str, expected.collect()))
        served = serving.read_zone_metrics(self.spark, self.folders[2])
        assert served.count() == whole.count() == served.join(
            whole, ["zone_id", "timestamp"]).where(served["trip_count"] == whole["trip_count"]).count()


def rows_of(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*GRID).collect())


@pytest.fixture
def deliver(spark, tmp_path, folders):
    return Deliveries(spark, tmp_path, folders)


def at(month, day, hour, zone=1, miles=2.0, minute=0):
    return trip(tpep_pickup_datetime=datetime(2023, month, day, hour, minute), minutes=20, PULocationID=zone, trip_distance=miles)


def written(folder):
    return {p: p.stat().st_mtime_ns for p in Path(folder).rglob("*.parquet")}


def test_later_and_earlier_cells_follow(deliver):
    deliver(*(at(3, d, h, z) for d in (1, 2) for h in (8, 9, 17) for z in (1, 2)))
    deliver.check()
    deliver(at(3, 2, 12, 1), at(3, 2, 9, 2, 7.0), at(3, 9, 9, 3))        # between two cells, in a cell, a new zone
    deliver.check()
    deliver(at(5, 1, 0, 1), at(5, 3, 4, 2))                               # a month in between stays empty
    deliver.check()
    deliver(at(4, 30, 23, 1, 9.0))                                        # moves the first cell of May
    deliver.check()
    deliver(at(1, 1, 0, 1), at(1, 31, 9, 3), at(3, 31, 23, 2, 4.0))       # before everything; the last cell of March
    deliver.check()
    deliver(at(3, 2, 12, 1), at(3, 2, 12, 1, 5.0, 30))                    # a copy of a stored trip, and another one
    deliver.check()


def test_only_touched_folders_are_written(deliver, folders):
    deliver(*(at(m, d, h) for m in (1, 2, 3) for d in range(1, 6) for h in (7, 8, 20)))
    before = [written(f) for f in (*folders, grid_lake.borders_path(folders[1]))]
    result = deliver(at(2, 4, 7, miles=9.0, minute=5), at(2, 5, 7, miles=9.0, minute=6))
    after = [written(f) for f in (*folders, grid_lake.borders_path(folders[1]))]
    assert result.added_count == 2
    # Trips are appended; cells of hour 7, and of hour 8 behind them, are written anew, in February alone.
    assert before[0].items() <= after[0].items() and {p.parent.name for p in after[0].keys() - before[0].keys()} == {"month=2"}
    kept = {(p.parent.parent.name, p.parent.name) for p in before[1].keys() & after[1].keys()}
    replaced = {(p.parent.parent.name, p.parent.name) for p in after[1].keys() - before[1].keys()}
    assert replaced == {(f"hour_of_day={h}", "grid_month=2023-02-01") for h in (7, 8)} and not kept & replaced
    assert {p.parent.name for p in after[2].keys() - before[2].keys()} == {"metric_period=2023-02-01"}
    assert {p.parent.name for p in after[3].keys() - before[3].keys()} == {"grid_month=2023-02-01"}
    deliver.check()


def test_plans_prune_months(spark, deliver, folders):
    deliver(*(at(m, 1, 8) for m in (1, 2, 3)))
    changed = grid_lake.changed_cells(trips(spark, at(2, 1, 8)))
    text = plan(grid_lake.aggregated(lake.read_clean_trips(spark, folders[0]), changed, [(2023, 2)]))
    filters = next(line for line in text.splitlines() if "PartitionFilters" in line).split("PartitionFilters: ")[1]
    assert "2023-2" in filters and "year" in filters
    read = grid_lake.aggregated(lake.read_clean_trips(spark, folders[0]), changed, [(2023, 2)])
    assert read.count() == 1
    keys = lake.stored_keys(spark, folders[0], [(2023, 2)])
    assert len(keys.inputFiles()) == 3 and "2023-2" in plan(keys)         # listed; two of the folders are never opened
    assert plan(keys).split("ReadSchema")[1].count(":") <= 5


def test_counts_are_those_of_the_delivery(deliver):
    good = [at(6, d, 8) for d in range(1, 9)]
    result = deliver(*good, *good[:2], trip(trip_distance=None), at(6, 1, 8, zone=999), at(6, 1, 8, miles=0.05), trip(minutes=0),
                     at(6, 1, 8, miles=90.0))
    assert (result.raw_count, result.clean_count, result.added_count) == (15, 8, 8)
    assert result.rejected == dict(incomplete=1, outside_city=1, implausible=1, bad_duration=1, bad_speed=1)
    again = deliver(*good[:3], at(7, 1, 8))
    assert (again.raw_count, again.clean_count, again.added_count, again.retention_pct) == (4, 4, 1, 100.0)
    none = deliver(trip(minutes=0))
    assert (none.raw_count, none.clean_count, none.retention_pct) == (1, 0, 0.0)
    deliver.check()


def test_failed_run_is_completed_by_the_next(spark, deliver, folders, monkeypatch):
    deliver(at(3, 1, 8))
    with monkeypatch.context() as broken:
        broken.setattr(batch.grid_lake, "update_grid", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            deliver(at(3, 1, 9), at(3, 1, 10))
    assert lake.read_clean_trips(spark, folders[0]).count() == 3 and lake.read_grid(spark, folders[1]).count() == 1
    result = deliver(at(3, 1, 9), at(3, 1, 10))
    assert (result.clean_count, result.added_count) == (2, 0)
    deliver.check()


def test_scored_levels_outlive_a_delivery(spark, deliver, folders):
    deliver(at(3, 1, 8), at(3, 1, 9))
    scores = spark.createDataFrame([(1, datetime(2023, 3, 1, 8), 4.5, 3, True)],
                                   "zone_id int, timestamp timestamp, predicted_delay_minutes double, congestion_level int, is_hotspot boolean")
    serving.write_zone_metrics(scores, folders[2])
    deliver(at(3, 1, 8, miles=15.0, minute=9), at(3, 1, 9, miles=15.0, minute=9))
    rows = {r.timestamp.hour: r for r in serving.read_zone_metrics(spark, folders[2]).collect()}
    assert (rows[8].trip_count, rows[8].congestion_level, rows[8].predicted_delay_minutes, rows[8].is_hotspot) == (2, 3, 4.5, True)
    assert (rows[9].trip_count, rows[9].congestion_level, rows[9].predicted_delay_minutes) == (2, 0, None)


def test_surplus_rows_are_found_without_sorting(spark, deliver):
    rows = trips(spark, at(3, 1, 8)).withColumns({"vendor": F.lit("v"), "_row": F.monotonically_increasing_id()})
    text = plan(cleaning.surplus_rows(rows, "_row", rows.drop("_row")))
    assert "SortAggregate" not in text and "partial_min_by" in text and text.count("Exchange") == 1


def test_any_row_of_a_key_with_strings(spark):
    data = trips(spark, *[at(3, 1, 8)] * 6).withColumns({"vendor": F.lit("v"), "_row": F.monotonically_increasing_id()})
    data = data.withColumn("vendor", F.when(F.col("_row") % 2 == 0, "a").when(F.col("_row") % 3 == 0, "b")).cache()
    kept = cleaning.without_surplus(data, "_row", cleaning.surplus_rows(data, "_row"))
    assert kept.count() == 1 and kept.columns == [c for c in data.columns if c != "_row"]


def test_run_scratch_goes_with_the_run(spark):
    with run_scratch(spark) as path:
        inner = scratch_dir(spark, "x")
        spark.range(3).write.parquet(inner)
        assert inner.startswith(path) and Path(inner).exists()
    assert not Path(path).exists() and not scratch_dir(spark, "x").startswith(path)
    with pytest.raises(ZeroDivisionError):
        with run_scratch(spark) as path:
            spark.range(3).write.parquet(scratch_dir(spark, "x"))
            1 / 0
    assert Path(path).exists()


def test_rejections_of_a_long_month_gap(deliver):
    start = datetime(2022, 11, 30, 22)
    deliver(*(trip(tpep_pickup_datetime=start + timedelta(hours=h), minutes=20) for h in range(0, 100, 7)))
    deliver.check()
