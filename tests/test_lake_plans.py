from datetime import datetime

import pytest
from pyspark.sql import functions as F

from helpers import plan, plan_after_run, trip, trips
from zonepulse import schemas, session
from zonepulse.catalog.queries import QUERIES, grid_lake
from zonepulse.operators import cleaning, features, fill, grid, joins
from zonepulse.plans.batch import run_batch
from zonepulse.sources import event_trips, lake, serving


@pytest.fixture(scope="module")
def raw_path(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "trips")
    event_trips.raw_trips(spark, sf_dir).withColumn("tip", F.lit(1.0)).write.parquet(path)
    return path


def test_filters_and_columns_reach_the_scan(spark, raw_path):
    text = plan(cleaning.clean_trips(lake.read_trips(spark, raw_path)))
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert "tip" not in scan.split("ReadSchema")[1]
    for pushed in ("GreaterThanOrEqual(PULocationID,1)", "LessThanOrEqual(DOLocationID,263)",
                   "GreaterThan(trip_distance,0.1)", "LessThan(fare_amount,500.0)",
                   "LessThanOrEqual(passenger_count,6)", "IsNotNull(tpep_pickup_datetime)",
                   "IsNotNull(tpep_dropoff_datetime)"):
        assert pushed in text, pushed


def test_one_shuffle_cleans_and_two_aggregate(spark, raw_path):
    clean = cleaning.clean_trips(lake.read_trips(spark, raw_path))
    assert plan(clean).count("Exchange hashpartitioning") == 1
    text = plan(grid.zone_hour_aggregates(clean))
    assert text.count("Exchange hashpartitioning") == 2
    assert text.count("partial_count") >= 1 and "partial_min_by" in text
    assert "SortAggregate" not in text


def test_no_python_and_no_whole_frame_window(spark, sf_dir):
    cells = grid_lake(spark, sf_dir)
    text = plan_after_run(features.feature_matrix(cells))
    assert "Python" not in text and "Pandas" not in text
    final = text.split("== Initial Plan ==")[0]
    # The only single-task step works on one row per zone.
    single = final.split("Exchange SinglePartition")
    assert len(single) == 2 and "min_by" in single[1].splitlines()[1]


def test_zone_fill_needs_one_shuffle(spark, sf_dir):
    out = fill.fill_gaps(grid_lake(spark, sf_dir), ["speed_stddev"], scope="zone")
    assert plan(out).count("Exchange") == 1


def test_small_zone_table_is_broadcast_and_large_is_not(spark, sf_dir):
    cells = grid_lake(spark, sf_dir)
    zones = spark.read.parquet(f"{sf_dir}/nation.parquet").withColumnRenamed("n_nationkey", "zone_id")
    assert "BroadcastHashJoin" in plan(joins.attach_zone_names(cells, zones))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan(joins.attach_zone_names(cells, zones))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_partition_pruning(spark, sf_dir):
    cells = grid_lake(spark, sf_dir)
    assert "PartitionFilters: [isnotnull(hour_of_day" in plan(cells.filter("hour_of_day = 8"))
    pruned = cells.filter("hour_of_day = 8")
    assert pruned.count() == sum(r.hour_of_day == 8 for r in cells.select("hour_of_day").collect())


def test_month_folders_and_replacing_touched_ones(spark, tmp_path):
    path = str(tmp_path / "clean")
    jan = cleaning.clean_trips(trips(spark, trip()))
    feb = cleaning.clean_trips(trips(
        spark, trip(tpep_pickup_datetime=datetime(2023, 2, 2, 8), minutes=20)))
    lake.write_clean_trips(jan.unionByName(feb), path)
    jan_year = lake.read_clean_trips(spark, path).where("month = 1").first().year
    assert sorted(str(p.relative_to(tmp_path / "clean")) for p in (tmp_path / "clean").glob("*/month=*")) == sorted(
        [f"year={jan_year}/month=1", "year=2023/month=2"])
    lake.write_clean_trips(feb, path)
    assert lake.read_clean_trips(spark, path).count() == 2
    stray = cleaning.clean_trips(trips(
        spark, trip(tpep_pickup_datetime=datetime(2023, 2, 28, 23), minutes=20),
        trip(tpep_pickup_datetime=datetime(2024, 2, 1, 0), minutes=20)))
    for _ in range(2):
        lake.write_clean_trips(stray, path)
        assert lake.read_clean_trips(spark, path).count() == 4
    assert lake.read_clean_trips(spark, path).distinct().count() == 4
    lake.write_clean_trips(feb, path, replace="all")
    assert lake.read_clean_trips(spark, path).count() == 1
    assert "snappy" in next((tmp_path / "clean").rglob("*.parquet")).name


def test_physical_types_may_differ_between_paths(spark, tmp_path):
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    one = trips(spark, trip())
    one.withColumns({"passenger_count": F.col("passenger_count").cast("double"),
                     "PULocationID": F.col("PULocationID").cast("int"),
                     "tpep_pickup_datetime": F.col("tpep_pickup_datetime").cast("timestamp_ntz"),
                     }).write.parquet(old)
    one.withColumn("extra", F.lit(1)).write.parquet(new)
    both = lake.read_trips(spark, old, new)
    assert both.select(*schemas.RAW_TRIP.fieldNames()).schema.simpleString() == schemas.RAW_TRIP.simpleString()
    assert both.count() == 2 and cleaning.clean_trips(both).count() == 1


def test_missing_path_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        lake.read_trips(spark, str(tmp_path / "nowhere"))


def test_batch_run_twice_gives_the_same_tables(spark, raw_path, tmp_path):
    folders = [str(tmp_path / n) for n in ("clean", "grid", "serving")]
    for _ in range(2):
        result = run_batch(spark, [raw_path], *folders)
        assert (result.raw_count, result.clean_count) == (1020, 652)
        assert result.raw_count - sum(result.rejected.values()) == 665
        assert result.retention_pct == pytest.approx(63.92, abs=0.01)
        assert result.grid.count() == 596
    served = serving.read_zone_metrics(spark, folders[2])
    assert served.count() == served.select("zone_id", "timestamp").distinct().count() == 596
    first = served.first()
    assert first.is_hotspot is False and first.created_at is not None and first.temperature is None
    assert "tip" in lake.read_clean_trips(spark, folders[0]).columns
    assert sorted(p.name for p in (tmp_path / "grid").glob("hour*"))[:2] == ["hour_of_day=0", "hour_of_day=1"]


def test_serving_merge_keeps_neighbours_and_predictions(spark, tmp_path):
    path = str(tmp_path / "serving")
    schema = "zone_id int, timestamp timestamp, trip_count long, predicted_delay_minutes double, is_hotspot boolean"
    december = [(z, datetime(2023, 12, d, 5), 10, 3.5, True) for z in (1, 2) for d in range(1, 31)]
    serving.write_zone_metrics(spark.createDataFrame(december, schema), path)
    batch = spark.createDataFrame([(1, datetime(2023, 12, 30, 5), 99), (1, datetime(2024, 1, 1, 0), 7)],
                                  "zone_id int, timestamp timestamp, trip_count long")
    for _ in range(2):
        serving.write_zone_metrics(batch, path)
        rows = {(r.zone_id, r.timestamp): r for r in serving.read_zone_metrics(spark, path).collect()}
        assert len(rows) == 61
        again, new = rows[1, datetime(2023, 12, 30, 5)], rows[1, datetime(2024, 1, 1, 0)]
        assert (again.trip_count, again.predicted_delay_minutes, again.is_hotspot) == (99, 3.5, True)
        assert (new.trip_count, new.predicted_delay_minutes, new.is_hotspot) == (7, None, False)


def test_command_line_batch(spark, raw_path, tmp_path):
    from zonepulse.__main__ import main
    main(["batch", "--raw", raw_path, "--clean", str(tmp_path / "c"), "--grid", str(tmp_path / "g"),
          "--serving", str(tmp_path / "s")])
    assert serving.read_zone_metrics(spark, str(tmp_path / "s")).count() == 596


def test_jdbc_options_come_from_the_environment(monkeypatch):
    with pytest.raises(KeyError):
        serving.jdbc_options("zone_metrics")
    monkeypatch.setenv("SERVING_JDBC_URL", "jdbc:x://h/d")
    monkeypatch.setenv("SERVING_JDBC_USER", "u")
    assert serving.jdbc_options("zone_metrics") == {
        "url": "jdbc:x://h/d", "dbtable": "zone_metrics", "user": "u"}


def test_scratch_folder_follows_the_session_setting(spark, monkeypatch):
    root = spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_dir(spark, "x").startswith(root)
    assert session.scratch_dir(spark, "x") != session.scratch_dir(spark, "x")


def test_session_settings(spark):
    for key in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled",
                "spark.sql.parquet.filterPushdown"):
        assert spark.conf.get(key) == "true"
    assert spark.conf.get("spark.sql.parquet.mergeSchema") == "false"
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_recent_query_prunes_serving_folders(spark, sf_dir):
    text = plan_after_run(QUERIES["recent_metrics"](spark, sf_dir))
    assert "TakeOrderedAndProject" in text
    filters = [part.split(", PushedFilters")[0] for part in text.split("PartitionFilters: ")[1:]]
    assert any("metric_period" in f and "ubquery" in f for f in filters), filters


def test_sizes_grow_with_the_input_and_are_bounded():
    mb, tb = 1024 ** 2, 1024 ** 4
    assert session.sizes_for(10 * mb) == (1, 128 * mb)
    assert session.sizes_for(tb) == (4096, 128 * mb)
    assert session.sizes_for(100 * tb) == (20000, 1024 * mb)


def test_sizes_are_raised_for_the_block_only(spark, raw_path):
    keys = ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")
    before = [spark.conf.get(k) for k in keys]
    with session.sized_for(spark, 2 * 1024 ** 4):
        assert spark.conf.get(keys[0]) == "8192"
    with session.sized_for(spark, 100 * 1024 ** 4):
        assert spark.conf.get(keys[1]) == str(1024 ** 3)
    with session.sized_for(spark, 1):
        assert [spark.conf.get(k) for k in keys] == before
    assert [spark.conf.get(k) for k in keys] == before


def test_stored_bytes(spark, raw_path):
    import pathlib
    files = [p for p in pathlib.Path(raw_path).iterdir() if not p.name.startswith((".", "_"))]
    assert lake.stored_bytes(spark, raw_path) == sum(p.stat().st_size for p in files)
