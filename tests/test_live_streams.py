"""Streams with state: messages sent again, weather, live features, RocksDB, timed triggers."""

import json
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import trip, trips
from test_streaming import DAY, add_file, clock, emitted, payload, stream
from zonepulse import rules, schemas
from zonepulse.catalog import queries
from zonepulse.operators import cleaning, features, grid, hotspots
from zonepulse.plans import scoring
from zonepulse.plans.batch import run_batch
from zonepulse.plans.streaming import stream_trip_windows
from zonepulse.sources import broker, event_trips, lake, serving
from zonepulse.streaming import live, sinks, windows


def message_file(folder, name, *ids_and_times):
    lines = [json.dumps({"topic": rules.TRIP_TOPIC, "value": payload(clock(t), trip_id=i)}) for i, t in ids_and_times]
    path = folder / f"{name}.json"
    path.write_text("\n".join(lines))


def drain(spark, inbox, base):
    stream_trip_windows(stream(spark, inbox, 100), str(base / "out"), str(base / "checkpoint"), once=True, state_partitions=2,
                        distinct=True, rocksdb=True).awaitTermination()


def test_a_message_sent_again_changes_no_window(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    sent = [("A", "00:00:30"), ("B", "00:01:00"), (None, "00:01:10"), (None, "00:01:20")]
    message_file(inbox, "a", *sent)
    drain(spark, inbox, tmp_path)
    message_file(inbox, "b", *sent, ("A", "00:00:40"), ("C", "00:01:30"))      # all again, an id at another time, a new one
    drain(spark, inbox, tmp_path)
    message_file(inbox, "c", ("D", "01:00:00"))
    drain(spark, inbox, tmp_path)
    message_file(inbox, "d", *sent, ("E", "00:01:00"), ("F", "02:00:00"))      # far behind the watermark: dropped, copy or not
    drain(spark, inbox, tmp_path)
    counts = {w: n for _, w, n in emitted(spark, tmp_path) if w < "00:50"}
    assert counts == {"00:00": 5, "00:01": 4}
    assert len(emitted(spark, tmp_path)) == len({w for _, w, _ in emitted(spark, tmp_path)})


def test_state_is_bounded_by_open_windows_and_read_back(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    for i, minute in enumerate((0, 20, 40)):
        message_file(inbox, f"m{i}", *((f"{i}-{s}", f"00:{minute:02d}:{s:02d}") for s in range(0, 60, 2)))
        drain(spark, inbox, tmp_path)           # each run restarts from the changelog checkpoint
    open_ = sinks.read_state(spark, str(tmp_path / "checkpoint"), 0)
    known = sinks.read_state(spark, str(tmp_path / "checkpoint"), 1)
    zones, windows_open = 1, 5 + 2              # five windows of the last minute, two minutes of watermark
    assert 0 < open_.count() <= zones * windows_open and known.count() <= 30
    assert "RocksDB" in (tmp_path / "checkpoint/offsets/0").read_text()
    assert list((tmp_path / "checkpoint/state").rglob("*.changelog"))


def test_timed_trigger_runs_until_stopped(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    add_file(spark, inbox, "a", ["00:00:30"])
    rows = broker.decode_trips(stream(spark, inbox))
    query = sinks.start(rows, sinks.batch_folder_sink(str(tmp_path / "out")), str(tmp_path / "cp"), trigger="500 milliseconds")
    try:
        def seen():
            return sinks.read_batches(spark, str(tmp_path / "out"), rows.schema).count() if (tmp_path / "out").exists() else 0

        for name, times, total in (("b", ["00:01:00"], 2), ("c", ["00:02:00", "00:03:00"], 4)):
            add_file(spark, inbox, name, times)
            end = time.time() + 60
            while seen() < total and time.time() < end:
                time.sleep(0.3)
            assert seen() == total and query.isActive
    finally:
        query.stop()
    assert not query.isActive


def test_windows_lie_by_date(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    message_file(inbox, "a", ("A", "00:00:30"), ("B", "01:00:00"))
    drain(spark, inbox, tmp_path)
    found = sorted({p.parent.name for p in (tmp_path / "out").rglob("*.parquet")})
    assert found == ["event_date=2023-12-31", "event_date=2024-01-01"]


def test_weather_of_the_slot(spark, tmp_path):
    def write(folder, name, rows, schema):
        target = tmp_path / folder
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(target))

    trip_rows, reading = "trip_id string, event_time timestamp", "weather_time timestamp, weather_condition string, temperature double"

    def run():
        rows = spark.readStream.schema(trip_rows).parquet(str(tmp_path / "trips"))
        weather = spark.readStream.schema(reading).parquet(str(tmp_path / "weather"))
        joined = windows.with_weather(rows, weather)
        sinks.drain(joined, sinks.batch_folder_sink(str(tmp_path / "out")), str(tmp_path / "cp"), 2, rocksdb=True)
        out = sinks.read_batches(spark, str(tmp_path / "out"), joined.schema)
        return sorted((r.trip_id, r.weather_condition, r.temperature) for r in out.collect())

    write("trips", "a", [("A", clock("0:01:00")), ("B", clock("0:12:00"))], trip_rows)
    write("weather", "a", [(clock("0:02:00"), "rain", 5.0)], reading)
    assert run() == []
    # Late weather of the first slot, within its delay; nothing for the second slot.
    write("weather", "b", [(clock("0:09:00"), "snow", -1.0), (clock("0:25:00"), "sun", 9.0)], reading)
    write("trips", "b", [("C", clock("0:26:00")), ("D", clock("1:30:00"))], trip_rows)
    run()
    write("weather", "c", [(clock("1:40:00"), "fog", 3.0)], reading)
    write("trips", "c", [("E", clock("1:45:00"))], trip_rows)
    assert run() == [("A", "snow", -1.0), ("B", None, None), ("C", "sun", 9.0)]


def test_weather_messages(spark):
    value = json.dumps({"timestamp": "2024-01-01T00:05:00", "weather_condition": "rain", "temperature": 4.5})
    rows = spark.createDataFrame([(rules.WEATHER_TOPIC, v, DAY) for v in (value, "broken")],
                                 "topic string, value string, timestamp timestamp").withColumn("value", F.col("value").cast("binary"))
    got = {tuple(r) for r in broker.decode_weather(rows).collect()}
    assert got == {(datetime(2024, 1, 1, 0, 5), "rain", 4.5), (None, None, None)}


def day_of_trips(hours, zones=(1, 2, 3)):
    start = datetime(2024, 3, 1, 6)
    return [trip(tpep_pickup_datetime=start + timedelta(hours=h, minutes=7 * k), minutes=10 + 3 * k + h, PULocationID=z,
                 trip_distance=1.0 + 0.5 * k + 0.2 * z) for h in hours for z in zones for k in range((h + z) % 4)]


def live_rows(spark, base, inbox):
    rows = live.live_features(broker.file_stream(spark, str(inbox), schemas.RAW_TRIP))
    sinks.drain(rows, sinks.batch_folder_sink(str(base / "live")), str(base / "cp"), 3, rocksdb=True)
    return sinks.read_batches(spark, str(base / "live"), rows.schema).drop("batch_id")


def comparable(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*sorted(df.columns)).collect())


def test_live_features_equal_batch_after_restarts(spark, tmp_path):
    everything = []
    for hours in (range(0, 5), range(5, 6), range(7, 15), range(20, 26)):
        some = day_of_trips(hours)
        everything += some
        # Copies of a file's last hour come with the file, too.
        trips(spark, *some, *some[-3:]).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        got = live_rows(spark, tmp_path, tmp_path / "in")
    raw = trips(spark, *everything)
    cells = grid.zone_hour_grid(cleaning.clean_trips(raw))
    end = cleaning.valid_trips(raw).agg(F.max("tpep_pickup_datetime")).first()[0] - timedelta(minutes=2)
    expected = (features.feature_matrix(cells, fill="forward", scope="zone", history="running")
                .where(F.col("hour_bucket") + F.expr("INTERVAL 1 HOUR") <= F.lit(end)))
    assert comparable(got) == comparable(expected) and got.count() > 40
    state = sinks.read_state(spark, str(tmp_path / "cp"), 0, "history")
    assert state.count() == 3                   # one row a zone


def test_trip_stream_is_scored(spark, tmp_path):
    class Models:
        def predict(self, rows):
            return rows.select("zone_id", F.col("hour_bucket").alias("timestamp"), (F.col("lag1_speed") + F.col("lag2_speed")).alias(
                "predicted_delay_minutes"), F.col("congestion_level"), (F.col("trip_count") > 2).alias("is_hotspot"))

    trips(spark, *day_of_trips(range(12))).coalesce(1).write.parquet(str(tmp_path / "in"))
    source = broker.file_stream(spark, str(tmp_path / "in"), schemas.RAW_TRIP)
    scoring.score_trip_stream(source, Models(), str(tmp_path / "out"), str(tmp_path / "cp"), once=True, state_partitions=2).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() > 20 and out.where("predicted_delay_minutes > 0").count() > 10


def test_weather_is_published_with_cells(spark, tmp_path):
    raw = str(tmp_path / "raw")
    trips(spark, *day_of_trips(range(6))).write.parquet(raw)
    readings = spark.createDataFrame([(datetime(2024, 3, 1, 7, 50), "rain", 4.0), (datetime(2024, 3, 1, 9, 0), "sun", 8.0)],
                                     "timestamp timestamp, weather_condition string, temperature double")
    folders = [str(tmp_path / n) for n in ("clean", "grid", "serving")]
    for _ in range(2):
        run_batch(spark, [raw], *folders, weather=readings)
        rows = {(r.timestamp.hour, r.weather_condition) for r in serving.read_zone_metrics(spark, folders[2]).collect()}
        assert rows == {(6, None), (7, None), (8, "rain"), (9, "sun"), (10, "sun"), (11, "sun")}


def test_sketches_merge_in_any_order(spark, sf_dir):
    cells = spark.range(40_000).select((F.col("id") % 3).alias("zone_id"), F.pmod(F.xxhash64("id"), F.lit(5000)).alias("trip_count"),
                                       (F.col("id") % 7).alias("part"))
    parts = [hotspots.trip_sketches(cells.where(F.col("part") == i)) for i in range(7)]
    exact = {r[0]: sorted(r[1]) for r in cells.groupBy("zone_id").agg(F.collect_list("trip_count")).collect()}
    for order in (parts, parts[::-1], [hotspots.merged_sketches(*parts[:4]), hotspots.merged_sketches(*parts[4:])]):
        for r in hotspots.sketched_spikes(hotspots.merged_sketches(*order)).collect():
            values = exact[r.zone_id]
            assert abs(sum(v <= r.spike_trips for v in values) / len(values) - 0.95) < 0.01


def test_top_scores_take_ties_by_key(spark):
    rows = [(z, h, float(z == 9), z < 3) for h in range(3) for z in (5, 3, 9, 1)]
    df = spark.createDataFrame(rows, "zone_id int, hour_bucket int, anomaly_score double, truth boolean")
    assert {(r.hour_bucket, r.zone_id, r["rank"]) for r in hotspots.top_scores(df, 2, "anomaly_score").collect()} == {
        (h, z, i) for h in range(3) for i, z in ((1, 9), (2, 1))}
    assert tuple(hotspots.precision_at_k(df, "truth", 2).first()) == (6, 3, 0.5, 0.5)
    assert tuple(hotspots.precision_at_k(df.limit(0), "truth", 2).first()) == (0, 0, 0.0, 0.0)


def test_state_of_catalogued_streams_grows_in_partitions_and_lies_on_disk(spark, sf_dir, monkeypatch, tmp_path):
    monkeypatch.setattr(queries, "scratch_dir", lambda spark, name: str(tmp_path / name))
    monkeypatch.setattr(queries, "STATE_PARTITIONS", 2)
    monkeypatch.setattr(queries, "STATE_BYTES", lake.stored_bytes(spark, f"{sf_dir}/events.parquet") // 5, raising=False)
    assert queries.stream_windows(spark, sf_dir).count() > 0
    state = tmp_path / "windows-checkpoint" / "state" / "0"
    parts = [p for p in state.iterdir() if p.name.isdigit()]
    assert len(parts) == 6 and all(list(p.glob("*.zip")) and not list(p.glob("*.changelog")) for p in parts)


def test_messages_sent_again_are_the_ones_sent_before(spark, sf_dir, monkeypatch, tmp_path):
    monkeypatch.setattr(queries, "scratch_dir", lambda spark, name: str(tmp_path / name))
    written = []
    rows = event_trips.broker_rows(spark, sf_dir)
    monkeypatch.setattr(queries, "drain", lambda spark, sf_dir, df, out, checkpoint: written.append(
        sorted(map(tuple, spark.read.parquet(str(tmp_path / "resent-inbox")).collect()))), raising=False)
    monkeypatch.setattr(queries.sinks, "read_batches", lambda spark, out, schema: spark.createDataFrame([], schema))
    queries.stream_resent(spark, sf_dir)
    first = list(map(tuple, rows.where("dayofmonth(timestamp) <= 15").collect()))
    assert written == [sorted(first), sorted(first + list(map(tuple, rows.collect())))]
