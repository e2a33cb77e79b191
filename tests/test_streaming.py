import json
import os
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from zonepulse import rules, schemas
from zonepulse.plans.streaming import stream_sensor_windows, stream_trip_windows
from zonepulse.sources import broker
from zonepulse.streaming import sinks, windows

DAY = datetime(2024, 1, 1)
MESSAGE = "topic string, value string, timestamp timestamp"
WINDOW_SCHEMA = ("zone_id int, window_start timestamp, window_end timestamp, trip_count_5min long, "
                 "avg_distance_5min double, total_passengers_5min long")


def payload(at, zone=7, **extra):
    clock = at if isinstance(at, str) else at.isoformat()
    return json.dumps({"trip_id": "T1", "pickup_zone": zone, "dropoff_zone": 2, "pickup_datetime": clock,
                       "passenger_count": 2, "trip_distance": 3.0, "fare_amount": 9.5,
                       "payment_type": "cash", **extra})


def messages(spark, *values, topic=rules.TRIP_TOPIC):
    rows = [(topic, v, DAY) for v in values]
    return spark.createDataFrame(rows, MESSAGE).withColumn("value", F.col("value").cast("binary"))


def clock(text):
    h, m, s = map(int, text.split(":"))
    return DAY + timedelta(hours=h, minutes=m, seconds=s)


def test_routing_and_decoding(spark):
    good = messages(spark, payload(clock("8:00:00")))
    other = messages(spark, payload(clock("9:00:00")), topic=rules.SENSOR_TOPIC)
    row, = broker.decode_trips(good.union(other)).collect()
    assert (row.pickup_zone, row.trip_distance, row.event_time) == (7, 3.0, clock("8:00:00"))
    assert row.kafka_timestamp == DAY and "payment_type" not in row.asDict()
    kept = broker.decode_trips(good, schemas.TRIP_MESSAGE_WITH_PAYMENT).first()
    assert kept.payment_type == "cash"


def test_bad_payloads_become_nulls_and_rejects(spark):
    rows = messages(spark, "{not json", payload("yesterday"), payload(clock("8:00:00")))
    decoded = broker.decode_trips(rows)
    assert decoded.filter("event_time IS NULL").count() == 2
    assert sorted(r.raw[:4] for r in broker.undecodable_trips(rows).collect()) == ['{"tr', "{not"]


def test_kafka_options_lose_nothing_unless_told():
    options = broker.kafka_options("host:1")
    assert options["subscribe"] == f"{rules.TRIP_TOPIC},{rules.SENSOR_TOPIC}"
    assert (options["startingOffsets"], options["failOnDataLoss"]) == ("latest", "true")
    assert "maxOffsetsPerTrigger" not in options
    capped = broker.kafka_options("host:1", max_offsets=rules.MAX_OFFSETS, fail_on_data_loss=False)
    assert (capped["failOnDataLoss"], capped["maxOffsetsPerTrigger"]) == ("false", "10000")


def test_batch_windows_slide_by_a_minute(spark):
    trips = broker.decode_trips(messages(spark, payload(clock("0:07:30"))))
    out = windows.trip_windows(trips).orderBy("window_start").collect()
    assert [r.window_start for r in out] == [clock(f"0:0{m}:00") for m in (3, 4, 5, 6, 7)]
    assert all(r.window_end - r.window_start == timedelta(minutes=5) for r in out)
    assert {(r.trip_count_5min, r.avg_distance_5min, r.total_passengers_5min) for r in out} == {(1, 3.0, 2)}


def add_file(spark, folder, name, times):
    """One file, with a modification time after the earlier ones."""
    text = [json.dumps({"topic": rules.TRIP_TOPIC, "value": payload(clock(t))}) for t in times]
    path = folder / f"{name}.json"
    path.write_text("\n".join(text))
    stamp = time.time() - 1000 + 10 * len(list(folder.iterdir()))
    os.utime(path, (stamp, stamp))


def stream(spark, folder, per_trigger=1):
    schema = "topic string, value string, timestamp timestamp"
    raw = (spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).json(str(folder)))
    return raw.withColumn("value", F.col("value").cast("binary"))


def run(spark, folder, base, **kwargs):
    query = stream_trip_windows(stream(spark, folder), str(base / "out"), str(base / "checkpoint"),
                                once=True, state_partitions=2, **kwargs)
    query.awaitTermination()
    return query


def emitted(spark, base):
    out = sinks.read_batches(spark, str(base / "out"), spark.createDataFrame([], WINDOW_SCHEMA).schema)
    return sorted(((r.batch_id, f"{r.window_start:%H:%M}", r.trip_count_5min) for r in out.collect()))


def test_late_rows_follow_the_previous_watermark(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    add_file(spark, inbox, "a", ["00:00:30", "00:20:00"])
    add_file(spark, inbox, "b", ["00:40:00"])
    add_file(spark, inbox, "c", ["00:00:40", "00:17:30", "01:00:00"])
    query = run(spark, inbox, tmp_path)
    assert emitted(spark, tmp_path) == (
        [(1, "00:00", 1)] + [(1, f"23:{m}", 1) for m in (56, 57, 58, 59)]
        + [(2, f"00:{m}", n) for m, n in zip(range(14, 21), (1, 1, 2, 2, 1, 1, 1))]
        + [(3, f"00:{m}", 1) for m in range(36, 41)])
    dropped = sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
    assert dropped > 0


def test_restart_emits_nothing_twice(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    add_file(spark, inbox, "a", ["00:00:30", "00:20:00"])
    run(spark, inbox, tmp_path)
    first = emitted(spark, tmp_path)
    run(spark, inbox, tmp_path)
    assert emitted(spark, tmp_path) == first
    add_file(spark, inbox, "b", ["00:19:10", "00:40:00"])
    run(spark, inbox, tmp_path)
    windows_ = [w for _, w, _ in emitted(spark, tmp_path)]
    assert len(windows_) == len(set(windows_)) == 11
    counts = {w: n for _, w, n in emitted(spark, tmp_path)}
    assert (counts["00:15"], counts["00:19"], counts["00:20"]) == (1, 2, 1)


def test_replayed_batch_replaces_itself(spark, tmp_path):
    write = sinks.batch_folder_sink(str(tmp_path / "out"))
    row = spark.createDataFrame([(1, DAY, DAY, 3, 1.0, 2)], WINDOW_SCHEMA)
    with pytest.raises(RuntimeError):
        write(row, 0)
    try:
        spark.sparkContext.setLocalProperty("sql.streaming.queryId", "first")
        for df in (row.union(row), row):
            write(df, 4)
        write(row.filter("1 = 0"), 5)
        assert sinks.read_batches(spark, str(tmp_path / "out"), row.schema).count() == 1
        spark.sparkContext.setLocalProperty("sql.streaming.queryId", "second")
        write(row, 4)
        assert sinks.read_batches(spark, str(tmp_path / "out"), row.schema).count() == 2
    finally:
        spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)


def test_new_checkpoint_on_a_used_path_keeps_what_was_written(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    add_file(spark, inbox, "a", ["00:00:30", "00:20:00"])
    run(spark, inbox, tmp_path)
    first = emitted(spark, tmp_path)
    query = stream_trip_windows(stream(spark, inbox), str(tmp_path / "out"), str(tmp_path / "other"),
                                once=True, state_partitions=2)
    query.awaitTermination()
    assert len(first) == 5 and emitted(spark, tmp_path) == sorted(first + first)


def test_failed_write_fails_the_query(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    add_file(spark, inbox, "a", ["00:00:30"])

    def broken(batch, batch_id):
        raise RuntimeError("sink is down")
    query = sinks.start(broker.decode_trips(stream(spark, inbox)), broken,
                        str(tmp_path / "checkpoint"), once=True)
    with pytest.raises(Exception, match="sink is down"):
        query.awaitTermination()


def test_state_partitions_leave_the_session_alone(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    add_file(spark, inbox, "a", ["00:00:30"])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    run(spark, inbox, tmp_path)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert len(list((tmp_path / "checkpoint/state/0").glob("[0-9]*"))) == 2


def test_sensor_stream(spark, tmp_path):
    inbox = tmp_path / "in"
    readings = [json.dumps({"sensor_id": "SENS_003_1", "zone_id": 3, "timestamp": t, "avg_speed_mph": v,
                            "vehicle_count": n, **occ})
                for t, v, n, occ in (("2024-01-01 00:02:30", 20.0, 40, {"occupancy_pct": 10.0}),
                                     ("2024-01-01 00:02:40", 10.0, 40, {}))]
    messages(spark, *readings, "broken", topic=rules.SENSOR_TOPIC).write.parquet(str(inbox))
    late = json.dumps({"zone_id": 3, "timestamp": "2024-01-01 01:00:00"})
    messages(spark, late, topic=rules.SENSOR_TOPIC).write.mode("append").parquet(str(inbox))
    stream_sensor_windows(broker.file_stream(spark, str(inbox)), str(tmp_path / "out"),
                          str(tmp_path / "checkpoint"), once=True, state_partitions=2).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out")).collect()
    assert len(out) == 5
    assert {(r.reading_count_5min, r.avg_speed_5min, r.avg_vehicles_5min, r.avg_occupancy_5min)
            for r in out} == {(2, 15.0, 40.0, 30.0)}
