"""Headline timings: prints one JSON line.

Reads ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]``. Every entry
is run three times and the median counts. Inputs that a real
deployment has on disk (raw trips, the lake, the serving table) are written before timing.
``$BENCH_TIMES`` repeats the events that many times, 30 days apart, to see how work grows.
"""

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from zonepulse.models.forest import fit_hotspot_forest  # noqa: E402
from zonepulse.operators import cleaning, features, grid, hotspots, reports  # noqa: E402
from zonepulse.operators.split import train_test  # noqa: E402
from zonepulse.plans.batch import run_batch  # noqa: E402
from zonepulse.session import build_session, scratch_dir  # noqa: E402
from zonepulse.sources import broker, event_trips, lake, serving  # noqa: E402
from zonepulse.streaming import sinks, windows  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
TIMES = int(os.environ.get("BENCH_TIMES", "1"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def noop(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    spark = build_session("bench", f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": str(max(int(CPUS), TIMES)),
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
    })
    spark.sparkContext.setLogLevel("ERROR")

    raw_path, events_path = scratch_dir(spark, "raw"), scratch_dir(spark, "events")
    shifted = F.make_dt_interval(days=F.lit(30) * F.col("copy").cast("int"))
    raw = event_trips.raw_trips(spark, SF_DIR)
    if TIMES > 1:
        raw = raw.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(TIMES - 1))))
        raw = raw.withColumns({c: F.col(c) + shifted for c in
                               ("tpep_pickup_datetime", "tpep_dropoff_datetime")}).drop("copy")
    raw.repartition(int(CPUS)).write.parquet(raw_path)
    event_trips.read_table(spark, SF_DIR, "events").write.parquet(events_path)
    trips = lake.read_trips(spark, raw_path)
    raw_rows = trips.count()

    base = [scratch_dir(spark, n) for n in ("clean", "grid", "serving")]
    run_batch(spark, [raw_path], *base)
    cells = lake.read_grid(spark, base[1])
    matrix_path = scratch_dir(spark, "matrix")
    features.feature_matrix(cells).write.parquet(matrix_path)
    matrix = spark.read.parquet(matrix_path)
    full_path = scratch_dir(spark, "metrics")
    serving.write_zone_metrics(hotspots.rule_hotspots(features.add_delay_target(cells))
                               .withColumnRenamed("delay_minutes", "predicted_delay_minutes"), full_path)
    metrics = serving.read_zone_metrics(spark, full_path)
    events = spark.read.parquet(events_path)

    def stream():
        counted = windows.trip_windows(event_trips.stream_trips(
            broker.file_stream(spark, events_path, events.schema)))
        sinks.drain(counted, sinks.batch_folder_sink(scratch_dir(spark, "windows")),
                    scratch_dir(spark, "cp"), int(CPUS))

    def second():
        """A delivery of two days, with copies of stored trips, on top of all others."""
        run_batch(spark, [few_path], *base)

    few_path = scratch_dir(spark, "few")
    trips.where("day(tpep_pickup_datetime) IN (28, 29)").coalesce(1).write.parquet(few_path)

    work = {
        "batch_second_delivery": second,
        "batch_run": lambda: run_batch(
            spark, [raw_path], *(scratch_dir(spark, n) for n in ("clean", "grid", "serving"))),
        "clean_trips": lambda: noop(cleaning.clean_trips(trips)),
        "retention_report": lambda: noop(cleaning.retention_report(trips)),
        "zone_hour_grid": lambda: noop(grid.zone_hour_grid(cleaning.clean_trips(trips))),
        "feature_matrix": lambda: noop(features.feature_matrix(cells)),
        "stratified_split": lambda: noop(train_test(matrix, stratify="congestion_level")),
        "isolation_forest": lambda: noop(fit_hotspot_forest(matrix).transform(matrix)),
        "stream_windows": stream,
        "recent_metrics": lambda: reports.recent_metrics(metrics).collect(),
        "kpis": lambda: reports.kpis(reports.recent_window(metrics)).collect(),
        "zone_summary": lambda: reports.zone_summary(reports.recent_window(metrics)).collect(),
        "delay_histogram": lambda: reports.histogram(reports.recent_window(metrics)).collect(),
        "congestion_by_hour": lambda: reports.congestion_by_hour(
            reports.recent_window(metrics)).collect(),
        "hotspot_alerts": lambda: reports.hotspot_alerts(reports.recent_window(metrics)).collect(),
        "zone_hourly": lambda: reports.zone_hourly(metrics).collect(),
    }
    only = sys.argv[1:]
    seconds = {}
    for name, job in work.items():
        if only and name not in only:
            continue
        runs = []
        for _ in range(RUNS):
            began = time.perf_counter()
            job()
            runs.append(time.perf_counter() - began)
        seconds[name] = round(statistics.median(runs), 3)

    batch = seconds.get("batch_run")
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": SF_DIR.rsplit("sf", 1)[-1], "cpus": int(CPUS), "times": TIMES,
        "runs": RUNS, "raw_rows": raw_rows,
        "batch_rows_per_sec": round(raw_rows / batch) if batch else None}))


if __name__ == "__main__":
    main()
