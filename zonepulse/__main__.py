"""``python -m zonepulse batch|stream|train|score|live``; also usable with spark-submit."""

import argparse
import logging

from zonepulse import schemas
from zonepulse.models.scoring import Models
from zonepulse.plans import batch, scoring, streaming, training
from zonepulse.session import build_session
from zonepulse.sources import broker, lake, serving


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="zonepulse")
    jobs = top.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("batch", help="raw trips to lake and serving table")
    job.add_argument("--raw", nargs="+", default=["data/raw/taxi_rides"])
    job.add_argument("--clean", default="data/lake/trajectory_cleaned")
    job.add_argument("--grid", default="data/lake/zone_aggregates")
    job.add_argument("--serving", default="data/serving/zone_metrics")
    job.add_argument("--jdbc-table")

    job = jobs.add_parser("stream", help="broker messages to window table")
    job.add_argument("--servers", default="localhost:9092")
    job.add_argument("--out", default="data/serving/stream_zone_windows")
    job.add_argument("--checkpoint", required=True)
    job.add_argument("--state-partitions", type=int)
    job.add_argument("--topic", choices=("trips", "sensors"), default="trips")
    job.add_argument("--jdbc-table", help="write windows there instead of to --out")
    job.add_argument("--distinct", action="store_true", help="trip messages sent again count once")
    job.add_argument("--rocksdb", action="store_true", help="for large state")
    job.add_argument("--max-offsets", type=int, help="per trigger; default: no cap")
    job.add_argument("--skip-lost", action="store_true", help="go on where offsets have expired")

    job = jobs.add_parser("train", help="fit and save the models")
    job.add_argument("--grid", default="data/lake/zone_aggregates")
    job.add_argument("--models", default="models")
    job.add_argument("--performance", default="data/serving/model_performance")
    job.add_argument("--horizon", type=int, default=0)
    job.add_argument("--balanced", action="store_true")

    job = jobs.add_parser("live", help="score raw trips as they arrive in a folder")
    job.add_argument("--trips", required=True)
    job.add_argument("--models", default="models")
    job.add_argument("--out", default="data/serving/live_predictions")
    job.add_argument("--checkpoint", required=True)
    job.add_argument("--state-partitions", type=int)
    job.add_argument("--once", action="store_true", help="stop when all that is there has been scored")

    job = jobs.add_parser("score", help="fill predictions in the serving table")
    job.add_argument("--grid", default="data/lake/zone_aggregates")
    job.add_argument("--models", default="models")
    job.add_argument("--serving", default="data/serving/zone_metrics")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    spark = build_session(f"zonepulse-{args.job}")
    if args.job == "batch":
        batch.run_batch(spark, args.raw, args.clean, args.grid, args.serving, args.jdbc_table)
    elif args.job == "stream":
        rows = broker.kafka_stream(spark, args.servers, max_offsets=args.max_offsets,
                                   fail_on_data_loss=not args.skip_lost)
        options = {"state_partitions": args.state_partitions, "jdbc_table": args.jdbc_table}
        if args.topic == "trips":
            query = streaming.stream_trip_windows(rows, args.out, args.checkpoint, distinct=args.distinct, rocksdb=args.rocksdb, **options)
        else:
            query = streaming.stream_sensor_windows(rows, args.out, args.checkpoint, **options)
        query.awaitTermination()
    elif args.job == "train":
        result = training.train(lake.read_grid(spark, args.grid), args.models,
                                horizon=args.horizon, balanced=args.balanced)
        serving.append_model_performance(result.performance, args.performance)
    elif args.job == "live":
        stream = broker.file_stream(spark, args.trips, schemas.RAW_TRIP)
        scoring.score_trip_stream(stream, Models.load(spark, args.models), args.out, args.checkpoint, args.once,
                                  args.state_partitions).awaitTermination()
    else:
        scoring.score_serving(spark, lake.read_grid(spark, args.grid), args.models, args.serving)


if __name__ == "__main__":
    main()
