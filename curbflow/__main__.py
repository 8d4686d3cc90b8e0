"""Command line jobs, for ``spark-submit`` or ``python -m curbflow``."""

from __future__ import annotations

import argparse
import json
from datetime import date

from pyspark.sql import SparkSession

from curbflow.operators import list_zones, load_model, lookup_zones, zone_counts
from curbflow.plans import predict, run_etl, run_scoring, train_demand_model
from curbflow.session import session_now, session_time
from curbflow.sources import expire_predictions, explore, load_demand, load_zones
from curbflow.spec import FEATURES, HOUR_ZONE_FEATURES, REQUEST_COLS, DemandSpec, require_columns
from curbflow.streaming import start_demand_stream


def _etl(spark: SparkSession, args: argparse.Namespace) -> None:
    spec = DemandSpec(args.time_col, args.zone_col, args.distance_col, args.count_col)
    report = run_etl(spark, args.input, args.output, spec, not args.no_audit, args.files, args.first_date, args.last_date)
    if report is not None:
        print(report.asDict())


def _stream(spark: SparkSession, args: argparse.Namespace) -> None:
    spec = DemandSpec(args.time_col, args.zone_col, args.distance_col, args.count_col)
    schema = spark.read.parquet(args.input).schema
    trips = spark.readStream.schema(schema).parquet(args.input)
    trigger = {"availableNow": True} if args.once else {"processingTime": args.every}
    start_demand_stream(
        trips, args.output, args.checkpoint, spec, args.width, args.late_after, trigger, args.files, args.trip_id
    ).awaitTermination()


def _train(spark: SparkSession, args: argparse.Namespace) -> None:
    features = HOUR_ZONE_FEATURES if args.hour_zone_only else FEATURES
    demand = load_demand(spark, args.batch, args.stream, args.first_date, args.last_date)
    result = train_demand_model(demand, features, args.model, args.rounds, args.seed)
    print({**result.stats.asDict(), **result.metrics.asDict()})


def _score(spark: SparkSession, args: argparse.Namespace) -> None:
    requests = spark.read.parquet(args.requests)
    require_columns(requests, REQUEST_COLS)
    zones = load_zones(spark, args.zones, optional=True) if args.zones else None
    now = session_time(spark, args.now) if args.now else session_now(spark)
    run_scoring(spark, requests, load_model(args.model), zones, args.output, now, args.cache)


def _predict(spark: SparkSession, args: argparse.Namespace) -> None:
    zones = load_zones(spark, args.zones, optional=True) if args.zones else None
    now = session_time(spark, args.now) if args.now else session_now(spark)
    model = load_model(args.model)
    print(json.dumps(predict(spark, model, zones, args.zone, args.hour, args.date, now, args.cache).asDict()))


def _expire(spark: SparkSession, args: argparse.Namespace) -> None:
    expire_predictions(spark, args.cache, session_time(spark, args.now) if args.now else session_now(spark))


def _zones(spark: SparkSession, args: argparse.Namespace) -> None:
    zones = load_zones(spark, args.file)
    if args.id:
        ids = spark.createDataFrame([(i,) for i in args.id], "location_id int")
        lookup_zones(ids, zones).show(len(args.id), truncate=False)
    else:
        listed = list_zones(zones, args.borough, args.search)
        print("\t".join(listed.columns))
        for row in (listed if args.rows is None else listed.limit(args.rows)).toLocalIterator():
            print("\t".join(str(v) for v in row))
        print(zone_counts(zones, args.borough, args.search).first().asDict())


def _explore(spark: SparkSession, args: argparse.Namespace) -> None:
    explore(spark, args.input, args.rows)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="curbflow", description=__doc__)
    jobs = top.add_subparsers(required=True)
    spec = DemandSpec()

    def with_columns(job: argparse.ArgumentParser) -> argparse.ArgumentParser:
        job.add_argument("--time-col", default=spec.ts_col)
        job.add_argument("--zone-col", default=spec.zone_col)
        job.add_argument("--distance-col", default=spec.distance_col)
        job.add_argument("--count-col", default=spec.count_col)
        return job

    etl = with_columns(jobs.add_parser("etl", help="raw trips to an hourly demand table"))
    etl.add_argument("--input", nargs="+", required=True)
    etl.add_argument("--output", required=True)
    etl.add_argument("--files", type=int, help="so many files instead of a folder per month")
    etl.add_argument("--first-date", type=date.fromisoformat, help="replace the dates from here")
    etl.add_argument("--last-date", type=date.fromisoformat, help="to here, and leave all others")
    etl.add_argument("--no-audit", action="store_true")
    etl.set_defaults(job=_etl)

    stream = with_columns(jobs.add_parser("stream", help="a folder of arriving trips to per-minute demand"))
    stream.add_argument("--input", required=True)
    stream.add_argument("--output", required=True)
    stream.add_argument("--checkpoint", required=True)
    stream.add_argument("--width", default="1 minute")
    stream.add_argument("--late-after", default="10 minutes")
    stream.add_argument("--every", default="1 minute")
    stream.add_argument("--files", type=int, help="tasks that write a trigger; by default by the size of the cluster")
    stream.add_argument("--trip-id", help="column by which a trip sent twice counts once")
    stream.add_argument("--once", action="store_true", help="stop when all present input is read")
    stream.set_defaults(job=_stream)

    train = jobs.add_parser("train", help="demand tables to a saved model")
    train.add_argument("--batch")
    train.add_argument("--stream")
    train.add_argument("--first-date", type=date.fromisoformat)
    train.add_argument("--last-date", type=date.fromisoformat)
    train.add_argument("--model", required=True)
    train.add_argument("--rounds", type=int, default=100)
    train.add_argument("--seed", type=int, default=42)
    train.add_argument("--hour-zone-only", action="store_true")
    train.set_defaults(job=_train)

    score = jobs.add_parser("score", help="a table of requests to a table of responses")
    score.add_argument("--requests", required=True)
    score.add_argument("--model", required=True)
    score.add_argument("--output", required=True)
    score.add_argument("--zones")
    score.add_argument("--cache")
    score.add_argument("--now", help="ISO time; the current time if absent")
    score.set_defaults(job=_score)

    one = jobs.add_parser("predict", help="the response to a single request, as JSON")
    one.add_argument("--zone", type=int, required=True)
    one.add_argument("--hour", type=int, required=True)
    one.add_argument("--date", required=True)
    one.add_argument("--model", required=True)
    one.add_argument("--zones")
    one.add_argument("--cache")
    one.add_argument("--now", help="ISO time; the current time if absent")
    one.set_defaults(job=_predict)

    expire = jobs.add_parser("expire", help="drop stored predictions past their lifetime, compact the others")
    expire.add_argument("--cache", required=True)
    expire.add_argument("--now", help="ISO time; the current time if absent")
    expire.set_defaults(job=_expire)

    zones = jobs.add_parser("zones", help="list, search or look up zones")
    zones.add_argument("--file", required=True)
    zones.add_argument("--borough")
    zones.add_argument("--search")
    zones.add_argument("--id", type=int, nargs="+")
    zones.add_argument("--rows", type=int, help="list so many only; all if absent")
    zones.set_defaults(job=_zones)

    look = jobs.add_parser("explore", help="schema and first rows of a Parquet table")
    look.add_argument("--input", required=True)
    look.add_argument("--rows", type=int, default=5)
    look.set_defaults(job=_explore)
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    args.job(spark or SparkSession.builder.appName("curbflow").getOrCreate(), args)


if __name__ == "__main__":
    main()
