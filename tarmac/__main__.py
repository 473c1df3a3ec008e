"""Command line: ``python -m tarmac <job> [options]`` (or the same through ``spark-submit``)."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tarmac.functions import times
from tarmac.plans import jobs
from tarmac.plans.schedules import run_schedules, select_landed
from tarmac.schemas import SCHEDULE
from tarmac.session import build_session, clear_stages
from tarmac.sources import landing
from tarmac.sources.dimension import read_dimension
from tarmac.sources.tables import copy_rows, export_json, read_table, replace_table


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tarmac")
    commands = parser.add_subparsers(dest="job", required=True)

    def command(name: str, *options: str, optional: tuple[str, ...] = (), limits: tuple[str, ...] = ()) -> None:
        sub = commands.add_parser(name)
        for option in options:
            sub.add_argument(f"--{option}", required=True)
        for option in optional:
            sub.add_argument(f"--{option}")
        for limit in limits:
            sub.add_argument(f"--{limit}", type=int)

    command("collect-history", "landing", "table", "day", limits=("per-request", "open-below", "total"))
    command("collect-weather", "landing", "table", optional=("role",))
    command("backfill", "landing", "table", limits=("per-request", "per-day"))
    command("train", "flights", "weather", "dimension", "model")
    command("predict", "landing", "day", "weather", "dimension", "model", limits=("per-request", "total"))
    command("check", "flights", "weather")
    command("schedules", "landing", "folder", limits=("limit",))
    command("export", "table", "output")
    command("copy", "table", "output")
    command("replace", "table", "output")
    return parser.parse_args()


def main() -> None:
    args = _arguments()
    spark = build_session(f"tarmac-{args.job}")
    try:
        run(spark, args)
    finally:
        clear_stages(spark)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.job == "collect-history":
        limits = {"per_request": args.per_request, "open_below": args.open_below, "total": args.total}
        jobs.collect_history(spark, args.landing, args.table, args.day, **limits).show()
    elif args.job == "collect-weather":
        jobs.collect_weather(spark, args.landing, args.table, args.role).show()
    elif args.job == "backfill":
        jobs.backfill(spark, args.landing, args.table, per_request=args.per_request, per_day=args.per_day).show()
    elif args.job == "train":
        inputs = jobs.load_inputs(spark, args.flights, args.weather, args.dimension)
        jobs.train(spark, *inputs, args.model).show()
    elif args.job == "predict":
        flights = jobs.live_flights(spark, args.landing, args.day, per_request=args.per_request, total=args.total)
        weather, dimension = landing.read_weather(spark, args.weather), read_dimension(spark, args.dimension)
        weather = weather.withColumn("collected_instant", times.instant_column(weather, "collected_at"))
        order = ["airport_rank", "status_rank", "source_file", "pos"]
        jobs.predict(spark, flights, weather, dimension, args.model, ["collected_instant"], order).show()
    elif args.job == "schedules":
        rows = landing.read_envelope(spark, args.landing, SCHEDULE, "response")
        run_schedules(select_landed(rows, "pos", args.limit), args.folder)
    elif args.job == "export":
        export_json(read_table(spark, args.table), args.output)
    elif args.job == "copy":
        copy_rows(read_table(spark, args.table), args.output)
    elif args.job == "replace":
        replace_table(read_table(spark, args.table), args.output)
    else:
        flights, weather = read_table(spark, args.flights), read_table(spark, args.weather)
        jobs.check_tables({"flights": flights, "weather": weather}).show()
        jobs.newest_rows(
            {
                "flights": (flights, {"flight.iata": "label", "flight_status": "detail"}),
                "weather": (weather, {"name": "label", "main.temp": "detail"}),
            }
        ).show()


if __name__ == "__main__":
    main()
