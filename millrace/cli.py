"""Command line of the jobs: `spark-submit run_job.py <job> ...` or `python -m millrace <job> ...`."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from millrace.operators.layout import with_parallelism
from millrace.operators.rules import read_rules
from millrace.plans import access_log, bids_by_city, city_profile, flights, motels, sensors, weather, words
from millrace.schemas import AD_LOGS
from millrace.session import build_session
from millrace.sources.messages import deliver, subscribe
from millrace.sources.sinks import write_lines
from millrace.sources.staged import read_staged
from millrace.sources.tables import read_lines, read_lookup, read_quoted, rejected_lookup
from millrace.streaming.ingest import ingest_lines, tail_lines
from millrace.streaming.scoring import score_message_stream


#: Rows that a job without --output prints.
SHOWN = 100


def emit(rows: DataFrame, output: str | None, sep: str = "\t") -> None:
    """Write the result as lines, or print its start and say how many rows are not shown."""
    if output:
        write_lines(rows, output, sep)
        return
    rows.show(SHOWN, truncate=False)
    if (more := rows.count() - SHOWN) > 0:
        print(f"{more} further rows; --output writes all of them")


def most_used_word(spark: SparkSession, args) -> None:
    emit(words.most_used_word(read_lines(spark, args.paths)).select("occurrences", "word"), args.output)


def longest_words(spark: SparkSession, args) -> None:
    emit(words.longest_words(read_lines(spark, args.paths), args.top).select("word"), args.output)


def log_stats(spark: SparkSession, args) -> None:
    found = access_log.reports(read_lines(spark, args.paths))
    if args.output:
        access_log.write_traffic(found["traffic"], f"{args.output}/traffic", args.output_format, args.compress == "true")
    else:
        emit(found["traffic"], None)
    emit(found["browsers"], args.output and f"{args.output}/browsers")
    emit(found["bad_lines"], args.output and f"{args.output}/bad_lines")


def city_bids(spark: SparkSession, args) -> None:
    cities = read_lookup(spark, args.city_names_file, "city_id") if args.city_names_file else None
    found = bids_by_city.reports(read_lines(spark, args.paths), cities)
    emit(with_parallelism(found["by_city"], args.reducers_num), args.output and f"{args.output}/by_city")
    if args.by_os:
        routed = bids_by_city.routed_by_os(found["by_os"], args.reducers_num)
        emit(routed, args.output and f"{args.output}/by_os")
    emit(found["bad_lines"], args.output and f"{args.output}/bad_lines")
    if cities is not None:
        emit(found["unknown_cities"], args.output and f"{args.output}/unknown_cities")
        emit(rejected_lookup(spark, args.city_names_file), args.output and f"{args.output}/rejected_city_names")


def load_flights(spark: SparkSession, args) -> None:
    paths = {"carriers": args.carriers, "airports": args.airports, "y2007": args.flights}
    flights.load_tables(spark, paths, args.warehouse)


def ask_flights(spark: SparkSession, args) -> None:
    y2007 = spark.read.parquet(f"{args.warehouse}/y2007")
    airports = spark.read.parquet(f"{args.warehouse}/airports")
    questions = {
        "per_carrier": lambda: flights.flights_per_carrier(y2007),
        "city_departures": lambda: flights.city_departures(y2007, airports, args.city, args.month),
        "busiest_airports": lambda: flights.busiest_airports(y2007),
        "top_carrier": lambda: flights.top_carrier(y2007),
        "cancelled": lambda: flights.cancelled_by_carrier(y2007, airports),
    }
    emit(questions[args.question](), args.output)


def sql(spark: SparkSession, args) -> None:
    """Any SQL text over the Parquet tables of a warehouse folder."""
    for name in args.tables:
        spark.read.parquet(f"{args.warehouse}/{name}").createOrReplaceTempView(name)
    with open(args.file, encoding="utf-8") as text:
        emit(spark.sql(text.read().strip().rstrip(";")), args.output)


def profile(spark: SparkSession, args) -> None:
    emit(city_profile.city_profile(read_quoted(spark, args.logs, AD_LOGS, sep="\t")), args.output)


def agent_families(spark: SparkSession, args) -> None:
    emit(city_profile.requests_by_family(read_lines(spark, args.paths), read_rules(spark, args.rules)), args.output)


def motel_prices(spark: SparkSession, args) -> None:
    motels.run(
        spark, args.bids_path, args.exchange_rate_path, args.motels_path, args.result_path, args.ties, args.as_lines,
        args.files,
    )


def _database(args) -> dict:
    properties = {"user": args.user, "password": args.password}
    return {**properties, "driver": args.driver} if args.driver else properties


def export_weather(spark: SparkSession, args) -> None:
    if args.prepare:
        weather.prepare_tables(spark, args.url, _database(args))
    print(weather.export_weather(spark, args.path, args.url, _database(args)), "rows exported")


def stage_weather(spark: SparkSession, args) -> None:
    print(weather.stage_weather(spark, args.path, args.target), "rows exported")
    emit(weather.first_days(read_staged(spark, args.target)), None)


def check_weather(spark: SparkSession, args) -> None:
    for result in weather.check_export(spark, args.url, _database(args)):
        emit(result, None)


def _kafka(args) -> dict:
    return {"kafka.bootstrap.servers": args.brokers}


def publish_readings(spark: SparkSession, args) -> None:
    sensors.publish_readings(sensors.read_readings(spark, args.path), args.topic, **_kafka(args))


def score_readings(spark: SparkSession, args) -> None:
    stream = subscribe(spark, args.topic, startingOffsets=args.starting_offsets, **_kafka(args))
    scored = score_message_stream(stream, args.alpha)
    deliver(scored, args.target_topic, args.checkpoint, **_kafka(args))
    deliver(sensors.rejected_messages(stream), args.reject_topic, f"{args.checkpoint}-rejects", **_kafka(args))
    # If one of the two ends, the job ends, and goes on from both checkpoints when started again.
    spark.streams.awaitAnyTermination()


def ingest(spark: SparkSession, args) -> None:
    if args.tail:
        tail_lines(spark, args.folder, args.target, args.checkpoint, args.pattern, args.from_end).awaitTermination()
    else:
        ingest_lines(spark, args.folder, args.target, args.checkpoint).awaitTermination()


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="millrace")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name, run, output=True):
        command = jobs.add_parser(name)
        command.set_defaults(run=run)
        if output:
            command.add_argument("--output")
        return command

    command = job("most-used-word", most_used_word)
    command.add_argument("paths", nargs="+")

    command = job("longest-words", longest_words)
    command.add_argument("paths", nargs="+")
    command.add_argument("--top", type=int, required=True)

    command = job("log-stats", log_stats)
    command.add_argument("paths", nargs="+")
    command.add_argument("--compress", choices=["true", "false"], default="true")
    command.add_argument("--output_format", choices=["sequence", "csv"], default="csv")

    command = job("city-bids", city_bids)
    command.add_argument("paths", nargs="+")
    command.add_argument("--city_names_file")
    command.add_argument("--reducers_num", type=int)
    command.add_argument("--by_os", action="store_true")

    command = job("load-flights", load_flights, output=False)
    for name in ("carriers", "airports", "flights", "warehouse"):
        command.add_argument(f"--{name}", required=True)

    command = job("flights", ask_flights)
    command.add_argument(
        "question", choices=["per_carrier", "city_departures", "busiest_airports", "top_carrier", "cancelled"]
    )
    command.add_argument("--warehouse", required=True)
    command.add_argument("--city", default="New York")
    command.add_argument("--month", type=int, default=6)

    command = job("sql", sql)
    command.add_argument("file")
    command.add_argument("--warehouse", required=True)
    command.add_argument("--tables", nargs="+", required=True)

    command = job("city-profile", profile)
    command.add_argument("logs")

    command = job("agent-families", agent_families)
    command.add_argument("paths", nargs="+")
    command.add_argument("--rules", required=True, help="lines of position, family and parts, parted by tabs")

    command = job("motels", motel_prices, output=False)
    for name in ("bids_path", "exchange_rate_path", "motels_path", "result_path"):
        command.add_argument(f"--{name}", required=True)
    command.add_argument("--ties", choices=["all", "first"], default="all")
    command.add_argument("--as_lines", action="store_true")
    command.add_argument("--files", type=int, help="files per result; without it as many as Spark has partitions")

    command = job("stage-weather", stage_weather, output=False)
    command.add_argument("path")
    command.add_argument("target", help="folder of the exported table")

    command = job("export-weather", export_weather, output=False)
    command.add_argument("path")
    command.add_argument("--prepare", action="store_true", help="drop and create both tables first")
    for command in (command, job("check-weather", check_weather, output=False)):
        command.add_argument("--url", required=True)
        command.add_argument("--user", default="")
        command.add_argument("--password", default="")
        command.add_argument("--driver")

    command = job("publish-readings", publish_readings, output=False)
    command.add_argument("path")
    command.add_argument("--brokers", required=True)
    command.add_argument("--topic", default="monitoring20")

    command = job("score-readings", score_readings, output=False)
    command.add_argument("--brokers", required=True)
    command.add_argument("--topic", default="monitoring20")
    command.add_argument("--target_topic", default="monitoringEnriched2")
    command.add_argument("--reject_topic", default="monitoringRejects2", help="gets the messages that cannot be scored")
    command.add_argument("--starting_offsets", default="latest")
    command.add_argument("--checkpoint", required=True)
    command.add_argument("--alpha", type=float, default=1.0)

    command = job("ingest-lines", ingest, output=False)
    for name in ("folder", "target", "checkpoint"):
        command.add_argument(f"--{name}", required=True)
    command.add_argument("--tail", action="store_true", help="follow growing files instead of reading each new file once")
    command.add_argument("--pattern", default="*", help="names of the files to follow")
    command.add_argument("--from_end", action="store_true", help="follow only what is appended from now on")
    return top


def main(arguments=None) -> None:
    args = parser().parse_args(arguments)
    spark = build_session(f"millrace {args.job}")
    args.run(spark, args)


if __name__ == "__main__":
    main()
