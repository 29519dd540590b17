"""Command line of the jobs: `spark-submit --py-files plumbline.zip -m plumbline.cli <command> ...` or `python -m plumbline.cli`."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators import catalog as ca
from plumbline.operators import refresh
from plumbline.plans import jobs
from plumbline.schemas import TOP_K, TRIGGER
from plumbline.session import build_session
from plumbline.sources import snapshots as sn
from plumbline.sources.events import read_messages
from plumbline.streaming import batches, split
from plumbline.streaming.watch import wait_for_all


def _pairs(values: Sequence[str]) -> dict[str, str]:
    return dict(value.split("=", 1) for value in values)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="plumbline")
    commands = parser.add_subparsers(dest="command", required=True)

    stream = commands.add_parser("stream", help="split a message stream into clean and anomalous events")
    stream.add_argument("--format", default="kafka")
    stream.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
    stream.add_argument("--source", help="path of a file source")
    tables = stream.add_mutually_exclusive_group(required=True)
    tables.add_argument("--events", help="table to write, with both sides")
    tables.add_argument("--clean-and-anomalies", nargs=2, metavar=("CLEAN", "ANOMALIES"), help="two tables to write, each batch once")
    stream.add_argument("--checkpoint", required=True)
    stream.add_argument("--trigger", default=TRIGGER, help="interval, or 'once' for all that is available")
    stream.add_argument("--sink", default="parquet")

    compact = commands.add_parser("compact", help="gather the small files of a table that a stream writes batch by batch")
    compact.add_argument("--table", required=True)
    compact.add_argument("--drop", action="store_true", help="delete what compacted files stand for; no reader may use it any more")

    profile = commands.add_parser("profile", help="refresh the stored profile of a partitioned table, and print it")
    profile.add_argument("--table", required=True, metavar="NAME=PATH")
    profile.add_argument("--profile", required=True)
    profile.add_argument("--by", default="date_part", help="partition column")
    profile.add_argument("--key", default="event_id", help="column that sample rows are ordered by")

    analyze = commands.add_parser("analyze", help="report the anomalies of a day")
    analyze.add_argument("--events", required=True)
    analyze.add_argument("--date", required=True)
    analyze.add_argument("--reports", required=True)
    analyze.add_argument("--format", default="parquet", help="format of the event table")

    schema = commands.add_parser("schema", help="check the newest schema change; fails if it is breaking")
    schema.add_argument("--snapshots", required=True)
    schema.add_argument("--name", required=True)
    schema.add_argument("--key", action="append", default=[])

    quality = commands.add_parser("quality", help="check a day and open an incident if it is stale")
    quality.add_argument("--events", required=True)
    quality.add_argument("--date", required=True)
    quality.add_argument("--incidents")
    quality.add_argument("--format", default="parquet", help="format of the event table")

    versions = commands.add_parser("catalog", help="profile tables into the next catalog version")
    versions.add_argument("--table", action="append", required=True, metavar="NAME=PATH")
    versions.add_argument("--catalog", required=True)
    versions.add_argument("--version", type=int, required=True)

    tables = commands.add_parser("tables", help="list the catalog, or describe one table")
    tables.add_argument("--catalog", required=True)
    tables.add_argument("--name")

    search = commands.add_parser("search", help="find the tables that answer a question")
    search.add_argument("--catalog", required=True)
    search.add_argument("--question", action="append", required=True)
    search.add_argument("--top-k", type=int, default=TOP_K)
    return parser


def _events(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    return spark.read.format(fmt).load(path)


def run(spark: SparkSession, argv: Sequence[str]) -> DataFrame | None:
    """Run one command; the frame it returns is what the command prints."""
    args = _parser().parse_args(argv)
    if args.command == "stream":
        messages = read_messages(spark, args.format, path=args.source, options=_pairs(args.option))
        trigger = None if args.trigger == "once" else args.trigger
        flagged = split.flagged_stream(messages)
        if args.events:
            query = split.split_once(flagged, args.events, args.checkpoint, trigger=trigger, fmt=args.sink)
        else:
            query = batches.split_by_batch(flagged, *args.clean_and_anomalies, args.checkpoint, trigger=trigger, fmt=args.sink)
        wait_for_all([query])
        return None
    if args.command == "compact":
        replaced = batches.compact(spark, args.table)
        dropped = batches.drop_covered(spark, args.table) if args.drop else 0
        return spark.createDataFrame([(args.table, replaced, dropped)], "table_path string, replaced_folders int, dropped_folders int")
    if args.command == "profile":
        (name, path), = _pairs([args.table]).items()
        refresh.refresh(spark.read.parquet(path), args.profile, by=args.by, key=args.key)
        return refresh.profile(spark, args.profile, name)
    if args.command == "analyze":
        return jobs.analyze_anomalies(_events(spark, args.events, args.format), args.date, args.reports)
    if args.command == "schema":
        return jobs.check_schema(sn.schema_versions(spark, args.snapshots, args.name), args.key)
    if args.command == "quality":
        return jobs.check_quality(_events(spark, args.events, args.format), args.date, "transactions", incidents_path=args.incidents).actions
    if args.command == "catalog":
        paths = _pairs(args.table)
        frames = {name: spark.read.parquet(path) for name, path in paths.items()}
        return ca.list_tables(jobs.refresh_catalog(frames, paths, args.catalog, args.version))
    if args.command == "tables":
        catalog = sn.read_as_of(spark, args.catalog)
        return ca.describe(catalog, args.name) if args.name else ca.list_tables(catalog)
    questions = spark.createDataFrame(list(enumerate(args.question, 1)), "question_id int, text string")
    return jobs.ask_catalog(spark, args.catalog, questions, k=args.top_k).drop("document").orderBy("question_id", F.col("rank"))


def main() -> None:
    result = run(build_session(), sys.argv[1:])
    if result is not None:
        for row in result.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).toLocalIterator():  # every row, as JSON lines
            print(row[0])


if __name__ == "__main__":
    main()
