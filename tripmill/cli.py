"""The steps of a run as commands, for ``spark-submit`` or ``python -m tripmill``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tripmill.plans import runs
from tripmill.plans.staging import NULL_TIPS, SURVIVORS
from tripmill.scenario import DEFAULT_SIZE, SCENARIOS
from tripmill.schema import TRIP_SCHEMA, check
from tripmill.sinks.clustered import read_window
from tripmill.sinks.tables import Sink, ensure_schema, format_sink, replace_table
from tripmill.sources.trips import load_trips, read_trips, trips_table
from tripmill.sources.zones import chicago_zones, read_zones


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tripmill")
    steps = parser.add_subparsers(dest="step", required=True)

    def step(name: str, text: str, *, source=False, root=False, zones=False):
        command = steps.add_parser(name, help=text)
        command.add_argument("size", nargs="?", default=DEFAULT_SIZE, choices=sorted(SCENARIOS))
        if source:
            given = command.add_mutually_exclusive_group(required=True)
            given.add_argument("--trips", help="Parquet folder or glob of raw trips")
            given.add_argument("--table", help="catalog table of raw trips")
        if root:
            command.add_argument("--root", required=True, help="shared folder of the run")
        if zones:
            command.add_argument("--zones", help="CSV seed; the packaged list if left out")
        command.add_argument("--run-id", help="leave out what the run of this id has done")
        return command

    def rules(command: argparse.ArgumentParser, null_tip: str) -> None:
        command.add_argument("--null-tip", choices=NULL_TIPS, default=null_tip)
        command.add_argument("--survivor", choices=SURVIVORS, default="first")

    def connector(command: argparse.ArgumentParser, what: str) -> None:
        command.add_argument("--format", help=f"connector that {what}; the catalog if left out")
        command.add_argument(
            "--option", action="append", default=[], type=_option, metavar="NAME=VALUE",
            help="option of the connector; may be given again",
        )

    extract = step("extract", "cut the trips to the window, as Parquet", source=True, root=True)
    connector(extract, "reads --table")
    extract.add_argument("--year-partition", help="column of years that folders are split by")
    extract.add_argument("--clustered", action="store_true", help="order the trips by start time")
    extract.add_argument("--narrow", action="store_true", help="only the columns the marts need")
    rules(
        step("transform", "build the marts from the extract, as Parquet", root=True, zones=True),
        "ignore",
    )
    load = step("load", "publish the mart folders as tables", root=True)
    load.add_argument("--schema", default=runs.MARTS_SCHEMA)
    connector(load, "writes the marts")
    elt = step("elt", "raw table, staging view and mart tables", source=True, zones=True)
    elt.add_argument("--location", help="folder for schemas that do not exist yet")
    elt.add_argument("--journal", help="shared folder for the records of a run with an id")
    elt.add_argument("--year-partition", help="column of years that folders are split by")
    connector(elt, "writes the marts")
    rules(elt, "zero")
    return parser


def _option(text: str) -> tuple[str, str]:
    name, sign, value = text.partition("=")
    if not sign:
        raise argparse.ArgumentTypeError(f"{text!r} is not NAME=VALUE")
    return name, value


def main(argv: Sequence[str] | None = None) -> None:
    """Run one step; any failure is raised and ends the process with an error."""
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"tripmill {args.step} {args.size}").getOrCreate()
    scenario = SCENARIOS[args.size]

    def trips() -> DataFrame:
        if args.trips and args.step == "extract":
            return check(read_window(spark, args.trips, scenario), TRIP_SCHEMA)
        if args.trips:
            return read_trips(spark, args.trips)
        if args.step == "extract" and args.format:
            return load_trips(spark, args.format, **{"table": args.table, **dict(args.option)})
        return trips_table(spark, args.table)

    def zones() -> DataFrame:
        return read_zones(spark, args.zones) if args.zones else chicago_zones(spark)

    def sink() -> Sink:
        return format_sink(args.format, **dict(args.option)) if args.format else replace_table

    if args.step == "extract":
        runs.extract_to_parquet(
            trips(),
            scenario,
            args.root,
            run_id=args.run_id,
            all_columns=not args.narrow,
            year_partition=args.year_partition,
            clustered=args.clustered,
        )
    elif args.step == "transform":
        raw = runs.raw_path(args.root, args.size)
        runs.transform(
            spark, raw, zones(), args.size, args.root, args.null_tip, args.survivor, args.run_id
        )
    elif args.step == "load":
        if not args.format:
            ensure_schema(spark, args.schema)
        paths = runs.mart_paths(args.root, args.size)
        runs.load(spark, paths, args.size, args.schema, sink(), args.root, args.run_id)
    else:
        runs.run_elt(
            spark,
            trips(),
            zones(),
            scenario,
            location=args.location,
            sink=sink(),
            null_tip=args.null_tip,
            survivor=args.survivor,
            journal=args.journal,
            run_id=args.run_id,
            year_partition=args.year_partition,
        )
