"""Trips laid out by start time, so that a later window reads only its own files and row groups.

A window on the start time is compared with the least and greatest time of each row group.
That skips little if trips lie in any order, as every group then spans all times, and
nothing at all if times are written in the format that keeps no such bounds. So the
trips are dealt by ranges of time, sorted within each file, and written with
times that have bounds. No column of years is needed.

Spark 4.1 uses such bounds for instants only; its Parquet reader does not compare zoneless times.
So a clustered folder also keeps a small table of the least and greatest time of each file, and
``read_window`` names to Spark only the files that meet the window. That also saves opening
the others.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.operators.selection import in_window
from tripmill.scenario import Scenario
from tripmill.sinks.versions import (
    current_folder,
    names_in,
    read_folder,
    version_path,
    write_parquet,
)

_TIME = "trip_start_timestamp"
_BOUNDS = "_bounds"
_FORMAT = "spark.sql.parquet.outputTimestampType"

# Before and after all trips.
_BEGINNING, _END = datetime(1, 1, 1), datetime(9999, 12, 31)

#: Bytes of a row group of trips; a window skips whole groups.
ROW_GROUP_BYTES = 32 << 20


@contextmanager
def readable_times(spark: SparkSession) -> Iterator[None]:
    """Write instants with bounds for each row group, which Spark's default format lacks."""
    before = spark.conf.get(_FORMAT)
    spark.conf.set(_FORMAT, "TIMESTAMP_MICROS")
    try:
        yield
    finally:
        spark.conf.set(_FORMAT, before)


def by_start_time(trips: DataFrame) -> DataFrame:
    """Trips dealt and sorted by start time.

    Equal times are dealt by trip key, so a moment that holds a large part of all trips
    spreads over several files. This is one shuffle of the window's rows.
    """
    order = [_TIME, "unique_key"]
    return trips.repartitionByRange(*order).sortWithinPartitions(*order)


def write_trips(
    trips: DataFrame, path: str, row_group_bytes: int = ROW_GROUP_BYTES, bounds: bool = False
) -> str:
    """Replace a folder of trips and return its version.

    With ``bounds``, the time span of each file is written too, from one read of that column.
    """
    spark = trips.sparkSession

    def write_bounds(run: str) -> None:
        rows = spark.read.parquet(run)
        spans = rows.groupBy(F.col("_metadata.file_name").alias("file")).agg(
            F.min(_TIME).alias(_TIME), F.max(_TIME).alias("last")
        )
        # A row for each file.
        spans.coalesce(1).write.parquet(f"{run}/{_BOUNDS}")

    with readable_times(spark):
        return write_parquet(
            trips,
            path,
            before_commit=write_bounds if bounds else None,
            **{"parquet.block.size": str(row_group_bytes)},
        )


def read_window(spark: SparkSession, path: str, scenario: Scenario) -> DataFrame:
    """The trips of a window; of a clustered folder only the files that meet it are read.

    The files of the window are named to Spark one by one, as it lists them anyway.
    """
    path = path.rstrip("/")
    version = None if any(c in path for c in "*?[{") else current_folder(spark, path)
    run = version and version_path(path, version)
    if not run or _BOUNDS not in names_in(spark, run):
        return in_window(read_folder(spark, path), scenario)
    spans = spark.read.parquet(f"{run}/{_BOUNDS}")
    # A file meets the window if its first trip is before the end and its last one is not
    # before the start.
    begun = in_window(spans, Scenario("until", _BEGINNING, scenario.end))
    ended = in_window(begun, Scenario("from", scenario.start, _END), column="last")
    files = [f"{run}/{r['file']}" for r in ended.select("file").orderBy("file").collect()]
    schema = spark.read.parquet(run).schema
    rows = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    return in_window(rows, scenario)
