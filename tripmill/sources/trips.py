"""Raw trips from Parquet files, catalog tables or any Spark data source.

Each reader analyses the source at once, so an unreadable path or a missing
column fails before any job starts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripmill.schema import TRIP_SCHEMA, check
from tripmill.sinks.versions import read_folder


def read_trips(spark: SparkSession, path: str) -> DataFrame:
    """Trips from Parquet files; ``path`` may be a folder, one with versions, or a glob."""
    return check(read_folder(spark, path), TRIP_SCHEMA)


def trips_table(spark: SparkSession, name: str) -> DataFrame:
    """Trips from a catalog table or view."""
    return check(spark.table(name), TRIP_SCHEMA)


def load_trips(spark: SparkSession, fmt: str, **options: str) -> DataFrame:
    """Trips through a connector on the classpath, e.g. ``fmt="bigquery"``."""
    return check(spark.read.format(fmt).options(**options).load(), TRIP_SCHEMA)
