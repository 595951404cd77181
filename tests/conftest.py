from __future__ import annotations

import contextlib
import io
import sys
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tripmill.schema import TRIP_SCHEMA, ZONE_SCHEMA  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tripmill-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def utc(*parts: int) -> datetime:
    return datetime(*parts, tzinfo=timezone.utc)


GOOD = {
    "unique_key": "a",
    "trip_start_timestamp": utc(2022, 5, 1, 10),
    "trip_seconds": 1800,
    "trip_miles": 10.0,
    "pickup_community_area": 8,
    "dropoff_community_area": 32,
    "tips": 2.0,
    "trip_total": 20.0,
    "payment_type": "Cash",
}


@pytest.fixture
def make_trips(spark):
    """Build a trips frame from dicts that override one good trip."""

    def make(*rows: dict):
        data = [tuple({**GOOD, **row}[c] for c in TRIP_SCHEMA.fieldNames()) for row in rows]
        return spark.createDataFrame(data, TRIP_SCHEMA)

    return make


@pytest.fixture
def zones(spark):
    return spark.createDataFrame([(8, "North"), (32, "Loop"), (76, "O'Hare")], ZONE_SCHEMA)


def bag(df, *columns):
    """Rows as a sorted list, so that frames compare without regard to order."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()
