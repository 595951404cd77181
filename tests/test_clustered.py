"""A window on the start time reads only its own row groups."""

from datetime import datetime, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import bag, utc
from tripmill.operators.selection import in_window
from tripmill.plans import runs
from tripmill.scenario import Scenario
from tripmill.sinks.clustered import read_window, write_trips
from tripmill.sinks.versions import current_folder, read_folder, version_path

YEARS = Scenario("years", datetime(2013, 1, 1), datetime(2018, 1, 1))
WEEK = Scenario("week", datetime(2015, 3, 2), datetime(2015, 3, 9))


@pytest.fixture(scope="module", params=["timestamp", "timestamp_ntz"])
def trips(spark, request):
    """Five years of trips in any order; a tenth of them in one moment."""
    seconds = F.when(F.col("id") % 10 == 0, F.lit(40_000_000)).otherwise(
        F.abs(F.xxhash64("id")) % (5 * 365 * 86_400)
    )
    start = F.timestamp_seconds(F.lit(int(utc(2013, 1, 1).timestamp())) + seconds)
    if request.param == "timestamp_ntz":
        start = start.cast("timestamp_ntz")
    return spark.range(0, 60_000, 1, 6).select(
        F.col("id").cast("string").alias("unique_key"),
        start.alias("trip_start_timestamp"),
        F.lit(600).cast("long").alias("trip_seconds"),
        F.lit(2.5).alias("trip_miles"),
        F.lit(8).cast("long").alias("pickup_community_area"),
        F.lit(32).cast("long").alias("dropoff_community_area"),
        F.lit(1.0).alias("tips"),
        F.rand(1).alias("trip_total"),
        F.sha2(F.col("id").cast("string"), 256).alias("payment_type"),
    )


def scanned(df):
    """The rows that the scan of ``df`` hands on, by Spark's own count."""
    df.collect()
    nodes, found = [df._jdf.queryExecution().executedPlan()], []
    while nodes:
        node = nodes.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            nodes.append(node.executedPlan())
            continue
        if name.startswith("Scan parquet"):
            found.append(node.metrics().apply("numOutputRows").value())
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    return sum(found)


def row_groups(spark, path, scenario):
    """Row groups in all, and those whose bounds meet the window."""
    import pathlib

    folder = version_path(path, current_folder(spark, path))
    groups = met = 0
    for file in sorted(pathlib.Path(folder).glob("*.parquet")):
        meta = pq.ParquetFile(file).metadata
        at = meta.schema.names.index("trip_start_timestamp")
        for i in range(meta.num_row_groups):
            bounds = meta.row_group(i).column(at).statistics
            groups += 1
            lo, hi = (x.replace(tzinfo=None) for x in (bounds.min, bounds.max))
            met += lo < scenario.end and hi >= scenario.start
    return groups, met


def test_a_window_reads_only_its_row_groups(spark, trips, tmp_path):
    paths = {c: f"{tmp_path}/{c}" for c in (True, False)}
    for clustered, path in paths.items():
        write_trips(runs.extract(trips, YEARS, clustered=clustered), path, row_group_bytes=64 << 10)
    want = bag(in_window(trips, WEEK))
    read = {}
    for clustered, path in paths.items():
        cut = in_window(read_folder(spark, path), WEEK)
        assert bag(cut) == want
        read[clustered] = scanned(cut)
    groups, met = row_groups(spark, paths[True], WEEK)
    assert groups >= 12 and met <= 3
    groups, met = row_groups(spark, paths[False], WEEK)
    assert met == groups
    # This version of Spark hands comparisons of zoneless times to the scan, but the
    # Parquet reader does not use them.
    if dict(trips.dtypes)["trip_start_timestamp"] == "timestamp":
        assert read[True] < 0.1 * read[False]


def test_a_window_opens_only_its_files(spark, trips, tmp_path):
    path = runs.extract_to_parquet(trips, YEARS, str(tmp_path), clustered=True)
    cut = read_window(spark, path, WEEK)
    everything = read_folder(spark, path)
    assert bag(cut) == bag(in_window(trips, WEEK))
    assert 0 < len(cut.inputFiles()) < len(everything.inputFiles()) / 2
    assert scanned(cut) < 30_000
    # Windows at the edges of files, and beyond all of them.
    for row in spark.read.parquet(f"{everything.inputFiles()[0].rpartition('/')[0]}/_bounds").collect():
        for edge in (row["trip_start_timestamp"], row["last"]):
            edge = edge.replace(tzinfo=None)
            for window in (
                Scenario("at", edge, edge + timedelta(microseconds=1)),
                Scenario("until", edge - timedelta(days=3), edge),
            ):
                assert bag(read_window(spark, path, window)) == bag(in_window(everything, window))
    none = read_window(spark, path, Scenario("none", datetime(1990, 1, 1), datetime(1991, 1, 1)))
    assert none.columns == everything.columns and none.isEmpty()


def test_windows_of_folders_without_bounds(spark, trips, tmp_path):
    plain, versioned = f"{tmp_path}/plain", f"{tmp_path}/versioned"
    trips.write.parquet(plain)
    write_trips(trips, versioned)
    want = bag(in_window(trips, WEEK))
    for path in (plain, versioned, f"{tmp_path}/pl*"):
        assert bag(read_window(spark, path, WEEK)) == want


def test_the_extract_is_clustered_on_request(spark, trips, tmp_path):
    path = runs.extract_to_parquet(trips, YEARS, str(tmp_path), clustered=True)
    assert bag(read_folder(spark, path)) == bag(in_window(trips, YEARS))
    groups, met = row_groups(spark, path, WEEK)
    assert met < groups
    # The moment with a tenth of all trips is not alone in one file.
    by_file = read_folder(spark, path).groupBy(F.input_file_name()).count().collect()
    assert max(r["count"] for r in by_file) < 2 * 60_000 / len(by_file)


def test_the_session_keeps_its_time_format(spark, trips, tmp_path):
    name = "spark.sql.parquet.outputTimestampType"
    before = spark.conf.get(name)
    runs.extract_to_parquet(trips, YEARS, str(tmp_path))
    assert spark.conf.get(name) == before
