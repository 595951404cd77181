"""What the physical plans must look like to hold at scale."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import plan
from checks.trips_view import trips as trips_view
from conftest import SF_DIR
from tripmill.operators import distribution as dist
from tripmill.operators.dedup import first_per_key
from tripmill.operators.selection import in_window, valid_trips
from tripmill.operators.zone_join import with_pickup_zone, with_zone_pair
from tripmill.plans import marts, profile
from tripmill.plans.staging import stage_trips
from tripmill.scenario import SCENARIOS
from tripmill.schema import MEASURES
from tripmill.sources.trips import read_trips
from tripmill.sources.zones import chicago_zones


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    """Trips as Parquet files by year, with a column no query needs."""
    path = str(tmp_path_factory.mktemp("raw") / "trips")
    (
        trips_view(spark, SF_DIR)
        .withColumn("company", F.lit("x"))
        .withColumn("rok", F.year("trip_start_timestamp"))
        .write.partitionBy("rok")
        .parquet(path)
    )
    return read_trips(spark, path)


def pushed(text):
    return " ".join(re.findall(r"PushedFilters: \[(.*)\]", text))


def schemas(text):
    return " ".join(re.findall(r"ReadSchema: struct<(.*)>", text))


def test_quality_rules_and_window_reach_the_scan(raw):
    found = pushed(plan(first_per_key(valid_trips(in_window(raw, SCENARIOS["small"])))))
    for want in (
        "GreaterThan(trip_seconds,0)", "GreaterThan(trip_miles,0.0)",
        "IsNotNull(pickup_community_area)", "IsNotNull(dropoff_community_area)",
        "GreaterThanOrEqual(trip_start_timestamp,2022-01-01",
        "LessThan(trip_start_timestamp,2023-01-01",
    ):
        assert want in found


def test_year_partitions_are_pruned(raw):
    text = plan(in_window(raw, SCENARIOS["medium"], year_partition="rok"))
    assert re.search(r"PartitionFilters: .*rok#\d+ >= 2016.*rok#\d+ <= 2017", text)


def test_staging_reads_nine_columns_and_cuts_before_its_one_shuffle(raw):
    text = plan(stage_trips(raw))
    assert "company" not in schemas(text)
    assert len(re.findall(r"^\(\d+\) Exchange", text, re.M)) == 1
    above, below = text.split("\n\n")[0].split("Exchange")
    assert "WindowGroupLimit" in above and "WindowGroupLimit" in below and "Filter" in below


def test_profiles_read_only_their_columns(raw):
    assert re.fullmatch(
        r"trip_seconds:bigint,trip_miles:double,trip_total:double",
        schemas(plan(profile.null_rates(raw, MEASURES))),
    )
    assert schemas(plan(dist.value_counts(raw, MEASURES))) == (
        "trip_seconds:bigint,trip_miles:double,trip_total:double"
    )
    assert schemas(plan(profile.uniqueness_by_year(raw))) == (
        "unique_key:string,trip_start_timestamp:timestamp_ntz"
    )


def test_packaged_zones_are_broadcast(spark, raw):
    text = plan(with_zone_pair(
        raw, chicago_zones(spark), "pickup_community_area", "dropoff_community_area"
    ))
    assert len(re.findall(r"^\(\d+\) BroadcastHashJoin", text, re.M)) == 2
    assert "SortMergeJoin" not in text


def test_zones_of_unknown_size_are_not(spark, raw, zones):
    text = plan(with_pickup_zone(raw, zones, "pickup_community_area"))
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text


def test_zone_names_meet_sums_and_not_trips(spark, raw):
    tree = plan(marts.traffic_dynamics(stage_trips(raw), chicago_zones(spark))).split("\n\n")[0]
    assert tree.index("BroadcastHashJoin") < tree.index("HashAggregate", tree.index("BroadcastHashJoin"))
    assert tree.index("HashAggregate", tree.index("BroadcastHashJoin")) < tree.index("Window")


def test_one_pass_has_one_deduplication(raw):
    text = plan(marts.mart_sums(stage_trips(raw)))
    for node in ("Window", "Scan parquet", "Expand"):
        assert len(re.findall(rf"^\(\d+\) {node}\s*$", text, re.M)) == 1


def test_profile_works_on_the_written_values(raw):
    values = profile.value_table(raw)
    trimmed = profile.trimmed_table(values)
    for frame in (profile.describe(values), profile.histogram(trimmed), profile.density(trimmed)):
        text = plan(frame)
        # As planned, without what reuse at run time saves.
        assert len(re.findall(r"^\(\d+\) Scan parquet", text, re.M)) <= 8
        read = set(re.findall(r"ReadSchema: struct<(.*)>", text))
        assert read and read <= {
            "kolumna:string,wartosc:double,liczba:bigint", "kolumna:string,wartosc:double"
        }
        assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_the_summary_reads_the_values_four_times(raw):
    values = profile.value_table(raw)
    for frame in (profile.describe(values), profile.trimmed_rows(raw, values)):
        scans = re.findall(r"Scan parquet(?:.|\n)*?ReadSchema: (.*)", plan(frame))
        assert sum("kolumna" in schema for schema in scans) == 4


def test_rules_reach_the_scan_through_staging(raw):
    for frame in (stage_trips(raw), stage_trips(raw, survivor="any")):
        found = pushed(plan(frame))
        for want in (
            "GreaterThan(trip_seconds,0)", "GreaterThan(trip_miles,0.0)",
            "IsNotNull(pickup_community_area)", "IsNotNull(dropoff_community_area)",
        ):
            assert want in found
    found = pushed(plan(stage_trips(in_window(raw, SCENARIOS["small"]))))
    assert "GreaterThanOrEqual(trip_start_timestamp,2022-01-01" in found


def test_no_python_in_any_plan(spark, raw):
    zones = chicago_zones(spark)
    staged, values = stage_trips(raw), profile.value_table(raw)
    trimmed = profile.trimmed_table(values)
    for frame in (
        staged, marts.traffic_dynamics(staged, zones), marts.finance(staged),
        marts.routes(staged, zones), profile.trimmed_rows(raw, values),
        profile.describe(values), profile.histogram(trimmed), profile.density(trimmed),
        profile.uniqueness_by_year(raw), profile.null_rates_long(raw),
    ):
        assert not re.search(r"EvalPython|InPandas|InArrow", plan(frame))
