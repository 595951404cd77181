from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import bag, utc
from checks.trips_view import trips as trips_view
from conftest import SF_DIR
from tripmill.functions import calendar
from tripmill.functions.measures import speed_mph, tip_percent
from tripmill.operators.dedup import SURVIVOR_ORDER, any_per_key, first_per_key
from tripmill.operators.selection import in_window, sample_by_key, sample_rows, valid_trips
from tripmill.plans.staging import stage_trips
from tripmill.scenario import SCENARIOS, Scenario, sized_name
from tripmill.schema import TRIP_COLUMNS

STAGED = [
    "id_przejazdu", "godzina_rozpoczecia_przejazdu", "czas_przejazdu", "dystans",
    "id_dzielnica_odbioru", "id_dzielnica_dowozu", "napiwek", "kwota_transackji",
    "typ_platnosci", "rok", "miesiac", "godzina", "predkosc", "procent_napiwku",
]


def test_quality_rules(make_trips):
    bad = [
        {"trip_seconds": 0}, {"trip_seconds": None}, {"trip_seconds": -5},
        {"trip_miles": 0.0}, {"trip_miles": None}, {"trip_miles": -1.0},
        {"pickup_community_area": None}, {"dropoff_community_area": None},
    ]
    rows = [{"unique_key": str(i), **b} for i, b in enumerate(bad)]
    kept = valid_trips(make_trips(*rows, {"unique_key": "good", "tips": None, "trip_total": None}))
    assert [r.unique_key for r in kept.collect()] == ["good"]


def test_window_is_half_open_and_drops_missing_times(make_trips):
    edges = {
        "before": utc(2021, 12, 31, 23, 59, 59, 999999),
        "first": utc(2022, 1, 1),
        "last": utc(2022, 12, 31, 23, 59, 59, 999999),
        "after": utc(2023, 1, 1),
        "never": None,
    }
    trips = make_trips(*[{"unique_key": k, "trip_start_timestamp": t} for k, t in edges.items()])
    for df in (
        trips,
        trips.withColumn(
            "trip_start_timestamp", F.col("trip_start_timestamp").cast("timestamp_ntz")
        ),
    ):
        kept = in_window(df, SCENARIOS["small"])
        assert {r.unique_key for r in kept.collect()} == {"first", "last"}


@pytest.mark.parametrize("zone", ["America/Chicago", "Asia/Tokyo", "UTC"])
def test_calendar_and_window_do_not_follow_the_session_zone(spark, make_trips, zone):
    times = {
        "new year": utc(2022, 1, 1, 0, 30),
        "month end": utc(2022, 1, 31, 23, 59),
        "clocks back, first": utc(2022, 11, 6, 6, 30),
        "clocks back, again": utc(2022, 11, 6, 7, 30),
        "before epoch": utc(1969, 12, 31, 23, 59, 59),
    }
    df = make_trips(*[{"unique_key": k, "trip_start_timestamp": t} for k, t in times.items()])
    start = "trip_start_timestamp"
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        parts = df.select(
            "unique_key", calendar.year(df, start), calendar.month(df, start),
            calendar.hour(df, start),
        )
        assert {r[0]: tuple(r)[1:] for r in parts.collect()} == {
            k: (t.year, t.month, t.hour) for k, t in times.items()
        }
        kept = {r.unique_key for r in in_window(df, SCENARIOS["small"]).collect()}
        assert kept == set(times) - {"before epoch"}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_scenarios():
    assert {n: (s.start.year, s.end.year) for n, s in SCENARIOS.items()} == {
        "small": (2022, 2023), "medium": (2016, 2018), "large": (2013, 2016),
    }
    assert sized_name("mart_trasy") == "mart_trasy_small"
    assert sized_name("mart_trasy", "large", "transformed_marts") == (
        "transformed_marts.mart_trasy_large"
    )
    with pytest.raises(ValueError):
        Scenario("empty", datetime(2022, 1, 1), datetime(2022, 1, 1))
    with pytest.raises(ValueError):
        Scenario("zoned", utc(2022, 1, 1), utc(2023, 1, 1))


def test_speed_and_tip_traps(make_trips):
    df = make_trips(
        {"unique_key": "zero", "trip_seconds": 0},
        {"unique_key": "null", "trip_seconds": None},
        {"unique_key": "plain"},
    ).select("unique_key", speed_mph("trip_miles", "trip_seconds").alias("v"))
    assert {r.unique_key: r.v for r in df.collect()} == {"zero": None, "null": None, "plain": 20.0}

    cases = {
        "both": (2.0, 20.0, 10.0, 10.0),
        "no tip": (None, 20.0, 0.0, None),
        "no total": (2.0, None, 0.0, 0.0),
        "zero total": (2.0, 0.0, 0.0, 0.0),
        "refund": (2.0, -5.0, 0.0, 0.0),
        "nothing": (None, None, 0.0, 0.0),
    }
    df = make_trips(*[
        {"unique_key": k, "tips": c[0], "trip_total": c[1]} for k, c in cases.items()
    ]).select(
        "unique_key",
        *[tip_percent("tips", "trip_total", r) for r in ("zero", "ignore")],
    )
    assert {r[0]: (r[1], r[2]) for r in df.collect()} == {k: c[2:] for k, c in cases.items()}
    with pytest.raises(ValueError):
        tip_percent("tips", "trip_total", "maybe")


def test_staged_columns_and_null_tip_rules(make_trips):
    trips = make_trips({"tips": None}).withColumn("company", F.lit("x"))
    zero, ignore = stage_trips(trips), stage_trips(trips, "ignore")
    assert zero.columns == ignore.columns == STAGED
    assert [(r.napiwek, r.procent_napiwku) for r in zero.collect()] == [(None, 0.0)]
    assert [(r.napiwek, r.procent_napiwku) for r in ignore.collect()] == [(0.0, None)]
    with pytest.raises(ValueError):
        stage_trips(trips, survivor="last")


def test_bad_record_does_not_push_out_a_good_one(make_trips):
    trips = make_trips(
        {"trip_start_timestamp": utc(2022, 1, 1), "trip_miles": 0.0},
        {"trip_start_timestamp": utc(2022, 1, 2)},
    )
    assert [r.godzina_rozpoczecia_przejazdu.day for r in stage_trips(trips).collect()] == [2]


def test_survivor(make_trips):
    trips = make_trips(
        {"unique_key": "late", "trip_start_timestamp": utc(2022, 1, 2), "trip_seconds": 1},
        {"unique_key": "late", "trip_start_timestamp": utc(2022, 1, 1), "trip_seconds": 2},
        {"unique_key": "unknown", "trip_seconds": 3},
        {"unique_key": "unknown", "trip_start_timestamp": None, "trip_seconds": 4},
        {"unique_key": "tie", "trip_seconds": 6, "trip_miles": 1.0},
        {"unique_key": "tie", "trip_seconds": 5, "trip_miles": 9.0},
        {"unique_key": "null tie", "payment_type": "Cash", "trip_seconds": 7},
        {"unique_key": "null tie", "payment_type": None, "trip_seconds": 7},
        {"unique_key": None, "trip_seconds": 9},
        {"unique_key": None, "trip_seconds": 8},
        {"unique_key": "same"},
        {"unique_key": "same"},
    )
    for n in (1, 5):
        rows = {r.unique_key: r for r in first_per_key(trips.repartition(n)).collect()}
        assert {k: r.trip_seconds for k, r in rows.items()} == {
            "late": 2, "unknown": 4, "tie": 5, "null tie": 7, None: 8, "same": 1800,
        }
        assert rows["null tie"].payment_type is None
        assert sorted(map(str, rows)) == sorted(
            str(r.unique_key) for r in any_per_key(trips.repartition(n)).collect()
        )


def test_any_survivor_is_a_whole_input_row(spark):
    trips = trips_view(spark, SF_DIR)
    kept = any_per_key(trips.repartition(13))
    assert kept.count() == trips.select("unique_key").distinct().count()
    assert kept.subtract(trips).count() == 0


def test_window_form_equals_aggregate_form(spark):
    trips = trips_view(spark, SF_DIR)
    least = (
        trips.groupBy("unique_key")
        .agg(F.min(F.struct(*SURVIVOR_ORDER)).alias("s"))
        .select("unique_key", "s.*")
        .select(*TRIP_COLUMNS)
    )
    assert bag(first_per_key(trips)) == bag(least)
    assert bag(first_per_key(trips.repartition(13))) == bag(least)


def test_a_third_of_all_rows_on_one_key(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .otherwise(F.col("id").cast("string"))
        .alias("unique_key"),
        ((F.col("id") * 7919) % 30_011).alias("at"),
    )
    kept = first_per_key(df, "unique_key", ["at"])
    assert kept.count() == 20_001
    want = min((i * 7919) % 30_011 for i in range(0, 30_000, 3))
    assert kept.filter("unique_key = 'hot'").first()["at"] == want


def test_sample(spark):
    df = spark.range(100_000)
    sample = sample_rows(df, 0.01, seed=3)
    n = sample.count()
    assert 800 < n < 1200
    assert sample.distinct().count() == n
    assert sample_rows(df, 0.01, seed=3).count() == n
    assert sample_rows(df, 1.0).count() == 100_000


def test_sample_by_key_does_not_depend_on_the_layout(spark):
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 50 != 0, F.concat(F.lit("k"), (F.col("id") % 15_000).cast("string")))
        .alias("unique_key"),
        "id",
    )
    want = bag(sample_by_key(rows, 0.05, seed=7))
    # Five standard deviations of 15,000 keys, some of them twice.
    assert abs(len(want) - 1000) < 5 * (1.7 * 20_000 * 0.05 * 0.95) ** 0.5
    for layout in (rows.repartition(13), rows.repartition(5, "id"), rows.coalesce(1).orderBy("id")):
        assert bag(sample_by_key(layout, 0.05, seed=7)) == want
    keys = {k for k, _ in want}
    assert set(want) == {r for r in bag(rows) if r[0] in keys}
    assert bag(sample_by_key(rows, 0.05, seed=8)) != want
    assert set(want) <= set(bag(sample_by_key(rows, 0.2, seed=7)))
    assert sample_by_key(rows, 0).isEmpty() and bag(sample_by_key(rows, 1)) == bag(rows)
    with pytest.raises(ValueError):
        sample_by_key(rows, 1.5)


def test_sample_by_several_columns_tells_them_apart(spark):
    rows = spark.createDataFrame([("a|1", "b"), ("a", "1|b"), (None, "null"), ("null", None)], "x string, y string")
    taken = [
        {tuple(r) for r in sample_by_key(rows, 0.5, seed, ["x", "y"]).collect()}
        for seed in range(20)
    ]
    patterns = {tuple(row in sample for sample in taken) for row in bag(rows)}
    assert len(patterns) == 4


def test_any_survivor_is_a_whole_valid_row(spark, make_trips):
    rows = [
        {"unique_key": k, "trip_seconds": s, "trip_miles": float(s), "tips": float(s) or None}
        for k in ("a", "b", None) for s in (0, 5, 6, 7)
    ]
    trips = make_trips(*rows)
    for n in (1, 5):
        staged = stage_trips(trips.repartition(n), survivor="any").collect()
        assert sorted(str(r.id_przejazdu) for r in staged) == ["None", "a", "b"]
        assert all(r.czas_przejazdu > 0 for r in staged)
        assert all(r.dystans == r.czas_przejazdu == r.napiwek for r in staged)


def test_staging_is_made_of_the_operators(spark, make_trips):
    """What the operators do step by step is what staging does."""
    trips = trips_view(spark, SF_DIR)
    by_hand = first_per_key(valid_trips(trips))
    start = "trip_start_timestamp"
    by_hand = by_hand.select(
        "unique_key",
        calendar.year(by_hand, start), calendar.month(by_hand, start), calendar.hour(by_hand, start),
        speed_mph("trip_miles", "trip_seconds"), tip_percent("tips", "trip_total"),
    )
    columns = ["id_przejazdu", "rok", "miesiac", "godzina", "predkosc", "procent_napiwku"]
    assert bag(stage_trips(trips), *columns) == bag(by_hand)
