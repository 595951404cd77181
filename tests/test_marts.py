import math

import pytest
from pyspark.sql import functions as F

from checks.trips_view import trips as trips_view
from checks.trips_view import zones as zones_view
from conftest import SF_DIR, bag, utc
from tripmill.operators.zone_join import with_pickup_zone, with_zone_pair
from tripmill.plans import marts
from tripmill.plans.runs import build_marts
from tripmill.plans.staging import stage_trips
from tripmill.schema import MARTS


@pytest.fixture(scope="module")
def staged(spark):
    return stage_trips(trips_view(spark, SF_DIR), "ignore")


@pytest.fixture(scope="module")
def nations(spark):
    return zones_view(spark, SF_DIR)


def close(left, right):
    assert left.columns == right.columns
    key = lambda r: repr([v for v in r if not isinstance(v, float)])
    left, right = sorted(left.collect(), key=key), sorted(right.collect(), key=key)
    assert len(left) == len(right)
    for a, b in zip(left, right):
        for x, y in zip(a, b):
            if isinstance(x, float) and isinstance(y, float):
                assert math.isclose(x, y, rel_tol=1e-9), (a, b)
            else:
                assert x == y, (a, b)


def test_by_hand(make_trips, zones):
    staged = stage_trips(
        make_trips(
            {"unique_key": "1"},
            {"unique_key": "2", "trip_miles": 20.0, "tips": None},
            {"unique_key": "3", "pickup_community_area": 99, "payment_type": None},
            {"unique_key": "4", "pickup_community_area": 98, "trip_total": None,
             "payment_type": None},
            {"unique_key": None, "trip_start_timestamp": None, "dropoff_community_area": 97},
        )
    )
    assert bag(marts.traffic_dynamics(staged, zones)) == sorted([
        ("North", 10, 2022, 5, 2, 30.0),
        (None, 10, 2022, 5, 2, 20.0),
        ("North", None, None, None, 0, 20.0),
    ], key=repr)
    assert bag(marts.finance(staged)) == sorted([
        (2022, 5, "Cash", 2, 40.0, 5.0),
        (2022, 5, None, 2, 20.0, 5.0),
        (None, None, "Cash", 1, 20.0, 10.0),
    ], key=repr)
    assert bag(marts.routes(staged, zones)) == sorted([
        ("North", "Loop", 2), (None, "Loop", 2), ("North", None, 0),
    ], key=repr)


def test_no_totals_and_no_tips_give_null(make_trips):
    staged = stage_trips(
        make_trips({"unique_key": "1", "trip_total": None},
                   {"unique_key": "2", "tips": None, "payment_type": "Card"}),
        "ignore",
    )
    assert bag(marts.finance(staged)) == [
        (2022, 5, "Card", 1, 20.0, None), (2022, 5, "Cash", 1, None, 0.0),
    ]


def test_one_pass_equals_single_marts(staged, nations):
    together = build_marts(staged, nations)
    assert tuple(together) == MARTS
    close(together["mart_dynamika_ruchu"], marts.traffic_dynamics(staged, nations))
    close(together["mart_finanse"], marts.finance(staged))
    close(together["mart_trasy"], marts.routes(staged, nations))


def test_name_after_sums_equals_name_per_trip(staged, nations):
    named = with_zone_pair(staged, nations)
    close(
        named.groupBy("dzielnica_odbioru", "godzina", "rok", "miesiac").agg(
            F.count("id_przejazdu").alias("liczba_przejazdow"),
            F.avg("predkosc").alias("srednia_predkosc_mph"),
        ),
        marts.traffic_dynamics(staged, nations),
    )
    close(
        named.groupBy("dzielnica_odbioru", "dzielnica_dowozu").agg(
            F.count("id_przejazdu").alias("liczba_przejazdow")
        ),
        marts.routes(staged, nations),
    )


def test_shared_names_fall_into_one_group(spark, staged, nations):
    same = nations.withColumn("nazwa_dzielnicy", F.lit("one"))
    rows = marts.routes(staged, same).collect()
    assert {(r.dzielnica_odbioru, r.dzielnica_dowozu) for r in rows} == {
        ("one", "one"), ("one", None), (None, "one"), (None, None),
    }
    assert len(rows) == 4


def test_totals_agree_with_staging(staged, nations):
    n = staged.count()
    assert staged.select("id_przejazdu").distinct().count() == n
    assert with_pickup_zone(staged, nations).count() == n
    assert with_zone_pair(staged, nations).count() == n
    for mart, column in (
        (marts.traffic_dynamics(staged, nations), "liczba_przejazdow"),
        (marts.routes(staged, nations), "liczba_przejazdow"),
        (marts.finance(staged), "liczba_transakcji"),
    ):
        assert mart.agg(F.sum(column)).first()[0] == n


def test_empty_input(spark, make_trips, zones):
    staged = stage_trips(make_trips({"trip_seconds": 0}))
    for mart in build_marts(staged, zones).values():
        assert mart.collect() == []


def test_hot_zone(spark, make_trips, zones):
    staged = stage_trips(
        make_trips({"trip_start_timestamp": utc(2022, 1, 1)})
        .crossJoin(spark.range(9_000))
        .withColumn("unique_key", F.col("id").cast("string"))
        .withColumn(
            "pickup_community_area", F.when(F.col("id") % 3 == 0, F.lit(8)).otherwise(F.col("id"))
        )
    )
    rows = {r.dzielnica_odbioru: r.liczba_przejazdow
            for r in marts.traffic_dynamics(staged, zones).collect()}
    want = {"North": 0, "Loop": 0, "O'Hare": 0, None: 0}
    names = {8: "North", 32: "Loop", 76: "O'Hare"}
    for i in range(9_000):
        want[names.get(8 if i % 3 == 0 else i)] += 1
    assert rows == want
