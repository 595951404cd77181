"""Distribution operators against numpy and pandas on small data."""

import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import bag, utc
from tripmill.operators import distribution as dist
from tripmill.plans import profile

STATS = ["count", "mean", "std", "min", "1%", "50%", "99%", "max"]


def frame(spark, **columns):
    schema = T.StructType([T.StructField(c, T.DoubleType()) for c in columns])
    return spark.createDataFrame(list(zip(*columns.values())), schema)


def table(spark, data):
    return profile.value_table(frame(spark, **data), list(data))


def numbers(seed, n=3000):
    rng = np.random.default_rng(seed)
    return {
        "even": rng.uniform(-5, 5, n).tolist(),
        "whole": rng.integers(0, 40, n).astype(float).tolist(),
        "tail": np.exp(rng.normal(0, 4, n)).tolist(),
        "hot": np.where(rng.random(n) < 0.4, 7.0, rng.normal(7, 3, n)).tolist(),
    }


def test_describe_equals_pandas(spark):
    data = numbers(1)
    data["gaps"] = [None if i % 3 else float(i) for i in range(3000)]
    want = pd.DataFrame(data).describe(percentiles=[0.01, 0.5, 0.99]).T
    rows = profile.describe(table(spark, data), list(data)).collect()
    assert len(rows) == len(data)
    for row in rows:
        for stat in STATS:
            assert math.isclose(row[stat], want.loc[row.kolumna, stat], rel_tol=1e-12), (row, stat)


def test_describe_edge_columns(spark):
    df = frame(
        spark, none=[None, None, None], one=[4.0, None, None], same=[2.0, 2.0, 2.0],
        nan=[1.0, float("nan"), 3.0],
    )
    rows = {r.kolumna: tuple(r)[1:] for r in profile.describe(profile.value_table(df, df.columns), df.columns).collect()}
    assert rows["none"] == (0, *[None] * 7)
    assert rows["one"] == (1, 4.0, None, 4.0, 4.0, 4.0, 4.0, 4.0)
    assert rows["same"] == (3, 2.0, 0.0, 2.0, 2.0, 2.0, 2.0, 2.0)
    assert rows["nan"][0] == 2 and rows["nan"][5] == 2.0


@pytest.mark.parametrize("bins,steps", [(2, 1), (3, 4), (4096, 2), (5, 0)])
def test_quantiles_do_not_depend_on_the_narrowing(spark, bins, steps):
    data = numbers(2, 500)
    ps = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]
    counts = dist.value_counts(frame(spark, **data), list(data))
    rows = dist.quantiles(counts, ps, bins=bins, steps=steps).collect()
    assert len(rows) == len(ps) * len(data)
    for row in rows:
        want = np.quantile(data[row.kolumna], row.p)
        assert math.isclose(row.kwantyl, want, rel_tol=1e-12), row


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.one_of(
            st.floats(-1e300, 1e300, allow_nan=False),
            st.floats(-2, 2).map(lambda x: round(x, 1)),
        ),
        min_size=1,
        max_size=40,
    ),
    st.sampled_from([0.01, 0.3, 0.5, 0.99]),
)
def test_quantile_property(spark, values, p):
    counts = dist.value_counts(frame(spark, x=values), ["x"])
    (row,) = dist.quantiles(counts, [p], bins=4).collect()
    ordered = sorted(values)
    at = p * (len(values) - 1)
    low, high = ordered[math.floor(at)], ordered[math.ceil(at)]
    want = low + (high - low) * (at - math.floor(at))
    assert row.kwantyl == want or math.isclose(row.kwantyl, want, rel_tol=1e-12)


def test_quantiles_over_the_whole_range_of_doubles(spark):
    values = [0.0, 5e-324, -5e-324, 2.2e-308, 1.7976931348623157e308, -1.7976931348623157e308]
    values += [s * 2.0**e * f for s in (1, -1) for e in range(-1000, 1000, 97)
               for f in (1 - 2**-53, 1.0, 1 + 2**-52)]
    values.sort()
    n = len(values)
    counts = dist.value_counts(frame(spark, x=values), ["x"])
    ps = [i / (n - 1) for i in range(0, n, 5)]
    for row in dist.quantiles(counts, ps, bins=8).collect():
        at = row.p * (n - 1)
        assert values[math.floor(at)] <= row.kwantyl <= values[math.ceil(at)]


def test_infinite_values_rank_last(spark):
    df = frame(spark, x=[1.0, 2.0, float("inf"), float("-inf"), 3.0])
    rows = dist.quantiles(dist.value_counts(df, ["x"]), [0.25, 0.5, 0.75]).collect()
    assert {r.p: r.kwantyl for r in rows} == {0.25: 1.0, 0.5: 2.0, 0.75: 3.0}


def trimmed(values):
    values = np.array([v for v in values if v is not None])
    return values[values <= np.quantile(values, 0.99)]


def test_trim(spark):
    data = numbers(3)
    data["gaps"] = [None if i % 3 else float(i) for i in range(3000)]
    df = frame(spark, **data)
    values = profile.value_table(df, list(data))
    rows = profile.trimmed_rows(df, values, list(data)).collect()
    got = {c: sorted(r.wartosc for r in rows if r.kolumna == c) for c in data}
    assert got == {c: sorted(trimmed(v).tolist()) for c, v in data.items()}


def test_histogram_equals_numpy(spark):
    data = numbers(4)
    rows = profile.histogram(profile.trimmed_table(table(spark, data))).collect()
    for c, values in data.items():
        want, edges = np.histogram(trimmed(values), bins=30)
        mine = sorted((r for r in rows if r.kolumna == c), key=lambda r: r.kosz)
        assert [r.liczba for r in mine] == want.tolist()
        assert np.allclose([r.od for r in mine] + [mine[-1].do], edges, rtol=1e-12)


def test_histogram_edge_columns(spark):
    df = frame(spark, same=[2.0, 2.0, 2.0], none=[None, None, None], two=[0.0, 1.0, 1.0])
    rows = dist.histogram(dist.value_counts(df, df.columns)).collect()
    got = {c: [0] * 30 for c in {r.kolumna for r in rows}}
    for r in rows:
        got[r.kolumna][r.kosz] = r.liczba
    assert got == {
        "same": np.histogram([2.0, 2.0, 2.0], bins=30)[0].tolist(),
        "two": np.histogram([0.0, 1.0, 1.0], bins=30)[0].tolist(),
    }


@pytest.mark.parametrize("seed", [5, 6])
def test_density(spark, seed):
    data = numbers(seed, 800)
    rows = profile.density(profile.trimmed_table(table(spark, data))).collect()
    for c, values in data.items():
        v = trimmed(values)
        h = len(v) ** -0.2 * v.std(ddof=1)
        x = np.linspace(v.min(), v.max(), 200)
        terms = np.exp(-0.5 * ((x[:, None] - v[None, :]) / h) ** 2).sum(axis=1)
        want = terms / (h * math.sqrt(2 * math.pi)) * (v.max() - v.min()) / 30
        mine = sorted((r for r in rows if r.kolumna == c), key=lambda r: r.punkt)
        assert len(mine) == 200
        assert np.allclose([r.x for r in mine], x, rtol=1e-12, atol=1e-12)
        assert np.allclose([r.gestosc for r in mine], want, rtol=1e-9, atol=1e-300)


def test_density_far_from_all_values_is_zero_not_missing(spark):
    df = frame(spark, x=[0.0] * 500 + [1.0] * 500 + [1e6])
    rows = dist.density(dist.value_counts(df, ["x"])).collect()
    assert len(rows) == 200 and all(r.gestosc is not None for r in rows)


def test_no_spread_is_no_spread(spark):
    df = frame(spark, same=[0.1, 0.1, 0.1], none=[None, None, None])
    stds = {r.kolumna: r["std"] for r in profile.describe(profile.value_table(df, df.columns), df.columns).collect()}
    assert stds == {"same": 0.0, "none": None}
    assert dist.density(dist.value_counts(df, df.columns)).collect() == []


def test_audit(make_trips):
    trips = make_trips(
        {"unique_key": "a"}, {"unique_key": "a"}, {"unique_key": "b"}, {"unique_key": None},
        {"unique_key": "c", "trip_start_timestamp": utc(2021, 1, 1)},
        {"unique_key": "d", "trip_start_timestamp": None},
    )
    assert [tuple(r) for r in profile.uniqueness_by_year(trips).collect()] == [
        (None, 1, 1, 0.0), (2021, 1, 1, 0.0), (2022, 4, 2, 50.0),
    ]


def test_null_rates(make_trips):
    trips = make_trips({"tips": None}, {"tips": None, "trip_total": None}, {}, {})
    assert profile.null_rates(trips).first().asDict() == {
        "pickup_community_area": 0.0, "dropoff_community_area": 0.0, "trip_start_timestamp": 0.0,
        "trip_seconds": 0.0, "trip_miles": 0.0, "trip_total": 25.0, "tips": 50.0,
        "payment_type": 0.0,
    }
    long = [tuple(r) for r in profile.null_rates_long(trips).collect()]
    assert long[:2] == [("tips", 50.0), ("trip_total", 25.0)] and len(long) == 8
    assert set(profile.null_rates(trips.filter(F.lit(False))).first()) == {None}


def test_counts_normalise_zero(spark):
    counts = dist.value_counts(frame(spark, x=[0.0, -0.0, 1.0]), ["x"])
    assert bag(counts) == [("x", 0.0, 2), ("x", 1.0, 1)]
