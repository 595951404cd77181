"""Staging and marts against plain Python on random small tables full of traps."""

import math
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import utc
from tripmill.operators.dedup import SURVIVOR_ORDER
from tripmill.plans.runs import build_marts
from tripmill.plans.staging import stage_trips

NAMES = {8: "North", 32: "Loop", 76: "O'Hare"}

trip = st.fixed_dictionaries({
    "unique_key": st.sampled_from(["a", "b", "c", "d", "e", "f", None]),
    "trip_start_timestamp": st.sampled_from([
        None, utc(2022, 1, 31, 23, 59, 59), utc(2022, 2, 1), utc(2021, 12, 31, 23),
    ]),
    "trip_seconds": st.sampled_from([600, 1800, 3600, 0, -60, None]),
    "trip_miles": st.sampled_from([1.0, 2.5, 10.0, 0.0, -1.0, None]),
    "pickup_community_area": st.sampled_from([8, 32, 76, 99, None]),
    "dropoff_community_area": st.sampled_from([8, 32, 98, 99, None]),
    "tips": st.sampled_from([None, 0.0, 2.0, 5.5]),
    "trip_total": st.sampled_from([None, 0.0, -3.0, 20.0, 41.25]),
    "payment_type": st.sampled_from(["Cash", "Card", None]),
})


def staged_by_hand(rows, null_tip):
    best = {}
    for r in rows:
        if not ((r["trip_seconds"] or 0) > 0 and (r["trip_miles"] or 0) > 0):
            continue
        if r["pickup_community_area"] is None or r["dropoff_community_area"] is None:
            continue
        rank = [(r[c] is not None, r[c] if r[c] is not None else 0) for c in SURVIVOR_ORDER]
        key = r["unique_key"]
        if key not in best or rank < best[key][0]:
            best[key] = (rank, r)
    out = []
    for _, r in best.values():
        start, tip, total = r["trip_start_timestamp"], r["tips"], r["trip_total"]
        percent = 0.0
        if total is not None and total > 0:
            if tip is not None:
                percent = tip / total * 100
            else:
                percent = 0.0 if null_tip == "zero" else None
        out.append({
            "key": r["unique_key"],
            "pick": NAMES.get(r["pickup_community_area"]),
            "drop": NAMES.get(r["dropoff_community_area"]),
            "when": (start.year, start.month, start.hour) if start else (None, None, None),
            "pay": r["payment_type"],
            "tip": 0.0 if tip is None and null_tip == "ignore" else tip,
            "total": total,
            "speed": r["trip_miles"] / (r["trip_seconds"] / 3600),
            "percent": percent,
        })
    return out


def mean(values):
    values = [v for v in values if v is not None]
    return sum(values) / len(values) if values else None


def same(got, want):
    assert set(got) == set(want)
    for key, values in want.items():
        for a, b in zip(got[key], values, strict=True):
            if a is None or b is None:
                assert a is b, key
            else:
                assert math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12), key


def grouped(rows, key):
    groups = defaultdict(list)
    for r in rows:
        groups[key(r)].append(r)
    return groups


def keys(rows):
    return sum(r["key"] is not None for r in rows)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(trip, min_size=1, max_size=60), st.sampled_from(["zero", "ignore"]))
def test_random_tables(make_trips, zones, rows, null_tip):
    want = staged_by_hand(rows, null_tip)
    staged = stage_trips(make_trips(*rows).repartition(3), null_tip)
    got = {
        r.id_przejazdu: (r.napiwek, r.predkosc, r.procent_napiwku, r.kwota_transackji)
        for r in staged.collect()
    }
    same(got, {r["key"]: (r["tip"], r["speed"], r["percent"], r["total"]) for r in want})

    marts = build_marts(staged, zones)
    same(
        {tuple(r)[:4]: tuple(r)[4:] for r in marts["mart_dynamika_ruchu"].collect()},
        {
            k: (keys(g), mean([r["speed"] for r in g]))
            for k, g in grouped(
                want, lambda r: (r["pick"], r["when"][2], r["when"][0], r["when"][1])
            ).items()
        },
    )

    def revenue(group):
        known = [r["total"] for r in group if r["total"] is not None]
        return sum(known) if known else None

    same(
        {tuple(r)[:3]: tuple(r)[3:] for r in marts["mart_finanse"].collect()},
        {
            k: (len(g), revenue(g), mean([r["percent"] for r in g]))
            for k, g in grouped(want, lambda r: (*r["when"][:2], r["pay"])).items()
        },
    )
    same(
        {tuple(r)[:2]: tuple(r)[2:] for r in marts["mart_trasy"].collect()},
        {k: (keys(g),) for k, g in grouped(want, lambda r: (r["pick"], r["drop"])).items()},
    )
