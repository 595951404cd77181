import hashlib
import random
import zlib
from fractions import Fraction

import pytest

from tripmill.llm import periods, queries
from tripmill.llm.frames import ship, table


def plain_runs(words, least=6, repeats=4):
    """Runs by trying every period and every stretch."""
    n, found = len(words), []
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            own = words[i : j + q]
            smallest = all(own[d:] != own[: len(own) - d] for d in range(1, q))
            if len(own) >= max(least, repeats * q) and smallest:
                found.append((i, len(own), q))
            i = j + 1
    return sorted(found)


@pytest.mark.parametrize("least, repeats", [(6, 4), (3, 4), (1, 5), (20, 4), (7, 6)])
def test_runs_against_every_period(least, repeats):
    draw = random.Random(least)
    for _ in range(6000):
        few = draw.choice([1, 2, 2, 3, 4])
        words = draw.choices(range(few), k=draw.randint(0, 12))
        for _ in range(draw.randint(0, 3)):
            unit = draw.choices(range(few), k=draw.randint(1, 9))
            words += unit * draw.randint(1, 7) + unit[: draw.randint(0, len(unit))]
        got = periods.periodic_runs(words, least, repeats)
        assert got == plain_runs(words, least, repeats), words


def test_runs_within_runs_and_long_ones():
    line = "- - - - - - - a b c".split()
    words = "x y".split() + line * 50 + "z".split()
    got = periods.periodic_runs(words)
    assert got == plain_runs(words)
    assert len(got) == 51 and (2, 500, 10) in got
    assert periods.periodic_runs(["a"] * 300_000) == [(0, 300_000, 1)]
    two = random.Random(1).choices("ab", k=20_000)
    assert all(n >= max(6, 4 * q) for _, n, q in periods.periodic_runs(two))
    with pytest.raises(ValueError):
        periods.periodic_runs([1, 1], 2, 3)


def test_strongest_and_collapsed():
    words = "a b a b a b a b c c c c c c d".split()
    runs = periods.periodic_runs(words)
    assert runs == [(0, 8, 2), (8, 6, 1)]
    assert periods.strongest(runs) == (8, 6, 1)
    assert periods.collapsed(words, runs) == "a b c d".split()
    assert periods.strongest([(5, 9, 2), (1, 18, 4), (1, 9, 2)]) == (1, 9, 2)
    assert periods.strongest([]) is None


def expected(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words) if len(words) < 400 else periods.periodic_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    milli = 1000 * best[1] // best[2] if runs else None
    return (
        doc_id, len(runs), *best, milli,
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest(),
    )


def test_query_against_every_period(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    got = queries.QUERIES["op12_periodic_runs"](spark, sf_dir).collect()
    want = sorted(expected(*r) for r in rows)
    assert sorted(map(tuple, got)) == want
    assert any(r[1] for r in want)


def test_defined_cases(spark):
    ship(spark)
    rows = [
        (1, None, 1), (2, "", 1), (3, " \t ", 1), (None, "a " * 9, 1), (4, "b\x85 " * 6, 1),
        (4, "b\x85 " * 6, 1), (5, "é " * 40_000, 1),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int")
    got = {(r["doc_id"], r["collapsed"]): r for r in periods.find_runs(docs).collect()}
    assert got[None, "a"]["runs"][0].asDict() == {"start": 0, "length": 9, "period": 1}
    assert got[5, "é"]["strongest"]["length"] == 40_000
    assert got[4, "b\x85"]["strongest"]["length"] == 6
    assert all(not got[i, ""]["runs"] and not got[i, ""]["strongest"] for i in (1, 2, 3))
    assert periods.find_runs(docs).count() == 7
    assert periods.find_runs(docs.limit(0)).count() == 0
