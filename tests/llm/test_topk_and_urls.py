import math
import random

import pytest
from pyspark.sql import functions as F

from tripmill.llm import topk, url_filter
from tripmill.llm.frames import ship

VECTORS = "vec_id long, embedding array<float>, score long, block string"


def vectors(spark, rows):
    ship(spark)
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], VECTORS)


def brute(rows, step, k, scale=256):
    import numpy as np

    sound = [
        (n, i, [math.floor(scale * float(np.float32(x))) for x in v])
        for n, (i, v) in enumerate(rows)
        if i is not None and v is not None
        and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for n, i, v in sound:
        if i % step:
            continue
        scored = sorted(
            (-sum(a * b for a, b in zip(v, w)), j) for m, j, w in sound if m != n
        )[:k]
        out += [(i, rank, j, -s) for rank, (s, j) in enumerate(scored, 1)]
    return sorted(out)


@pytest.mark.parametrize(("seed", "dims"), [(1, 8), (2, 3)])
def test_top_k_equals_brute_force(spark, seed, dims, monkeypatch):
    # Functions are sent by name, so tasks see the module's own sizes.
    draw = random.Random(seed)
    rows = [(i, [draw.gauss(0, 1) for _ in range(dims)]) for i in range(1500)]
    rows[10] = (10, None)
    rows[20] = (20, [1.0, None] + [0.0] * (dims - 2))
    rows[30] = (30, [float("nan")] * dims)
    rows[40] = (40, [float("inf")] * dims)
    rows += [(2000 + i, rows[0][1]) for i in range(700)]
    rows += [(None, rows[0][1]), (50, rows[50][1]), (3000, []), (3050, rows[1][1][:1])]
    got = topk.top_k(vectors(spark, rows), F.col("vec_id") % 50 == 0, k=5)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, 50, 5)


def visited(spark, rows, monkeypatch):
    """The answers, and which share of (query group, block) pairs is visited."""
    kept = {}
    real = topk.keep

    def recorded(df, work, name):
        kept[name] = real(df, work, name)
        return kept[name]

    with monkeypatch.context() as m:
        m.setattr(topk, "keep", recorded)
        got = topk.top_k(vectors(spark, rows), F.col("vec_id") % 20 == 0, k=5)
        found = sorted(map(tuple, got.collect()))
    groups = kept["queries"].select("query_group").distinct().count()
    return found, kept["wanted"].count() / (groups * kept["blocks"].count())


def test_clustered_vectors_are_pruned(spark, monkeypatch):
    draw = random.Random(4)
    centres = [[draw.gauss(0, 4) for _ in range(8)] for _ in range(12)]
    rows = [
        (i, [x + draw.gauss(0, 0.05) for x in centres[draw.randrange(12)]]) for i in range(12_000)
    ]
    found, share = visited(spark, rows, monkeypatch)
    sample = [r for r in found if r[0] % 2000 == 0]
    assert sample == [r for r in brute(rows, 2000, 5)]
    assert share < 0.55
    flat = [(i, [draw.gauss(0, 1) for _ in range(8)]) for i in range(12_000)]
    _, share = visited(spark, flat, monkeypatch)
    assert share > 0.9


def test_top_k_of_few_or_no_rows(spark):
    rows = [(0, [1.0]), (1, [2.0]), (2, [-1.0])]
    got = topk.top_k(vectors(spark, rows), F.col("vec_id") == 0, k=5).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 1, 131072), (0, 2, 2, -65536)]
    empty = vectors(spark, rows).limit(0)
    assert topk.top_k(empty, F.col("vec_id") == 0).collect() == []


def test_large_components_stay_exact(spark):
    rows = [(0, [3e6, 1.0]), (1, [3e6, 2.0]), (2, [3e6, 1.0])]
    got = topk.top_k(vectors(spark, rows), F.col("vec_id") == 0, k=2).collect()
    assert sorted(map(tuple, got)) == brute(rows, 1, 2)[:2]


def test_bounds_hold():
    import numpy as np

    draw = np.random.default_rng(4)
    shape = topk.Shape(6, True)
    block, queries = draw.integers(-50, 50, (40, 6)), draw.integers(-50, 50, (9, 6))
    bound = shape.bounds(queries, block.max(axis=0)[None], block.min(axis=0)[None])
    assert (shape.products(queries, block) <= bound).all()


KEYS = [f"host{i}.example".encode() for i in range(3000)]


@pytest.mark.parametrize("n", [0, 1, 40, 1500, 3000])
def test_cascade_is_exact_over_its_universe(n):
    listed = set(random.Random(n).sample(KEYS, n))
    others = [k for k in KEYS if k not in listed]
    levels = [
        url_filter.Level(c, i) for i, c in enumerate(url_filter.cascade(sorted(listed), others), 1)
    ]
    assert url_filter.listed_in(levels, KEYS).tolist() == [k in listed for k in KEYS]
    assert len(levels) < 40


RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"))
URLS = [
    ("http://WWW.Example.com/en/1?x=/a#b", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
    ("https://m.example.com/en/", "m.example.com", "/en/", "example.com/en/", "block"),
    ("https://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
    ("https://a.com", "a.com", "", None, "allow"),
    ("ftp://spam.org?x://y/z", "spam.org", "", None, "block"),
    ("no scheme", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("x://", "", "", None, "allow"),
    ("a://b.org#c://com/", "b.org", "", None, "allow"),
    ("s3://ÄB.org/p\n/q", "Äb.org", "/p\n/q", None, "allow"),
]


@pytest.mark.parametrize("sent_bytes", [1 << 20, 0])
def test_urls(spark, sent_bytes):
    ship(spark)
    pages = [(i, u, "x", "y") for i, (u, *_) in enumerate(URLS)] * 2 + [(None, "x://spam.org", "", "")]
    df = spark.createDataFrame(pages, "page_id long, url string, key string, listed string")
    got = url_filter.judge(
        df, RULES, F.col("key").contains("spam"), sent_bytes=sent_bytes, shard_keys=2
    ).collect()
    want = [(i, *rest) for i, (_, *rest) in enumerate(URLS)] * 2
    want.append((None, "spam.org", "", None, "block"))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_no_pages(spark):
    ship(spark)
    df = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge(df, RULES, F.lit(True)).collect() == []
