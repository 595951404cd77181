import hashlib
import random
import re

import numpy as np
import pytest

from tripmill.llm import exact_dedup, near_dedup
from tripmill.llm.components import components
from tripmill.llm.frames import scratch_dir, ship

SCHEMA = "doc_id long, text string, kept string, digest long, entry int"


def frame(spark, rows):
    ship(spark)
    return spark.createDataFrame([(i, t, "no", 1, 2) for i, t in rows], SCHEMA)


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


ROWS = [
    (5, "a  b"), (2, "a b"), (9, "a\t\nb"), (4, None), (3, ""), (7, " "), (8, "\n"),
    (6, "A b"), (None, "a b"), (None, "alone"), (1, "same row"), (1, "same row"),
    (10, "x" * 300_000), (11, "x" * 300_000), (12, "a b"), (13, "a b"),
]


def test_exact_copies_equal_brute_force(spark):
    rows = exact_dedup.exact_copies(frame(spark, ROWS)).collect()
    groups = {}
    for i, t in ROWS:
        groups.setdefault(normal(t), []).append(i)
    assert len(rows) == len(ROWS)
    by_text = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for row in rows:
        ids = by_text[row.text_sha256]
        known = [i for i in ids if i is not None]
        assert row.group_size == len(ids)
        assert row.keep_id == (min(known) if known else None)
    for sha, ids in by_text.items():
        own = [r for r in rows if r.text_sha256 == sha]
        assert sorted(map(str, (r.doc_id for r in own))) == sorted(map(str, ids))
        assert sum(r.kept for r in own) == 1
        assert all(r.doc_id == r.keep_id for r in own if r.kept)


def test_buckets_split_and_chains_do_not(spark, monkeypatch):
    rows = [(i, f"text {i % 300}") for i in range(900)] + [(1000 + i, "hot") for i in range(500)]
    held = exact_dedup.HELD_BYTES
    assert held > 0
    index = exact_dedup.Index(scratch_dir(spark), rows=8, bytes_=1 << 30)
    docs = frame(spark, rows)
    keyed = exact_dedup.as_text(docs, "doc_id", "text").selectExpr(
        "doc_id", "xxhash64(text) AS digest", "unhex(sha2(text, 256)) AS key",
        "encode(text, 'UTF-8') AS text",
    )
    index.add(keyed.mapInArrow(exact_dedup._local_entries, exact_dedup._ROWS), 1)
    buckets = [tuple(r) for r in index.leaves.collect()]
    depths = {bits for bits, _, _ in buckets}
    assert max(depths) > 4
    # The leaves cover every key once.
    leaves = sorted((prefix << (60 - bits), 1 << (60 - bits)) for bits, prefix, _ in buckets)
    assert all(a + size <= b for (a, size), (b, _) in zip(leaves, leaves[1:]))
    # Owners read each leaf once, in ranges of keys.
    owned = index.owners(spark).collect()
    paths = [p for r in owned for p in r.paths]
    assert sorted(paths) == sorted(f"{index.folder(b)}/bucket={p}" for b, p, _ in buckets)
    found = exact_dedup.exact_copies(docs, bucket_rows=8).collect()
    assert sum(r.kept for r in found) == 301
    assert {r.group_size for r in found} == {3, 500}


def test_more_rows_than_are_worked_on_at_a_time(spark):
    rows = [(i, f"text {i % 1500}") for i in range(2000)]
    docs = frame(spark, rows).coalesce(1)
    found = exact_dedup.exact_copies(docs).collect()
    assert sorted((r.doc_id, r.keep_id) for r in found) == [(i, i % 1500) for i in range(2000)]
    near = near_dedup.near_copies(docs).collect()
    assert sorted((r.doc_id, r.component_id) for r in near) == [(i, i % 1500) for i in range(2000)]


def test_equal_keys_with_unlike_bytes_stay_apart():
    import pyarrow as pa

    key = pa.array([b"k" * 32] * 4, pa.binary())
    text = pa.array([b"one", b"two", b"one", b"two"], pa.binary())
    batch = pa.record_batch({
        "doc_id": pa.array([1, 2, 3, 4]), "digest": pa.array([1, 2, 1, 2]), "key": key, "text": text,
    })
    (out,) = exact_dedup._local_entries(iter([batch]))
    entry = out.column("entry").to_pylist()
    assert entry[0] == entry[2] and entry[1] == entry[3] and entry[0] != entry[1]


def test_without_copies_keeps_columns_and_one_row_of_each(spark):
    kept = exact_dedup.without_copies(frame(spark, ROWS))
    assert kept.columns == ["doc_id", "text", "kept", "digest", "entry"]
    got = sorted((normal(r.text), str(r.doc_id)) for r in kept.collect())
    least = {}
    for i, t in ROWS:
        key = normal(t)
        least[key] = min(least.get(key, (True, 0)), (i is None, i or 0))
    assert got == sorted((t, "None" if none else str(i)) for t, (none, i) in least.items())


def test_empty_tables(spark):
    empty = frame(spark, ROWS).limit(0)
    assert exact_dedup.exact_copies(empty).collect() == []
    assert exact_dedup.without_copies(empty).collect() == []
    assert near_dedup.near_copies(empty).collect() == []


def words(text):
    lower = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def brute_set(text):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def brute_components(rows, threshold):
    """For each row its set's size and the smallest id that can be reached."""
    sets = [brute_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= threshold * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        r = find(i)
        least[r] = min(least.get(r, (True, 0)), (doc_id is None, doc_id or 0))
    return [(len(sets[i]), least[find(i)]) for i in range(len(rows))]


def near_rows(seed):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for base in range(12):
        text = draw.choices(vocabulary, k=draw.randint(30, 150))
        for _ in range(draw.choice([1, 2, 12])):
            own = list(text)
            for _ in range(draw.randint(0, 5)):
                own[draw.randrange(len(own))] = draw.choice(vocabulary)
            rows.append(" ".join(own))
    draw.shuffle(rows)
    rows += [rows[0], rows[0].upper(), "", None, "one two", "one  TWO", "three", "\n\t"]
    return [(i * 3 + 1, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize(("seed", "threshold"), [(1, 85), (2, 80)])
def test_near_copies_equal_brute_force(spark, seed, threshold):
    rows = near_rows(seed)
    found = near_dedup.near_copies(frame(spark, rows), threshold=threshold).collect()
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found}
    want = brute_components(rows, threshold)
    assert got == {i: (n, c, c == i) for (i, _), (n, (_, c)) in zip(rows, want, strict=True)}


def test_near_copies_without_or_with_equal_ids(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(None, text), (None, text + " end"), (4, text), (4, text), (None, "other words")]
    found = near_dedup.near_copies(frame(spark, rows)).collect()
    one = [r for r in found if r.n_shingles > 2]
    assert {r.component_id for r in one} == {4} and sum(r.kept for r in one) == 1
    kept = near_dedup.without_near_copies(frame(spark, rows)).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["4", "None"]


def test_large_buckets_are_cut_into_blocks(spark, monkeypatch):
    """A group of near copies of which few are linked directly, in small blocks."""
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    draw = random.Random(3)
    text = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(60):
        own = list(text)
        for at in draw.sample(range(80), 2):
            own[at] = f"x{draw.randrange(4)}"
        rows.append((i, " ".join(own)))
    found = near_dedup.near_copies(frame(spark, rows), threshold=80).collect()
    want = brute_components(rows, 80)
    assert {r.doc_id: r.component_id for r in found} == {
        i: c for (i, _), (_, (_, c)) in zip(rows, want, strict=True)
    }


def test_signature_estimates_similarity():
    draw = random.Random(9)
    for share in (0.3, 0.6, 0.9):
        errors = []
        for _ in range(20):
            both = [draw.getrandbits(64) for _ in range(int(600 * share))]
            rest = [draw.getrandbits(64) for _ in range(600 - len(both))]
            sets = [np.array(both + rest[k::2], np.uint64) for k in (0, 1)]
            a, b = (np.frombuffer(near_dedup.packed(near_dedup.minima(s)), np.uint8) for s in sets)
            errors.append(near_dedup.estimate(near_dedup.equal_fields(a, b)) - share)
        assert abs(np.mean(errors)) < 0.03


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 60)] + [(500, 500)]
    ship(spark)
    df = spark.createDataFrame(links, "x long, y long")
    got = {r.node: r.root for r in components(df, scratch_dir(spark)).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 7 for i in range(7, 60)}


def test_buckets_of_other_members_stay_apart(spark):
    from pyspark.sql import functions as F

    # The lowest 40 bits of the hashes of either pair have the same sum.
    buckets = {1: (1550, 2666), 2: (3068, 3673), 3: (3673, 3068), 4: (7, 8)}
    rows = spark.createDataFrame(
        [(key, node, 7 if key == 4 else node) for key, own in buckets.items() for node in own],
        "key long, node long, root long",
    )
    old = rows.groupBy("key").agg(F.sum(F.xxhash64("node") % (1 << 40)).alias("mark"))
    assert old.filter("key < 4").select("mark").distinct().count() == 1
    found = near_dedup._spanning(rows).collect()
    assert sorted((r.key, r.blocks) for r in found) == [(1, 1), (2, 1)]


@pytest.mark.parametrize("threshold", [80, 85])
def test_no_link_of_small_sets_is_lost(spark, threshold):
    """Thousands of pairs of 4 to 30 shingles, at the threshold and next to it."""
    draw = random.Random(threshold)
    rows, linked_pairs = [], set()
    for pair in range(4000):
        n = draw.randint(4, 30)
        # The longer text has ``more`` further shingles: n / (n + more).
        at = n * (100 - threshold) // threshold
        more = max(1, at + draw.choice([-1, 0, 0, 0, 1]))
        text = [f"{draw.getrandbits(40):x}" for _ in range(n + 4 + more)]
        rows += [(2 * pair, " ".join(text[: n + 4])), (2 * pair + 1, " ".join(text))]
        if 100 * n >= threshold * (n + more):
            linked_pairs.add(pair)
    assert len(linked_pairs) > 2000
    found = near_dedup.near_copies(frame(spark, rows), threshold=threshold).collect()
    joined = {r.doc_id // 2 for r in found if r.doc_id % 2 and r.component_id == r.doc_id - 1}
    assert joined == linked_pairs
    assert {r.component_id for r in found if not r.doc_id % 2} == set(range(0, 8000, 2))


def test_fields_of_unlike_sets_agree_independently():
    """The spread of equal fields is that of independent fields, also for small sets."""
    draw = np.random.default_rng(5)
    for n, more in ((6, 1), (4, 1), (200, 40)):
        equal = []
        for _ in range(800):
            big = draw.integers(1, 1 << 63, n + more, dtype=np.uint64)
            a, b = (np.frombuffer(near_dedup.packed(near_dedup.minima(np.sort(x))), np.uint8)
                    for x in (big[:n], big))
            equal.append(int(near_dedup.equal_fields(a, b)))
        p = 0.25 + 0.75 * n / (n + more)
        spread = (256 * p * (1 - p)) ** 0.5
        assert abs(np.mean(equal) - 256 * p) < 3
        assert np.std(equal) < 1.6 * spread
    assert near_dedup.least_equal(0.85) < 256 * (0.25 + 0.75 * 0.85) - 7 * 5


def test_very_long_texts(spark):
    draw = random.Random(7)
    text = [f"{draw.getrandbits(32):x}" for _ in range(200_000)]
    changed = list(text)
    for at in range(0, 200_000, 2000):
        changed[at] = "other"
    rows = [(1, " ".join(text)), (2, " ".join(changed)), (3, " ".join(text[:100_000])), (4, " ".join(text))]
    found = {r.doc_id: r for r in near_dedup.near_copies(frame(spark, rows)).collect()}
    # 100 of 200,000 words are in 500 shingles; half a text is no near copy.
    assert [found[i].component_id for i in (1, 2, 3, 4)] == [1, 1, 3, 1]
    assert found[1].n_shingles == len(set(zip(*(text[k:] for k in range(5)), strict=False)))
    assert {r.doc_id: r.keep_id for r in exact_dedup.exact_copies(frame(spark, rows)).collect()} == {
        1: 1, 2: 2, 3: 3, 4: 1,
    }
