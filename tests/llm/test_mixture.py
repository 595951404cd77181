import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripmill.llm import mixture, queries
from tripmill.llm.frames import ship, table

ROWS = [
    (4, "one two three four five six seven", "a"),
    (None, "no id at all", "a"),
    (2, "", "a"),
    (2, None, "b"),
    (9, "x\ty\x0bz\xa0z", None),
    (5, "same words", "b"),
    (5, "same words", "b"),
    (7, " ".join(f"w{i}" for i in range(30_000)), "c"),
    (8, "word " * 5000, "hot"),
]


def docs(spark, rows=ROWS):
    ship(spark)
    extra = [(i, t, s, 1, "at", 7) for i, t, s in rows]
    return spark.createDataFrame(
        extra, "doc_id long, text string, source string, block int, at string, start int"
    )


def by_five_two_one(sources):
    return [(5, 2, 1)[i % 3] for i in range(len(sources))]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 63, 64, 65, 1000])
def test_permutation_is_one(n):
    order = mixture.Permutation(n, (3, n))
    assert sorted(order.at(np.arange(n))) == list(range(n))
    assert [order.place(int(x)) for x in order.at(np.arange(min(n, 70)))] == list(range(min(n, 70)))


def test_targets_share_out_what_is_cut_off():
    draw = random.Random(2)
    for _ in range(300):
        sizes = [draw.choice([0, 1, 5, 100, 10_000]) for _ in range(draw.randint(1, 9))]
        weights = by_five_two_one(sizes)
        got = mixture.targets(sizes, weights, 3)
        assert sum(got) == pytest.approx(sum(sizes))
        # Sources below their cap share by weight, and no one at the cap would get less.
        rate = [Fraction(g) / w for g, w in zip(got, weights, strict=True)]
        free = [r for r, g, s in zip(rate, got, sizes, strict=True) if g < 3 * s]
        assert all(g <= 3 * s for g, s in zip(got, sizes, strict=True))
        if free:
            assert float(max(free)) == pytest.approx(float(min(free)))
            assert all(float(r) <= float(free[0]) * (1 + 1e-9) for r in rate)


def test_share_takes_exactly_the_words():
    draw = random.Random(4)
    for _ in range(2000):
        size, block, seed = draw.randint(1, 60), draw.choice([1, 3, 8, 100]), draw.randint(0, 9)
        taken = draw.randint(0, 3 * size)
        mine = mixture.share(0, size, taken, block, seed)
        words = 0
        for number in range(mine.slots):
            epoch, place = divmod(number, mine.blocks)
            at = int(mixture.Permutation(mine.blocks, (seed, 0, epoch)).at(np.array([place]))[0])
            length = min(block, size - at * block)
            words += min(length, mine.last) if number == mine.slots - 1 else length
        assert words == taken


def test_mix_by_hand(spark):
    made = mixture.mix(docs(spark), by_five_two_one, block=8, shard=32, seed=3, texts=True)
    mixed = made.mixed().collect()
    sources = {r["source_no"]: r for r in made.sources.collect()}
    assert [sources[i]["source"] for i in range(5)] == ["a", "b", "c", "hot", None]
    # Slots are numbered without gaps and every shard but the last is full.
    shards = Counter(r["shard"] for r in mixed)
    assert set(shards) == set(range(len(shards))) and len(shards) > 100
    assert all(n == 32 for shard, n in shards.items() if shard < len(shards) - 1)
    assert len({(r["shard"], r["slot"]) for r in mixed}) == len(mixed)
    # Each time a source is gone through, no block comes twice, and none comes a second
    # time before all came once.
    uses = Counter((r["source_no"], r["epoch"], r["block"]) for r in mixed)
    assert set(uses.values()) == {1}
    for no, s in sources.items():
        epochs = Counter(e for n, e, _ in uses if n == no)
        blocks = -(-s["source_size"] // 8)
        assert all(n == blocks for e, n in epochs.items() if e < max(epochs))
    # Segments hold the words they name.
    texts = {(i, t or "") for i, t, _ in ROWS}
    for r in mixed[:3000]:
        for s in r["segments"]:
            own = [t.encode().split() for i, t in texts if i == s["doc_id"]]
            cut = [b" ".join(w[s["first"] : s["first"] + s["words"]]).decode() for w in own]
            assert s["text"] in cut
    # Shards differ by chance; the whole mix has the words of its targets.
    hot = Counter(r["shard"] for r in mixed if sources[r["source_no"]]["source"] == "hot")
    assert len({hot[shard] for shard in range(20)}) > 2
    taken = Counter()
    for r in made.taken().collect():
        taken[r["source"]] += r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    for s in sources.values():
        assert taken[s["source"]] == round(s["target"])
    assert made.taken().count() == len(ROWS)


def test_taken_agrees_with_the_mix_and_with_reruns(spark):
    made = mixture.mix(docs(spark), by_five_two_one, block=8, shard=32, seed=3)
    words = Counter()
    for r in made.mixed().collect():
        for s in r["segments"]:
            words[s["doc_id"], r["source_no"]] += max(0, min(s["words"], r["words"] - s["at"]))
    taken = Counter()
    no = {r["source"]: r["source_no"] for r in made.sources.collect()}
    rows = made.taken().collect()
    for r in rows:
        taken[r["doc_id"], no[r["source"]]] += r["taken"]
    assert +taken == +words
    again = mixture.mix(
        docs(spark).repartition(7, F.rand(1)), by_five_two_one, block=8, shard=32, seed=3
    ).taken()
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(map(tuple, rows), key=repr)
    other = mixture.mix(docs(spark), by_five_two_one, block=8, shard=32, seed=4)
    assert set(map(tuple, other.slots.collect())) != set(map(tuple, made.slots.collect()))


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "", "a"), (1, "", "a")]])
def test_nothing_to_mix(spark, rows):
    made = mixture.mix(docs(spark, rows), by_five_two_one)
    got = [(r["size"], r["taken"], r["target"]) for r in made.taken().collect()]
    assert got == [(0, 0, 0.0)] * len(rows)
    assert made.mixed().count() == 0


def test_query_against_sizes_of_texts(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = queries.QUERIES["op11_mixture"](spark, sf_dir).collect()
    given = {
        r["doc_id"]: (len((r["text"] or "").encode().split()), r["source"])
        for r in table(spark, sf_dir, "documents").collect()
    }
    sizes, taken, goals = Counter(), Counter(), {}
    for size, source in given.values():
        sizes[source] += size
    for r in rows:
        size, source = given.pop(r["doc_id"])
        assert r["size"] == size and r["source_size"] == sizes[source]
        assert r["taken"] <= 3 * size
        taken[source] += r["taken"]
        goals[source] = r["target"]
    assert not given
    names = sorted(sizes)
    expected = mixture.targets([sizes[n] for n in names], by_five_two_one(names), 3)
    assert [goals[n] for n in names] == expected
    assert all(taken[n] == round(goals[n]) for n in names)
