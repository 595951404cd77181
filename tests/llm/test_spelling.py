import random
import re
import zlib
from collections import Counter

from tripmill.llm import queries, spelling
from tripmill.llm.frames import ship, table


def near(a, b):
    """Whether one replaced, inserted or deleted character makes ``b`` of ``a``."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(
        long[:i] + long[i + 1 :] == short for i in range(len(long))
    )


def plain_variants(counts, factor=10):
    found = {}
    for w, n in counts.items():
        others = sorted(((-m, v) for v, m in counts.items() if near(w, v)))
        form = others[0] if others and -others[0][0] >= factor * n else None
        found[w] = (form and form[1], n, len(others), form and -form[0])
    rows = []
    for w, (form, n, n_near, form_n) in found.items():
        root = w
        while found[root][0]:
            root = found[root][0]
        rows.append((w, form, root, n, n_near, form_n))
    return sorted(rows)


def got(frame):
    return sorted(map(tuple, frame.collect()))


def test_variants_against_all_pairs(spark):
    ship(spark)
    draw = random.Random(3)
    for letters, size in (("ab", 6), ("abcé", 4), ("aÿ÷", 7)):
        counts = {
            "".join(draw.choices(letters, k=draw.randint(1, size))): draw.choice([1, 2, 2, 20, 400])
            for _ in range(250)
        }
        words = spark.createDataFrame(list(counts.items()), "word string, n long")
        assert got(spelling.variants(words)) == plain_variants(counts)


def test_chains_of_forms(spark):
    ship(spark)
    counts = {"aaaaaaa": 2, "aaaaaab": 20, "aaaaabb": 200, "aaaabbb": 2000, "aaabbbb": 20_000}
    counts |= {"zzzzzzzz": 5}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    rows = got(spelling.variants(words))
    assert rows == plain_variants(counts)
    assert {r[2] for r in rows} == {"aaabbbb", "zzzzzzzz"}


def test_words_of_one_prefix_over_many_batches(spark):
    ship(spark)
    letters = [chr(c) for c in range(0xC0, 0x100)] + [chr(c) for c in range(97, 123)]
    counts = {f"same{c}word": 3 + i for i, c in enumerate(letters)} | {"sameword": 1}
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        words = spark.createDataFrame(list(counts.items()), "word string, n long")
        assert got(spelling.variants(words)) == plain_variants(counts)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def plain_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{doc_id}:{w}".encode())
            if h % 31 == 0:
                at = h % len(w)
                w = w[:at] + w[at + 1 :]
            if len(w) >= 7:
                counts[w] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def test_vocabulary_of_the_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    counts = plain_words(rows)
    frame = queries.QUERIES["op13_spelling_variants"](spark, sf_dir)
    result = got(frame)
    assert {r[0]: r[3] for r in result} == counts
    # All pairs, but only between words that share one of their halves.
    halves = {}
    for w in counts:
        for part in {("l", w[: len(w) // 2]), ("l", w[: (len(w) - 1) // 2]), ("l", w[: (len(w) + 1) // 2]),
                     ("r", w[len(w) // 2 :]), ("r", w[(len(w) - 1) // 2 :]), ("r", w[(len(w) + 1) // 2 :])}:
            halves.setdefault(part, set()).add(w)
    close = {}
    for group in halves.values():
        for a in group:
            close.setdefault(a, set()).update(b for b in group if near(a, b))
    for w, form, root, n, n_near, form_n in result:
        assert n_near == len(close[w])
        best = min(((-counts[v], v) for v in close[w]), default=None)
        if best and -best[0] >= 10 * n:
            assert (form, form_n) == (best[1], -best[0])
        else:
            assert form is None and form_n is None and root == w
    assert any(r[1] for r in result)


def test_defined_cases(spark):
    ship(spark)
    rows = [
        (1, None, 1), (None, "Ärgerlich ärgerlich ÄRGERLICH", 1), (2, "", 1),
        (3, "WordsWords wordswords", 1), (3, "WordsWords wordswords", 1), (4, "longword " * 9000, 1),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word int")
    words = {r["word"]: r["n"] for r in spelling.vocabulary(docs).collect()}
    # Only ASCII letters are lower-cased, also in a word that is all capitals.
    assert words == {"wordswords": 4, "longword": 9000, "Ärgerlich": 2}
    everything = {r["word"] for r in spelling.vocabulary(docs, least_count=1).collect()}
    assert everything == {"Ärgerlich", "ärgerlich", "wordswords", "longword"}
    assert spelling.variants(spelling.vocabulary(docs.limit(0))).count() == 0
