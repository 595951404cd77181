import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tripmill.llm import id_files, packing, queries, tokens
from tripmill.llm.frames import scratch_dir, ship

ODD = [
    (3, "plain words here"),
    (1, None),
    (2, ""),
    (2, ""),
    (None, "no id"),
    (7, "  two  spaces\t and\n\nlines \n"),
    (9, "it's <|endoftext|> spelt out, näive — 漢字 \x1c x"),
    (11, "long " * 3000),
]


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(queries.TOKENIZER)


def expected(plain, text):
    return [*plain.encode(text or "", add_special_tokens=False).ids, queries.END_ID]


def odd_docs(spark):
    ship(spark)
    rows = [(i, t, "x", 5) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, uid string, bin int")


def test_words_give_the_ids_of_whole_texts(plain):
    letters = list("ab Z é\n\t  ',.!’ß漢1 23 's") + ["-", "\x85", "\xa0", "<|endoftext|>"]
    draw = random.Random(5)
    encoder = tokens.Encoder(queries.TOKENIZER, queries.END_ID)
    for _ in range(4000):
        text = "".join(draw.choices(letters, k=draw.randint(0, 14)))
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == expected(plain, text), text


def test_texts_share_the_words_that_are_merged(plain, monkeypatch):
    encoder = tokens.Encoder(queries.TOKENIZER, queries.END_ID)
    monkeypatch.setattr(tokens, "GROUP_CHARS", 60)
    texts = [None, "", "a tree, a tree. TREE", "x tree; (tree) d'été, été\ntree!", "tree", "y é..."]
    texts = [t or "" for t in texts] + [f"b tree{'!?'[i % 2] * (i % 9)}" for i in range(50)]
    found = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode_all(texts)]
    assert found == [expected(plain, t) for t in texts]
    assert encoder.encode_all([]) == []
    # One entry for a word, whatever marks follow it.
    assert [w for w in encoder._words if w.startswith("tree")] == ["tree"]


def test_a_worker_keeps_one_cache(plain):
    from tripmill.llm import frames

    encoder = tokens.encoder(queries.TOKENIZER, queries.END_ID)
    assert tokens.encoder(queries.TOKENIZER, queries.END_ID) is encoder
    assert frames.kept_for("another", dict) == {} and list(frames._KEPT) == ["another"]
    assert tokens.encoder(queries.TOKENIZER, queries.END_ID) is not encoder
    assert list(frames.slices(iter([]))) == [] and not frames._KEPT


def test_kept_words_may_run_out(plain, monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_BYTES", 1000)
    encoder = tokens.Encoder(queries.TOKENIZER, queries.END_ID)
    text = " ".join(f"word{i % 7}, again{i % 11}" for i in range(60))
    for _ in range(2):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == expected(plain, text)


@pytest.mark.parametrize("n", [0, 1, 4, 5, 1000])
def test_block_round_trip(n):
    draw = np.random.default_rng(n)
    ranks = (draw.integers(0, 1 << 32, n) >> draw.integers(0, 32, n)).astype("<u4")
    control, data = id_files.encode_block(ranks)
    assert len(control) == -(-n // 4)
    lengths = [max(1, (int(r).bit_length() + 7) // 8) for r in ranks]
    assert len(data) == sum(lengths)
    assert id_files.decode_block(control, data, n).tolist() == ranks.tolist()


def test_file_round_trip(tmp_path):
    ranks = np.arange(200_000, dtype="<u4") % 70_000
    path = f"{tmp_path}/a/b.bin"
    id_files.write_file(path, [5, None], [3, 199_997], ranks)
    docs, counts, back = id_files.read_file(path)
    assert docs == [5, None] and counts.tolist() == [3, 199_997]
    assert back.tolist() == ranks.tolist()
    assert [p.name for p in (tmp_path / "a").iterdir()] == ["b.bin"]


def read_back(spark, docs, **how):
    work = scratch_dir(spark)
    files, ids_of = id_files.write_token_files(
        docs, queries.TOKENIZER, f"{work}/f", queries.END_ID, queries.VOCABULARY, work=work, **how
    )
    return id_files.read_token_files(files, ids_of).collect()


@pytest.mark.parametrize("shard_ids", [1 << 23, 500])
def test_token_files(spark, plain, shard_ids):
    rows = read_back(spark, odd_docs(spark), shard_ids=shard_ids)
    want = sorted(
        ((-1 if i is None else i, expected(plain, t)) for i, t in ODD), key=lambda x: x[0]
    )
    got = sorted(rows, key=lambda r: r.start)
    assert [-1 if r.doc_id is None else r.doc_id for r in got] == [i for i, _ in want]
    at = 0
    for row, (_, ids) in zip(got, want, strict=True):
        assert (row.start, row.n_tokens) == (at, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)


def test_token_files_of_an_empty_table(spark):
    assert read_back(spark, odd_docs(spark).limit(0)) == []


def test_cut_leaves_only_the_first_piece_short():
    assert packing.cut(5, 10) == [(0, 5)]
    assert packing.cut(20, 10) == [(0, 10), (10, 10)]
    assert packing.cut(23, 10) == [(0, 3), (3, 10), (13, 10)]


def brute_best_fit(sizes, capacity):
    bins = []
    for size in sorted(sizes, reverse=True):
        fitting = [b for b in bins if sum(b) + size <= capacity]
        if fitting:
            max(fitting, key=sum).append(size)
        else:
            bins.append([size])
    return sorted(sorted(map(sum, bins)))


@pytest.mark.parametrize("seed", range(5))
def test_best_fit_equals_brute_force(seed):
    draw = random.Random(seed)
    sizes = [draw.randint(1, 40) for _ in range(200)]
    places = packing.best_fit(sizes, 50)
    fill = {}
    for size, (bin_, at) in sorted(zip(sizes, places, strict=True), key=lambda x: x[1]):
        assert at == fill.get(bin_, 0)
        fill[bin_] = at + size
    assert max(fill.values()) <= 50
    assert sorted(fill.values()) == brute_best_fit(sizes, 50)


def check_packing(rows, capacity):
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


@pytest.mark.parametrize("group_items", [40_000, 40])
def test_pack_documents(spark, plain, group_items):
    draw = random.Random(1)
    texts = [(i, "word " * draw.randint(0, 60)) for i in range(600)]
    docs = odd_docs(spark).select("doc_id", "text", "uid", "bin").union(
        spark.createDataFrame([(100 + i, t, "x", 1) for i, t in texts], "doc_id long, text string, uid string, bin int")
    )
    rows = packing.pack_documents(
        docs, queries.TOKENIZER, queries.END_ID, capacity=64, group_items=group_items
    ).collect()
    n = check_packing(rows, 64)
    total = sum(r.length for r in rows)
    assert n <= 1.05 * -(-total // 64) + 2
    whole = {i: expected(plain, t) for i, t in ODD if i not in (2,)}
    for row in rows:
        if row.doc_id in whole:
            ids = whole[row.doc_id][row.start : row.start + row.length]
            assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
    assert sum(r.length for r in rows if r.doc_id == 11) == len(whole[11])
    assert sum(r.doc_id == 2 for r in rows) == 2


def test_half_full_bins_stop_the_rounds(spark):
    """Pieces that can never share a sequence are packed one by one, and it ends."""
    pieces = spark.range(500).selectExpr("id AS uid", "id AS doc_id", "40L AS length")
    rows = packing.pack(pieces, 64, group_items=50).collect()
    assert check_packing(rows, 64) == 500


def test_pack_an_empty_table(spark):
    docs = odd_docs(spark).limit(0)
    assert packing.pack_documents(docs, queries.TOKENIZER, queries.END_ID).collect() == []


def test_very_long_texts(spark, plain):
    ship(spark)
    draw = random.Random(3)
    text = " ".join(f"w{draw.randrange(5000)}," for _ in range(250_000))
    docs = spark.createDataFrame([(2, text), (1, "a b")], "doc_id long, text string")
    ids = expected(plain, text)
    pieces = packing.pack_documents(docs, queries.TOKENIZER, queries.END_ID).filter("doc_id = 2")
    rows = sorted(pieces.select("piece", "start", "length", "ids_crc32").collect())
    assert len(rows) == -(-len(ids) // 1024)
    for piece, start, length, crc in rows[:3] + rows[-3:]:
        own = np.array(ids[start : start + length], "<u4").tobytes()
        assert zlib.crc32(own) == crc
    files, ids_of = id_files.write_token_files(
        docs, queries.TOKENIZER, f"{scratch_dir(spark)}/files", queries.END_ID, queries.VOCABULARY
    )
    back = {r.doc_id: r for r in id_files.read_token_files(files, ids_of).collect()}
    assert back[2].n_tokens == len(ids) and back[2].start == back[1].n_tokens
    assert back[2].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
