import sys

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF_DIR
from tripmill.llm import exact_dedup, near_dedup, queries, secret_scan, toxicity
from tripmill.llm.frames import keep, scratch_dir, table


@pytest.fixture(scope="module")
def steps(spark):
    """What each stage is given and returns, over the small tables."""
    docs, out = table(spark, SF_DIR, "documents"), {}
    work = scratch_dir(spark)
    for name, stage in corpus_pipeline.STAGES:
        after = keep(stage(spark, docs, SF_DIR), work, name)
        out[name] = (docs, after)
        docs = after
    return out


def test_stages_in_order():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "near_dedup", "secret_scan", "best_fit_packing"]


def test_columns_stay(steps):
    for name in list(steps)[:-1]:
        before, after = steps[name]
        assert after.columns == before.columns
        assert [f.dataType for f in after.schema] == [f.dataType for f in before.schema]


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_each_decision_takes_effect(spark, steps):
    before, after = steps["toxicity"]
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    marks = toxicity.toxicity(before, table(spark, SF_DIR, "labels"), held)
    assert ids(after) == ids(marks.filter("predicted = 0"))
    before, after = steps["exact_dedup"]
    assert ids(after) == ids(exact_dedup.exact_copies(before).filter("kept"))
    before, after = steps["near_dedup"]
    found = near_dedup.near_copies(before, threshold=80)
    assert ids(after) == sorted({r.component_id for r in found.collect()})
    before, after = steps["secret_scan"]
    texts = {r.doc_id: r.text for r in after.collect()}
    rank = secret_scan.known_words(before)
    assert texts == {r.doc_id: secret_scan.redacted(r.text, rank=rank) for r in before.collect()}
    before, after = steps["best_fit_packing"]
    assert set(ids(after.select("doc_id").distinct())) == set(ids(before))
    assert after.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 1024").count() == 0


def test_run_gives_the_last_stage(spark, steps):
    got = corpus_pipeline.run(spark, SF_DIR)
    want = steps["best_fit_packing"][1]
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(
        map(tuple, want.select(columns).collect())
    )


def odd(spark, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long, uid long, kept string"
    return spark.createDataFrame([(i, t, None, "s", n, 1, "k") for i, t, n in rows], schema)


def test_stages_take_odd_tables(spark):
    rows = [(1, None, None), (1, None, None), (None, "", 0), (2, "a b", 3), (2, "a b", 3), (3, "token = abcdefgh1", 17)]
    for table_rows in (rows, []):
        docs = odd(spark, table_rows)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF_DIR)
            docs = keep(docs, scratch_dir(spark), "odd")
        assert docs.count() == (3 if table_rows else 0)


def test_entry_registers_every_operator():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert set(queries.QUERIES) <= names and "pipeline" in names
    assert {name.split("_")[0] for name in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert "corpus_pipeline" in sys.modules
