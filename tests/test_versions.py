"""Replacing folders and tables while others read them, and after a writer's death."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from conftest import bag
from tripmill.sinks import tables, versions
from tripmill.sinks.versions import (
    current_folder,
    current_table,
    drop_table,
    names_in,
    read_folder,
    replace_table,
    write_parquet,
)


@pytest.fixture
def at_once(monkeypatch):
    """Versions go as soon as they are neither the current nor the previous one."""
    monkeypatch.setattr(versions, "KEPT_SECONDS", 0)


class Killed(BaseException):
    """Stands for the death of the driver: nothing cleans up after it."""


def die(*args, **kwargs):
    raise Killed


def polled(read, replace, times=5):
    """What a reader sees that polls while ``replace(i)`` runs ``times`` times."""
    seen, errors, over = [], [], threading.Event()

    def poll():
        while not over.is_set():
            try:
                seen.append(read())
            except Exception as error:
                errors.append(error)

    reader = threading.Thread(target=poll)
    reader.start()
    try:
        for i in range(1, times + 1):
            before = len(seen)
            replace(i)
            # Let the reader finish one reading for each replacement at least.
            for _ in range(600):
                if len(seen) > before or errors:
                    break
                time.sleep(0.05)
    finally:
        over.set()
        reader.join()
    return seen, errors


def whole(seen):
    """Whether each reading is of one version, and versions follow each other."""
    return all(n == 100 and lo == hi for n, lo, hi in seen) and [x[1] for x in seen] == sorted(
        x[1] for x in seen
    )


def version(spark, i):
    return spark.range(0, 100, 1, 4).select("id", F.lit(i).alias("i"))


def summary(df):
    return tuple(df.agg(F.count("*"), F.min("i"), F.max("i")).first())


def test_a_reader_polls_through_replaced_folders(spark, tmp_path):
    path = f"{tmp_path}/mart"
    write_parquet(version(spark, 0), path)
    seen, errors = polled(
        lambda: summary(read_folder(spark, path)), lambda i: write_parquet(version(spark, i), path)
    )
    assert not errors and whole(seen) and len({x[1] for x in seen}) > 1
    # All were replaced within the hour.
    assert len(names_in(spark, f"{path}/_runs")) == 6


def test_a_reader_polls_through_replaced_tables(spark):
    replace_table(version(spark, 0), "polled_table")
    seen, errors = polled(
        lambda: summary(spark.table("polled_table")),
        lambda i: replace_table(version(spark, i), "polled_table"),
    )
    assert not errors and whole(seen) and len({x[1] for x in seen}) > 1
    left = [t.name for t in spark.catalog.listTables() if "polled_table" in t.name]
    assert len(left) == 1 + 6


def test_a_reader_that_began_before_a_replacement_ends(spark, tmp_path):
    replace_table(version(spark, 0), "slow_reader")
    write_parquet(version(spark, 0), f"{tmp_path}/slow")
    table, folder = spark.table("slow_reader"), read_folder(spark, f"{tmp_path}/slow")
    replace_table(version(spark, 1), "slow_reader")
    write_parquet(version(spark, 1), f"{tmp_path}/slow")
    assert summary(table) == summary(folder) == (100, 0, 0)
    assert summary(spark.table("slow_reader")) == (100, 1, 1)


@pytest.mark.parametrize("step", ["put_file", "_sweep_folder"])
def test_the_next_run_repairs_a_folder(spark, tmp_path, monkeypatch, at_once, step):
    path = f"{tmp_path}/mart"
    write_parquet(version(spark, 0), path)
    with monkeypatch.context() as m:
        m.setattr(versions, step, die)
        with pytest.raises(Killed):
            write_parquet(version(spark, 1), path)
    # Before the commit the old rows stand, after it the new ones.
    want = 0 if step == "put_file" else 1
    assert summary(read_folder(spark, path)) == (100, want, want)
    assert len(names_in(spark, f"{path}/_runs")) == 2
    write_parquet(version(spark, 2), path)
    write_parquet(version(spark, 3), path)
    assert summary(read_folder(spark, path)) == (100, 3, 3)
    assert names_in(spark, f"{path}/_runs") == names_in(spark, f"{path}/_commits")
    assert len(names_in(spark, f"{path}/_runs")) == versions.KEPT


@pytest.mark.parametrize("step", ["set_view", "_sweep_tables"])
def test_the_next_run_repairs_a_table(spark, monkeypatch, at_once, step):
    name = f"dead_{step}"
    replace_table(version(spark, 0), name)
    with monkeypatch.context() as m:
        m.setattr(versions, step, die)
        with pytest.raises(Killed):
            replace_table(version(spark, 1), name)
    want = 0 if step == "set_view" else 1
    assert summary(spark.table(name)) == (100, want, want)
    replace_table(version(spark, 2), name)
    replace_table(version(spark, 3), name)
    assert summary(spark.table(name)) == (100, 3, 3)
    left = [t.name for t in spark.catalog.listTables() if name in t.name]
    assert len(left) == 1 + versions.KEPT


def test_versions_stay_for_a_while(spark, tmp_path, monkeypatch):
    made = {f"{i}": t for i, t in enumerate([0, 100, 4000, 5000, 5100])}
    assert versions._outdated(list(made), made) == ["0"]
    monkeypatch.setattr(versions, "KEPT_SECONDS", 1000)
    assert versions._outdated(list(made), made) == ["0", "1"]
    monkeypatch.setattr(versions, "KEPT_SECONDS", 0)
    assert versions._outdated(list(made), made) == ["0", "1", "2"]
    assert versions._outdated(["0"], made) == versions._outdated([], made) == []


def test_folders_of_a_dead_writer_go(spark):
    """A driver that dies inside the write leaves a folder that the catalog does not know."""
    replace_table(version(spark, 0), "half_written")
    folder = spark.catalog.getDatabase(spark.catalog.currentDatabase()).locationUri
    orphan = f"{folder}/v000000002_abcdef__half_written"
    version(spark, 1).write.parquet(orphan)
    replace_table(version(spark, 2), "half_written")
    assert summary(spark.table("half_written")) == (100, 2, 2)
    assert "v000000002_abcdef__half_written" not in names_in(spark, folder)


def test_a_plain_table_and_a_plain_folder_are_taken_over(spark, tmp_path):
    version(spark, 0).write.saveAsTable("was_plain")
    assert current_table(spark, "was_plain") is None
    replace_table(version(spark, 1), "was_plain")
    assert summary(spark.table("was_plain")) == (100, 1, 1)
    path = f"{tmp_path}/plain"
    version(spark, 0).write.parquet(path)
    assert current_folder(spark, path) is None
    assert summary(read_folder(spark, path)) == (100, 0, 0)
    for i in (1, 2):
        write_parquet(version(spark, i), path)
        assert summary(read_folder(spark, path)) == (100, i, i)
    assert [n for n in names_in(spark, path) if n[0] not in "._"] == []


def test_a_replaced_table_may_change_its_columns(spark):
    replace_table(spark.range(3), "wider")
    replace_table(spark.range(4).select("id", F.lit("x").alias("more")), "wider")
    assert bag(spark.table("wider")) == [(i, "x") for i in range(4)]
    drop_table(spark, "wider")
    assert not [t.name for t in spark.catalog.listTables() if "wider" in t.name]


def test_the_staging_view_is_never_gone(spark, make_trips):
    replace_table(make_trips({}), "viewed_trips")
    tables.replace_staging_view(spark, "viewed_trips", "never_gone")
    seen, errors = polled(
        lambda: spark.table("never_gone").count(),
        lambda i: tables.replace_staging_view(spark, "viewed_trips", "never_gone"),
    )
    assert not errors and set(seen) == {1}


def test_schema_names_and_locations_are_quoted(spark, tmp_path):
    place = f"{tmp_path}/it's"
    tables.ensure_schema(spark, "quoted_schema", place)
    assert spark.catalog.getDatabase("quoted_schema").locationUri.endswith("it's")
    replace_table(spark.range(2), "quoted_schema.t")
    replace_table(spark.range(5), "quoted_schema.t")
    assert spark.table("quoted_schema.t").count() == 5
