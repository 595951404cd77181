"""Runs that were interrupted and go on."""

import pytest

from checks.trips_view import SCENARIOS, trips as trips_view, zones as zones_view
from conftest import SF_DIR, bag
from tripmill.cli import main
from tripmill.plans import runs
from tripmill.schema import MARTS
from tripmill.sinks import tables, versions
from tripmill.sinks.versions import current_folder, current_table, replace_table

SMALL = SCENARIOS["small"]


class Killed(BaseException):
    pass


@pytest.fixture(scope="module")
def inputs(spark):
    return trips_view(spark, SF_DIR), zones_view(spark, SF_DIR)


def folders(spark, root):
    paths = [runs.raw_path(root, "small"), *runs.mart_paths(root, "small").values()]
    return [current_folder(spark, p) for p in paths]


def test_a_run_killed_after_transform_goes_on_with_load(spark, inputs, tmp_path, monkeypatch):
    trips, zones = inputs
    root = str(tmp_path)
    tables.ensure_schema(spark, "resumed_marts")

    def killed(*args, **kwargs):
        raise Killed

    with monkeypatch.context() as m:
        m.setattr(runs, "load", killed)
        with pytest.raises(Killed):
            runs.run_etl(spark, trips, zones, SMALL, root, "resumed_marts", run_id="r1")
    before = folders(spark, root)
    assert all(before)
    with monkeypatch.context() as m:
        # Neither the extract nor a mart may be written again.
        m.setattr(runs, "write_parquet", lambda *a: pytest.fail("written again"))
        m.setattr(runs, "mart_sums", lambda *a: pytest.fail("summed again"))
        targets = runs.run_etl(spark, trips, zones, SMALL, root, "resumed_marts", run_id="r1")
    assert folders(spark, root) == before
    assert all(spark.table(t).count() for t in targets.values())
    # A third call has nothing to do at all.
    published = {t: current_table(spark, t) for t in targets.values()}
    runs.run_etl(spark, trips, zones, SMALL, root, "resumed_marts", run_id="r1")
    assert {t: current_table(spark, t) for t in targets.values()} == published
    # Another run does everything, as does one without an id.
    for run_id in ("r2", None):
        runs.run_etl(spark, trips, zones, SMALL, root, "resumed_marts", run_id=run_id)
        after = folders(spark, root)
        assert not set(after) & set(before)
        before = after


def test_marts_that_are_missing_are_built_alone(spark, inputs, tmp_path, monkeypatch):
    trips, zones = inputs
    root = str(tmp_path)
    real = runs.write_parquet

    def failing(df, path):
        if "finanse" in path:
            raise OSError("no room")
        return real(df, path)

    runs.extract_to_parquet(trips, SMALL, root, run_id="x")
    raw = runs.raw_path(root, "small")
    with monkeypatch.context() as m:
        m.setattr(runs, "write_parquet", failing)
        with pytest.raises(tables.PublishError, match="no room"):
            runs.transform(spark, raw, zones, "small", root, run_id="x")
    before = dict(zip(["raw", *MARTS], folders(spark, root), strict=True))
    assert before["mart_finanse"] is None and before["mart_trasy"]
    runs.transform(spark, raw, zones, "small", root, run_id="x")
    after = dict(zip(["raw", *MARTS], folders(spark, root), strict=True))
    assert after["mart_finanse"] and after | {"mart_finanse": None} == before


def test_other_inputs_or_options_are_not_taken_for_done(spark, inputs, tmp_path):
    trips, zones = inputs
    root = str(tmp_path)
    runs.extract_to_parquet(trips, SMALL, root, run_id="x")
    raw = runs.raw_path(root, "small")
    first = runs.transform(spark, raw, zones, "small", root, run_id="x")
    one = folders(spark, root)
    assert runs.transform(spark, raw, zones, "small", root, run_id="x") == first
    assert folders(spark, root) == one
    runs.transform(spark, raw, zones, "small", root, null_tip="zero", run_id="x")
    two = folders(spark, root)
    assert two[0] == one[0] and not set(two[1:]) & set(one[1:])
    # A new extract makes new marts.
    runs.extract_to_parquet(trips, SMALL, root, run_id="x", all_columns=False)
    runs.transform(spark, raw, zones, "small", root, null_tip="zero", run_id="x")
    assert not set(folders(spark, root)) & set(two)


def test_elt_goes_on(spark, inputs, tmp_path, monkeypatch):
    trips, zones = inputs
    where = {"raw_schema": "resumed_raw", "target_schema": "resumed", "journal": str(tmp_path)}
    real = runs.publish
    failed = []

    def half(frames, schema, size, sink, spark, threads):
        assert threads == len(MARTS)

        def some(df, name):
            if "trasy" in name and not failed:
                failed.append(name)
                raise OSError("no room")
            return sink(df, name)

        return real(frames, schema, size, some, spark, threads)

    monkeypatch.setattr(runs, "publish", half)
    with pytest.raises(tables.PublishError, match="no room"):
        runs.run_elt(spark, trips, zones, SMALL, **where, run_id="r")
    raw, finance = "resumed_raw.taxi_trips_small", "resumed_marts.mart_finanse_small"
    before = [current_table(spark, t) for t in (raw, finance)]
    targets = runs.run_elt(spark, trips, zones, SMALL, **where, run_id="r")
    assert [current_table(spark, t) for t in (raw, finance)] == before
    assert spark.table(targets["mart_trasy"]).count()
    monkeypatch.setattr(runs, "mart_sums", lambda *a: pytest.fail("summed again"))
    assert runs.run_elt(spark, trips, zones, SMALL, **where, run_id="r") == targets


def test_a_run_with_an_id_needs_a_journal(spark, inputs):
    with pytest.raises(ValueError, match="journal"):
        runs.run_elt(spark, *inputs, SMALL, run_id="r")


def test_targets_that_were_replaced_since_are_published_again(spark, inputs, tmp_path):
    trips, zones = inputs
    root = str(tmp_path)
    tables.ensure_schema(spark, "resumed_again")
    targets = runs.run_etl(spark, trips, zones, SMALL, root, "resumed_again", run_id="r")
    target = targets["mart_trasy"]
    want = bag(spark.table(target))
    replace_table(spark.range(1), target)
    runs.run_etl(spark, trips, zones, SMALL, root, "resumed_again", run_id="r")
    assert bag(spark.table(target)) == want


def test_commands_of_one_run(spark, make_trips, tmp_path):
    raw, root = f"{tmp_path}/source", f"{tmp_path}/run"
    make_trips({}).write.parquet(raw)
    steps = [
        ["extract", "--trips", raw, "--root", root, "--run-id", "monday"],
        ["transform", "--root", root, "--run-id", "monday"],
        ["load", "--root", root, "--schema", "resumed_cli", "--run-id", "monday"],
    ]
    for step in steps:
        main(step)
    before = folders(spark, root), current_table(spark, "resumed_cli.mart_trasy_small")
    for step in steps:
        main(step)
    assert (folders(spark, root), current_table(spark, "resumed_cli.mart_trasy_small")) == before


def test_marts_are_written_side_by_side_and_failures_collected(spark):
    import threading

    together = threading.Barrier(3, timeout=60)
    pools = set()

    def sink(df, name):
        together.wait()  # all three are under way
        pools.add(spark.sparkContext.getLocalProperty("spark.scheduler.pool"))
        if "finanse" in name:
            raise OSError("no room")
        return df.count()

    with pytest.raises(tables.PublishError) as error:
        tables.publish({m: spark.range(1) for m in MARTS}, "s", "small", sink, spark, threads=3)
    assert list(error.value.failures) == ["s.mart_finanse_small"]
    assert pools == set(MARTS)
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_an_interrupt_is_no_failed_target(spark):
    def sink(df, name):
        raise Killed

    with pytest.raises(Killed):
        tables.publish({m: spark.range(1) for m in MARTS}, "s", "small", sink, spark, threads=3)


def test_put_file_is_whole_and_made_once(spark, tmp_path):
    path = f"{tmp_path}/a"
    assert versions.get_file(spark, path) is None
    versions.put_file(spark, path, "zażółć")
    assert versions.get_file(spark, path) == "zażółć"
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["a"]
