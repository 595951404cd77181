"""Sources and sinks through a connector, by call and by command."""

import time

import pytest

from checks.trips_view import SCENARIOS, trips as trips_view, zones as zones_view
from checks.warehouse import Store, register
from conftest import SF_DIR, bag
from tripmill.cli import main
from tripmill.plans import marts, runs
from tripmill.plans.staging import stage_trips
from tripmill.schema import MARTS, SchemaError
from tripmill.sinks.tables import PublishError, format_sink, publish
from tripmill.sources.trips import load_trips


@pytest.fixture
def warehouse(spark, tmp_path):
    return register(spark), f"{tmp_path}/warehouse"


def read(spark, warehouse, table):
    fmt, root = warehouse
    return spark.read.format(fmt).option("root", root).option("table", table).load()


def settled(store, want):
    """Whether the table's folders are ``want`` once tasks that were cut off have ended."""
    for _ in range(100):
        if store.folders() == want:
            return True
        time.sleep(0.1)
    return False


def test_trips_go_in_and_out(spark, warehouse):
    fmt, root = warehouse
    trips = trips_view(spark, SF_DIR)
    format_sink(fmt, root=root)(trips, "raw.trips")
    back = load_trips(spark, fmt, root=root, table="raw.trips")
    assert back.schema.fieldNames() == trips.columns
    assert bag(back) == bag(trips)
    format_sink(fmt, root=root)(trips.limit(0), "raw.trips")
    assert read(spark, warehouse, "raw.trips").count() == 0
    format_sink(fmt, root=root)(spark.range(3), "raw.other")
    with pytest.raises(SchemaError):
        load_trips(spark, fmt, root=root, table="raw.other")


def test_an_aborted_write_leaves_the_old_rows_and_nothing_else(spark, warehouse):
    fmt, root = warehouse
    format_sink(fmt, root=root)(spark.range(10), "t")
    store = Store({"root": root, "table": "t"})
    before = store.folders()
    # Only one of five tasks has so many rows; the others have written theirs.
    uneven = spark.range(0, 5, 1, 5).selectExpr("explode(sequence(1, if(id = 3, 9, 2))) AS id")
    with pytest.raises(PublishError, match="full"):
        publish({"x": uneven}, None, "s", lambda df, name: format_sink(fmt, root=root, fail_at="5")(df, "t"))
    assert settled(store, before)
    assert bag(read(spark, warehouse, "t")) == [(i,) for i in range(10)]
    with pytest.raises(PublishError):
        publish({"x": uneven}, None, "s", lambda df, name: format_sink(fmt, root=root, fail_at="5")(df, "new"))
    assert settled(Store({"root": root, "table": "new"}), [])
    assert Store({"root": root, "table": "new"}).list() is None


def test_a_run_publishes_through_the_connector(spark, warehouse, tmp_path):
    fmt, root = warehouse
    trips, zones = trips_view(spark, SF_DIR), zones_view(spark, SF_DIR)
    scenario = SCENARIOS["small"]
    sink = format_sink(fmt, root=root)
    targets = runs.run_etl(spark, trips, zones, scenario, str(tmp_path / "run"), "marts", sink)
    want = marts.routes(stage_trips(runs.extract(trips, scenario)), zones)
    assert bag(read(spark, warehouse, targets["mart_trasy"])) == bag(want)
    # One target fails, the others are published, and its old rows stay.
    full = format_sink(fmt, root=root, fail_at="0")

    def partly(df, name):
        (full if "finanse" in name else sink)(df, name)

    before = bag(read(spark, warehouse, targets["mart_finanse"]))
    with pytest.raises(PublishError) as error:
        runs.run_etl(spark, trips, zones, scenario, str(tmp_path / "run"), "marts", partly)
    assert list(error.value.failures) == [targets["mart_finanse"]]
    assert bag(read(spark, warehouse, targets["mart_finanse"])) == before


def test_commands_read_and_write_the_warehouse(spark, make_trips, warehouse, tmp_path):
    fmt, root = warehouse
    format_sink(fmt, root=root)(make_trips({}, {"unique_key": "b", "tips": None}), "lake.trips")
    run = f"{tmp_path}/run"
    through = ["--format", fmt, "--option", f"root={root}"]
    main(["extract", "--table", "lake.trips", "--root", run, *through])
    main(["transform", "--root", run])
    main(["load", "--root", run, "--schema", "out", "--run-id", "r", *through])
    assert bag(read(spark, warehouse, "out.mart_trasy_small")) == [("Near North Side", "Loop", 2)]
    # What the run has published is not sent again.
    folders = {m: Store({"root": root, "table": f"out.{m}_small"}).folders() for m in MARTS}
    main(["load", "--root", run, "--schema", "out", "--run-id", "r", *through])
    assert {m: Store({"root": root, "table": f"out.{m}_small"}).folders() for m in MARTS} == folders
    main(["load", "--root", run, "--schema", "out", *through])
    assert {m: Store({"root": root, "table": f"out.{m}_small"}).folders() for m in MARTS} != folders
    spark.catalog.dropTempView("lake_trips")
    make_trips({}).createOrReplaceTempView("lake_trips")
    main(["elt", "--table", "lake_trips", *through])
    assert read(spark, warehouse, "transformed_marts.mart_trasy_small").count() == 1
