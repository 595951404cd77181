"""Whole runs for one scenario: extract, stage, build the marts, publish.

Marts go to folders and catalog tables side by side. A run with an id keeps a journal of its steps: called
again with that id, it goes on where it was interrupted.
"""

from __future__ import annotations

import uuid
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.operators.selection import in_window
from tripmill.plans.journal import Journal, source_mark
from tripmill.plans.marts import mart_sums, marts_from_sums
from tripmill.plans.staging import stage_trips
from tripmill.scenario import Scenario, sized_name
from tripmill.schema import MARTS, TRIP_COLUMNS, TRIP_SCHEMA, check
from tripmill.scratch import materialise
from tripmill.sinks.tables import (
    Sink,
    ensure_schema,
    publish,
    raise_failures,
    remove_folder,
    replace_staging_view,
    replace_table,
    side_by_side,
    write_parquet,
)
from tripmill.sinks.clustered import by_start_time, readable_times, write_trips
from tripmill.sinks.versions import current_folder, current_table, read_folder, version_path
from tripmill.sources.trips import read_trips

# The public schema names.
RAW_SCHEMA = "raw"
TARGET_SCHEMA = "transformed"
MARTS_SCHEMA = "transformed_marts"


def raw_path(root: str, size: str) -> str:
    return f"{root}/raw/{size}"


def mart_paths(root: str, size: str) -> dict[str, str]:
    return {name: f"{root}/marts/{size}/{name}" for name in MARTS}


def extract(
    trips: DataFrame,
    scenario: Scenario,
    all_columns: bool = True,
    year_partition: str | None = None,
    clustered: bool = False,
) -> DataFrame:
    """The trips of a scenario: every column, or only those the marts need.

    ``clustered`` orders them by start time, see ``by_start_time``.
    """
    trips = in_window(check(trips, TRIP_SCHEMA), scenario, year_partition=year_partition)
    trips = trips if all_columns else trips.select(*TRIP_COLUMNS)
    return by_start_time(trips) if clustered else trips


def extract_to_parquet(
    trips: DataFrame, scenario: Scenario, root: str, run_id: str | None = None, **how
) -> str:
    """Write the scenario's trips below ``root`` and return the folder."""
    spark, path = trips.sparkSession, raw_path(root, scenario.name)
    _journal(spark, root, scenario.name, run_id).once(
        "extract",
        lambda: {"window": str(scenario), "how": how, "trips": source_mark(trips)},
        lambda: write_trips(
            extract(trips, scenario, **how), path, bounds=how.get("clustered", False)
        ),
        lambda version: version == current_folder(spark, path),
    )
    return path


def extract_to_table(
    trips: DataFrame, scenario: Scenario, schema: str = RAW_SCHEMA, **how
) -> str:
    """Replace the scenario's raw table and return its name."""
    name = sized_name("taxi_trips", scenario.name, schema)
    _replace_trips(extract(trips, scenario, **how), name)
    return name


def _replace_trips(trips: DataFrame, name: str) -> str | None:
    with readable_times(trips.sparkSession):
        return replace_table(trips, name)


def build_marts(
    staged: DataFrame, zones: DataFrame, path: str | None = None
) -> dict[str, DataFrame]:
    """All three marts for one pass over ``staged``.

    The sums are written to the folder ``path``, or below the shared scratch
    folder, and read back, so that the three marts share them without a cache that
    dies with its executor. The marts read the folder, so it goes after them.
    """
    return marts_from_sums(materialise(mart_sums(staged), path), zones)


def _journal(spark: SparkSession, folder: str | None, size: str, run_id: str | None) -> Journal:
    if run_id and not folder:
        raise ValueError("a run with an id needs a folder for its journal")
    return Journal(spark, f"{folder}/_journal/{size}/{run_id}" if run_id else None)


def transform(
    spark: SparkSession,
    raw: str,
    zones: DataFrame,
    size: str,
    root: str,
    null_tip: str = "ignore",
    survivor: str = "first",
    run_id: str | None = None,
) -> dict[str, str]:
    """Marts from the raw Parquet folder, as one Parquet folder each.

    Scratch lies below ``root`` and is removed, also after a failure. With a run id only
    the marts that the run has not made yet are built.
    """
    journal = _journal(spark, root, size, run_id)
    scratch = f"{root}/scratch/{uuid.uuid4().hex}"
    paths = mart_paths(root, size)
    # The version is fixed once, so that all marts are of the same rows.
    version = current_folder(spark, raw)
    inputs = {"raw": raw, "version": version, "null_tip": null_tip, "survivor": survivor}

    def given() -> dict:
        return inputs | {"zones": source_mark(zones)}

    def made(name: str) -> bool:
        before = journal.folder and journal.version(f"transform-{name}", given())
        return bool(before) and before == current_folder(spark, paths[name])

    todo = [name for name in MARTS if not made(name)]
    if not todo:
        return paths
    try:
        trips = read_trips(spark, version_path(raw, version) if version else raw)
        marts = build_marts(stage_trips(trips, null_tip, survivor), zones, scratch)

        def job(name: str):
            return lambda: journal.once(
                f"transform-{name}",
                given,
                lambda: write_parquet(marts[name], paths[name]),
                lambda version: False,
            )

        raise_failures(side_by_side(spark, {name: job(name) for name in todo}, len(todo)))
    finally:
        remove_folder(spark, scratch)
    return paths


def _recorded(spark: SparkSession, journal: Journal, sink: Sink, inputs) -> Sink:
    """``sink``, but a target that the run has published is left as it is."""

    def stands(name: str, version: str) -> bool:
        # Only the catalog can be asked; a connector's target is taken to stand.
        return sink is not replace_table or current_table(spark, name) == version

    def write(df: DataFrame, name: str) -> str | None:
        return journal.once(
            f"load-{name}",
            lambda: inputs(name) | {"target": name},
            lambda: sink(df, name),
            lambda version: stands(name, version),
        )

    return write


def _threads(sink: Sink, targets: int) -> int:
    """Catalog tables are written side by side; a connector gets one write at a time, as
    it may have a single place for all."""
    return targets if sink is replace_table else 1


def load(
    spark: SparkSession,
    paths: dict[str, str],
    size: str,
    schema: str | None = MARTS_SCHEMA,
    sink: Sink = replace_table,
    root: str | None = None,
    run_id: str | None = None,
) -> dict[str, str]:
    """Publish mart folders as tables; see ``publish`` for failures.

    With a run id, whose journal is below ``root``, only what it has not published yet.
    """
    frames = {name: partial(read_folder, spark, path) for name, path in paths.items()}
    versions = {
        sized_name(name, size, schema): {"folder": path, "version": current_folder(spark, path)}
        for name, path in paths.items()
    }
    journal = _journal(spark, root, size, run_id)
    recorded = _recorded(spark, journal, sink, versions.__getitem__)
    return publish(frames, schema, size, recorded, spark, _threads(sink, len(paths)))


def run_etl(
    spark: SparkSession,
    trips: DataFrame,
    zones: DataFrame,
    scenario: Scenario,
    root: str,
    schema: str | None = MARTS_SCHEMA,
    sink: Sink = replace_table,
    null_tip: str = "ignore",
    survivor: str = "first",
    run_id: str | None = None,
    **how,
) -> dict[str, str]:
    """Files first: raw Parquet, mart Parquet, then mart tables.

    ``root`` must be a folder that all executors reach. The schema must exist
    when the sink is a catalog table. With ``run_id``, steps that the run has done
    before are left out.
    """
    size = scenario.name
    raw = extract_to_parquet(trips, scenario, root, run_id, **how)
    paths = transform(spark, raw, zones, size, root, null_tip, survivor, run_id)
    return load(spark, paths, size, schema, sink, root, run_id)


def run_elt(
    spark: SparkSession,
    trips: DataFrame,
    zones: DataFrame,
    scenario: Scenario,
    raw_schema: str = RAW_SCHEMA,
    target_schema: str = TARGET_SCHEMA,
    location: str | None = None,
    sink: Sink = replace_table,
    null_tip: str = "zero",
    survivor: str = "first",
    journal: str | None = None,
    run_id: str | None = None,
    **how,
) -> dict[str, str]:
    """Tables throughout: raw table, zone table, staging view, mart tables.

    Staging goes to ``<target_schema>_staging`` and the marts, which read the view
    and go out through ``sink``, to ``<target_schema>_marts``. Schemas that do not
    exist yet are created, below ``location`` when given. The sums that the marts
    share are a table of the staging schema while the run lasts. With ``run_id``, steps that
    the run has done before are left out; ``journal`` is the folder for its records.
    """
    size = scenario.name
    steps = _journal(spark, journal or location, size, run_id)
    staging_schema, marts_schema = f"{target_schema}_staging", f"{target_schema}_marts"
    for schema in (raw_schema, staging_schema, marts_schema):
        ensure_schema(spark, schema, f"{location}/{schema}" if location else None)
    raw = sized_name("taxi_trips", size, raw_schema)
    dimension = sized_name("dim_strefy_chicago", size, staging_schema)
    version = steps.once(
        f"extract-{raw}",
        lambda: {"window": str(scenario), "how": how, "trips": source_mark(trips)},
        lambda: _replace_trips(extract(trips, scenario, **how), raw),
        lambda version: version == current_table(spark, raw),
    )
    seed = steps.once(
        f"seed-{dimension}",
        lambda: source_mark(zones),
        lambda: replace_table(zones, dimension),
        lambda version: version == current_table(spark, dimension),
    )
    view = sized_name("stg_taxi_trips", size, staging_schema)
    replace_staging_view(spark, raw, view, null_tip, survivor)
    inputs = {"raw": version, "zones": seed, "null_tip": null_tip, "survivor": survivor}
    targets = {name: sized_name(name, size, marts_schema) for name in MARTS}
    recorded = _recorded(spark, steps, sink, lambda name: inputs)

    def made(name: str) -> bool:
        before = steps.version(f"load-{name}", inputs | {"target": name}) if run_id else None
        return before is not None and (
            sink is not replace_table or before == current_table(spark, name)
        )

    if all(made(target) for target in targets.values()):
        return targets
    sums = f"{staging_schema}.mart_sums_{uuid.uuid4().hex}"
    try:
        mart_sums(spark.table(view)).write.saveAsTable(sums)
        marts = marts_from_sums(spark.table(sums), spark.table(dimension))
        return publish(marts, marts_schema, size, recorded, spark, _threads(sink, len(marts)))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {sums}")


def table_counts(spark: SparkSession, targets: dict[str, str]) -> DataFrame:
    """``cel, wiersze``: the rows in each published table."""
    counts = None
    for name, target in sorted(targets.items()):
        part = spark.table(target).agg(F.count("*").alias("wiersze"))
        part = part.select(F.lit(name).alias("cel"), "wiersze")
        counts = part if counts is None else counts.union(part)
    return counts
