"""Every query of the library over the whole order tables.

Sums and means of doubles depend on the order of addition, so the last digits
are rounded off here, and only here.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import warehouse
from checks.trips_view import SCENARIOS, trips, zones
from tripmill.functions import calendar
from tripmill.functions.measures import speed_mph, tip_percent
from tripmill.operators.dedup import any_per_key, first_per_key
from tripmill.operators.selection import in_window, sample_by_key, sample_rows, valid_trips
from tripmill.operators.zone_join import with_pickup_zone, with_zone_pair
from tripmill.plans import marts, profile, runs
from tripmill.plans.staging import stage_trips
from tripmill.scenario import Scenario, sized_name
from tripmill.schema import AUDITED, MARTS, MEASURES, STAGED_NAMES
from tripmill.scratch import materialise, scratch_dir
from tripmill.sinks.clustered import read_window
from tripmill.sinks.tables import ensure_schema, format_sink, replace_staging_view
from tripmill.sources.trips import load_trips, read_trips, trips_table
from tripmill.sources.zones import chicago_zones, read_zones

SMALL = SCENARIOS["small"]


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(f"`{c}`"), digits) for c in columns})


def _dynamics(df: DataFrame) -> DataFrame:
    return _rounded(df, 6, "srednia_predkosc_mph")


def _finance(df: DataFrame) -> DataFrame:
    return _rounded(_rounded(df, 2, "laczny_przychod"), 6, "sredni_procent_napiwku")


# Sources and sinks


def scan_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips(spark, sf_dir).select("*")


def extract_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = runs.extract_to_parquet(trips(spark, sf_dir), SMALL, scratch_dir(spark))
    return read_trips(spark, path)


def _raw_table(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    schema = f"raw_{uuid.uuid4().hex}"
    ensure_schema(spark, schema, scratch_dir(spark))
    return schema, runs.extract_to_table(trips(spark, sf_dir), SMALL, schema)


def raw_table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, table = _raw_table(spark, sf_dir)
    return trips_table(spark, table)


def staging_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema, table = _raw_table(spark, sf_dir)
    view = sized_name("stg_taxi_trips", SMALL.name, schema)
    replace_staging_view(spark, table, view)
    return spark.table(view)


def zone_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark)
    zones(spark, sf_dir).write.option("header", True).csv(path)
    return read_zones(spark, path)


def _publish_elt(spark: SparkSession, sf_dir: str, size: str = "small") -> dict[str, str]:
    run = uuid.uuid4().hex
    return runs.run_elt(
        spark,
        trips(spark, sf_dir),
        zones(spark, sf_dir),
        SCENARIOS[size],
        raw_schema=f"raw_{run}",
        target_schema=f"transformed_{run}",
        location=scratch_dir(spark),
    )


def _publish_etl(spark: SparkSession, sf_dir: str, size: str = "small") -> dict[str, str]:
    schema = f"transformed_marts_{uuid.uuid4().hex}"
    folder = scratch_dir(spark)
    ensure_schema(spark, schema, f"{folder}/{schema}")
    return runs.run_etl(
        spark, trips(spark, sf_dir), zones(spark, sf_dir), SCENARIOS[size], folder, schema
    )


def publish_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.table_counts(spark, _publish_elt(spark, sf_dir))


def published_dynamics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dynamics(spark.table(_publish_elt(spark, sf_dir)["mart_dynamika_ruchu"]))


def published_finance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _finance(spark.table(_publish_etl(spark, sf_dir)["mart_finanse"]))


def published_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(_publish_etl(spark, sf_dir)["mart_trasy"])


def _published(run: Callable, mart: str, size: str) -> Callable[[SparkSession, str], DataFrame]:
    """A mart as a whole run of ``size`` publishes it."""
    rounded = {"mart_dynamika_ruchu": _dynamics, "mart_finanse": _finance}.get(mart, lambda x: x)
    return lambda spark, sf_dir: rounded(spark.table(run(spark, sf_dir, size)[mart]))


def raw_table_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every trip through Parquet, a catalog table and back."""
    everything = Scenario("all", datetime(1900, 1, 1), datetime(2100, 1, 1))
    path = runs.extract_to_parquet(trips(spark, sf_dir), everything, scratch_dir(spark))
    schema = f"raw_{uuid.uuid4().hex}"
    ensure_schema(spark, schema, scratch_dir(spark))
    return trips_table(spark, runs.extract_to_table(read_trips(spark, path), everything, schema))


def connector_finance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips read from a connector, staged and summed, and the mart published through it."""
    fmt, root = warehouse.register(spark), scratch_dir(spark)
    sink = format_sink(fmt, root=f"{root}/warehouse")
    sink(trips(spark, sf_dir), "raw.trips")
    source = load_trips(spark, fmt, root=f"{root}/warehouse", table="raw.trips")
    targets = runs.run_etl(spark, source, zones(spark, sf_dir), SMALL, root, "marts", sink)
    options = {"root": f"{root}/warehouse", "table": targets["mart_finanse"]}
    return _finance(spark.read.format(fmt).options(**options).load())


def window_of_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The small window, cut from an extract of all years that lies by start time."""
    everything = Scenario("all", datetime(1900, 1, 1), datetime(2100, 1, 1))
    path = runs.extract_to_parquet(
        trips(spark, sf_dir), everything, scratch_dir(spark), clustered=True
    )
    return read_window(spark, path, SMALL)


def resumed_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that stops before it loads, and then goes on under its id."""
    schema, folder = f"transformed_marts_{uuid.uuid4().hex}", scratch_dir(spark)
    ensure_schema(spark, schema, f"{folder}/{schema}")
    raw = runs.extract_to_parquet(trips(spark, sf_dir), SMALL, folder, "nightly")
    runs.transform(spark, raw, zones(spark, sf_dir), SMALL.name, folder, run_id="nightly")
    targets = runs.run_etl(
        spark, trips(spark, sf_dir), zones(spark, sf_dir), SMALL, folder, schema, run_id="nightly"
    )
    return spark.table(targets["mart_trasy"])


# Filters, projections, functions


def _window(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: in_window(trips(spark, sf_dir), SCENARIOS[name])


def quality_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_trips(trips(spark, sf_dir))


def calendar_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = "trip_start_timestamp"
    df = trips(spark, sf_dir, ["unique_key", start])
    return df.withColumns({
        "rok": calendar.year(df, start),
        "miesiac": calendar.month(df, start),
        "godzina": calendar.hour(df, start),
    })


def speed(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = trips(spark, sf_dir, ["unique_key", "trip_miles", "trip_seconds"])
    return df.withColumn("predkosc", speed_mph("trip_miles", "trip_seconds"))


def tip_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips(spark, sf_dir, ["unique_key", "tips", "trip_total"]).withColumns({
        "procent_zero": tip_percent("tips", "trip_total", "zero"),
        "procent_ignore": tip_percent("tips", "trip_total", "ignore"),
    })


def sample_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["unique_key", *MEASURES]
    return sample_by_key(trips(spark, sf_dir, columns), 0.01, seed=7).select(*MEASURES)


def sample_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All trips, sampled rows that are no trips, and whether the sample's size is
    within five standard deviations of one percent."""
    everything = materialise(trips(spark, sf_dir))
    picked = materialise(sample_rows(everything, 0.01, seed=7))
    one, none = F.lit(1), F.lit(0)
    names = ("wszystkie", "spoza_wejscia", "wybrane")
    parts = [(everything, 0), (picked.subtract(everything), 1), (picked, 2)]
    marked = [
        df.select(*[(one if i == at else none).alias(name) for i, name in enumerate(names)])
        for df, at in parts
    ]
    sums = reduce(DataFrame.union, marked).agg(*[F.sum(name).alias(name) for name in names])
    off = F.abs(F.col("wybrane") - F.col("wszystkie") * 0.01)
    return sums.select(
        "wszystkie",
        "spoza_wejscia",
        (off <= 5 * F.sqrt(F.col("wszystkie") * 0.01 * 0.99)).alias("rozmiar_pasuje"),
    )


# Deduplication, staging, zones


def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_per_key(trips(spark, sf_dir))


def dedup_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each key, and whether the row that survives is one of its rows as a whole."""
    rows = trips(spark, sf_dir)
    survivors = any_per_key(rows)
    inputs = rows.select(*[F.col(c).alias(f"we_{c}") for c in rows.columns]).distinct()
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"we_{c}")) for c in rows.columns])
    return survivors.join(inputs, same, "left").select(
        "unique_key", F.col("we_unique_key").isNotNull().alias("z_wejscia")
    )


def staged(spark: SparkSession, sf_dir: str, null_tip: str = "zero") -> DataFrame:
    return stage_trips(trips(spark, sf_dir), null_tip)


def staged_null_tip_ignored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(spark, sf_dir, "ignore")


_AREAS = ("unique_key", "pickup_community_area", "dropoff_community_area")


def stage_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each staged key, and whether the row that survived is one of its valid rows as a whole."""
    survivors = stage_trips(trips(spark, sf_dir), survivor="any")
    valid = valid_trips(trips(spark, sf_dir))
    inputs = valid.select(*[F.col(c).alias(f"we_{c}") for c in STAGED_NAMES]).distinct()
    same = [F.col(name).eqNullSafe(F.col(f"we_{c}")) for c, name in STAGED_NAMES.items()]
    return survivors.join(inputs, reduce(and_, same), "left").select(
        "id_przejazdu", F.col("we_unique_key").isNotNull().alias("z_wejscia")
    )


def zone_join_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = trips(spark, sf_dir, _AREAS[:2])
    return with_pickup_zone(df, zones(spark, sf_dir), _AREAS[1])


def zone_pair_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = trips(spark, sf_dir, _AREAS)
    return with_zone_pair(df, zones(spark, sf_dir), _AREAS[1], _AREAS[2])


def zone_pair_join_chicago(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_zone_pair(trips(spark, sf_dir, _AREAS), chicago_zones(spark), _AREAS[1], _AREAS[2])


def zone_names_chicago(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips by packaged zone, for areas that run through all 77 ids and one more."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    areas = orders.select((F.col("o_orderkey") % 78 + 1).cast("bigint").alias(_AREAS[1]))
    return with_pickup_zone(areas, chicago_zones(spark), _AREAS[1]).groupBy(
        _AREAS[1], "dzielnica_odbioru"
    ).agg(F.count("*").alias("liczba"))


# Marts


def mart_dynamics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dynamics(marts.traffic_dynamics(staged(spark, sf_dir), zones(spark, sf_dir)))


def mart_finance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _finance(marts.finance(staged(spark, sf_dir)))


def mart_finance_null_tip_ignored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _finance(marts.finance(staged_null_tip_ignored(spark, sf_dir)))


def mart_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.routes(staged(spark, sf_dir), zones(spark, sf_dir))


# Profile


def audit_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.uniqueness_by_year(
        trips(spark, sf_dir, ["unique_key", "trip_start_timestamp"])
    )


def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.null_rates(trips(spark, sf_dir, AUDITED))


def null_profile_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.null_rates_long(trips(spark, sf_dir, AUDITED))


def _values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.value_table(trips(spark, sf_dir, MEASURES))


def describe_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = profile.describe(_values(spark, sf_dir))
    return _rounded(summary, 4, *summary.columns[2:])


def trim_p99(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = trips(spark, sf_dir, MEASURES)
    return profile.trimmed_rows(rows, profile.value_table(rows))


def histogram30(spark: SparkSession, sf_dir: str) -> DataFrame:
    trimmed = profile.trimmed_table(_values(spark, sf_dir))
    return _rounded(profile.histogram(trimmed), 6, "od", "do")


def kde200(spark: SparkSession, sf_dir: str) -> DataFrame:
    curve = profile.density(profile.trimmed_table(_values(spark, sf_dir)))
    return _rounded(_rounded(curve, 6, "x"), 3, "gestosc")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_trips": scan_trips,
    "extract_roundtrip": extract_roundtrip,
    "raw_table_roundtrip": raw_table_roundtrip,
    "staging_view": staging_view,
    "raw_table_whole": raw_table_whole,
    "connector_mart_finanse": connector_finance,
    "window_of_clustered": window_of_clustered,
    "resumed_mart_trasy": resumed_routes,
    "zone_dim": zone_dim,
    "publish_marts": publish_marts,
    "published_dynamika_ruchu_small": published_dynamics,
    "published_finanse_small": published_finance,
    "published_trasy_small": published_routes,
    "scenario_filter_small": _window("small"),
    "scenario_filter_medium": _window("medium"),
    "scenario_filter_large": _window("large"),
    "quality_filter": quality_filter,
    "calendar_parts": calendar_parts,
    "speed_mph": speed,
    "tip_percent": tip_share,
    "sample_trips": sample_trips,
    "sample_check": sample_check,
    "dedup_first_by_time": dedup_first,
    "dedup_any": dedup_any,
    "stage_trips": staged,
    "stage_trips_null_tip_ignored": staged_null_tip_ignored,
    "stage_trips_any": stage_any,
    "zone_join_left": zone_join_left,
    "zone_pair_join": zone_pair_join,
    "zone_pair_join_chicago": zone_pair_join_chicago,
    "zone_names_chicago": zone_names_chicago,
    "mart_dynamika_ruchu": mart_dynamics,
    "mart_finanse": mart_finance,
    "mart_finanse_null_tip_ignored": mart_finance_null_tip_ignored,
    "mart_trasy": mart_routes,
    "audit_uniqueness_by_year": audit_uniqueness,
    "null_profile": null_profile,
    "null_profile_long": null_profile_long,
    "describe_numeric": describe_numeric,
    "trim_p99": trim_p99,
    "histogram30": histogram30,
    "kde200": kde200,
}

# Whole runs: every mart of both variants in the larger sizes, and those of the
# small one that have no key of their own above.
RUNS = {"etl": _publish_etl, "elt": _publish_elt}
QUERIES |= {
    f"{variant}_{mart}_{size}": _published(run, mart, size)
    for variant, run in RUNS.items()
    for mart in MARTS
    for size in SCENARIOS
}
