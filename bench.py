"""Time the queries and print one JSON line.

``BENCH_SF_DIR`` names the tables and ``BENCH_CPUS`` the threads. Every query
runs once to warm up; its time is the median of ``BENCH_RUNS`` further runs,
from building the frame to the last row.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.queries import QUERIES  # noqa: E402
from checks.trips_view import trips, zones  # noqa: E402
from tripmill.plans import marts, runs  # noqa: E402
from tripmill.plans.staging import stage_trips  # noqa: E402
from tripmill.scratch import materialise  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = (
    "scan_trips",
    "extract_roundtrip",
    "scenario_filter_small",
    "quality_filter",
    "dedup_first_by_time",
    "dedup_any",
    "stage_trips",
    "zone_pair_join",
    "mart_dynamika_ruchu",
    "mart_finanse",
    "mart_trasy",
    "publish_marts",
    "etl_mart_finanse_large",
    "audit_uniqueness_by_year",
    "null_profile_long",
    "describe_numeric",
    "trim_p99",
    "histogram30",
    "kde200",
)


def scale() -> float | str:
    name = Path(SF_DIR).name.removeprefix("sf")
    try:
        return float(name)
    except ValueError:
        return name


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def three_marts(staged: DataFrame, areas: DataFrame) -> list[DataFrame]:
    return [
        marts.traffic_dynamics(staged, areas),
        marts.finance(staged),
        marts.routes(staged, areas),
    ]


def marts_one_pass(spark: SparkSession, sf_dir: str) -> None:
    staged = stage_trips(trips(spark, sf_dir))
    for df in runs.build_marts(staged, zones(spark, sf_dir)).values():
        drain(df)


def marts_staged_once(spark: SparkSession, sf_dir: str) -> None:
    staged = materialise(stage_trips(trips(spark, sf_dir)))
    for df in three_marts(staged, zones(spark, sf_dir)):
        drain(df)


def marts_staged_per_mart(spark: SparkSession, sf_dir: str) -> None:
    for df in three_marts(stage_trips(trips(spark, sf_dir)), zones(spark, sf_dir)):
        drain(df)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tripmill-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="bench-warehouse-"))
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-shared-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    jobs = {name: (lambda s, d, q=QUERIES[name]: drain(q(s, d))) for name in HEADLINE}
    jobs |= {f.__name__: f for f in (marts_one_pass, marts_staged_once, marts_staged_per_mart)}
    seconds = {}
    for name, job in jobs.items():
        times = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            job(spark, SF_DIR)
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    spark.stop()
    print(json.dumps({
        "metric": "sum of median query times",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": scale(),
        "cpus": int(CPUS),
        "runs": RUNS,
    }))


if __name__ == "__main__":
    main()
