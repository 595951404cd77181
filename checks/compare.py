"""Run every query against its SQL oracle: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import ORACLE
from checks.queries import QUERIES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value + 0.0
    return value


def _bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str, sf_dir: str):
    """``None`` if query and oracle agree, else a short description."""
    frame = QUERIES[name](spark, sf_dir)
    got = _bag(frame.columns, frame.collect())
    if name not in ORACLE:
        return None if got else "no rows"
    result = con.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(columns)}"
    want = _bag(columns, result.fetchall())
    if got == want:
        return None
    extra, lacking = got - want, want - got
    return (
        f"{got.total()} rows against {want.total()};"
        f" only in Spark: {list(extra)[:3]}; only in DuckDB: {list(lacking)[:3]}"
    )


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(sf_dir), 0
    for name in names:
        start = time.time()
        problem = difference(spark, con, name, sf_dir)
        bad += problem is not None
        print(f"{name:32} {time.time() - start:6.2f}s  {problem or 'ok'}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
