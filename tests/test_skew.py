"""Every query with a third of all records on one trip key, supplier and value.

Automatic broadcast is off and skew splitting sets in at once, so the joins run
the way they would on tables that do not fit anywhere.
"""

import shutil
from pathlib import Path

import duckdb
import pytest

from checks.compare import difference, duck
from checks.oracle import ORACLE
from conftest import SF_DIR

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4096",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4096",
}


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("hot")
    for name in ("supplier", "orders", "customer", "nation"):
        shutil.copy(f"{SF_DIR}/{name}.parquet", folder / f"{name}.parquet")
    duckdb.sql(f"""
        COPY (
            SELECT * EXCLUDE (hot) REPLACE (
                CASE WHEN hot THEN 7 ELSE l_orderkey END AS l_orderkey,
                CASE WHEN hot THEN 1 ELSE l_linenumber END AS l_linenumber,
                CASE WHEN hot THEN 3 ELSE l_suppkey END AS l_suppkey,
                CASE WHEN hot THEN 21.0 ELSE l_quantity END AS l_quantity
            )
            FROM (SELECT *, row_number() OVER () % 3 = 0 AS hot
                  FROM '{SF_DIR}/lineitem.parquet')
        ) TO '{folder / "lineitem.parquet"}' (FORMAT parquet)""")
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield str(folder)
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.fixture(scope="module")
def con(hot):
    assert Path(hot, "lineitem.parquet").exists()
    return duck(hot)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_hot_tables(spark, hot, con, name):
    assert difference(spark, con, name, hot) is None
