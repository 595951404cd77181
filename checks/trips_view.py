"""Trips in the shape the library expects, derived from the order tables.

The expressions and the joins are those of FIXTURES.md section 5: every lineitem
that has a supplier, an order and a customer is one trip record.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.scenario import Scenario
from tripmill.schema import TRIP_COLUMNS

# The order tables cover other years than real trips do.
SCENARIOS = {
    "small": Scenario("small", datetime(1998, 1, 1), datetime(1999, 1, 1)),
    "medium": Scenario("medium", datetime(1996, 1, 1), datetime(1998, 1, 1)),
    "large": Scenario("large", datetime(1999, 1, 1), datetime(2002, 1, 1)),
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trips(spark: SparkSession, sf_dir: str, columns: Sequence[str] = TRIP_COLUMNS) -> DataFrame:
    supplier = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    customer = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    # Orders meet their customers first: the records are many times more.
    orders = (
        _table(spark, sf_dir, "orders")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "c_nationkey")
    )
    records = (
        _table(spark, sf_dir, "lineitem")
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    )
    order_mod = F.col("l_orderkey") % 50
    start_hour = (F.col("l_partkey") * 7 + F.col("l_suppkey")) % 24
    expressions = {
        "unique_key": F.concat(
            F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")
        ),
        "trip_start_timestamp": F.when(
            F.col("l_partkey") % 500 != 0,
            F.col("l_shipdate") + F.make_dt_interval(hours=start_hour.cast("int")),
        ),
        "trip_seconds": ((F.col("l_quantity") - 1) * 60).cast("bigint"),
        "trip_miles": F.col("l_discount") * 100,
        "pickup_community_area": F.nullif(F.col("s_nationkey"), F.lit(24)),
        "dropoff_community_area": F.nullif(F.col("c_nationkey"), F.lit(23)),
        "tips": F.nullif(F.col("l_tax"), F.lit(0.0)) * F.col("l_extendedprice"),
        "trip_total": F.when(order_mod == 0, F.lit(0.0)).when(
            order_mod > 1, F.col("l_extendedprice")
        ),
        "payment_type": F.when(F.col("l_orderkey") % 97 != 0, F.col("l_returnflag")),
    }
    return records.select(*[expressions[c].alias(c) for c in TRIP_COLUMNS if c in columns])


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as zones; ids from 20 up stay unknown."""
    return (
        _table(spark, sf_dir, "nation")
        .filter(F.col("n_nationkey") < 20)
        .select(
            F.col("n_nationkey").cast("bigint").alias("id_dzielnicy"),
            F.col("n_name").alias("nazwa_dzielnicy"),
        )
    )
