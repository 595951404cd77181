"""Zone names for trips.

The zone table carries no broadcast hint here, because callers bring their own:
Spark broadcasts it where its known size is below the threshold, and otherwise
joins by shuffle with skewed zones split at run time. The packaged list, whose
77 rows are fixed, brings its hint along (``sources.zones``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_zone_name(df: DataFrame, zones: DataFrame, area: str, name: str) -> DataFrame:
    """Add column ``name`` for the zone id in ``area``; null where unknown."""
    key = f"_{name}_id"
    role = zones.select(
        F.col("id_dzielnicy").alias(key),
        F.col("nazwa_dzielnicy").alias(name),
    )
    return df.join(role, F.col(area) == F.col(key), "left").drop(key)


def with_pickup_zone(
    df: DataFrame, zones: DataFrame, area: str = "id_dzielnica_odbioru"
) -> DataFrame:
    return with_zone_name(df, zones, area, "dzielnica_odbioru")


def with_zone_pair(
    df: DataFrame,
    zones: DataFrame,
    pickup_area: str = "id_dzielnica_odbioru",
    dropoff_area: str = "id_dzielnica_dowozu",
) -> DataFrame:
    """The zone table in two roles: pickup name and dropoff name."""
    df = with_zone_name(df, zones, pickup_area, "dzielnica_odbioru")
    return with_zone_name(df, zones, dropoff_area, "dzielnica_dowozu")
