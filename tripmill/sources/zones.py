"""The zone dimension: the packaged list, or a CSV seed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.schema import ZONE_SCHEMA, check

# The 77 community areas, numbered from 1 in this order.
CHICAGO_ZONES = (
    "Rogers Park", "West Ridge", "Uptown", "Lincoln Square", "North Center",
    "Lake View", "Lincoln Park", "Near North Side", "Edison Park", "Norwood Park",
    "Jefferson Park", "Forest Glen", "North Park", "Albany Park", "Portage Park",
    "Irving Park", "Dunning", "Montclare", "Belmont Cragin", "Hermosa",
    "Avondale", "Logan Square", "Humboldt Park", "West Town", "Austin",
    "West Garfield Park", "East Garfield Park", "Near West Side", "North Lawndale", "South Lawndale",
    "Lower West Side", "Loop", "Near South Side", "Armour Square", "Douglas",
    "Oakland", "Fuller Park", "Grand Boulevard", "Kenwood", "Washington Park",
    "Hyde Park", "Woodlawn", "South Shore", "Chatham", "Avalon Park",
    "South Chicago", "Burnside", "Calumet Heights", "Roseland", "Pullman",
    "South Deering", "East Side", "West Pullman", "Riverdale", "Hegewisch",
    "Garfield Ridge", "Archer Heights", "Brighton Park", "McKinley Park", "Bridgeport",
    "New City", "West Elsdon", "Gage Park", "Clearing", "West Lawn",
    "Chicago Lawn", "West Englewood", "Englewood", "Greater Grand Crossing", "Ashburn",
    "Auburn Gresham", "Beverly", "Washington Heights", "Mount Greenwood", "Morgan Park",
    "O'Hare", "Edgewater",
)


def chicago_zones(spark: SparkSession) -> DataFrame:
    """The packaged list, marked for broadcast: its 77 rows never grow, and Spark
    knows no size for rows that come from the driver."""
    rows = list(enumerate(CHICAGO_ZONES, start=1))
    return F.broadcast(spark.createDataFrame(rows, ZONE_SCHEMA))


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """A zone table from CSV files with a header line."""
    zones = (
        spark.read.schema(ZONE_SCHEMA)
        .options(header=True, enforceSchema=False, mode="FAILFAST")
        .csv(path)
    )
    return check(zones, ZONE_SCHEMA)
