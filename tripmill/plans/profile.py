"""Data-quality profile of raw trips: duplicates, gaps, distributions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.functions import calendar
from tripmill.operators import distribution as dist
from tripmill.schema import AUDITED, MEASURES
from tripmill.scratch import materialise

# The statistics of the summary, named as users know them.
PERCENTILES = {0.01: "1%", 0.5: "50%", 0.99: "99%"}
UPPER = 0.99


def uniqueness_by_year(trips: DataFrame) -> DataFrame:
    """Rows, distinct keys and the share of duplicates per year, in year order."""
    rows, keys = F.col("wszystkie_przejazdy"), F.col("unikalne_przejazdy")
    return (
        trips.groupBy(calendar.year(trips, "trip_start_timestamp").alias("rok"))
        .agg(
            F.count("*").alias("wszystkie_przejazdy"),
            F.count_distinct("unique_key").alias("unikalne_przejazdy"),
        )
        .withColumn("pct_duplikatow", F.round((rows - keys) / rows * 100, 5))
        .orderBy("rok")
    )


def null_rates(trips: DataFrame, columns: Sequence[str] = AUDITED) -> DataFrame:
    """One row: the percentage of nulls in each column; null for no rows at all."""
    rows = F.nullif(F.count("*"), F.lit(0))
    return trips.agg(*[
        (F.count_if(F.col(c).isNull()) / rows * 100).alias(c) for c in columns
    ])


def null_rates_long(trips: DataFrame, columns: Sequence[str] = AUDITED) -> DataFrame:
    """``kolumna, procent_NULL``, the column with most gaps first."""
    return (
        null_rates(trips, columns)
        .unpivot([], list(columns), "kolumna", "procent_NULL")
        .orderBy(F.desc("procent_NULL"), "kolumna")
    )


def value_table(
    trips: DataFrame, columns: Sequence[str] = MEASURES, path: str | None = None
) -> DataFrame:
    """Distinct values of each column with their counts, written to ``path``,
    or below the shared scratch folder.

    This is the only read of the trips that the summary, the histogram and the
    density need; they take the table it returns, or what ``trimmed_table`` makes
    of it, and pass over it several times without adding the values up again.
    """
    return materialise(dist.value_counts(trips, columns), path)


def describe(values: DataFrame, columns: Sequence[str] = MEASURES) -> DataFrame:
    """One row per column: ``count, mean, std, min, 1%, 50%, 99%, max``.

    Missing values do not count; a column without values has count 0 and nulls. All
    statistics come from one ladder, which reads the value table four times.
    """
    found = dist.ladder(values, list(PERCENTILES))
    marks = {
        name: F.get("kwantyle", F.lit(i))["kwantyl"].alias(name)
        for i, name in enumerate(PERCENTILES.values())
    }
    names = values.sparkSession.createDataFrame([(c,) for c in columns], "kolumna string")
    # One row per column on both sides.
    return names.join(F.broadcast(found), "kolumna", "left").select(
        "kolumna",
        F.coalesce("n", F.lit(0)).cast("bigint").alias("count"),
        F.col("srednia").alias("mean"),
        F.col("odchylenie").alias("std"),
        F.col("lo").alias("min"),
        *marks.values(),
        F.col("hi").alias("max"),
    )


def trimmed_table(values: DataFrame, upper: float = UPPER, path: str | None = None) -> DataFrame:
    """The value table without the values above each column's percentile.

    Written to ``path``, or below the shared scratch folder: the percentiles are
    found once for the histogram and the density, which both take this table.
    """
    return materialise(dist.trim_upper(values, dist.upper_limits(values, upper)), path)


def trimmed_rows(
    trips: DataFrame,
    values: DataFrame,
    columns: Sequence[str] = MEASURES,
    upper: float = UPPER,
) -> DataFrame:
    """``kolumna, wartosc``: the same cut on the single measurements of ``trips``."""
    limits = dist.upper_limits(values, upper)
    rows = trips.select(*[F.col(c).cast("double").alias(c) for c in columns])
    return dist.trim_upper(rows.unpivot([], list(columns), "kolumna", "wartosc"), limits)


def histogram(trimmed: DataFrame, bins: int = 30) -> DataFrame:
    """Equal-width bins of the trimmed values of each column."""
    return dist.histogram(trimmed, bins)


def density(trimmed: DataFrame, points: int = 200, bins: int = 30) -> DataFrame:
    """The density curve drawn over the histogram of each column."""
    return dist.density(trimmed, points, bins)
