"""Row selection: time window, quality rules, sampling."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.functions.calendar import utc_literal
from tripmill.scenario import Scenario


def in_window(
    df: DataFrame,
    scenario: Scenario,
    column: str = "trip_start_timestamp",
    year_partition: str | None = None,
) -> DataFrame:
    """Rows with ``start <= column < end``; rows without a time drop out.

    On a table partitioned by the (UTC) year of ``column``, name that partition
    column in ``year_partition``: a range on the timestamp alone prunes row
    groups, but not directories.
    """
    ts = F.col(column)
    df = df.filter(
        (ts >= utc_literal(df, column, scenario.start))
        & (ts < utc_literal(df, column, scenario.end))
    )
    if year_partition:
        last = scenario.end - timedelta(microseconds=1)
        df = df.filter(F.col(year_partition).between(scenario.start.year, last.year))
    return df


#: Trips that moved, took time and have both community areas. Spark counts NaN as
#: greater than any number, but NaN miles are no distance.
VALID_TRIP = (
    "trip_seconds > 0 AND trip_miles > 0 AND NOT isnan(trip_miles)"
    " AND pickup_community_area IS NOT NULL AND dropoff_community_area IS NOT NULL"
)


def valid_trips(df: DataFrame) -> DataFrame:
    """The rows that ``VALID_TRIP`` describes, which staging keeps."""
    return df.filter(VALID_TRIP)


def sample_rows(df: DataFrame, fraction: float = 0.01, seed: int | None = None) -> DataFrame:
    """Each row independently with probability ``fraction``.

    Which rows those are depends on how the table is partitioned; see ``sample_by_key``.
    """
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


#: Hexadecimal digits of a key's digest that are compared; 60 bits.
_DIGITS = 15


def sample_by_key(
    df: DataFrame, fraction: float = 0.01, seed: int = 0, key: Sequence[str] = ("unique_key",)
) -> DataFrame:
    """The rows whose key falls into the sampled ``fraction`` of all keys.

    A key is in if the digest of seed and key, as a number between 0 and 1, is below
    ``fraction``. That is a property of the row alone: any partitioning, file layout or engine
    gives the same rows, a larger fraction with one seed holds a smaller one, and tables that
    are sampled by the same key still join. Rows of one key are in or out
    together; a null in the key counts as a value of its own. One scan, no shuffle.
    """
    if not 0 <= fraction <= 1:
        raise ValueError(f"fraction must be between 0 and 1, not {fraction}")
    if fraction == 1:
        return df
    # Each part carries its length, so that no two keys have one text.
    parts = [F.lit(str(seed))]
    for column in key:
        text = F.col(column).cast("string")
        sized = F.concat(F.length(text).cast("string"), F.lit(":"), text)
        parts.append(F.coalesce(sized, F.lit("null")))
    mark = F.substring(F.md5(F.concat_ws("|", *parts)), 1, _DIGITS)
    return df.filter(mark < f"{int(fraction * 16**_DIGITS):0{_DIGITS}x}")
