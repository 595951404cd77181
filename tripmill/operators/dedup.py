"""One row per key, as SQL text that staging uses and as frames made of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tripmill.schema import TRIP_COLUMNS

# Start time first; the other columns only break ties, so that the survivor
# does not depend on how the rows happen to be partitioned.
SURVIVOR_ORDER = tuple(
    ["trip_start_timestamp"]
    + [c for c in TRIP_COLUMNS if c not in ("unique_key", "trip_start_timestamp")]
)


def first_sql(
    source: str, key: str = "unique_key", order: Sequence[str] = SURVIVOR_ORDER, where: str = "true"
) -> str:
    """The first row of each key in ascending ``order``, nulls first.

    Rows with a null key form one group. Every map task cuts its own rows to one
    per key before the shuffle, so a key that holds a large part of the table
    reaches its reducer as one row per task.
    """
    by = ", ".join(f"{c} ASC NULLS FIRST" for c in order)
    return f"""
        SELECT * EXCEPT (_row_number) FROM (
            SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {by}) AS _row_number
            FROM {source}
            WHERE {where}
        )
        WHERE _row_number = 1"""


def any_sql(source: str, key: str = "unique_key", where: str = "true") -> str:
    """One whole row of each key, no matter which.

    Nothing is sorted by other columns; each map task again sends one row of a key at most.
    """
    return first_sql(source, key, [key], where)


def first_per_key(
    df: DataFrame, key: str = "unique_key", order: Sequence[str] = SURVIVOR_ORDER
) -> DataFrame:
    return df.sparkSession.sql(first_sql("{rows}", key, order), rows=df)


def any_per_key(df: DataFrame, key: str = "unique_key") -> DataFrame:
    return df.sparkSession.sql(any_sql("{rows}", key), rows=df)
