"""Calendar parts in UTC, whatever time zone the session runs in."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SECONDS_PER_DAY = 86_400


def is_zoned(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.TimestampType)


def calendar_sql(column: str, zoned: bool) -> dict[str, str]:
    """SQL for ``year``, ``month`` and ``hour``, the text that staging uses too.

    A zoned timestamp is an instant, so its UTC day and hour are plain arithmetic.
    """
    day, hour = column, f"hour({column})"
    if zoned:
        seconds = f"unix_seconds({column})"
        day = f"date_from_unix_date(cast(floor({seconds} / {_SECONDS_PER_DAY}) AS int))"
        hour = f"cast(floor(pmod({seconds}, {_SECONDS_PER_DAY}) / 3600) AS int)"
    return {"year": f"year({day})", "month": f"month({day})", "hour": hour}


def _part(df: DataFrame, column: str, part: str) -> Column:
    return F.expr(calendar_sql(column, is_zoned(df, column))[part])


def year(df: DataFrame, column: str) -> Column:
    return _part(df, column, "year")


def month(df: DataFrame, column: str) -> Column:
    return _part(df, column, "month")


def hour(df: DataFrame, column: str) -> Column:
    return _part(df, column, "hour")


def utc_literal(df: DataFrame, column: str, moment: datetime) -> Column:
    """``moment`` (UTC) as a literal of the type that ``column`` has.

    With equal types on both sides no cast wraps the column, and the comparison
    can be pushed to the Parquet reader.
    """
    text = moment.isoformat(sep=" ")
    if is_zoned(df, column):
        return F.expr(f"TIMESTAMP '{text}+00:00'")
    return F.expr(f"TIMESTAMP_NTZ '{text}'")
