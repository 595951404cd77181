"""From raw trips to the 14 staged columns.

Staging is one SQL text, put together from those of the operators: a catalog view keeps
its text and no DataFrame, and a DataFrame can be made from the same text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tripmill.functions.calendar import calendar_sql, is_zoned
from tripmill.functions.measures import NULL_TIP_RULES, speed_sql, tip_sql
from tripmill.operators.dedup import any_sql, first_sql
from tripmill.operators.selection import VALID_TRIP
from tripmill.schema import STAGED_NAMES, TRIP_COLUMNS, TRIP_SCHEMA, check

NULL_TIPS = NULL_TIP_RULES
SURVIVORS = ("first", "any")


def staging_sql(
    source: str, zoned: bool = True, null_tip: str = "zero", survivor: str = "first"
) -> str:
    """The staging query over table ``source``.

    The quality rules come before the deduplication: a bad record must not push
    out a good one of the same trip. ``null_tip="ignore"`` leaves the percentage
    of a missing tip null and fills the tip itself with 0; ``"zero"`` does the
    opposite. ``survivor="any"`` keeps an arbitrary row of a key. ``zoned`` tells
    whether the start time is an instant, whose UTC parts need arithmetic, or a
    plain time. Miles that are NaN are no distance, so such a record is bad.
    """
    if null_tip not in NULL_TIPS:
        raise ValueError(f"null_tip must be one of {NULL_TIPS}, not {null_tip!r}")
    if survivor not in SURVIVORS:
        raise ValueError(f"survivor must be one of {SURVIVORS}, not {survivor!r}")
    parts = calendar_sql("trip_start_timestamp", zoned)
    shown = {"tips": "coalesce(tips, 0.0D)"} if null_tip == "ignore" else {}
    names = ", ".join(f"{shown.get(raw, raw)} AS {staged}" for raw, staged in STAGED_NAMES.items())
    one_per_key = first_sql if survivor == "first" else any_sql
    return f"""
        SELECT {names},
               {parts["year"]} AS rok,
               {parts["month"]} AS miesiac,
               {parts["hour"]} AS godzina,
               {speed_sql("trip_miles", "trip_seconds")} AS predkosc,
               {tip_sql("tips", "trip_total", null_tip)} AS procent_napiwku
        FROM ({one_per_key(source, where=VALID_TRIP)})"""


def stage_trips(trips: DataFrame, null_tip: str = "zero", survivor: str = "first") -> DataFrame:
    """Valid trips, one row per trip key, renamed and with derived columns."""
    narrow = check(trips, TRIP_SCHEMA).select(*TRIP_COLUMNS)
    text = staging_sql("{trips}", is_zoned(narrow, "trip_start_timestamp"), null_tip, survivor)
    return trips.sparkSession.sql(text, trips=narrow)
