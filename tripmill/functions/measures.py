"""Speed and tip percentage, as SQL text that staging uses and as columns made of it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_TIP_RULES = ("zero", "ignore")


def speed_sql(miles: str, seconds: str) -> str:
    """Miles per hour; null where the duration is zero or unknown."""
    return f"{miles} / nullif({seconds} / 3600, 0)"


def tip_sql(tip: str, total: str, null_tip: str = "zero") -> str:
    """Tip as a percentage of the total; 0 where the total is not positive.

    ``null_tip`` decides a missing tip on a positive total: ``"zero"`` counts it
    as 0 percent, ``"ignore"`` leaves the percentage null so averages skip it.
    """
    if null_tip not in NULL_TIP_RULES:
        raise ValueError(f"null_tip must be one of {NULL_TIP_RULES}, not {null_tip!r}")
    given = f"coalesce({tip}, 0)" if null_tip == "zero" else tip
    return f"CASE WHEN {total} > 0 THEN {given} / {total} * 100 ELSE 0 END"


def speed_mph(miles: str, seconds: str) -> Column:
    return F.expr(speed_sql(miles, seconds))


def tip_percent(tip: str, total: str, null_tip: str = "zero") -> Column:
    return F.expr(tip_sql(tip, total, null_tip))
