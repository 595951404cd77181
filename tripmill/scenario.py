"""Named time windows and the target names derived from them."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime


@dataclass(frozen=True)
class Scenario:
    """A name and a half-open window ``[start, end)`` in UTC."""

    name: str
    start: datetime
    end: datetime

    def __post_init__(self) -> None:
        if not self.start < self.end:
            raise ValueError(f"scenario {self.name}: start must lie before end")
        if self.start.tzinfo or self.end.tzinfo:
            raise ValueError(f"scenario {self.name}: give the bounds as plain UTC times")


# The sizes users know by name.
SCENARIOS = {
    "small": Scenario("small", datetime(2022, 1, 1), datetime(2023, 1, 1)),
    "medium": Scenario("medium", datetime(2016, 1, 1), datetime(2018, 1, 1)),
    "large": Scenario("large", datetime(2013, 1, 1), datetime(2016, 1, 1)),
}

DEFAULT_SIZE = "small"


def sized_name(base: str, size: str = DEFAULT_SIZE, schema: str | None = None) -> str:
    """``base_size``, qualified by ``schema`` when one is given."""
    name = f"{base}_{size}"
    return f"{schema}.{name}" if schema else name
