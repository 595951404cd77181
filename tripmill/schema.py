"""Column names, declared schemas and the check every source runs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

TRIP_SCHEMA = T.StructType([
    T.StructField("unique_key", T.StringType()),
    T.StructField("trip_start_timestamp", T.TimestampType()),
    T.StructField("trip_seconds", T.LongType()),
    T.StructField("trip_miles", T.DoubleType()),
    T.StructField("pickup_community_area", T.LongType()),
    T.StructField("dropoff_community_area", T.LongType()),
    T.StructField("tips", T.DoubleType()),
    T.StructField("trip_total", T.DoubleType()),
    T.StructField("payment_type", T.StringType()),
])

ZONE_SCHEMA = T.StructType([
    T.StructField("id_dzielnicy", T.LongType()),
    T.StructField("nazwa_dzielnicy", T.StringType()),
])

TRIP_COLUMNS = TRIP_SCHEMA.fieldNames()

# The public names of the staged columns.
STAGED_NAMES = {
    "unique_key": "id_przejazdu",
    "trip_start_timestamp": "godzina_rozpoczecia_przejazdu",
    "trip_seconds": "czas_przejazdu",
    "trip_miles": "dystans",
    "pickup_community_area": "id_dzielnica_odbioru",
    "dropoff_community_area": "id_dzielnica_dowozu",
    "tips": "napiwek",
    "trip_total": "kwota_transackji",
    "payment_type": "typ_platnosci",
}

# The public names of the marts.
MARTS = ("mart_dynamika_ruchu", "mart_finanse", "mart_trasy")

# The columns the numeric profile looks at.
MEASURES = ("trip_seconds", "trip_miles", "trip_total")

# The columns the completeness audit looks at.
AUDITED = (
    "pickup_community_area",
    "dropoff_community_area",
    "trip_start_timestamp",
    "trip_seconds",
    "trip_miles",
    "trip_total",
    "tips",
    "payment_type",
)


class SchemaError(ValueError):
    """A source lacks a column or holds it with an unusable type."""


def _family(data_type: T.DataType) -> str:
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return "timestamp"
    if isinstance(data_type, T.NumericType):
        return "number"
    if isinstance(data_type, (T.StringType, T.CharType, T.VarcharType)):
        return "string"
    return data_type.typeName()


def check(df: DataFrame, schema: T.StructType, columns: Iterable[str] | None = None) -> DataFrame:
    """Return ``df`` unchanged, or raise if it does not fit ``schema``.

    Widths may differ (int for bigint, zoned or zoneless timestamps); kinds may
    not. Only the analysed schema is looked at, so no job runs.
    """
    found = {f.name: f.dataType for f in df.schema.fields}
    wanted = [f for f in schema.fields if columns is None or f.name in set(columns)]
    problems = []
    for field in wanted:
        if field.name not in found:
            problems.append(f"{field.name} is missing")
        elif _family(found[field.name]) != _family(field.dataType):
            problems.append(
                f"{field.name} is {found[field.name].simpleString()},"
                f" expected {field.dataType.simpleString()}"
            )
    if problems:
        raise SchemaError("; ".join(problems))
    return df
