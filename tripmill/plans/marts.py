"""The three marts, one at a time or all in one pass over the staged trips.

Trips are first summed up by zone id. Names are joined to those few sums and
summed once more by name, because ids without a name share one group. Neither
the names nor the join ever meet single trips, so a busy zone is no hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.operators.zone_join import with_pickup_zone, with_zone_pair

_PICKUP = "id_dzielnica_odbioru"
_DROPOFF = "id_dzielnica_dowozu"

_DYNAMICS_KEYS = [_PICKUP, "godzina", "rok", "miesiac"]
_FINANCE_KEYS = ["rok", "miesiac", "typ_platnosci"]
_ROUTES_KEYS = [_PICKUP, _DROPOFF]


def _trip_count() -> Column:
    return F.count("id_przejazdu").alias("przejazdy")


def _speed_sums() -> list[Column]:
    return [F.sum("predkosc").alias("predkosc_suma"), F.count("predkosc").alias("predkosc_n")]


def _finance_sums() -> list[Column]:
    return [
        F.count("*").alias("wiersze"),
        F.sum("kwota_transackji").alias("przychod"),
        F.sum("procent_napiwku").alias("napiwek_suma"),
        F.count("procent_napiwku").alias("napiwek_n"),
    ]


def _mean(total: Column, count: Column) -> Column:
    return total / F.nullif(count, F.lit(0))


def _name_dynamics(sums: DataFrame, zones: DataFrame) -> DataFrame:
    return (
        with_pickup_zone(sums, zones)
        .groupBy("dzielnica_odbioru", "godzina", "rok", "miesiac")
        .agg(
            F.sum("przejazdy").alias("liczba_przejazdow"),
            _mean(F.sum("predkosc_suma"), F.sum("predkosc_n")).alias("srednia_predkosc_mph"),
        )
    )


def _name_routes(sums: DataFrame, zones: DataFrame) -> DataFrame:
    return (
        with_zone_pair(sums, zones)
        .groupBy("dzielnica_odbioru", "dzielnica_dowozu")
        .agg(F.sum("przejazdy").alias("liczba_przejazdow"))
    )


def _finish_finance(sums: DataFrame) -> DataFrame:
    return sums.select(
        "rok",
        "miesiac",
        "typ_platnosci",
        F.col("wiersze").alias("liczba_transakcji"),
        F.col("przychod").alias("laczny_przychod"),
        _mean(F.col("napiwek_suma"), F.col("napiwek_n")).alias("sredni_procent_napiwku"),
    )


def traffic_dynamics(staged: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips and mean speed by pickup zone, hour, year and month."""
    return _name_dynamics(staged.groupBy(*_DYNAMICS_KEYS).agg(_trip_count(), *_speed_sums()), zones)


def finance(staged: DataFrame) -> DataFrame:
    """Transactions, revenue and mean tip percentage by month and payment type."""
    return _finish_finance(staged.groupBy(*_FINANCE_KEYS).agg(*_finance_sums()))


def routes(staged: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips by pickup and dropoff zone."""
    return _name_routes(staged.groupBy(*_ROUTES_KEYS).agg(_trip_count()), zones)


def mart_sums(staged: DataFrame) -> DataFrame:
    """The sums behind all three marts from a single pass, tagged by ``mart``.

    Every staged row is added to its three groups within the task that holds it,
    so the costly deduplication runs once and only sums are shuffled. The result
    grows with zones, months and payment types, not with trips.
    """
    keys = [_PICKUP, _DROPOFF, "godzina", "rok", "miesiac", "typ_platnosci"]
    mart = (
        F.when(F.grouping("godzina") == 0, F.lit("mart_dynamika_ruchu"))
        .when(F.grouping("typ_platnosci") == 0, F.lit("mart_finanse"))
        .otherwise(F.lit("mart_trasy"))
    )
    return staged.groupingSets(
        [[F.col(k) for k in group] for group in (_DYNAMICS_KEYS, _FINANCE_KEYS, _ROUTES_KEYS)],
        *[F.col(k) for k in keys],
    ).agg(mart.alias("mart"), _trip_count(), *_speed_sums(), *_finance_sums())


def marts_from_sums(sums: DataFrame, zones: DataFrame) -> dict[str, DataFrame]:
    """Split the result of ``mart_sums`` into the three marts."""

    def part(name: str) -> DataFrame:
        return sums.filter(F.col("mart") == name)

    return {
        "mart_dynamika_ruchu": _name_dynamics(part("mart_dynamika_ruchu"), zones),
        "mart_finanse": _finish_finance(part("mart_finanse")),
        "mart_trasy": _name_routes(part("mart_trasy"), zones),
    }
