"""The same queries as plain SQL over the order tables, for DuckDB.

Written apart from the library: deduplication, percentiles, bins and densities
use other means than the DataFrame code does.
"""

from __future__ import annotations

from checks.trips_view import SCENARIOS

_TRIPS = """trips AS (
    SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS unique_key,
           CASE WHEN l_partkey % 500 = 0 THEN NULL
                ELSE l_shipdate + ((l_partkey * 7 + l_suppkey) % 24) * INTERVAL '1' HOUR
           END AS trip_start_timestamp,
           CAST((l_quantity - 1) * 60 AS BIGINT) AS trip_seconds,
           l_discount * 100 AS trip_miles,
           NULLIF(s_nationkey, 24) AS pickup_community_area,
           NULLIF(c_nationkey, 23) AS dropoff_community_area,
           NULLIF(l_tax, 0.0) * l_extendedprice AS tips,
           CASE WHEN l_orderkey % 50 = 0 THEN 0.0 WHEN l_orderkey % 50 = 1 THEN NULL
                ELSE l_extendedprice END AS trip_total,
           CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE l_returnflag END AS payment_type
    FROM lineitem
    JOIN supplier ON l_suppkey = s_suppkey
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
)"""

_ZONES = """zones AS (
    SELECT CAST(n_nationkey AS BIGINT) AS id_dzielnicy, n_name AS nazwa_dzielnicy
    FROM nation WHERE n_nationkey < 20
)"""

# The community areas in the order of their public numbers, written
# down apart from the library's list.
_AREA_NAMES = """
    Rogers Park, West Ridge, Uptown, Lincoln Square, North Center, Lake View, Lincoln Park,
    Near North Side, Edison Park, Norwood Park, Jefferson Park, Forest Glen, North Park,
    Albany Park, Portage Park, Irving Park, Dunning, Montclare, Belmont Cragin, Hermosa,
    Avondale, Logan Square, Humboldt Park, West Town, Austin, West Garfield Park,
    East Garfield Park, Near West Side, North Lawndale, South Lawndale, Lower West Side, Loop,
    Near South Side, Armour Square, Douglas, Oakland, Fuller Park, Grand Boulevard, Kenwood,
    Washington Park, Hyde Park, Woodlawn, South Shore, Chatham, Avalon Park, South Chicago,
    Burnside, Calumet Heights, Roseland, Pullman, South Deering, East Side, West Pullman,
    Riverdale, Hegewisch, Garfield Ridge, Archer Heights, Brighton Park, McKinley Park,
    Bridgeport, New City, West Elsdon, Gage Park, Clearing, West Lawn, Chicago Lawn,
    West Englewood, Englewood, Greater Grand Crossing, Ashburn, Auburn Gresham, Beverly,
    Washington Heights, Mount Greenwood, Morgan Park, O'Hare, Edgewater
"""

_CHICAGO = "zones(id_dzielnicy, nazwa_dzielnicy) AS (VALUES {})".format(
    ", ".join(
        "({}, '{}')".format(i, " ".join(name.split()).replace("'", "''"))
        for i, name in enumerate(_AREA_NAMES.split(","), start=1)
    )
)

_VALID = """
    trip_seconds > 0 AND trip_miles > 0
    AND pickup_community_area IS NOT NULL AND dropoff_community_area IS NOT NULL"""

_FIRST = """QUALIFY row_number() OVER (
        PARTITION BY unique_key
        ORDER BY trip_start_timestamp NULLS FIRST, trip_seconds NULLS FIRST,
                 trip_miles NULLS FIRST, pickup_community_area NULLS FIRST,
                 dropoff_community_area NULLS FIRST, tips NULLS FIRST,
                 trip_total NULLS FIRST, payment_type NULLS FIRST) = 1"""

_CALENDAR = """CAST(year(trip_start_timestamp) AS INTEGER) AS rok,
           CAST(month(trip_start_timestamp) AS INTEGER) AS miesiac,
           CAST(hour(trip_start_timestamp) AS INTEGER) AS godzina"""

_SPEED = "trip_miles / NULLIF(trip_seconds / 3600, 0)"
_TIP_ZERO = "CASE WHEN trip_total > 0 THEN COALESCE(tips, 0) / trip_total * 100 ELSE 0 END"
_TIP_IGNORE = "CASE WHEN trip_total > 0 THEN tips / trip_total * 100 ELSE 0 END"


def _staged(tip: str = "tips", percent: str = _TIP_ZERO, window: str = "TRUE") -> str:
    return f"""staged AS (
    SELECT unique_key AS id_przejazdu,
           trip_start_timestamp AS godzina_rozpoczecia_przejazdu,
           trip_seconds AS czas_przejazdu,
           trip_miles AS dystans,
           pickup_community_area AS id_dzielnica_odbioru,
           dropoff_community_area AS id_dzielnica_dowozu,
           {tip} AS napiwek,
           trip_total AS kwota_transackji,
           payment_type AS typ_platnosci,
           {_CALENDAR},
           {_SPEED} AS predkosc,
           {percent} AS procent_napiwku
    FROM trips WHERE {_VALID} AND {window}
    {_FIRST}
)"""


def _window(name: str) -> str:
    scenario = SCENARIOS[name]
    return (
        f"trip_start_timestamp >= TIMESTAMP '{scenario.start}'"
        f" AND trip_start_timestamp < TIMESTAMP '{scenario.end}'"
    )


_SMALL = _window("small")
_IGNORED = ("COALESCE(tips, 0.0)", _TIP_IGNORE)

_DYNAMICS = """SELECT nazwa_dzielnicy AS dzielnica_odbioru, godzina, rok, miesiac,
       COUNT(id_przejazdu) AS liczba_przejazdow,
       ROUND(AVG(predkosc), 6) AS srednia_predkosc_mph
FROM staged LEFT JOIN zones ON id_dzielnica_odbioru = id_dzielnicy
GROUP BY 1, 2, 3, 4"""

_FINANCE = """SELECT rok, miesiac, typ_platnosci, COUNT(*) AS liczba_transakcji,
       ROUND(SUM(kwota_transackji), 2) AS laczny_przychod,
       ROUND(AVG(procent_napiwku), 6) AS sredni_procent_napiwku
FROM staged GROUP BY 1, 2, 3"""

_ROUTES = """SELECT p.nazwa_dzielnicy AS dzielnica_odbioru, d.nazwa_dzielnicy AS dzielnica_dowozu,
       COUNT(id_przejazdu) AS liczba_przejazdow
FROM staged
LEFT JOIN zones p ON id_dzielnica_odbioru = p.id_dzielnicy
LEFT JOIN zones d ON id_dzielnica_dowozu = d.id_dzielnicy
GROUP BY 1, 2"""

_ZONE_PAIR = """SELECT unique_key, pickup_community_area, dropoff_community_area,
       p.nazwa_dzielnicy AS dzielnica_odbioru, d.nazwa_dzielnicy AS dzielnica_dowozu
FROM trips
LEFT JOIN zones p ON pickup_community_area = p.id_dzielnicy
LEFT JOIN zones d ON dropoff_community_area = d.id_dzielnicy"""

_AUDITED = (
    "pickup_community_area", "dropoff_community_area", "trip_start_timestamp", "trip_seconds",
    "trip_miles", "trip_total", "tips", "payment_type",
)


def _null_rate(column: str) -> str:
    return f"COUNT(*) FILTER (WHERE {column} IS NULL) / COUNT(*) * 100"


_LONG = """long AS (
    SELECT 'trip_seconds' AS kolumna, CAST(trip_seconds AS DOUBLE) AS wartosc FROM trips
    UNION ALL SELECT 'trip_miles', trip_miles FROM trips
    UNION ALL SELECT 'trip_total', trip_total FROM trips
)"""

_TRIMMED = """limits AS (
    SELECT kolumna, quantile_cont(wartosc, 0.99) AS granica FROM long GROUP BY kolumna
), trimmed AS (
    SELECT kolumna, wartosc FROM long JOIN limits USING (kolumna) WHERE wartosc <= granica
)"""


def _with(*parts: str) -> str:
    *ctes, select = parts
    return "WITH " + ",\n".join(ctes) + "\n" + select


ORACLE: dict[str, str] = {
    "scan_trips": _with(_TRIPS, "SELECT * FROM trips"),
    "extract_roundtrip": _with(_TRIPS, f"SELECT * FROM trips WHERE {_SMALL}"),
    "raw_table_roundtrip": _with(_TRIPS, f"SELECT * FROM trips WHERE {_SMALL}"),
    "staging_view": _with(_TRIPS, _staged(window=_SMALL), "SELECT * FROM staged"),
    "raw_table_whole": _with(
        _TRIPS, "SELECT * FROM trips WHERE trip_start_timestamp IS NOT NULL"
    ),
    "sample_check": _with(
        _TRIPS,
        """SELECT COUNT(*) AS wszystkie, CAST(0 AS BIGINT) AS spoza_wejscia,
               TRUE AS rozmiar_pasuje FROM trips""",
    ),
    "zone_names_chicago": _with(
        _CHICAGO,
        """SELECT CAST(o_orderkey % 78 + 1 AS BIGINT) AS pickup_community_area,
               nazwa_dzielnicy AS dzielnica_odbioru, COUNT(*) AS liczba
        FROM orders LEFT JOIN zones ON o_orderkey % 78 + 1 = id_dzielnicy
        GROUP BY 1, 2""",
    ),
    "connector_mart_finanse": _with(_TRIPS, _staged(*_IGNORED, window=_SMALL), _FINANCE),
    "window_of_clustered": _with(_TRIPS, f"SELECT * FROM trips WHERE {_SMALL}"),
    "resumed_mart_trasy": _with(_TRIPS, _ZONES, _staged(window=_SMALL), _ROUTES),
    "zone_dim": _with(_ZONES, "SELECT * FROM zones"),
    "publish_marts": _with(
        _TRIPS,
        _ZONES,
        _staged(window=_SMALL),
        f"""SELECT 'mart_dynamika_ruchu' AS cel, COUNT(*) AS wiersze FROM ({_DYNAMICS})
        UNION ALL SELECT 'mart_finanse', COUNT(*) FROM ({_FINANCE})
        UNION ALL SELECT 'mart_trasy', COUNT(*) FROM ({_ROUTES})""",
    ),
    "published_dynamika_ruchu_small": _with(_TRIPS, _ZONES, _staged(window=_SMALL), _DYNAMICS),
    "published_finanse_small": _with(_TRIPS, _staged(*_IGNORED, window=_SMALL), _FINANCE),
    "published_trasy_small": _with(_TRIPS, _ZONES, _staged(window=_SMALL), _ROUTES),
    "scenario_filter_small": _with(_TRIPS, f"SELECT * FROM trips WHERE {_SMALL}"),
    "scenario_filter_medium": _with(_TRIPS, f"SELECT * FROM trips WHERE {_window('medium')}"),
    "scenario_filter_large": _with(_TRIPS, f"SELECT * FROM trips WHERE {_window('large')}"),
    "quality_filter": _with(_TRIPS, f"SELECT * FROM trips WHERE {_VALID}"),
    "calendar_parts": _with(
        _TRIPS, f"SELECT unique_key, trip_start_timestamp, {_CALENDAR} FROM trips"
    ),
    "speed_mph": _with(
        _TRIPS, f"SELECT unique_key, trip_miles, trip_seconds, {_SPEED} AS predkosc FROM trips"
    ),
    "tip_percent": _with(
        _TRIPS,
        f"""SELECT unique_key, tips, trip_total, {_TIP_ZERO} AS procent_zero,
               {_TIP_IGNORE} AS procent_ignore FROM trips""",
    ),
    "dedup_first_by_time": _with(_TRIPS, f"SELECT * FROM trips {_FIRST}"),
    "dedup_any": _with(_TRIPS, "SELECT DISTINCT unique_key, TRUE AS z_wejscia FROM trips"),
    "stage_trips": _with(_TRIPS, _staged(), "SELECT * FROM staged"),
    "stage_trips_null_tip_ignored": _with(_TRIPS, _staged(*_IGNORED), "SELECT * FROM staged"),
    "stage_trips_any": _with(
        _TRIPS,
        f"SELECT DISTINCT unique_key AS id_przejazdu, TRUE AS z_wejscia FROM trips WHERE {_VALID}",
    ),
    "sample_trips": _with(
        _TRIPS,
        # One percent of 16^15, as 15 hexadecimal digits.
        f"""SELECT trip_seconds, trip_miles, trip_total FROM trips
        WHERE substr(md5('7|' || length(unique_key) || ':' || unique_key), 1, 15)
              < '{int(0.01 * 16**15):015x}'""",
    ),
    "zone_join_left": _with(
        _TRIPS,
        _ZONES,
        """SELECT unique_key, pickup_community_area, nazwa_dzielnicy AS dzielnica_odbioru
        FROM trips LEFT JOIN zones ON pickup_community_area = id_dzielnicy""",
    ),
    "zone_pair_join": _with(_TRIPS, _ZONES, _ZONE_PAIR),
    "zone_pair_join_chicago": _with(_TRIPS, _CHICAGO, _ZONE_PAIR),
    "mart_dynamika_ruchu": _with(_TRIPS, _ZONES, _staged(), _DYNAMICS),
    "mart_finanse": _with(_TRIPS, _staged(), _FINANCE),
    "mart_finanse_null_tip_ignored": _with(_TRIPS, _staged(*_IGNORED), _FINANCE),
    "mart_trasy": _with(_TRIPS, _ZONES, _staged(), _ROUTES),
    "audit_uniqueness_by_year": _with(
        _TRIPS,
        """SELECT CAST(year(trip_start_timestamp) AS INTEGER) AS rok,
               COUNT(*) AS wszystkie_przejazdy,
               COUNT(DISTINCT unique_key) AS unikalne_przejazdy,
               ROUND((COUNT(*) - COUNT(DISTINCT unique_key)) / COUNT(*) * 100, 5)
                   AS pct_duplikatow
        FROM trips GROUP BY 1 ORDER BY 1 NULLS FIRST""",
    ),
    "null_profile": _with(
        _TRIPS,
        "SELECT " + ", ".join(f"{_null_rate(c)} AS {c}" for c in _AUDITED) + " FROM trips",
    ),
    "null_profile_long": _with(
        _TRIPS,
        " UNION ALL ".join(
            f"SELECT '{c}' AS kolumna, {_null_rate(c)} AS \"procent_NULL\" FROM trips"
            for c in _AUDITED
        )
        + " ORDER BY 2 DESC, 1",
    ),
    "describe_numeric": _with(
        _TRIPS,
        _LONG,
        """SELECT kolumna, COUNT(wartosc) AS "count", ROUND(AVG(wartosc), 4) AS mean,
               ROUND(STDDEV_SAMP(wartosc), 4) AS std, ROUND(MIN(wartosc), 4) AS "min",
               ROUND(quantile_cont(wartosc, 0.01), 4) AS "1%",
               ROUND(quantile_cont(wartosc, 0.5), 4) AS "50%",
               ROUND(quantile_cont(wartosc, 0.99), 4) AS "99%",
               ROUND(MAX(wartosc), 4) AS "max"
        FROM long GROUP BY kolumna""",
    ),
    "trim_p99": _with(_TRIPS, _LONG, _TRIMMED, "SELECT kolumna, wartosc FROM trimmed"),
    "histogram30": _with(
        _TRIPS,
        _LONG,
        _TRIMMED,
        """ends AS (
            SELECT kolumna, MIN(wartosc) AS lo, MAX(wartosc) AS hi FROM trimmed GROUP BY kolumna
        ), bins AS (
            SELECT kolumna, kosz, lo + kosz * ((hi - lo) / 30) AS od,
                   CASE WHEN kosz = 29 THEN hi ELSE lo + (kosz + 1) * ((hi - lo) / 30) END AS "do"
            FROM ends, (SELECT unnest(range(30)) AS kosz)
        )""",
        """SELECT b.kolumna, b.kosz, ROUND(b.od, 6) AS od, ROUND(b."do", 6) AS "do",
               COUNT(t.wartosc) AS liczba
        FROM bins b LEFT JOIN trimmed t
          ON t.kolumna = b.kolumna AND t.wartosc >= b.od
         AND (t.wartosc < b."do" OR (b.kosz = 29 AND t.wartosc <= b."do"))
        GROUP BY b.kolumna, b.kosz, b.od, b."do" """,
    ),
    "kde200": _with(
        _TRIPS,
        _LONG,
        _TRIMMED,
        """shape AS (
            SELECT kolumna, COUNT(*) AS n, MIN(wartosc) AS lo, MAX(wartosc) AS hi,
                   STDDEV_SAMP(wartosc) * POWER(COUNT(*), -0.2) AS h
            FROM trimmed GROUP BY kolumna
        ), tally AS (
            SELECT kolumna, wartosc, COUNT(*) AS ile FROM trimmed GROUP BY ALL
        ), grid AS (
            SELECT *, CASE WHEN punkt = 199 THEN hi ELSE lo + punkt * ((hi - lo) / 199) END AS x
            FROM shape, (SELECT unnest(range(200)) AS punkt)
        )""",
        """SELECT g.kolumna, g.punkt, ROUND(g.x, 6) AS x,
               ROUND(SUM(t.ile * EXP(-0.5 * POWER((g.x - t.wartosc) / g.h, 2)))
                     / (g.h * SQRT(2 * PI())) * (g.hi - g.lo) / 30, 3) AS gestosc
        FROM grid g JOIN tally t ON t.kolumna = g.kolumna
        GROUP BY g.kolumna, g.punkt, g.x, g.h, g.lo, g.hi""",
    ),
}

# Whole runs of every size. The file variant leaves missing tips out of the means.
_TIPS = {"etl": _IGNORED, "elt": ("tips", _TIP_ZERO)}
_MART_SQL = {
    "mart_dynamika_ruchu": _DYNAMICS, "mart_finanse": _FINANCE, "mart_trasy": _ROUTES,
}
ORACLE |= {
    f"{variant}_{mart}_{size}": _with(_TRIPS, _ZONES, _staged(*tips, window=_window(size)), sql)
    for variant, tips in _TIPS.items()
    for mart, sql in _MART_SQL.items()
    for size in SCENARIOS
}
