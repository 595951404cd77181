"""Exact statistics of numeric columns, from distinct values and their counts.

``value_counts`` reads the table once and combines equal values before its
shuffle; everything else takes its result (best written out first, as
``profile.value_table`` does), so a value that fills a third of the table is a
single row here. Per column, the output is a handful of rows; no step puts all
values of a column into one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# How finely percentiles narrow down the values around a rank. The first cut is
# by magnitude, 1024 bins per power of two, so the values of a bin differ by less
# than 0.07 percent and at most 2**42.5 different doubles fit into one. Two cuts
# into 4096 equal parts leave at most 2**18.5 (about 370,000) of them, no matter
# how many rows there are or how they are spread.
MAGNITUDE_BINS = 1024
NARROW_BINS = 4096
NARROW_STEPS = 2

# No double lies outside 2**-1074 to 2**1024.
_MIN_EXPONENT, _MAX_EXPONENT = -1074, 1024

# exp(-z * z / 2) is exactly 0.0 in double precision beyond this distance.
_KERNEL_REACH = 38.7


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``kolumna, wartosc, liczba``: how often each value occurs.

    Null and NaN count as missing, as they do in a pandas summary.
    """
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    return (
        wide.unpivot([], list(columns), "kolumna", "wartosc")
        .filter(F.col("wartosc").isNotNull() & ~F.isnan("wartosc"))
        .groupBy("kolumna", "wartosc")
        .agg(F.count("*").alias("liczba"))
    )


def totals(counts: DataFrame) -> DataFrame:
    """One row per column: ``kolumna, n, lo, hi, srednia``."""
    return counts.groupBy("kolumna").agg(
        F.sum("liczba").alias("n"),
        F.min("wartosc").alias("lo"),
        F.max("wartosc").alias("hi"),
        (F.sum(F.col("wartosc") * F.col("liczba")) / F.sum("liczba")).alias("srednia"),
    )


def deviations(counts: DataFrame, whole: DataFrame) -> DataFrame:
    """``whole`` with ``odchylenie``, the sample standard deviation.

    The mean is taken off each value first, as sums of plain squares lose digits.
    ``whole`` has one row per column, which bounds the broadcast.
    """
    square = F.pow(F.col("wartosc") - F.col("srednia"), 2) * F.col("liczba")
    # The mean of equal values may be a rounding error away from them.
    spread = F.when(F.col("lo") == F.col("hi"), F.lit(0.0)).otherwise(
        F.sqrt(F.sum(square) / (F.col("n") - 1))
    )
    return (
        counts.join(F.broadcast(whole), "kolumna")
        .groupBy(*whole.columns)
        .agg(F.when(F.col("n") > 1, spread).alias("odchylenie"))
    )


def _rank(p: float) -> Column:
    """The position of percentile ``p`` among ``n`` sorted values, from 0."""
    return F.lit(p) * (F.col("n") - 1)


def _holds(k: Column) -> Column:
    return (F.col("przed") <= k) & (k < F.col("do_tad"))


def _wanted(probabilities: Sequence[float]) -> Column:
    """Whether a bin holds a rank that some percentile needs."""
    return reduce(or_, [_holds(f(_rank(p))) for p in probabilities for f in (F.floor, F.ceil)])


def _magnitude() -> Column:
    """A whole number that never falls as ``wartosc`` grows."""
    exponent = F.floor(F.log2(F.abs("wartosc")) * MAGNITUDE_BINS)
    top = F.lit(_MAX_EXPONENT * MAGNITUDE_BINS).cast("bigint")
    size = F.least(exponent, top) - _MIN_EXPONENT * MAGNITUDE_BINS + 1
    return (
        F.when(F.col("wartosc") > 0, size)
        .when(F.col("wartosc") < 0, -size)
        .otherwise(F.lit(0).cast("bigint"))
    )


def _whole(value: Column) -> Column:
    """An aggregate over all rows of a column."""
    return value.over(W.partitionBy("kolumna"))


def _up_to_here(*within: str) -> Column:
    """How many values the bins of a column or range hold, up to this one."""
    ordered = W.partitionBy("kolumna", *within).orderBy("kosz")
    return F.sum("liczba").over(ordered.rowsBetween(W.unboundedPreceding, W.currentRow))


def _ranges(bins: DataFrame, carried: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """One row per column: the bins with a wanted rank, cut to their values, as ``zakresy``.

    A column has at least one such bin and at most two per percentile.
    """
    one = F.struct("od", "do", "przed")
    return (
        bins.filter(_wanted(probabilities))
        .groupBy("kolumna", *carried)
        .agg(F.sort_array(F.collect_list(one)).alias("zakresy"))
    )


def _first_step(counts: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """Bins by magnitude, whose sums also give ``n, lo, hi, srednia`` of each column."""
    bins = counts.groupBy("kolumna", _magnitude().alias("kosz")).agg(
        F.sum("liczba").alias("liczba"),
        F.sum(F.col("wartosc") * F.col("liczba")).alias("suma"),
        F.min("wartosc").alias("od"),
        F.max("wartosc").alias("do"),
    )
    whole = {
        "n": _whole(F.sum("liczba")),
        "lo": _whole(F.min("od")),
        "hi": _whole(F.max("do")),
        "suma_kolumny": _whole(F.sum("suma")),
        "do_tad": _up_to_here(),
    }
    placed = bins.withColumns(whole).withColumns({
        "przed": F.col("do_tad") - F.col("liczba"),
        "srednia": F.col("suma_kolumny") / F.col("n"),
    })
    return _ranges(placed, ["n", "lo", "hi", "srednia"], probabilities)


def _next_step(
    counts: DataFrame,
    ranges: DataFrame,
    bin_of: Column,
    carried: Sequence[str],
    probabilities: Sequence[float],
    squares: bool = False,
) -> DataFrame:
    """Read the values again and cut each range of ``ranges`` into bins.

    ``ranges`` has one row per column, which bounds the broadcast; of its ranges, at most two
    per percentile, a value can lie in one. With ``squares``, all values add to their column's
    ``kwadraty``, the squared distances from its mean; else those outside drop out.
    Result: bins with ``przed`` and ``do_tad``, the number of values below and up to here.
    """
    most = 2 * len(probabilities)
    found = [F.get("zakresy", F.lit(i)) for i in range(most)]
    of_value = F.coalesce(*[
        F.when(F.col("wartosc").between(z["od"], z["do"]), z) for z in found
    ])
    rows = counts.join(F.broadcast(ranges), "kolumna").withColumn("zakres", of_value)
    if not squares:
        rows = rows.filter(F.col("zakres").isNotNull())
    sums = {
        "liczba": F.sum("liczba"),
        "od": F.min("wartosc"),
        "do": F.max("wartosc"),
    }
    if squares:
        # The mean is taken off each value first, as sums of plain squares lose digits.
        distance = F.pow(F.col("wartosc") - F.col("srednia"), 2) * F.col("liczba")
        sums["kwadraty"] = F.sum(distance)
    bins = rows.groupBy(
        "kolumna",
        *carried,
        F.col("zakres.od").alias("zakres_od"),
        F.col("zakres.przed").alias("zakres_przed"),
        F.when(F.col("zakres").isNotNull(), bin_of).alias("kosz"),
    ).agg(*[value.alias(name) for name, value in sums.items()])
    if squares:
        bins = bins.withColumn("kwadraty", _whole(F.sum("kwadraty")))
    return (
        bins.filter(F.col("zakres_od").isNotNull())
        .withColumn("do_tad", F.col("zakres_przed") + _up_to_here("zakres_od"))
        .withColumn("przed", F.col("do_tad") - F.col("liczba"))
    )


def ladder(
    counts: DataFrame,
    probabilities: Sequence[float],
    bins: int = NARROW_BINS,
    steps: int = NARROW_STEPS,
) -> DataFrame:
    """One row per column: ``kolumna, n, lo, hi, srednia, odchylenie, kwantyle``.

    ``odchylenie`` is the sample standard deviation (null for a single value) and ``kwantyle``
    holds ``p, kwantyl``: exact percentiles with linear interpolation.

    The values are read once for each step. The first counts them by magnitude and gives the
    moments that need no mean; each further one keeps only the bins around the wanted ranks, cut to
    their smallest and largest value, and the second also adds up squared distances
    from the mean; the last ranks the single values left over. With the default two
    narrowing steps these are four reads.

    One task ranks the bins of a column (or of a range), whose number the format
    of doubles bounds: 2 * 2098 * 1024 + 1 (4.3 million) bins by magnitude, fewer
    the narrower the values' range; 4096 in the next steps; 370,000 in the last.
    """
    carried = ["n", "lo", "hi", "srednia"]
    ranges = _first_step(counts, probabilities)
    z = F.col("zakres")
    width = z["do"] - z["od"]
    share = F.when(width > 0, (F.col("wartosc") - z["od"]) / width).otherwise(F.lit(0.0))
    bin_of = F.least(F.floor(share * bins), F.lit(bins - 1).cast("bigint"))
    for step in range(steps):
        narrow = _next_step(counts, ranges, bin_of, carried, probabilities, squares=step == 0)
        carried = ["n", "lo", "hi", "srednia", "kwadraty"]
        ranges = _ranges(narrow, carried, probabilities)
    single = _next_step(
        counts, ranges, F.col("wartosc"), carried, probabilities, squares=steps == 0
    )
    carried = ["n", "lo", "hi", "srednia", "kwadraty"]

    def value_at(k: Column) -> Column:
        return F.max(F.when(_holds(k), F.col("od")))

    marks = []
    for p in probabilities:
        at = _rank(p)
        low, high = value_at(F.floor(at)), value_at(F.ceil(at))
        marks.append(
            F.struct(
                F.lit(p).alias("p"),
                (low + (high - low) * (at - F.floor(at))).alias("kwantyl"),
            )
        )
    # The mean of equal values may be a rounding error away from them.
    spread = F.when(F.col("lo") == F.col("hi"), F.lit(0.0)).otherwise(
        F.sqrt(F.col("kwadraty") / (F.col("n") - 1))
    )
    return (
        single.filter(_wanted(probabilities))
        .groupBy("kolumna", *carried)
        .agg(F.array(*marks).alias("kwantyle"))
        .withColumn("odchylenie", F.when(F.col("n") > 1, spread))
        .select("kolumna", "n", "lo", "hi", "srednia", "odchylenie", "kwantyle")
    )


def quantiles(
    counts: DataFrame,
    probabilities: Sequence[float],
    bins: int = NARROW_BINS,
    steps: int = NARROW_STEPS,
) -> DataFrame:
    """``kolumna, p, kwantyl``: exact percentiles with linear interpolation; see ``ladder``."""
    return ladder(counts, probabilities, bins, steps).select("kolumna", F.inline("kwantyle"))


def upper_limits(counts: DataFrame, probability: float = 0.99) -> DataFrame:
    """``kolumna, granica``: the percentile at which each column is cut."""
    return quantiles(counts, [probability]).select("kolumna", F.col("kwantyl").alias("granica"))


def trim_upper(values: DataFrame, limits: DataFrame) -> DataFrame:
    """Values up to and including the limit of their column.

    ``values`` has ``kolumna, wartosc`` and possibly more; ``limits`` has one row
    per column. Missing values drop out with the comparison.
    """
    limits = F.broadcast(limits)
    return values.join(limits, "kolumna").filter(F.col("wartosc") <= F.col("granica")).drop(
        "granica"
    )


def histogram(counts: DataFrame, bins: int = 30) -> DataFrame:
    """``kolumna, kosz, od, do, liczba`` for equal-width bins, empty ones too.

    A bin holds ``od <= x < do``; the last one also holds its upper edge. A
    column with one value gets a range of width one around it.
    """
    whole = totals(counts)
    flat = F.col("lo") == F.col("hi")
    edges = whole.select(
        "kolumna",
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    ).withColumn("krok", (F.col("hi") - F.col("lo")) / bins)

    def edge(i):
        return F.when(i == bins, F.col("hi")).otherwise(F.col("lo") + i * F.col("krok"))

    last = F.lit(bins - 1).cast("bigint")
    guess = F.least(F.floor((F.col("wartosc") - F.col("lo")) / F.col("krok")), last)
    # The division may land one bin beside the edges that the result states.
    settled = (
        F.when(F.col("wartosc") < edge(F.col("kosz")), F.col("kosz") - 1)
        .when(
            (F.col("kosz") < last) & (F.col("wartosc") >= edge(F.col("kosz") + 1)),
            F.col("kosz") + 1,
        )
        .otherwise(F.col("kosz"))
    )
    filled = (
        counts.join(F.broadcast(edges), "kolumna")
        .withColumn("kosz", guess)
        .withColumn("kosz", settled)
        .groupBy("kolumna", "kosz")
        .agg(F.sum("liczba").alias("liczba"))
    )
    frame = edges.withColumn(
        "kosz", F.explode(F.sequence(F.lit(0).cast("bigint"), last))
    )
    return frame.join(filled, ["kolumna", "kosz"], "left").select(
        "kolumna",
        "kosz",
        edge(F.col("kosz")).alias("od"),
        edge(F.col("kosz") + 1).alias("do"),
        F.coalesce("liczba", F.lit(0)).cast("bigint").alias("liczba"),
    )


def density(counts: DataFrame, points: int = 200, bins: int = 30) -> DataFrame:
    """``kolumna, punkt, x, gestosc``: a Gaussian kernel density curve.

    Bandwidth by Scott's rule, ``points`` positions from the smallest to the
    largest value, scaled to the counts of a histogram with ``bins`` bins. A
    column without spread has no curve. Each distinct value meets only the grid
    points whose kernel term is not zero in double precision, and the terms are
    added up per point before the shuffle.
    """
    grid = (
        deviations(counts, totals(counts))
        .filter(F.col("odchylenie") > 0)
        .select(
            "kolumna",
            "lo",
            "hi",
            (F.pow("n", F.lit(-0.2)) * F.col("odchylenie")).alias("h"),
            ((F.col("hi") - F.col("lo")) / (points - 1)).alias("krok"),
            # One whole number per column and point is a cheaper key for the many
            # terms than a name and a number. One row per column goes into this.
            ((F.row_number().over(W.orderBy("kolumna")) - 1) * points).cast("bigint").alias("baza"),
        )
    )
    last = F.lit(points - 1).cast("bigint")
    first = F.lit(0).cast("bigint")
    offset = F.col("wartosc") - F.col("lo")
    reach = F.col("h") * _KERNEL_REACH
    near_from = F.greatest(first, F.ceil((offset - reach) / F.col("krok")))
    near_to = F.least(last, F.floor((offset + reach) / F.col("krok")))
    x = F.col("lo") + F.col("punkt") * F.col("krok")
    z = (x - F.col("wartosc")) / F.col("h")
    # Up to ``points`` exponentials per row: keep every shuffle partition a task
    # of its own, however few bytes it has. (By value alone, as Spark drops a
    # repartition on the keys that the counts are already partitioned by.)
    spark = counts.sparkSession
    spread = counts.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "wartosc")
    sums = (
        spread.join(F.broadcast(grid), "kolumna")
        .filter(near_from <= near_to)
        .withColumn("punkt", F.explode(F.sequence(near_from, near_to)))
        .withColumn("skladnik", F.col("liczba") * F.exp(-z * z / 2))
        .groupBy((F.col("baza") + F.col("punkt")).alias("miejsce"))
        .agg(F.sum("skladnik").alias("suma"))
    )
    # Density times the histogram's area: n values times the bin width.
    to_counts = (F.col("hi") - F.col("lo")) / bins / (F.col("h") * math.sqrt(2 * math.pi))
    return (
        grid.withColumn("punkt", F.explode(F.sequence(first, last)))
        .withColumn("miejsce", F.col("baza") + F.col("punkt"))
        .join(sums, "miejsce", "left")
        .select(
            "kolumna",
            "punkt",
            F.when(F.col("punkt") == last, F.col("hi")).otherwise(x).alias("x"),
            (F.coalesce("suma", F.lit(0.0)) * to_counts).alias("gestosc"),
        )
    )
