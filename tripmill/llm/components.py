"""Connected components of a graph of links, as Spark joins and aggregates.

Alternates two steps until nothing changes: every node passes its least
neighbour to its larger neighbours (large star), then to its smaller ones
(small star). Paths shorten by half each time, and no group is ever gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.frames import keep


def _mark(edges: DataFrame) -> tuple:
    """A fingerprint of a set of links: how many, and the sum of their hashes."""
    mixed = F.xxhash64("u", "v") % F.lit(1 << 40)
    return tuple(edges.agg(F.count("*"), F.sum(mixed)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return (
        both.join(least, "u")
        .filter((F.col("v") > F.col("u")))
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` go from larger to smaller."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = (
        edges.join(least, "u")
        .filter(F.col("v") != F.col("m"))
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
    )
    return others.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, work: str) -> DataFrame:
    """``node, root`` for every node of ``links`` (two long columns, any order).

    ``root`` is the least node that can be reached; a root has a row for itself.
    """
    a, b = links.columns[:2]
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = keep(edges.filter("u != v").distinct(), work, "edges")
    before = None
    while before != (before := _mark(edges)):
        edges = keep(_small_star(_large_star(edges)), work, "edges")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return roots.union(edges.select(F.col("u").alias("node"), F.col("v").alias("root")))
