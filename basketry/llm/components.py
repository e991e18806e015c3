"""Connected components of a table of links, by rounds of star contraction
(Kiveris et al. 2014, "Connected Components in MapReduce and Beyond").

Every round is two grouped aggregations and joins; its links are written to
the shared folder, so a lost executor costs one round at most. Aggregations
combine before the shuffle and joins on a hot node can be split by adaptive
execution, so a star with a third of all links doesn't meet in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch


def _checksum(edges: DataFrame):
    h = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.sum(h.cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("u")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
    out = both.where(F.col("b") > F.col("a")).join(least, F.col("a") == F.col("u"))
    return out.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    moved = down.join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("u", "m")).where("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b), bigint; root is the
    smallest node that can be reached. Links to itself, repeats and either
    direction are allowed; null ends are ignored. No links: no rows."""
    edges = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    edges = scratch(edges.where("a != b").select(F.greatest("a", "b").alias("a"),
                                                 F.least("a", "b").alias("b")).distinct(), "links")
    seen = None
    while (now := _checksum(edges)) != seen:
        if not now[0]:
            break
        seen = now
        edges = scratch(_small_star(_large_star(edges)), "links")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
