"""Connected components of a distributed edge list, by alternating large and small stars.

Each step is one aggregation and one join on the edges, so no node's edges meet in one task (the engine splits a skewed
join side), and only counts come to the driver. Steps are written tables, so the lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import Scratch


def _least(edges: DataFrame) -> DataFrame:
    """The smallest of each node u and its neighbours v."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are hung on the smallest of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are hung on the smallest of these."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    hung = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """edges: u, v of one orderable type. Returns node, root: the smallest node reachable, for all but the roots.

    Steps go on until one changes nothing: a number that grows with the logarithm of the longest path, squared at worst.
    """
    scratch = Scratch(edges.sparkSession, "components")
    mark = [F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))]
    now = scratch.save(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
    seen = now.agg(*mark).first()
    while seen[0]:
        large = scratch.save(_large_star(now))
        small = scratch.save(_small_star(large))
        scratch.drop(now, large)
        now, before, seen = small, seen, small.agg(*mark).first()
        if seen == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
