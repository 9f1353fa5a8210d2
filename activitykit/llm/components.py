"""Connected components of an edge table by alternating large-star and small-star steps.

Each step is an aggregate (smallest neighbour) and a join on the node; nothing is gathered per
node, so a node may have any number of edges. Every step's edges are written to the shared
checkpoint folder, which cuts the lineage. Ends when a round leaves the edges as they were.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activitykit.llm.common import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, key: str, root: str = "root") -> DataFrame:
    """(key, root) for every node of ``edges(u, v)``: the smallest node it is linked to.

    Roots themselves are rows too. Nulls and self links are ignored; an empty table gives none.
    """
    pairs = edges.filter("u is not null and v is not null and u <> v")
    now = cut_lineage(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = _mark(now)
    while mark[0]:
        now = cut_lineage(_small_star(_large_star(now)))
        before, mark = mark, _mark(now)
        if before == mark:
            break
    roots = now.select(F.col("v").alias(key), F.col("v").alias(root)).distinct()
    return now.select(F.col("u").alias(key), F.col("v").alias(root)).unionByName(roots)
