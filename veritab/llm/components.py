"""Distributed connected components: alternating large-star and small-star rounds.

Edges stay in DataFrames; the driver sees only a count and a checksum of each
round. A hub of any degree is safe: least neighbours are combined in the map
tasks, and the join back is split by AQE where a hub's side is large.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.llm.common import cut


def _large_star(edges: DataFrame) -> DataFrame:
    """Each neighbour above u moves to the least of u and its neighbours."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").where("v <> m").select(F.col("m").alias("u"), "v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each v and its neighbours below it move to the least of those."""
    least = edges.groupBy("v").agg(F.min("u").alias("m"))
    hung = edges.join(least, "v").where("u <> m").select(F.col("m").alias("u"), F.col("u").alias("v"))
    return hung.unionByName(least.select(F.col("m").alias("u"), "v")).distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of undirected `edges` (u long, v long): the least node reachable.

    Null ends and loops are ignored; no edges give no rows.
    """
    cols = edges.columns
    a, b = F.col(cols[0]).cast("long"), F.col(cols[1]).cast("long")
    now = cut(edges.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).where(a.isNotNull() & b.isNotNull() & (a != b)).distinct())
    mark = None
    for _ in range(max_rounds):
        seen = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if seen == mark or seen[0] == 0:
            break
        mark = seen
        now = cut(_small_star(_large_star(now)))
    else:
        raise RuntimeError(f"components didn't settle in {max_rounds} rounds")
    roots = now.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()
    return now.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(roots)
