"""Connected components by alternating large and small stars.

Every round replaces the links of a node by links to its smallest neighbour; no node's links are
ever gathered in one task (minima are combined on the map side, the join on a hub can be split).
Rounds are written to the shared folder, so lost executors cost a task and not the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.session import pin


def _mark(edges: DataFrame):
    return edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()


def connected(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v: long); root is the smallest node reachable.

    Links may come repeated, in either direction, or from a node to itself (ignored). No links:
    no rows. Raises if it has not settled after ``rounds`` (their number grows with the logarithm
    of the size).
    """
    links = pin(
        edges.filter("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    mark = _mark(links)
    if mark[0] == 0:
        return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    for _ in range(rounds):
        both = links.union(links.select("v", "u"))
        # Written apart, so that the join deals both sides anew and the links of a hub can be split.
        least = pin(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")))
        large = (
            both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.filter("m < u").select("u", F.col("m").alias("v")))
            .filter("u <> v").distinct()
        )
        nearest = pin(large.groupBy("u").agg(F.min("v").alias("m")))
        small = (
            large.join(nearest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(nearest.select("u", F.col("m").alias("v")))
            .filter("u <> v").distinct()
        )
        links = pin(small)
        after = _mark(links)
        if after == mark:
            stars = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return stars.union(links.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
        mark = after
    raise RuntimeError(f"components have not settled after {rounds} rounds")
