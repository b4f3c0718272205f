"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm.common import drop_staged, staged


def _min_neighbour(edges: DataFrame, direction: str) -> DataFrame:
    """(n, v, m): every neighbour ``v`` of ``n`` with ``m`` the smallest of n and its neighbours.

    The minimum is a partial aggregate joined back, so a node with very many
    neighbours is combined map-side and its rows stay splittable in the join.
    """
    low = F.least(F.col("n"), F.min("v")).alias("m")
    return edges.join(edges.groupBy("n").agg(low), "n").select("n", "v", "m") if direction == "both" else \
        edges.join(edges.groupBy("n").agg(F.min("v").alias("m")), "n").select("n", "v", "m")


def connected_components(spark: SparkSession, edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with an edge; root is the component's smallest node.

    Alternates large-star and small-star steps until the edge set stops
    changing; each round is written to the shared folder in place of the one before.  Self loops, NULL
    ends and repeated edges are ignored; an empty table gives an empty result.
    """
    cur = staged(spark, edges.where(f"{a} IS NOT NULL AND {b} IS NOT NULL AND {a} <> {b}")
                 .select(F.greatest(a, b).alias("n"), F.least(a, b).alias("v")).distinct(), "cc")
    mark = None
    while True:
        sign = cur.agg(F.count("*"), F.bit_xor(F.xxhash64("n", "v"))).first()
        if tuple(sign) == mark or sign[0] == 0:
            break
        mark = tuple(sign)
        both = cur.select("n", "v").unionAll(cur.select(F.col("v").alias("n"), F.col("n").alias("v")))
        large = _min_neighbour(both, "both").where("v > n").select(F.col("v").alias("n"), F.col("m").alias("v")) \
            .distinct()
        nb = _min_neighbour(large, "down")
        small = nb.where("v <> m").select(F.col("v").alias("n"), F.col("m").alias("v")) \
            .unionAll(nb.select("n", F.col("m").alias("v"))).distinct()
        before, cur = cur, staged(spark, small, "cc")
        drop_staged(spark, before)
    return cur.select(F.col("n").alias("node"), F.col("v").alias("root")) \
        .unionAll(cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
