"""Connected components of a distributed edge list.

Alternating large-star and small-star rounds (Kiveris et al., "Connected
Components in MapReduce and Beyond", SoCC 2014).  Every round is two
aggregations and two joins over edges; nothing is gathered per node, so a hub
with a third of the edges is an ordinary (splittable) join key.  Each round is
written to the shared checkpoint folder, which bounds the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return (both.where("b > a").join(low, "a")
                .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(low.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple[int, int]:
    h = F.xxhash64("a", "b")
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(h).alias("x")).first()
    return row["n"], row["x"] or 0


def connected_components(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of every node that has a link; component = smallest node.

    ``pairs`` may hold repeated, reversed and self pairs; rows with a null end
    link nothing.  Nodes without links do not appear.
    """
    edges = (pairs.where(F.col(a).isNotNull() & F.col(b).isNotNull())
                  .select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
                  .where("a > b").distinct()).checkpoint(eager=True)
    state = _state(edges)
    while state[0]:
        edges = _small_star(_large_star(edges)).checkpoint(eager=True)
        now = _state(edges)
        if now == state:
            break
        state = now
    return (edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
                 .union(edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct())
