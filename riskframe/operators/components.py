"""Connected components of an undirected edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.lookup import lookup_join, spread_join
from riskframe.session import checkpointed


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``nodes(node)``, ``edges(a, b)`` -> (node, component), the smallest node of each component.

    Alternating large-star and small-star steps, which need a logarithmic number of
    rounds.  Every round is checkpointed, so lost executors do not replay the loop.
    """
    current = checkpointed(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    state = _fingerprint(current)
    while True:
        current = checkpointed(_small_star(checkpointed(_large_star(current))))
        latest = _fingerprint(current)
        if latest == state:
            break
        state = latest
    roots = current.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    joined = lookup_join(nodes.select("node").distinct(), roots, ["node"], "left")
    return joined.select("node", F.coalesce("component", "node").alias("component"))


def _fingerprint(edges: DataFrame) -> tuple:
    hashed = F.xxhash64("u", "v")
    row = edges.agg(
        F.count(F.lit(1)), F.bit_xor(hashed), F.sum(hashed.cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    larger = both.where(F.col("v") > F.col("u"))
    linked = spread_join(larger, lowest, ["u"], "inner", spread_by="v")
    return linked.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    lowest = edges.groupBy("u").agg(F.min("v").alias("m"))
    linked = spread_join(edges, lowest, ["u"], "inner", spread_by="v")
    others = linked.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct()
