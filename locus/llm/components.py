"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locus.llm.common import attach_salted, remove, written


def _lowest(edges: DataFrame, salts: int) -> DataFrame:
    """Edges (u, v) with the lowest v of their u as ``m``."""
    lows = edges.groupBy("u").agg(F.min("v").alias("m"))
    return attach_salted(edges, lows, ["u"], F.col("v"), salts)


def connected_components(links: DataFrame, salts: int = 8) -> DataFrame:
    """(node, component) of all nodes of ``links`` (u, v longs), the component
    being its smallest node.

    Each round connects every node's larger neighbours to its lowest one
    (large star), then its smaller neighbours likewise (small star); rounds
    are logarithmic in the longest path. Links stay rows, a node's links are
    never gathered, and every round is a written table in place of the last. Ends when a round
    changes nothing; then every node points at its component."""
    edges, path = written(links.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    mark = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _lowest(both, salts).where("v > u").select(
            F.col("v").alias("u"), F.least("m", "u").alias("v")).where("u <> v").distinct()
        near = _lowest(large, salts)
        small = near.select("u", F.col("m").alias("v")).union(
            near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()
        edges, newer = written(small, "links")
        remove(edges.sparkSession, path)
        path = newer
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    ends = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return ends.union(ends.select(F.col("component").alias("node"), "component").distinct())
