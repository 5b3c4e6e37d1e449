"""Connected components of an edge table, as alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import checkpoint_dir


def _cut(df: DataFrame) -> DataFrame:
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.col("a").cast("decimal(38,0)")),
                           F.sum(F.col("b").cast("decimal(38,0)")),
                           F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(a long, b long)`` -> ``(node long, component long)``, one row per node that
    has an edge to another node; ``component`` is the smallest node id reachable.

    Each round hooks every neighbour larger than a node to the node's smallest
    neighbour, then every smaller one likewise, until nothing changes.  A node's minimum
    is a partial aggregate joined back on the node, so a hub is never one group in memory.
    Null ends and self loops are ignored; no edges gives no rows.
    """
    cur = _cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
               .where("a <> b").distinct())
    before = _state(cur)
    while before[0]:
        both = cur.union(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select("a", "b", "m")
        cur = _cut(small.select("a", F.col("m").alias("b"))
                   .union(small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct())
        after = _state(cur)
        if after == before:
            break
        before = after
    labels = cur.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("node"), "component")
    roots = cur.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return labels.union(roots)
