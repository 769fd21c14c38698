"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of every node of ``edges(a, b)``, the component
    being its smallest node.  Rounds go on until nothing changes; each is
    written to the shared folder.  A hub's edges are joined, never grouped, so a
    skewed join can split them; the minima are aggregated map-side."""
    edges = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                        .distinct(), "components")
    before = _state(edges)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(lowest, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(lowest.select("u", F.col("m").alias("v"))))
        edges = materialize(small.distinct(), "components")
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node")).distinct()
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(roots.select("node", F.col("node").alias("component"))))
