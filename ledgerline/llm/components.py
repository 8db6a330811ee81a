"""Connected components by large-star / small-star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``edges``; root is the smallest node it
    reaches. Each half round is a grouped minimum and a join back, so a node
    with very many neighbours is pre-aggregated and its join can be split.
    Every round is a written table; two are kept at a time. Self loops and
    repeated edges are harmless; no edges give no rows."""
    scratch = Scratch(edges.sparkSession, "components")
    pair = [F.greatest(a, b).alias("u"), F.least(a, b).alias("v")]
    now = scratch.save(edges.select(*pair).where("u <> v").distinct())
    mark = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = scratch.save(large.distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                 .union(low.select("u", F.col("m").alias("v"))).distinct())
        after = scratch.save(small)
        scratch.drop(now)
        scratch.drop(large)
        seen = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        now = after
        if mark == tuple(seen):
            break
        mark = tuple(seen)
    roots = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
