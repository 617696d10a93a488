"""Connected components by alternating stars, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root): every node of ``edges`` (a, b long) but the roots, with the smallest node it reaches.

    Each round lets every node hand its larger neighbours to its smallest one
    (large star), then gathers its smaller neighbours under the smallest
    (small star). A hub's neighbours are only counted by a minimum and joined,
    never gathered. Each round is a written table.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = stored(e, "edges")
    for _ in range(rounds):
        children = e.groupBy("u").count()
        nested = e.select(F.col("v").alias("u")).join(children.select("u"), "u", "left_semi")
        if children.where("count > 1").isEmpty() and nested.isEmpty():
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        e = stored(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
    raise RuntimeError("components did not settle")
