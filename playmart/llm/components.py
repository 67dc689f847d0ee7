"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stored


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Hook every neighbour of a node (larger ones, or all smaller ones and the node) to the least of them."""
    if small:
        best = edges.groupBy("a").agg(F.min("b").alias("m"))
        hooked = edges.join(best, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                                                                F.struct(F.col("a"), F.col("m").alias("b")))).alias("e"))
        hooked = hooked.select("e.a", "e.b")
    else:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        best = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        hooked = both.where("b > a").join(best, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hooked.where("a != b").distinct()


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the least node of its component."""
    edges = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(),
                   f"{name}-edges")
    before = None
    while True:
        edges = stored(_star(_star(edges, small=False), small=True), f"{name}-star")
        # at the end every node hangs on its root: one edge a node, roots hang on nothing
        now = tuple(edges.agg(F.count("*"), F.countDistinct("a"), F.coalesce(F.expr("bit_xor(xxhash64(a, b))"), F.lit(0))).first())
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = now
