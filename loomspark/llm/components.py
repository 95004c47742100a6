"""Connected components of a graph given as an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspark.llm.scratch import written


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (src, dst: long); component is the smallest node it reaches.

    Each round joins the edges with a pre-aggregated minimum per node (a hot node is one row there, and its edges are
    split by the adaptive skew join), and is written to the shared folder, so the lineage stays short. The rounds end
    when the edges no longer change: the graph is then a forest of stars around the smallest nodes. Self-loops, repeated
    edges and null ends are ignored; an empty table gives an empty result.
    """
    e = (
        edges.where("src <> dst")
        .select(F.greatest("src", "dst").alias("a"), F.least("src", "dst").alias("b"))
        .distinct()
    )
    e, before = written(e, "cc"), None
    while True:
        both = e.union(e.select(F.col("b"), F.col("a")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = (
            both.join(least, "a")
            .where("b > a and b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(
            F.explode(
                F.array(
                    F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))
                )
            )
            .alias("x")
        )
        e = written(small.select("x.a", "x.b").where("a <> b").distinct(), "cc")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return e.select(
        F.col("a").alias("node"), F.col("b").alias("component")
    ).union(e.select(F.col("b"), F.col("b")).distinct())
