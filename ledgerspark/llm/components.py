"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.common import Scratch


def connected_components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``edges(a, b)``, undirected, any orderable type -> ``(node, label)``, label the smallest node reachable.

    Every node with an edge to another is returned, but for the smallest of each component. Every round is two aggregations with map-side
    combine and two joins on edge rows; a hot node is met by the aggregation and by AQE's skew join. Each
    round's edges are written to the scratch folder; rounds end when the edges no longer change.
    """
    e = (
        edges.where("a != b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u is not null and v is not null")
        .distinct()
    )
    e, before, k = scratch.save(e, f"{name}-0"), None, 0
    while True:
        stamp = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if stamp == before or stamp[0] == 0:
            break
        before, k = stamp, k + 1
        both = e.union(e.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("x"))
            .select(F.col("x.v").alias("u"), F.col("x.m").alias("v"))
            .where("u != v")
            .distinct()
        )
        e = scratch.save(small, f"{name}-{k}")
        scratch.drop(f"{name}-{k - 1}")
    return e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("label"))
