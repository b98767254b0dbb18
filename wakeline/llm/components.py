"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.session import settle


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """node and component (the smallest node reachable) of every node that has an edge to another.

    edges: columns a and b. Each round links every node's neighbours to the smallest of them, first the
    larger neighbours, then the smaller ones, and cuts the lineage; rounds end when the edges, compared by
    their number and checksum, stay as they were. Minima are taken by partial aggregation, so that a node
    with very many neighbours does not gather them in one task. Self links and nulls are ignored; no edges
    give no rows.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = settle(e)
    seen = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        star = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = star.groupBy("u").agg(F.min("v").alias("m"))
        near = star.join(low, "u")
        e = near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        e = settle(e)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
