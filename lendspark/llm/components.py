"""Connected components of links by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendspark.llm.common import written


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component) for each node that has a link; the component is its least node.

    Every round is two joins of the links with their nodes' least neighbours, written to
    the shared folder; the links never reach the driver. A link to oneself or to null is
    no link; no links give no rows.
    """
    edges = links.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u <> v")
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = written(edges, "edges")
    before = None
    while True:
        # Large star: each node hands its greater neighbours to its least one.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        greater = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Small star: each node and its lesser neighbours go to the least of them.
        edges = written(greater.where("u <> v").distinct(), "edges")
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        lesser = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        joined = lesser.unionByName(least.select("u", F.col("m").alias("v")))
        edges = written(joined.where("u <> v").distinct(), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
