"""Connected components of an edge table, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import staged

LINKS_PER_FILE = 1 << 18


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest
    node of its component.

    Alternating large-star and small-star steps: each node points its larger
    neighbours, then its smaller ones, to the smallest neighbour. The edge count
    never grows, a node with very many neighbours is a skewed join side with one
    row per key on the other side, and a few rounds suffice for any shape. Each
    round is written to the shared folder, in files by the number of links: every
    file costs the executor's JVM a few processes that set its rights.
    """
    links = edges.where("a <> b").select(F.least("a", "b").alias("root"), F.greatest("a", "b").alias("node")).distinct()
    links, before = staged(links, "links"), None
    while True:
        now = links.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("root", "node").cast("decimal(20,0)")), F.lit(0))).first()
        if now == before or not now[0]:
            return links.select("node", "root").union(links.select(F.col("root").alias("node"), "root").distinct())
        before = now
        both = links.select(F.col("root").alias("u"), F.col("node").alias("v")).union(
            links.select(F.col("node").alias("u"), F.col("root").alias("v")))
        low = both.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m"))
        large = both.where("v > u").join(low, "u").where("v <> m").select(F.col("m").alias("p"), F.col("v").alias("c")).distinct()
        low = large.groupBy("c").agg(F.min("p").alias("m"))
        moved = large.join(low, "c").where("p <> m").select(F.col("m").alias("root"), F.col("p").alias("node"))
        links = moved.union(low.select(F.col("m").alias("root"), F.col("c").alias("node"))).distinct()
        links = staged(links.coalesce(-(-now[0] // LINKS_PER_FILE)), "links")
