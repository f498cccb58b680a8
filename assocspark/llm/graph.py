"""Joins against id sets of checked size, and connected components of link tables."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import stage

#: Ids that may be broadcast (8 bytes each); larger sets are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def only_ids(docs: DataFrame, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows of ``docs`` whose doc_id is (left_semi) or is not (left_anti) in ``ids``, a written table of distinct doc_ids."""
    return docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "doc_id", how)


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (columns a, b); the component is its smallest node.

    Every round hooks each node on its smallest neighbour, shortens the paths and contracts the links, until none is left.
    Rounds are written to the shared folder. Links of one node are only aggregated or joined, never gathered.
    """
    links = stage(links.selectExpr("CAST(a AS long) AS a", "CAST(b AS long) AS b").where("a <> b").distinct())
    labels = links.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("component", F.col("node"))
    while not links.isEmpty():
        both = links.select("a", "b").union(links.select("b", "a"))
        parent = stage(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("up")))
        for _ in range(2):
            above = parent.select(F.col("node").alias("up"), F.col("up").alias("top"))
            parent = parent.join(above, "up", "left").select("node", F.coalesce("top", "up").alias("up"))
        parent = stage(parent)
        up = parent.select(F.col("node").alias("component"), "up")
        labels = stage(labels.join(up, "component", "left").select("node", F.coalesce("up", "component").alias("component")))
        a, b = parent.select(F.col("node").alias("a"), F.col("up").alias("ua")), parent.select(F.col("node").alias("b"), F.col("up").alias("ub"))
        links = stage(links.join(a, "a").join(b, "b").select(F.col("ua").alias("a"), F.col("ub").alias("b")).where("a <> b").distinct())
    return labels
