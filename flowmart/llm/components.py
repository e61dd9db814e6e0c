"""Connected components of an edge table, by repeated minimum and pointer jumping on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from flowmart.llm.common import shared_dir, stored


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node that an edge touches: ``label`` is the smallest node reachable from it.

    ``edges`` holds node pairs ``a``, ``b`` of one type, in either direction and possibly repeated; loops and pairs with
    a null are ignored. Each round lowers every label to the least among the neighbours and then to that label's own
    label, so chains halve; it ends when a round changes nothing. Rounds are written tables: a lost executor costs
    a re-read, and a node with very many edges is split where it is joined and pre-summed where it is grouped.
    """
    spark = edges.sparkSession
    pairs = edges.where("a != b").select("a", "b")
    both = stored(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = stored(both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("label")))
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("low"))
        lower = stored(labels.join(near, labels["node"] == near["a"]).select("node", F.least("label", "low").alias("label"), F.col("label").alias("was")))
        up = lower.select(F.col("node").alias("label"), F.col("label").alias("top"))
        path, seen = shared_dir(spark, "components"), Observation()
        moved = (F.coalesce("top", "label") != F.col("was")).cast("long")
        lower.join(up, "label", "left").observe(seen, F.sum(moved).alias("moved")).select(
            "node", F.coalesce("top", "label").alias("label")
        ).write.parquet(path)
        labels = spark.read.schema(labels.schema).parquet(path)
        if not seen.get["moved"]:
            return labels
