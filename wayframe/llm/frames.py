"""Small helpers over DataFrames that several operators share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def components(edges: DataFrame, settle) -> DataFrame:
    """Connected components as (node, component): the smallest node reachable.

    ``edges`` has bigint columns a and b. Every round links each node and its neighbours to
    the smallest of them, then shortens paths by following the link once more, so that the
    number of rounds is logarithmic for chains too. Rounds are written tables; the driver
    sees one number per round. Nodes may have any number of links: a node's neighbours are
    only ever reduced to their minimum.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = settle(both.where("a <> b").distinct())
    labels = settle(both.groupBy("a").agg(F.min("b").alias("low")).select(
        F.col("a").alias("node"), F.least("a", "low").alias("label")))
    while True:
        # The smallest label around each node, offered to the node's own label as well.
        around = (
            both.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy("a").agg(F.min("label").alias("near"))
            .join(labels.select(F.col("node").alias("a"), "label"), "a")
            .select("a", "label", F.least("label", "near").alias("near"))
        )
        around = settle(around)
        offers = (
            around.select(F.col("a").alias("node"), F.col("near").alias("label"))
            .union(around.select(F.col("label").alias("node"), F.col("near").alias("label")))
            .groupBy("node").agg(F.min("label").alias("label"))
        )
        hop = offers.select(F.col("node").alias("label"), F.col("label").alias("next"))
        after = settle(
            offers.join(hop, "label", "left")
            .select("node", F.coalesce("next", "label").alias("label"))
        )
        moved = after.join(labels.withColumnRenamed("label", "was"), "node").where("label <> was")
        done = moved.isEmpty()
        labels = after
        if done:
            return labels.withColumnRenamed("label", "component")
