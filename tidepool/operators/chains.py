"""Iterations over links between rows: groups that are linked by way of others, and decisions taken in order."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where that is unset in a local session (tests), a temporary one."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if where is None:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = tempfile.mkdtemp(prefix="spark-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def cut_lineage(df: DataFrame) -> DataFrame:
    """df written to the session's shared folder, so that what follows doesn't depend on what came before."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def groups(links: DataFrame) -> DataFrame:
    """(node, component) of links(a, b): the smallest node reachable, by rounds of taking the neighbours' smallest.

    A round also jumps to the label's own label, so rounds grow with the logarithm of the longest chain.
    """
    both = cut_lineage(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    label = both.select(F.col("a").alias("node")).distinct().withColumn("component", F.col("node"))
    while True:
        near = both.join(label.select(F.col("node").alias("b"), "component"), "b").groupBy("a").agg(F.min("component").alias("near"))
        stepped = label.join(near, label["node"] == near["a"]).select("node", F.col("component").alias("was"), F.least("component", "near").alias("component"))
        jump = stepped.select(F.col("node").alias("component"), F.col("component").alias("further"))
        label = stepped.join(jump, "component", "left").select("node", "was", F.least("component", F.coalesce("further", "component")).alias("component"))
        label = cut_lineage(label)
        if label.filter("component <> was").isEmpty():
            return label.drop("was")
        label = label.drop("was")


def refused_in_order(links: DataFrame) -> DataFrame:
    """The nodes that are refused when rows are taken in order and each that has a link to a row taken before is refused.

    links has (later, earlier). This is the first maximal independent set of an order: a row is settled once all
    earlier rows it is linked with are. In a round, rows without an open earlier row are taken and rows linked with
    them are refused; links of settled rows go. Rounds are as many as decisions that wait for each other, about
    the logarithm of the rows where links don't follow the order.
    """
    spark = links.sparkSession
    links = cut_lineage(links.select("later", "earlier").distinct())
    kind = links.schema["later"].dataType.simpleString()
    refused = spark.createDataFrame([], f"node {kind}")
    while not links.isEmpty():
        waiting = links.select(F.col("later").alias("earlier")).distinct()
        taken = links.join(waiting, "earlier", "left_anti")
        now = cut_lineage(taken.select(F.col("later").alias("node")).distinct())
        refused = refused.union(now)
        left = links.join(now.select(F.col("node").alias("later")), "later", "left_anti")
        links = cut_lineage(left.join(now.select(F.col("node").alias("earlier")), "earlier", "left_anti"))
    return refused
