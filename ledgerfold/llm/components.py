"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.sources.workspace import remove, shared_folder, written


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); root is the smallest node reachable.

    Each round a node takes the smallest label of its neighbours and then the label
    of that label, so labels travel twice as far every round. Labels are written
    after each round. Nodes with very many links are hot only on the row side of
    joins between written tables, which adaptive execution splits, and the minimum
    is taken map-side.
    """
    spark, folder = links.sparkSession, shared_folder(links.sparkSession)
    edges = written(
        links.select("a", "b").union(links.select("b", "a")).where("a != b").distinct(),
        f"{folder}/edges",
    )
    labels = written(
        edges.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("root")),
        f"{folder}/labels-0",
    )
    step = 0
    while True:
        step += 1
        near = (
            edges.join(labels.select(F.col("node").alias("b"), F.col("root").alias("label")), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        hooked = labels.join(near, "node").select(
            "node", F.col("root").alias("before"), F.least("root", "near").alias("root")
        )
        above = labels.select(F.col("node").alias("root"), F.col("root").alias("up"))
        jumped = hooked.join(above, "root").select(
            "node", F.least("root", "up").alias("root"),
            (F.least("root", "up") != F.col("before")).alias("moved"),
        )
        stepped = written(jumped, f"{folder}/labels-{step}")
        remove(spark, f"{folder}/labels-{step - 1}")
        labels = stepped.drop("moved")
        if stepped.where("moved").isEmpty():
            return labels
