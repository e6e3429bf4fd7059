"""Connected classes by spreading the least label, all in joins."""

from pyspark.sql import DataFrame, functions as F

from tracemill.session import spool


def classes(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of `edges` (a, b): the least node it is connected with.

    Each round takes the least label of the neighbours and then the label of
    that label, so chains shrink by half. A node with very many edges is met by
    partial aggregates and by joins that Spark may split.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label"))
    labels = spool(labels, "labels")
    while True:
        none = F.lit(None).cast(labels.schema["label"].dataType)
        near = both.join(labels, both["b"] == labels["node"]).select(F.col("a").alias("node"), "label", none.alias("old"))
        met = near.union(labels.select("node", "label", F.col("label").alias("old")))
        met = met.groupBy("node").agg(F.min("label").alias("via"), F.max("old").alias("old"))
        jump = labels.select(F.col("node").alias("via"), F.col("label").alias("jump"))
        new = spool(met.join(jump, "via", "left").select("node", "old", F.least("jump", "via").alias("label")), "labels")
        labels = new.select("node", "label")
        if new.filter(F.col("old") != F.col("label")).isEmpty():
            return labels
