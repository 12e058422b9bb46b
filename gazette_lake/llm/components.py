"""Connected components of a graph that is given as groups of nodes."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazette_lake.session import stage


def connect(entries: DataFrame) -> DataFrame:
    """Smallest node of each node's component.  ``entries`` (key, node): nodes of one key belong together.

    In each round a key takes the smallest label of its nodes, a node that of its keys, and then
    the label of its label, so that chains shorten by half.  Minima are combined before every
    exchange; a key or label with very many nodes is only joined, which adaptive execution splits.
    Every round is a written table, so a lost executor costs one round at most.  ``entries`` should be a
    written table.
    """
    keys = entries.groupBy("key").agg(F.min("node").alias("label"))
    labels = stage(entries.join(keys, "key").groupBy("node").agg(F.min("label").alias("label")), "labels")
    while True:
        keys = entries.join(labels, "node").groupBy("key").agg(F.min("label").alias("label"))
        best = entries.join(keys, "key").groupBy("node").agg(F.min("label").alias("best"))
        up = labels.select(F.col("node").alias("best"), F.col("label").alias("further"))
        moved = labels.join(best, "node").join(up, "best").select(
            "node", F.least("best", "further").alias("label"), (F.least("best", "further") < F.col("label")).alias("moved"))
        moved = stage(moved, "labels")
        labels = moved.drop("moved")
        if moved.filter("moved").isEmpty():
            return labels
