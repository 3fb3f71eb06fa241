"""Connected components of a link table, as DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import written


def components(links: DataFrame) -> DataFrame:
    """node, label (least node reachable) of every node of links(a, b), undirected.

    Each round takes the least label among a node and its neighbours, then jumps
    to that label's own label, so chains shorten by half. Null ends and loops are
    ignored; an empty table has no components. Rounds end when no label changed.
    """
    one = links.where("a <> b").select("a", "b")
    edges = written(one.union(one.select("b", "a")).distinct())
    labels = written(edges.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")))
    while True:
        seen = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        lower = labels.join(seen, "node", "left").select("node", F.col("label").alias("old"), F.least("label", F.coalesce("near", "label")).alias("label"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("top"))
        after = written(lower.join(up, "label", "left").select("node", "old", F.least("label", F.coalesce("top", "label")).alias("label")))
        labels = after.select("node", "label")
        if after.where("label < old").isEmpty():
            return labels
