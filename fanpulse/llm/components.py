"""Connected components by least labels, as joins over tables; nothing of the graph reaches the driver but a count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame) -> DataFrame:
    """``edges``: a, b. Returns node, comp (least node of its component) for every node that has an edge.

    Each round a node takes the least label around it, then its label's label, until no label changes. Neighbours are
    reduced by a partial minimum before the shuffle, so a hub costs a row per task.
    """
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
    both = stored(both.distinct(), "edges")
    labels = stored(both.groupBy("node").agg(F.least("node", F.min("other")).alias("comp")), "labels")
    while True:
        around = both.join(labels.select(F.col("node").alias("other"), F.col("comp").alias("near")), "other").groupBy("node").agg(F.min("near").alias("near"))
        new = labels.join(around, "node").select("node", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        new = stored(new, "labels")
        up = new.select(F.col("node").alias("comp"), F.col("comp").alias("up"))
        jumped = stored(new.join(up, "comp").select("node", "old", F.least("comp", "up").alias("comp")), "labels")
        if jumped.where("comp <> old").isEmpty():
            return jumped.select("node", "comp")
        labels = jumped.select("node", "comp")
