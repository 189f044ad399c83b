"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom.session import checkpointed, forget


def components(links: DataFrame, left: str = "left", right: str = "right") -> DataFrame:
    """``im_id`` of every linked row with ``component``, the least id that its links reach.

    Each round takes the least label of the neighbours, then the label of that label; every round is a written table,
    so lost executors repeat one round only.  An id with very many links is pre-aggregated before the shuffle.
    """
    ends = links.select(F.col(left).alias("im_id"), F.col(right).alias("other"))
    both = ends.unionByName(links.select(F.col(right).alias("im_id"), F.col(left).alias("other"))).distinct()
    both = checkpointed(both)
    table = labels = checkpointed(both.groupBy("im_id").agg(F.min("other").alias("other")).select("im_id", F.least("im_id", "other").alias("component")))
    while True:
        near = both.join(labels.withColumnRenamed("im_id", "other"), "other").groupBy("im_id").agg(F.min("component").alias("near"))
        lower = labels.join(near, "im_id").select("im_id", F.col("component").alias("was"), F.least("component", "near").alias("at"))
        lower = checkpointed(lower)
        jump = lower.select(F.col("im_id").alias("at"), F.col("at").alias("beyond"))
        moved = lower.join(jump, "at").select("im_id", "was", F.least("at", "beyond").alias("component"))
        moved = checkpointed(moved)
        forget(lower, table)
        table, labels = moved, moved.select("im_id", "component")
        if moved.filter(F.col("was") != F.col("component")).isEmpty():
            forget(both)
            return labels
