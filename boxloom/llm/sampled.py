"""Bounded samples of judged image rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom.llm.frames import described
from boxloom.session import checkpointed


def one_of_each(rows: DataFrame, *key: str) -> DataFrame:
    """One row of each key, that with the least hash of its ``im_description``; equal ids send one text only."""
    least = F.min(F.struct(F.xxhash64("im_description").alias("hash"), "im_description")).alias("least")
    return rows.groupBy(*key).agg(least).select(*key, F.col("least.im_description").alias("im_description"))


def judged_sample(images: DataFrame, judged: DataFrame, mark: str, most: int) -> DataFrame:
    """Ids, descriptions and marks of at most ``most`` judged rows, those first by a hash of their id.

    An id that several rows have gives one description for each of its marks.  The bound makes the broadcast of the ids and what is fitted on them independent of the table's size.
    """
    order = F.xxhash64(F.col("im_id").cast("string"), F.lit(17))
    rows = judged.select("im_id", F.col(mark).cast("int").alias("mark")).dropna().distinct()
    rows = checkpointed(rows.orderBy(order, "im_id", "mark").limit(most))
    return one_of_each(described(images).join(F.broadcast(rows), "im_id"), "im_id", "mark")
