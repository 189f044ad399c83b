"""Shared steps of the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from boxloom.session import ship_packages

Batches = Iterator[pa.RecordBatch]


def described(images: DataFrame) -> DataFrame:
    """Id and description of image rows; other columns, whatever their names, take no part."""
    return images.select(F.col("im_id"), F.col("im_description").cast("string").alias("im_description"))


def in_tasks(df: DataFrame, step: Callable[[Batches], Batches], schema: str) -> DataFrame:
    """Run ``step`` over Arrow batches of each partition; workers get this library's code."""
    ship(df.sparkSession)

    def whole(batches: Batches) -> Batches:
        yield from step(batches)
        # Workers live on: what this partition needed goes back to the machine.
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(whole, schema)


def ship(spark: SparkSession) -> None:
    ship_packages(spark, str(Path(__file__).resolve().parent.parent))


def held_by_smaller(rows: DataFrame, key: list[str], owner: str = "im_id") -> DataFrame:
    """Rows whose key also belongs to a smaller owner."""
    least = F.min(owner).over(Window.partitionBy(*key))
    return rows.withColumn("_least", least).filter(F.col("_least") < F.col(owner)).drop("_least")


def held_by_several(rows: DataFrame, key: list[str], owner: str = "im_id") -> DataFrame:
    """Rows whose key belongs to at least two owners."""
    span = Window.partitionBy(*key)
    marked = rows.withColumn("_least", F.min(owner).over(span)).withColumn("_most", F.max(owner).over(span))
    return marked.filter(F.col("_least") < F.col("_most")).drop("_least", "_most")


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def lists(values, lengths, kind: pa.DataType) -> pa.Array:
    """List column out of flat values and the length of each list."""
    import numpy as np

    offsets = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
