"""Annotate new input files as they arrive.

A thin driver for ``operators.annotate``: each micro-batch is annotated into
the same keyed store, so a replayed batch finds its results already there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from boxloom.operators.annotate import ResultStore, RowAnnotator, annotated


def annotate_arrivals(
    stream: DataFrame, keys: list[str], annotator: RowAnnotator, store_path: str, checkpoint: str, **options
) -> StreamingQuery:
    """Start a query that annotates everything available and then stops."""

    def one_batch(batch: DataFrame, _: int) -> None:
        store = ResultStore(batch.sparkSession, store_path, keys)
        annotated(batch, keys, annotator, store, **options)

    return (
        stream.writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
