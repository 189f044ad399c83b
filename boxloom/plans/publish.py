"""From curated image rows to a published, split dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame

from boxloom.operators import dataset as D
from boxloom.session import checkpointed
from boxloom.sources import sinks


def published_dataset(rows: DataFrame, verify: bool = True) -> DataFrame:
    """Compact, clean, clip and verify; ``split`` says where each row goes."""
    out = D.published_rows(D.cleaned(rows))
    if verify:
        out = D.verified(checkpointed(out))
    return D.split_rows(out)


def publish(rows: DataFrame, folder: str, name: str) -> None:
    """Write dataset, distribution, splits and drift under ``folder``."""
    final = checkpointed(published_dataset(rows))
    sinks.write_csv(final.select(*D.DATASET), f"{folder}/{name}_dataset")
    sinks.write_csv(D.distribution(final), f"{folder}/{name}_dataset_data_distribution")
    sinks.write_splits(final.select(*D.DATASET, "split"), folder, D.split_drift(final))
