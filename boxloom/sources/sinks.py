"""Writers: CSV and JSON directories, splits, versions, crops."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom.sources.paths import claimed_number, next_version, path_exists


def write_csv(df: DataFrame, path: str) -> None:
    """CSV directory with header; array and map cells become JSON text."""
    nested = ("array", "map", "struct")
    flat = df.select(*[F.to_json(c).alias(c) if t.startswith(nested) else F.col(c) for c, t in df.dtypes])
    flat.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_splits(df: DataFrame, path: str, diagnostics: DataFrame | None = None) -> None:
    """One sub-directory per split, and the drift table beside them."""
    df.write.mode("overwrite").partitionBy("split").option("header", True).option("escape", '"').csv(f"{path}/splits")
    if diagnostics is not None:
        write_csv(diagnostics, f"{path}/split_diagnostics")


def write_version(df: DataFrame, folder: str, prefix: str) -> str:
    """Write to the next free ``v<N>`` of a dataset folder; returns the path.

    The number is claimed by a file before anything is written, so two jobs at once get two versions; a failed job's number stays unused.
    """
    spark = df.sparkSession
    version = claimed_number(spark, f"{folder}/_versions", "v", next_version(spark, folder))
    path = f"{folder}/v{version}/{prefix}_v{version}_dataset"
    write_csv(df, path)
    return path


def write_crops(df: DataFrame, path: str) -> None:
    """Cropped pixels, one directory per class."""
    df.write.mode("overwrite").partitionBy("name").parquet(path)


def stage(df: Callable[[], DataFrame], spark, path: str) -> DataFrame:
    """Result of a stage: read when it was written to its end before, else computed, written and read back."""
    if not path_exists(spark, f"{path}/_SUCCESS"):
        df().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
