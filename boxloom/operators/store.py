"""Keyed results in hash buckets.

A store is a Parquet table partitioned by a hash of its keys.  A lookup first
sees which buckets its keys fall into and reads only those.  Appends become
visible when their job commits; of several results of a key the one of the
highest run counts.  Beside the store, ``<path>-runs`` holds one empty file per run
and one with the number of buckets, so run numbers are claimed without reading results.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxloom.operators import groups
from boxloom.sources.paths import claimed, claimed_number, deleted, listed, path_exists

RUN = "_run"
BUCKET = "_bucket"
# Enough for stores of a few GB; give large stores more, so that a bucket stays a few scan tasks.
BUCKETS = 16


class ResultStore:
    """Append-only table of model results with key columns, in ``buckets`` partitions (more of them for large stores)."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], buckets: int = BUCKETS):
        self.spark, self.path, self.keys = spark, path, keys
        self._wanted, self._fixed = buckets, None

    @property
    def buckets(self) -> int:
        """Number of buckets; that of the first append stays."""
        if self._fixed is None:
            found = self._made()
            if found is None:
                return self._wanted
            self._fixed = found
        return self._fixed

    def _made(self) -> int | None:
        names = [re.search(r"/buckets-(\d+)$", p) for p in listed(self.spark, f"{self.path}-runs")]
        return min((int(m.group(1)) for m in names if m), default=None)

    def _bucketed(self, df: DataFrame) -> DataFrame:
        # As text, so that keys of other integer types find the same bucket.
        hashed = F.xxhash64(*[F.col(k).cast("string") for k in self.keys])
        return df.withColumn(BUCKET, F.pmod(hashed, F.lit(self.buckets)).cast("int"))

    def exists(self) -> bool:
        """Whether any commit with rows was written to its end."""
        return path_exists(self.spark, f"{self.path}/_SUCCESS") and any(f"/{BUCKET}=" in p for p in listed(self.spark, self.path))

    def touched(self, df: DataFrame) -> list[int]:
        """Buckets that the keys of ``df`` fall into; at most as many numbers as there are buckets."""
        return sorted(r[0] for r in self._bucketed(df.select(*self.keys)).select(BUCKET).distinct().collect())

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """All results, or those of some buckets."""
        rows = self.spark.read.parquet(self.path)
        if buckets is not None and len(buckets) < self.buckets:
            rows = rows.filter(F.col(BUCKET).isin(buckets))
        return rows.drop(BUCKET)

    def latest(self, buckets: list[int] | None = None) -> DataFrame:
        """Last result per key."""
        return groups.first_per_key(self.read(buckets), self.keys, [RUN], last=True)

    def next_run(self) -> int:
        """Number of a new run, claimed for it alone."""
        return claimed_number(self.spark, f"{self.path}-runs", "run-")

    def append(self, df: DataFrame, run: int) -> None:
        if self._made() is None:
            claimed(self.spark, f"{self.path}-runs/buckets-{self._wanted}")
        claimed(self.spark, f"{self.path}-runs/run-{run}")
        rows = self._bucketed(df.withColumn(RUN, F.lit(run).cast("long")))
        # One file per bucket; buckets that are large are split.
        rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).mode("append").parquet(self.path)

    def append_failed(self, df: DataFrame, run: int) -> None:
        """Keys and reasons of calls that gave no result, beside the store."""
        df.withColumn(RUN, F.lit(run).cast("long")).write.mode("append").parquet(f"{self.path}-failed")

    def failed(self) -> DataFrame | None:
        """All failed calls so far; a key may have a result by now."""
        path = f"{self.path}-failed"
        return self.spark.read.parquet(path) if path_exists(self.spark, f"{path}/_SUCCESS") else None

    def stored(self, df: DataFrame, buckets: list[int] | None = None) -> DataFrame:
        """Stored results for the keys of ``df``; ``buckets`` are those of its keys where the caller knows them."""
        buckets = self.touched(df) if buckets is None else buckets
        return groups.join_null_safe(self.read(buckets), df.select(*self.keys).distinct(), self.keys, "left_semi")

    def pending(self, df: DataFrame, buckets: list[int] | None = None) -> DataFrame:
        """Rows of ``df`` whose key is not stored."""
        if not self.exists():
            return df
        buckets = self.touched(df) if buckets is None else buckets
        return groups.join_null_safe(df, self.read(buckets).select(*self.keys).distinct(), self.keys, "left_anti")

    def compact(self, most_files: int = 8) -> list[int]:
        """Rewrite buckets of more than ``most_files`` files with the last result of each key; returns them.

        The kept rows are committed before the old files go, and they keep their run, so a job that stops in between
        leaves repeated rows only.  Nothing else may read or write the store meanwhile.
        """
        done = []
        for folder in listed(self.spark, self.path):
            bucket = re.search(rf"/{BUCKET}=(\d+)$", folder)
            files = [p for p in listed(self.spark, folder) if p.endswith(".parquet")] if bucket else []
            if len(files) <= most_files:
                continue
            rows = self.spark.read.option("basePath", self.path).parquet(*files)
            kept = groups.first_per_key(rows.drop(BUCKET), self.keys, [RUN], last=True)
            self._bucketed(kept).hint("rebalance", BUCKET).write.partitionBy(BUCKET).mode("append").parquet(self.path)
            for path in files:
                deleted(self.spark, path)
            done.append(int(bucket.group(1)))
        return done

    def compacted_to(self, path: str) -> "ResultStore":
        """Copy with one row per key."""
        copy = ResultStore(self.spark, path, self.keys, self.buckets)
        if copy.exists():
            raise FileExistsError(path)
        rows = self.latest()
        copy._bucketed(rows).hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(path)
        claimed(self.spark, f"{path}-runs/buckets-{self.buckets}")
        last = rows.agg(F.max(RUN)).first()[0]
        if last is not None:
            claimed(self.spark, f"{path}-runs/run-{last}")
        return copy
