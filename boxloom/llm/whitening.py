"""Whitening of vectors: projections on the leading components of their covariance, scaled to variance one."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxloom.llm.eigen import leading
from boxloom.llm.frames import Batches, in_tasks, lists, ship
from boxloom.session import checkpointed

_EPS = np.finfo(float).eps


def whole_numbers(vector: Column, scale: int, shift: int) -> Column:
    """floor(``scale`` * c) + ``shift`` of every entry; NULL for a vector that is NULL or holds a NULL or a non-finite entry."""
    real = F.transform(vector, lambda c: c.cast("double"))
    bad = F.exists(real, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.when(vector.isNotNull() & ~bad, F.transform(real, lambda c: F.floor(c * scale).cast("bigint") + F.lit(shift).cast("bigint")))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: 64-bit where it fits, else Python integers."""
    if len(x) and max(map(abs, (int(x.max()), int(x.min())))) * n + max(map(abs, sums)) >= 1 << 62:
        return x.astype(object) * n - np.array(sums, dtype=object)
    return x * n - np.array(sums, dtype=np.int64)


def _column_sums(width: int):
    def step(batches: Batches) -> Batches:
        sums, n = [0] * width, 0
        for batch in batches:
            x = _matrix(batch.column("x"), width)
            n += len(x)
            # Halves, so that no sum of a batch overflows.
            high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
            sums = [s + (int(h) << 32) + int(w) for s, h, w in zip(sums, high, low)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(-1, width), pa.int32()), pa.array([n, *sums], pa.decimal128(38, 0))], names=["i", "total"]
        )

    return step


def _products(rows: Callable[[np.ndarray], np.ndarray], width: int, size: int):
    """Sums of products of all pairs of ``size`` columns, upper triangle; one set a task."""

    def step(batches: Batches) -> Batches:
        total = np.zeros((size, size))
        for batch in batches:
            z = rows(_matrix(batch.column("x"), width))
            total += z.T @ z
        i, j = np.triu_indices(size)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], names=["i", "j", "total"])

    return step


def _gathered(df: DataFrame, size: int) -> np.ndarray:
    """Symmetric matrix of totals; its size depends on the width of the vectors alone."""
    out = np.zeros((size, size))
    for r in df.groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["total"]
    return out


def _projected(shared, width: int):
    def step(batches: Batches) -> Batches:
        n, sums, components = shared.value
        k = components.shape[1]
        for batch in batches:
            z = _centred(_matrix(batch.column("x"), width), n, sums)
            if z.dtype == object or not len(z) or max(int(z.max()), -int(z.min())) ** 2 * width >= 1 << 63:
                squares = [sum(v * v for v in row) for row in z.astype(object).tolist()]
                deviation = pa.array([s if s < 10**38 else None for s in squares], pa.decimal128(38, 0))
            else:
                deviation = pa.array((z * z).sum(axis=1)).cast(pa.decimal128(38, 0))
            y = (z.astype(float) / n) @ components
            yield pa.RecordBatch.from_arrays(
                [batch.column("im_id"), deviation, lists(y.ravel(), np.full(len(y), k), pa.float64())], names=["im_id", "deviation", "whitened"]
            )

    return step


def whitened(images: DataFrame, n_components: int = 16, scale: int = 64, shift: int = 0) -> DataFrame:
    """Whitened vectors of image rows (``im_id`` of any type, ``embedding``; further columns take no part).

    The project has no embeddings of its own, so any numeric array will do, for example the corners of boxes.  An entry c becomes the whole number
    x = floor(``scale`` * c) + ``shift``; missing entries of a shorter vector count as c = 0.  Rows whose vector is NULL
    or holds a NULL or non-finite entry are left out.

    Mean and covariance (divisor n) are of the distinct x vectors, each once.  The matrix is summed up in tasks over
    centred vectors; its tridiagonal form, eigenvalues and eigenvectors are taken on the driver, as their size depends on
    the width of the vectors alone.  The components go to the tasks as a broadcast.

    One row per row and component, numbered from 1 by falling eigenvalue e: ``im_id``, ``component``, ``n`` distinct vectors,
    ``deviation`` (decimal: the sum over entries of (n x - S)^2, S the sums; NULL beyond 38 digits), ``whitened`` (x - S / n on the
    component, over the root of e), ``explained`` (e over the trace) and ``identity_error`` (one value: the largest
    absolute entry of the whitened distinct vectors' covariance minus the identity).  Components without
    variance (e within rounding of 0) are left out, so equal vectors alone give no rows, as do empty tables and empty
    vectors.  Repeated rows, also of one id, are rows each.
    """
    spark = images.sparkSession
    ship(spark)
    kind = images.schema["im_id"].dataType.simpleString()
    rows = images.select("im_id", whole_numbers(F.col("embedding"), scale, shift).alias("x")).filter(F.col("x").isNotNull())
    width = rows.agg(F.max(F.size("x")).alias("width")).head()["width"] or 0
    schema = f"im_id {kind}, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if not width:
        return spark.createDataFrame([], schema)
    padded = F.concat("x", F.array_repeat(F.lit(shift).cast("bigint"), F.lit(width) - F.size("x")))
    rows = rows.select("im_id", padded.alias("x"))
    fit = checkpointed(rows.select("x").distinct())
    totals = in_tasks(fit, _column_sums(width), "i int, total decimal(38,0)").groupBy("i").agg(F.sum("total").alias("total"))
    found = {r["i"]: int(r["total"]) for r in totals.collect()}
    n, sums = found[-1], [found[i] for i in range(width)]

    def centred(x: np.ndarray) -> np.ndarray:
        return _centred(x, n, sums).astype(float) / n

    pair = "i int, j int, total double"
    covariance = _gathered(in_tasks(fit, _products(centred, width, width), pair), width) / n
    values, vectors = leading(covariance, n_components)
    kept = int((values > 4 * width * _EPS * values[0]).sum()) if values[0] > 0 else 0
    if not kept:
        return spark.createDataFrame([], schema)
    values, components = values[:kept], vectors[:, :kept] / np.sqrt(values[:kept])

    def scored(x: np.ndarray) -> np.ndarray:
        return np.column_stack([centred(x) @ components, np.ones(len(x))])

    products = _gathered(in_tasks(fit, _products(scored, width, kept + 1), pair), kept + 1) / n
    mean = products[-1, :-1]
    error = float(np.abs(products[:-1, :-1] - np.outer(mean, mean) - np.eye(kept)).max())
    explained = (values / np.trace(covariance)).tolist()
    shared = spark.sparkContext.broadcast((n, sums, components))
    out = in_tasks(rows, _projected(shared, width), f"im_id {kind}, deviation decimal(38,0), whitened array<double>")
    out = out.select("im_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    shares = F.array(*[F.lit(e) for e in explained])
    return out.select(
        "im_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )
