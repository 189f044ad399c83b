"""Whitening against numpy's own eigenvalues, and the solver on hard matrices."""

from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from boxloom.llm.eigen import bisected, leading, tridiagonal
from boxloom.llm.queries import QUERIES
from boxloom.llm.whitening import whitened


def matrices():
    chance = np.random.default_rng(1)
    a = chance.standard_normal((40, 40))
    q = np.linalg.qr(a)[0]
    yield "random", a @ a.T
    yield "repeated", q @ np.diag([5.0] * 7 + [3.0] * 5 + [1e-9] * 28) @ q.T
    yield "close", q @ np.diag(1 + 1e-13 * np.arange(40)) @ q.T
    yield "graded", q @ np.diag(10.0 ** -np.arange(40)) @ q.T
    yield "diagonal", np.diag(np.arange(12.0))
    yield "blocks", np.kron(np.eye(6), np.array([[2.0, 1.0], [1.0, 2.0]]))
    yield "zero", np.zeros((5, 5))
    yield "one", np.array([[4.0]])
    yield "two", np.array([[1.0, 2.0], [2.0, -3.0]])


@pytest.mark.parametrize("name,matrix", list(matrices()), ids=lambda v: v if isinstance(v, str) else "")
def test_leading(name, matrix):
    matrix = (matrix + matrix.T) / 2
    values, vectors = leading(matrix, 16)
    k, scale = len(values), max(1e-300, np.abs(matrix).max())
    assert k == min(16, len(matrix))
    assert np.allclose(values, np.linalg.eigvalsh(matrix)[::-1][:k], rtol=0, atol=1e-13 * scale * 40)
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-12
    assert np.abs(matrix @ vectors - vectors * values).max() <= 1e-13 * scale * 40


def test_tridiagonal_keeps_eigenvalues():
    a = np.random.default_rng(2).standard_normal((15, 15))
    a = a + a.T
    diagonal, off, _ = tridiagonal(a)
    assert np.allclose(bisected(diagonal, off, 15), np.linalg.eigvalsh(a)[::-1], atol=1e-12)


def plain(vectors, k, scale, shift):
    x = [[int(np.floor(scale * c)) + shift for c in v] for v in vectors]
    fit = sorted(set(map(tuple, x)))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[n * c - s for c, s in zip(v, sums)] for v in fit], float) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    y = np.array([[n * c - s for c, s in zip(v, sums)] for v in x], float) / n @ axes[:, :k] / np.sqrt(values[:k])
    return n, [sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in x], y, values[:k] / values.sum()


def compared(got, ids, vectors, k, scale, shift):
    n, deviation, y, explained = plain(vectors, k, scale, shift)
    assert len(got) == len(ids) * k and {r["n"] for r in got} == {n}
    at = {i: row for row, i in enumerate(ids)}
    mine = np.zeros((len(ids), k))
    for r in got:
        row = at[r["im_id"]]
        mine[row, r["component"] - 1] = r["whitened"]
        assert r["deviation"] == deviation[row]
        assert abs(r["explained"] / explained[r["component"] - 1] - 1) < 1e-9
        assert r["identity_error"] < 1e-9
    signs = np.sign((mine * y).sum(axis=0))
    assert np.abs(mine * signs - y).max() < 1e-7


def test_against_numpy(spark):
    chance = np.random.default_rng(3)
    vectors = (chance.standard_normal((300, 20)) * np.linspace(1, 3, 20)).round(2).tolist()
    vectors += vectors[:1] * 100
    ids = list(range(400))
    rows = spark.createDataFrame(list(zip(ids, vectors)), "im_id bigint, embedding array<double>").repartition(6)
    rows = rows.select("*", *[F.lit("x").alias(c) for c in ("x", "component", "whitened", "n")])
    compared(whitened(rows, 5, shift=10**6).collect(), ids, vectors, 5, 64, 10**6)


def test_corners_of_boxes(spark):
    chance = np.random.default_rng(4)
    corners = np.cumsum(chance.integers(1, 60, (200, 4)), axis=1)[:, [0, 1, 2, 3]]
    boxes = spark.createDataFrame([(f"im{i}", *map(float, c)) for i, c in enumerate(corners)], "im_id string, x1 double, y1 double, x2 double, y2 double")
    got = whitened(boxes.withColumn("embedding", F.array("x1", "y1", "x2", "y2")), 3, scale=1).collect()
    compared(got, [f"im{i}" for i in range(200)], corners.tolist(), 3, 1, 0)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (2, [3.0, 1.0]), (2, [3.0, 1.0]), (None, [0.0, 5.0]), (4, None), (5, [1.0, None]), (6, [nan, 1.0]), (7, [1.0, inf]), (8, []), (9, [4.0])]
    df = spark.createDataFrame(rows, "im_id bigint, embedding array<float>")
    got = whitened(df, 16).collect()
    assert sorted((r["im_id"] or 0, r["component"]) for r in got) == sorted((i, c) for i in (0, 1, 2, 2, 8, 9) for c in (1, 2))
    assert {r["n"] for r in got} == {5}
    for none in (df.limit(0), df.filter("im_id = 2"), df.filter("im_id = 8"), df.filter("im_id in (4, 5, 6, 7)")):
        empty = whitened(none, 16)
        assert empty.columns == ["im_id", "component", "n", "deviation", "whitened", "explained", "identity_error"] and empty.count() == 0


def test_large_numbers_stay_exact(spark):
    rows = [(1, [2.0**55, 0.0]), (2, [0.0, 2.0**55]), (3, [2.0**50, 1.0])]
    got = whitened(spark.createDataFrame(rows, "im_id bigint, embedding array<double>"), 2, scale=8).collect()
    _, deviation, _, _ = plain([v for _, v in rows], 2, 8, 0)
    assert {(r["im_id"], r["deviation"]) for r in got} == {(i + 1, Decimal(d)) for i, d in enumerate(deviation)}


def test_query(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    got = QUERIES["op12_whitening"](spark, sf)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert dict(got.dtypes)["deviation"] == "bigint"
    vectors = [[float(c) for c in r["embedding"]] for r in rows]
    compared(got.withColumnRenamed("vec_id", "im_id").collect(), [r["vec_id"] for r in rows], vectors, 16, 64, 10**6)
