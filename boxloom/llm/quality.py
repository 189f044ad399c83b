"""Quality of image descriptions, learned from pairs of a good and a poor one."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom.llm import words as W
from boxloom.llm.frames import Batches, described, in_tasks, lists
from boxloom.llm.sampled import judged_sample

CUT = 0.3
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def _class(members) -> np.ndarray:
    flags = np.zeros(256, dtype=bool)
    flags[list(members)] = True
    return flags


_KINDS = [
    _class(range(0x41, 0x5B)),
    _class(range(0x61, 0x7B)),
    _class(range(0x30, 0x3A)),
    _class([*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]),
    _class(b"|"),
    _class(b"!#$%&*"),
    _class(b"\n"),
    _class(range(0x80, 0x100)),
]
_PLAIN = len(_KINDS) + 8
N_FEATURES = 2 * _PLAIN


def _repeat_share(keys: np.ndarray, rows: np.ndarray, n_rows: int) -> np.ndarray:
    """Share of a row's keys that repeat one of its earlier ones."""
    distinct = np.unique(keys + rows.astype(np.uint64) * _SPREAD, return_index=True)[1]
    total, kept = np.bincount(rows, minlength=n_rows), np.bincount(rows[distinct], minlength=n_rows)
    return 1 - kept / np.maximum(total, 1)


def shape_features(block: W.Block) -> np.ndarray:
    """Shape of each row: shares of character kinds, word lengths, repeats; each plain and as a logarithm."""
    n = block.n_rows
    sizes = np.maximum(np.diff(block.offsets), 1)
    columns = []
    for kind in _KINDS:
        running = np.concatenate([[0], np.cumsum(kind[block.data], dtype=np.int64)])
        columns.append((running[block.offsets[1:]] - running[block.offsets[:-1]]) / sizes)
    rows, hashes = block.rows, W.word_hashes(block)
    words = np.bincount(rows, minlength=n)
    lengths = (block.ends - block.starts).astype(np.float64)
    some = np.maximum(words, 1)
    upper = np.concatenate([[0], np.cumsum(_KINDS[1][block.data], dtype=np.int64)])
    capitals = np.concatenate([[0], np.cumsum(_KINDS[0][block.data], dtype=np.int64)])
    shouted = (upper[block.ends] == upper[block.starts]) & (capitals[block.ends] - capitals[block.starts] > 1)
    same = np.zeros(len(hashes), dtype=bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])
    fives = W.in_one_row(block, 5)
    runs = W.window_hashes(hashes, 5)[fives]
    columns += [
        np.log1p(words) / 10,
        np.minimum(np.bincount(rows, weights=lengths, minlength=n) / some / 20, 2),
        np.bincount(rows, weights=(lengths > 20), minlength=n) / some,
        np.bincount(rows, weights=shouted, minlength=n) / some,
        np.bincount(rows, weights=same, minlength=n) / some,
        _repeat_share(hashes, rows, n),
        _repeat_share(runs, rows[: len(fives)][fives], n),
        (words < 5).astype(np.float64),
    ]
    plain = np.column_stack(columns)
    return np.column_stack([plain, np.log(plain + 0.01)])


def _feature_rows(batches: Batches) -> Batches:
    for batch in batches:
        for block in W.blocks(batch.column(1), W.BLANKS):
            x = shape_features(block)
            at = slice(block.first, block.first + block.n_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(2)[at], lists(x.ravel(), [N_FEATURES] * block.n_rows, pa.float64())], names=["mark", "features"]
            )


class Preference:
    """Bradley-Terry model: a row beats another with the logistic of the difference of their scores."""

    def __init__(self, x: np.ndarray, good: np.ndarray, partners: int = 8, penalty: float = 1e-3, rounds: int = 25, seed: int = 7):
        self.mean = x.mean(axis=0) if len(x) else np.zeros(N_FEATURES)
        spread = x.std(axis=0) if len(x) else np.zeros(N_FEATURES)
        self.scale = np.where(spread > 1e-9, spread, 1.0)
        self.weights, self.cut = np.zeros(N_FEATURES), 0.0
        better, worse = x[good == 1], x[good == 0]
        if not len(better) or not len(worse):
            self.cut = -1.0 if len(better) or not len(x) else 1.0
            return
        chance = np.random.default_rng(seed)
        n = partners * max(len(better), len(worse))
        pairs = (better[chance.integers(0, len(better), n)] - worse[chance.integers(0, len(worse), n)]) / self.scale
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(pairs @ self.weights, -30, 30)))
            gradient = pairs.T @ (1 - p) / n - penalty * self.weights
            curve = (pairs * (p * (1 - p))[:, None]).T @ pairs / n + penalty * np.eye(N_FEATURES)
            move = np.linalg.solve(curve, gradient)
            self.weights += move
            if np.abs(move).max() < 1e-6:
                break
        self._choose_cut(self.raw(x), good)

    def _choose_cut(self, raw: np.ndarray, good: np.ndarray) -> None:
        """The quantile of the scores that tells most rows right; of equal ones the middle."""
        levels = np.linspace(0, 1, 1001)
        cuts = np.quantile(raw, levels)
        right = np.array([((raw >= c) == (good == 1)).mean() for c in cuts])
        best = np.flatnonzero(right == right.max())
        self.cut = float(cuts[best[len(best) // 2]])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights

    def scores(self, x: np.ndarray) -> np.ndarray:
        """0 to 1; the chosen quantile is at ``CUT``."""
        lift = np.clip(self.raw(x) - self.cut, -30, 30) + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-lift))


def _score_rows(model, keep_text: bool):
    def step(batches: Batches) -> Batches:
        for batch in batches:
            scores = [model.value.scores(shape_features(block)) for block in W.blocks(batch.column(1), W.BLANKS)]
            scores = np.concatenate(scores) if scores else np.zeros(0)
            columns = [batch.column(0), pa.array(scores), pa.array((scores >= CUT).astype(np.int32))]
            names = ["im_id", "score", "predicted"]
            if keep_text:
                columns.insert(1, batch.column(1))
                names.insert(1, "im_description")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return step


def learned_quality(images: DataFrame, judged: DataFrame, most_rows: int = 20_000) -> Preference:
    """Model of what tells good from poor descriptions.

    ``images`` has ``im_id`` and ``im_description``; ``judged`` has ``im_id`` and ``quality`` (1 good, 0 poor; NULL is ignored).  At
    most ``most_rows`` judged rows (those first by a hash of the id) are learned from: random pairs of a good and a
    poor row, logistic loss on the difference of their shape features (Bradley-Terry).  The cut is the quantile of the
    scores that tells most of these rows right.
    """
    sample = judged_sample(images, judged, "quality", most_rows).select("im_id", "im_description", "mark")
    rows = in_tasks(sample, _feature_rows, "mark int, features array<double>").toPandas()
    x = np.array(rows["features"].tolist(), dtype=np.float64).reshape(-1, N_FEATURES)
    order = np.lexsort((*x.T[:4], rows["mark"].to_numpy())) if len(x) else np.zeros(0, dtype=int)
    return Preference(x[order], rows["mark"].to_numpy()[order])


def scored(images: DataFrame, model: Preference, keep_text: bool = False) -> DataFrame:
    """Scores of image descriptions by a learned model; ``keep_text`` also returns ``im_description``.

    One row per input row, in place: ``im_id`` (of any type), ``score`` (0 to 1, the cut is at 0.3), ``predicted`` (1 from 0.3 on).
    NULL is an empty text and is scored like one.
    """
    shared = images.sparkSession.sparkContext.broadcast(model)
    kind = images.schema["im_id"].dataType.simpleString()
    text = "im_description string, " if keep_text else ""
    return in_tasks(described(images), _score_rows(shared, keep_text), f"im_id {kind}, {text}score double, predicted int")


def quality_scores(images: DataFrame, judged: DataFrame, most_rows: int = 20_000) -> DataFrame:
    """Score image descriptions by what tells good from poor ones: ``scored`` by ``learned_quality``.

    Only descriptions are looked at.  Without judged rows of both labels every score is the same, on the side of the
    label that is there (good if there is none).
    """
    return scored(images, learned_quality(images, judged, most_rows))
