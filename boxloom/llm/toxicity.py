"""Severity of abuse in image descriptions and titles."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom.llm import words as W
from boxloom.llm.frames import Batches, described, in_tasks, lists
from boxloom.llm.sampled import judged_sample
from boxloom.session import checkpointed

#: Words and beginnings known to the model, 8 bytes and a weight each.
MOST_WORDS = 1 << 14
#: Judged rows that a word must be in.
LEAST_ROWS = 5
#: Squared distance, in standard deviations, of a word's abusive rows from what chance gives.
LEAST_TELLING = 12
#: Bytes of the beginnings of words that are features too.
BEGINNINGS = (4, 5, 6, 7, 8)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def _distinct_words(block: W.Block) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of each distinct word, and beginning of a longer word, of each row."""
    first = np.unique(W.word_hashes(block) + block.rows.astype(np.uint64) * _SPREAD, return_index=True)[1]
    first.sort()
    words = replace(block, starts=block.starts[first], ends=block.ends[first], _rows=block.rows[first])
    rows, hashes = [words.rows], [W.word_hashes(words)]
    for length in BEGINNINGS:
        at = np.flatnonzero(words.ends - words.starts > length)
        cut = replace(words, starts=words.starts[at], ends=words.starts[at] + length, _rows=words.rows[at])
        own = W.word_hashes(cut, seed=length)
        distinct = np.unique(own + cut.rows.astype(np.uint64) * _SPREAD, return_index=True)[1]
        rows.append(cut.rows[distinct])
        hashes.append(own[distinct])
    rows, hashes = np.concatenate(rows), np.concatenate(hashes)
    order = np.argsort(rows, kind="stable")
    return rows[order], hashes[order]


def _word_rows(batches: Batches) -> Batches:
    for batch in batches:
        for block in W.blocks(batch.column(1), W.ALPHANUMERIC, lower=True):
            rows, hashes = _distinct_words(block)
            counts = np.bincount(rows, minlength=block.n_rows)
            at = slice(block.first, block.first + block.n_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(2)[at], lists(hashes.view(np.int64), counts, pa.int64())], names=["mark", "words"]
            )


def _known_rows(vocabulary):
    """Places in the vocabulary of the words of judged rows; other words stay behind."""

    def step(batches: Batches) -> Batches:
        known = vocabulary.value
        for batch in batches:
            words = batch.column(1)
            lengths = pa.compute.list_value_length(words).to_numpy(zero_copy_only=False)
            rows = np.repeat(np.arange(len(words)), lengths)
            hashes = words.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            place = np.minimum(np.searchsorted(known, hashes), max(len(known) - 1, 0))
            keep = known[place] == hashes if len(known) else np.zeros(len(hashes), dtype=bool)
            counts = np.bincount(rows[keep], minlength=len(words))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists(place[keep], counts, pa.int32())], names=["mark", "places"])

    return step


class Severity:
    """Cumulative-link model: P(grade > k) is the logistic of one weighted sum less the k-th threshold."""

    def __init__(self, vocabulary: np.ndarray, rows: np.ndarray, words: np.ndarray, grades: np.ndarray, rounds: int = 300, penalty: float = 1e-5):
        """``rows`` and ``words`` are the places of the known words of the judged rows."""
        self.vocabulary = vocabulary
        self.n_grades = max(2, int(grades.max()) + 1 if len(grades) else 2)
        n, d = len(grades), len(vocabulary)
        self.weights = np.zeros(d)
        shares = [(grades > k).mean() if n else 0.5 for k in range(self.n_grades - 1)]
        shares = np.clip(shares, 1e-3, 1 - 1e-3)
        self.thresholds = np.log((1 - shares) / shares)
        if not n or grades.max() == grades.min():
            return
        # Adam on the mean log-likelihood of the grades.
        state = np.zeros((2, d + len(self.thresholds)))
        edges = np.concatenate([[-np.inf], np.zeros(len(self.thresholds)), [np.inf]])
        for turn in range(1, rounds + 1):
            edges[1:-1] = self.thresholds
            sums = np.bincount(rows, weights=self.weights[words], minlength=n)
            upper = _logistic(edges[grades + 1] - sums)
            lower = _logistic(edges[grades] - sums)
            chance = np.maximum(upper - lower, 1e-12)
            slope_upper, slope_lower = upper * (1 - upper) / chance, lower * (1 - lower) / chance
            by_sum = -(slope_upper - slope_lower) / n
            g = np.zeros(d + len(self.thresholds))
            g[:d] = np.bincount(words, weights=by_sum[rows], minlength=d) - penalty * self.weights
            for k in range(len(self.thresholds)):
                g[d + k] = (slope_upper[grades == k].sum() - slope_lower[grades == k + 1].sum()) / n
            state[0] = 0.9 * state[0] + 0.1 * g
            state[1] = 0.99 * state[1] + 0.01 * g * g
            move = 0.1 * (state[0] / (1 - 0.9**turn)) / (np.sqrt(state[1] / (1 - 0.99**turn)) + 1e-8)
            self.weights += move[:d]
            self.thresholds = np.sort(self.thresholds + move[d:])

    def sums(self, rows: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
        if not len(self.vocabulary):
            return np.zeros(n)
        place = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        known = self.vocabulary[place] == hashes
        return np.bincount(rows[known], weights=self.weights[place[known]], minlength=n)

    def above(self, sums: np.ndarray) -> np.ndarray:
        """P(grade > k) in column k."""
        return _logistic(sums[:, None] - self.thresholds[None, :])


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _grades(marks: np.ndarray, rows: np.ndarray, words: np.ndarray, d: int, n_grades: int) -> np.ndarray:
    """Grades of rows that are only marked abusive or not.

    Abusive rows are graded in equal parts by how many of the words they have that are at least ten times as frequent
    in abusive rows as in others.
    """
    if n_grades <= 2 or not len(marks) or marks.max() > 1:
        return marks
    bad = np.bincount(words, weights=marks[rows], minlength=d)
    good = np.bincount(words, minlength=d) - bad
    telling = (bad + 0.5) / (marks.sum() + 1) >= 10 * (good + 0.5) / (len(marks) - marks.sum() + 1)
    hits = np.bincount(rows, weights=telling[words], minlength=len(marks))
    own = hits[marks == 1]
    grades = marks.copy()
    if len(own):
        inner = np.quantile(own, np.arange(1, n_grades - 1) / (n_grades - 1))
        grades[marks == 1] = 1 + np.searchsorted(inner, own, side="left")
    return grades


def _severity_rows(model):
    def step(batches: Batches) -> Batches:
        for batch in batches:
            for block in W.blocks(batch.column(1), W.ALPHANUMERIC, lower=True):
                rows, hashes = _distinct_words(block)
                above = model.value.above(model.value.sums(rows, hashes, block.n_rows))
                edges = np.column_stack([np.ones(block.n_rows), above, np.zeros(block.n_rows)])
                grade = np.argmax(edges[:, :-1] - edges[:, 1:], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(block.first, block.n_rows),
                        pa.array(above[:, 0]),
                        pa.array(above.sum(axis=1)),
                        pa.array(grade.astype(np.int32)),
                    ],
                    names=["im_id", "score", "severity", "grade"],
                )

    return step


def toxicity_severity(images: DataFrame, judged: DataFrame, n_grades: int = 3, most_rows: int = 20_000) -> DataFrame:
    """Expected severity of abuse of image descriptions.

    ``images`` has ``im_id`` and ``im_description``; ``judged`` has ``im_id`` and ``toxic``: grades from 0 on, or only 0
    and 1, which are then spread over ``n_grades`` grades by the number of telling words.  At most ``most_rows`` judged
    rows (first by a hash of the id) are learned from.  Features are the distinct words of a text (A-Z lower-cased, digits, letters
    and characters beyond ASCII) and beginnings of words that at least five of these rows have and that tell them apart; one weight per word serves all thresholds (cumulative link).

    One row per input row: ``im_id``, ``score`` (chance of a grade above 0), ``severity`` (expected grade), ``grade``
    (likeliest).  NULL and empty texts have no words and get the base rates; without judged rows these are even.
    """
    sample = judged_sample(images, judged, "toxic", most_rows).select("im_id", "im_description", "mark")
    sample = checkpointed(in_tasks(sample, _word_rows, "mark int, words array<bigint>"))
    top = sample.agg(F.max("mark")).first()[0] or 0
    marks = [(F.col("mark") > k).cast("double").alias(f"above_{k}") for k in range(max(1, top))]
    shares = sample.agg(*[F.avg(m).alias(f"above_{k}") for k, m in enumerate(marks)]).first()
    known = sample.select(*marks, F.explode("words").alias("word")).groupBy("word")
    known = known.agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"above_{k}").alias(f"above_{k}") for k in range(len(marks))])
    apart = F.lit(0.0)
    for k in range(len(marks)):
        share = shares[k] or 0.0
        own = (F.col(f"above_{k}") - F.col("n") * share) ** 2 / (F.col("n") * max(share * (1 - share), 1e-9))
        apart = F.greatest(apart, own)
    known = known.filter(F.col("n") >= LEAST_ROWS).withColumn("apart", apart).filter(F.col("apart") >= LEAST_TELLING)
    known = [r["word"] for r in known.orderBy(F.desc("apart"), "word").limit(MOST_WORDS).collect()]
    vocabulary = np.sort(np.array(known, dtype=np.int64).view(np.uint64))
    shared = images.sparkSession.sparkContext.broadcast(vocabulary)
    table = in_tasks(sample, _known_rows(shared), "mark int, places array<int>").toArrow()
    order = sorted(range(table.num_rows), key=lambda i: (table["mark"][i].as_py(), table["places"][i].as_py()))
    table = table.take(pa.array(order, pa.int64()))
    marks = table.column("mark").to_numpy()
    column = table.column("places").combine_chunks()
    rows = np.repeat(np.arange(len(marks)), pa.compute.list_value_length(column).to_numpy(zero_copy_only=False))
    place = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    grades = _grades(marks.astype(np.int64), rows, place, len(vocabulary), n_grades)
    model = images.sparkSession.sparkContext.broadcast(Severity(vocabulary, rows, place, grades))
    kind = images.schema["im_id"].dataType.simpleString()
    return in_tasks(described(images), _severity_rows(model), f"im_id {kind}, score double, severity double, grade int")
