"""Secrets in image descriptions: fixed patterns, and a tagger that learns from them."""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom.llm import words as W
from boxloom.llm.frames import Batches, described, in_tasks
from boxloom.llm.sampled import one_of_each
from boxloom.session import checkpointed

# The base patterns, the least length of a match, and what a text must hold to be looked at.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_LEAST = 6
ASSIGN_HINTS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 20
HEX_LEAST = 24
KINDS = ("assign", "access", "hex", "tagged")

_HEX = np.zeros(256, dtype=bool)
_HEX[[*b"0123456789abcdef"]] = True
#: Bytes of tokens: letters, digits, ``+/_.=-`` and all beyond ASCII.
_TOKEN = np.zeros(256, dtype=bool)
_TOKEN[[*b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-", *range(0x80, 0x100)]] = True
_DIGIT, _UPPER, _SMALL, _WIDE, _HEXLESS = (np.zeros(256, dtype=bool) for _ in range(5))
_DIGIT[0x30:0x3A] = _UPPER[0x41:0x5B] = _SMALL[0x61:0x7B] = _WIDE[0x80:] = True
_HEXLESS[[*b"ghijklmnopqrstuvwxyzGHIJKLMNOPQRSTUVWXYZ+/_.=-"]] = True
_HEXLESS[0x80:] = True
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

OUTSIDE, BEGIN, INSIDE = 0, 1, 2
N_TAGS = 3
_HASHED = 1 << 12
#: Tokens on both sides of a learned place.
AROUND = 7

Span = tuple[int, int, int]


def base_spans(text: str) -> list[Span]:
    """Matches of the base patterns as (start, end, kind), in code points, leftmost and apart within a kind."""
    out = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_LEAST]
    return out + [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]


def _places(data: bytes, hints: tuple[bytes, ...]) -> list[int]:
    out = []
    for hint in hints:
        at = data.find(hint)
        while at >= 0:
            out.append(at)
            at = data.find(hint, at + 1)
    return out


def block_spans(block: W.Block, points: np.ndarray) -> dict[int, list[Span]]:
    """Base spans of the rows that have any."""
    found: dict[int, list[Span]] = {}
    places = _places(W.LOWER[block.data].tobytes(), ASSIGN_HINTS) + _places(block.data.tobytes(), (b"AKIA",))
    for row in np.unique(np.searchsorted(block.offsets, places, side="right") - 1).tolist() if places else []:
        spans = base_spans(block.text(row).decode())
        if spans:
            found[row] = spans
    runs = W._block(block.first, block.data, block.offsets, _HEX)
    for i in np.flatnonzero(runs.ends - runs.starts >= HEX_LEAST).tolist():
        row = int(runs.rows[i])
        start = points[block.offsets[row]]
        found.setdefault(row, []).append((int(points[runs.starts[i]] - start), int(points[runs.ends[i]] - start), 2))
    for spans in found.values():
        spans.sort(key=lambda s: (s[0], s[2]))
    return found


def code_points(block: W.Block) -> np.ndarray:
    """Code points before each byte of the block."""
    out = np.zeros(len(block.data) + 1, dtype=np.int64)
    np.cumsum((block.data & 0xC0) != 0x80, out=out[1:])
    return out


def _running(flags: np.ndarray, data: np.ndarray, block: W.Block) -> np.ndarray:
    total = np.zeros(len(data) + 1, dtype=np.int32)
    np.cumsum(flags[data], out=total[1:])
    return total[block.ends] - total[block.starts]


#: Features of a token: (name, number of values).
FEATURES = [
    ("length", 10),
    ("kinds", 16),
    ("digits", 6),
    ("only hex", 2),
    ("changes", 6),
    ("before", 6),
    ("quote", 4),
    ("word before", _HASHED),
    ("second word before", _HASHED),
    ("word after", _HASHED),
    ("file length", 8),
    ("file digits", 6),
]
_FIRST = np.concatenate([[0], np.cumsum([n for _, n in FEATURES])])
N_WEIGHTS = int(_FIRST[-1])


def token_features(block: W.Block) -> np.ndarray:
    """Weight numbers of each token of the block: its shape, what stands before, its neighbours, its file."""
    data, starts, ends, rows = block.data, block.starts, block.ends, block.rows
    n = len(starts)
    length = ends - starts
    digits, upper, small, wide = (_running(f, data, block) for f in (_DIGIT, _UPPER, _SMALL, _WIDE))
    out = np.zeros((n, len(FEATURES)), dtype=np.int32)
    out[:, 0] = np.searchsorted([2, 4, 6, 8, 12, 16, 20, 24, 40], length, side="right")
    out[:, 1] = (digits > 0) + 2 * (upper > 0) + 4 * (small > 0) + 8 * (wide > 0)
    out[:, 2] = np.minimum(5 * digits // np.maximum(length, 1), 5)
    out[:, 3] = _running(_HEXLESS, data, block) == 0
    kind = np.select([_DIGIT[data], _UPPER[data], _SMALL[data]], [1, 2, 3], 0).astype(np.int8)
    change = np.zeros(len(data) + 1, dtype=np.int32)
    if len(data) > 1:
        np.cumsum(kind[1:] != kind[:-1], out=change[2:])
    changes = change[ends] - change[np.minimum(starts + 1, len(data))]
    out[:, 4] = np.searchsorted([1, 2, 3, 5, 8], changes, side="right")
    first = block.offsets[rows]
    gap = data[np.maximum(starts - 1, 0)]
    alone = starts == first
    out[:, 5] = np.select([alone, gap == 0x20, (gap == 0x3A) | (gap == 0x3D), (gap == 0x22) | (gap == 0x27), gap == 0x0A], [0, 1, 2, 3, 4], 5)
    before = data[np.maximum(starts - 2, 0)]
    out[:, 6] = np.select([starts < first + 2, (before == 0x3A) | (before == 0x3D), before == 0x20], [0, 1, 2], 3)
    lowered = W.Block(block.first, W.LOWER[data], block.offsets, starts, ends, block.bounds, rows)
    names = (W.word_hashes(lowered) >> np.uint64(52)).astype(np.int32)
    for column, shift in ((7, 1), (8, 2)):
        if n > shift:
            same = rows[shift:] == rows[:-shift]
            out[shift:, column] = np.where(same, names[:-shift], 0)
    if n > 1:
        out[:-1, 9] = np.where(rows[1:] == rows[:-1], names[1:], 0)
    counts = np.bincount(rows, minlength=block.n_rows)
    out[:, 10] = np.searchsorted([20, 60, 150, 400, 1000, 3000, 10000], counts, side="right")[rows]
    share = np.bincount(rows, weights=digits, minlength=block.n_rows) / np.maximum(np.bincount(rows, weights=length, minlength=block.n_rows), 1)
    out[:, 11] = np.searchsorted([0.002, 0.01, 0.03, 0.1, 0.3], share, side="right")[rows]
    return out + _FIRST[:-1].astype(np.int32)


class Tagger:
    """Linear-chain conditional random field over begin, inside and outside."""

    def __init__(self):
        self.weights = np.zeros((N_WEIGHTS, N_TAGS))
        self.steps = np.zeros((N_TAGS, N_TAGS))
        self.known = False

    def fit(
        self, features: np.ndarray, tags: np.ndarray, lengths: np.ndarray, rounds: int = 120, penalty: float = 1e-4, settled: float = 2e-3
    ) -> Tagger:
        """``features`` are padded sequences (sequence, place, feature); ``tags`` and ``lengths`` go with them.

        Ends after ``rounds`` steps, or when ten steps lowered the loss by less than the share ``settled``.
        """
        if not len(tags) or not (tags > 0).any():
            return self
        self.known = True
        # Places first: each step of a sequence is one block of memory.
        features, tags = np.ascontiguousarray(features.transpose(1, 0, 2)), np.ascontiguousarray(tags.T)
        inside = np.arange(len(tags))[:, None] < lengths[None, :]
        total = inside.sum()
        state = [np.zeros((2, *self.weights.shape)), np.zeros((2, *self.steps.shape))]
        truth = np.eye(N_TAGS)[tags] * inside[..., None]
        true_steps = np.einsum("tni,tnj->ij", truth[:-1] * inside[1:, :, None], truth[1:])
        flat = features[inside]
        losses: list[float] = []
        for turn in range(1, rounds + 1):
            scores = np.zeros((*tags.shape, N_TAGS))
            scores[inside] = sum(self.weights[flat[:, column]] for column in range(flat.shape[1]))
            chance, joint, whole = chances(scores, self.steps, inside)
            losses.append(float(whole.sum() - (truth * scores).sum() - (true_steps * self.steps).sum()) / total)
            if turn > 10 and losses[-11] - losses[-1] < settled * abs(losses[-11]):
                break
            by_token = (truth - chance)[inside]
            by_weight = np.zeros_like(self.weights)
            for tag in range(N_TAGS):
                by_weight[:, tag] = np.bincount(flat.ravel(), weights=np.repeat(by_token[:, tag], flat.shape[1]), minlength=N_WEIGHTS)
            gradients = (by_weight / total - penalty * self.weights, (true_steps - joint) / total - penalty * self.steps)
            for own, memory, g in zip((self.weights, self.steps), state, gradients, strict=True):
                memory[0] = 0.9 * memory[0] + 0.1 * g
                memory[1] = 0.99 * memory[1] + 0.01 * g * g
                own += 0.1 * (memory[0] / (1 - 0.9**turn)) / (np.sqrt(memory[1] / (1 - 0.99**turn)) + 1e-9)
        return self

    def tags(self, features: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Best tags (Viterbi) of the tokens of rows that follow each other.

        A token whose outside score leads by more than any change of two steps can be worth is outside on every best
        path; the tokens between such ones are decoded apart.
        """
        n = len(features)
        out = np.zeros(n, dtype=np.int8)
        if not self.known or not n:
            return out
        scores = np.zeros((n, N_TAGS))
        for column in range(features.shape[1]):
            scores += self.weights[features[:, column]]
        slack = 2 * (self.steps.max() - self.steps.min())
        unsure = scores[:, OUTSIDE] - scores[:, 1:].max(axis=1) <= slack
        at = np.flatnonzero(unsure)
        if not len(at):
            return out
        cut = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (rows[at[1:]] != rows[at[:-1]])])
        first = np.flatnonzero(cut)
        last = np.append(first[1:], len(at)) - 1
        for a, b in zip(at[first].tolist(), at[last].tolist(), strict=True):
            left = a > 0 and rows[a - 1] == rows[a]
            right = b + 1 < n and rows[b + 1] == rows[b]
            out[a : b + 1] = self._best(scores[a : b + 1], left, right)
        return out

    def _best(self, scores: np.ndarray, left: bool, right: bool) -> np.ndarray:
        best = scores[0] + (self.steps[OUTSIDE] if left else 0)
        came = np.zeros((len(scores), N_TAGS), dtype=np.int8)
        for t in range(1, len(scores)):
            options = best[:, None] + self.steps
            came[t] = options.argmax(axis=0)
            best = options.max(axis=0) + scores[t]
        if right:
            best = best + self.steps[:, OUTSIDE]
        path = np.zeros(len(scores), dtype=np.int8)
        path[-1] = int(best.argmax())
        for t in range(len(scores) - 1, 0, -1):
            path[t - 1] = came[t, path[t]]
        return path


def chances(scores: np.ndarray, steps: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chance of each tag (place, sequence, tag), expected number of each step (tag, tag), log of each sequence's whole sum.

    ``inside`` (place, sequence) marks the places of a sequence, which has at least one.  Sums are scaled to one at each place.
    """
    top = scores.max(axis=2, keepdims=True)
    own = np.exp(scores - top)
    change = np.exp(steps - steps.max())
    ahead, back, scale = np.empty_like(own), np.ones_like(own), np.ones(inside.shape)
    for t in range(len(own)):
        value = own[t] if t == 0 else (ahead[t - 1] @ change) * own[t]
        scale[t] = np.where(inside[t], value.sum(axis=1), 1)
        ahead[t] = np.where(inside[t, :, None], value / scale[t][:, None], ahead[t - 1] if t else value)
    joint = np.zeros_like(steps)
    for t in range(len(own) - 2, -1, -1):
        later = own[t + 1] * back[t + 1] / scale[t + 1][:, None] * inside[t + 1, :, None]
        joint += change * (ahead[t].T @ later)
        back[t] = np.where(inside[t + 1, :, None], later @ change.T, 1)
    whole = (np.log(scale) + top[..., 0] * inside).sum(axis=0) + steps.max() * (inside.sum(axis=0) - 1)
    return ahead * back * inside[..., None], joint, whole


def _base_tags(block: W.Block, points: np.ndarray, found: dict[int, list[Span]]) -> np.ndarray:
    """Tags of the tokens that the base spans cover."""
    tags = np.zeros(len(block.starts), dtype=np.int8)
    for row, spans in found.items():
        low, high = int(block.bounds[row]), int(block.bounds[row + 1])
        start = points[block.starts[low:high]] - points[block.offsets[row]]
        end = points[block.ends[low:high]] - points[block.offsets[row]]
        for s, e, _ in spans:
            own = low + np.flatnonzero((start < e) & (end > s))
            if len(own):
                tags[own] = INSIDE
                tags[own[0]] = BEGIN
    return tags


def _lesson_rows(per_row: int):
    """Short sequences to learn from: around base spans, and one from the middle of each row."""

    def step(batches: Batches) -> Batches:
        width = 2 * AROUND + 1
        for batch in batches:
            for block in W.blocks(batch.column(1), _TOKEN):
                if not len(block.starts):
                    continue
                points = code_points(block)
                features = token_features(block)
                tags = _base_tags(block, points, block_spans(block, points))
                centres = np.flatnonzero(tags == BEGIN)
                keep, seen = [], {}
                for c in centres.tolist():
                    row = int(block.rows[c])
                    seen[row] = seen.get(row, 0) + 1
                    if seen[row] <= per_row:
                        keep.append(c)
                middle = (block.bounds[:-1] + block.bounds[1:]) // 2
                keep += middle[block.bounds[1:] > block.bounds[:-1]].tolist()
                rows = []
                for c in keep:
                    low = max(int(block.bounds[block.rows[c]]), c - AROUND)
                    high = min(int(block.bounds[block.rows[c] + 1]), low + width)
                    rows.append((features[low:high].ravel().tolist(), tags[low:high].tolist()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.list_(pa.int32())), pa.array([r[1] for r in rows], pa.list_(pa.int32()))],
                    names=["features", "tags"],
                )

    return step


def _kind_rows(batches: Batches) -> Batches:
    """Id, hash and kind of base span of each row, once per kind that it has; kind -1 for rows without any."""
    for batch in batches:
        for block in W.blocks(batch.column(1), _TOKEN):
            found = block_spans(block, code_points(block))
            at, kinds = [], []
            for row in range(block.n_rows):
                for kind in sorted({k for _, _, k in found.get(row, [])}) or [-1]:
                    at.append(block.first + row)
                    kinds.append(kind)
            take = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(2).take(take), pa.array(kinds, pa.int32())], names=["im_id", "hash", "kind"]
            )


def lesson_sample(images: DataFrame, most_rows: int) -> DataFrame:
    """Rows to learn from: ``im_id``, ``im_description``.

    Base spans are looked for in all rows.  Of the ids that have some of one kind, a sixth of ``most_rows`` is taken for each of the three kinds, of those without any
    half of it, both in the order of a hash of the id.  An id gives one text per kind, that with the least hash.
    """
    rows = described(images).filter(F.col("im_id").isNotNull()).withColumn("hash", F.xxhash64("im_description"))
    kind = images.schema["im_id"].dataType.simpleString()
    found = in_tasks(rows, _kind_rows, f"im_id {kind}, hash bigint, kind int")
    # Ids, hashes and kinds only; read once for each kind.
    found = checkpointed(found.groupBy("im_id", "kind").agg(F.min("hash").alias("hash")))
    by = [F.xxhash64(F.col("im_id").cast("string"), F.lit(29)), F.col("im_id")]
    shares = {-1: most_rows // 2, **dict.fromkeys(range(3), most_rows // 6)}
    taken = [found.filter(F.col("kind") == k).orderBy(*by).limit(n).select("im_id", "hash") for k, n in shares.items()]
    # At most most_rows rows, so the broadcast has a bound.
    taken = checkpointed(reduce(DataFrame.unionByName, taken).distinct())
    return one_of_each(rows.join(F.broadcast(taken), ["im_id", "hash"], "left_semi"), "im_id", "hash").select("im_id", "im_description")


def learned_tagger(images: DataFrame, most_rows: int = 4800) -> Tagger:
    """Tagger learned from at most ``most_rows`` rows, half of them with base spans where there are enough (``lesson_sample``)."""
    rows = lesson_sample(images, most_rows)
    lessons = in_tasks(rows, _lesson_rows(4), "features array<int>, tags array<int>").toPandas()
    if lessons.empty:
        return Tagger()
    order = sorted(range(len(lessons)), key=lambda i: (list(lessons["tags"][i]), list(lessons["features"][i])))
    lengths = np.array([len(lessons["tags"][i]) for i in order])
    width, k = int(lengths.max()), len(FEATURES)
    features = np.zeros((len(order), width, k), dtype=np.int32)
    tags = np.zeros((len(order), width), dtype=np.int64)
    for place, i in enumerate(order):
        features[place, : lengths[place]] = np.asarray(lessons["features"][i]).reshape(-1, k)
        tags[place, : lengths[place]] = lessons["tags"][i]
    return Tagger().fit(features, tags, lengths)


def _span_rows(tagger):
    def step(batches: Batches) -> Batches:
        for batch in batches:
            for block in W.blocks(batch.column(1), _TOKEN):
                points = code_points(block)
                found = block_spans(block, points)
                tags = tagger.value.tags(token_features(block), block.rows) if len(block.starts) else np.zeros(0)
                at = np.flatnonzero(tags)
                heads = at[(tags[at] == BEGIN) | (at == 0) | (tags[np.maximum(at - 1, 0)] == OUTSIDE) | (block.rows[np.maximum(at - 1, 0)] != block.rows[at])]
                for i in heads.tolist():
                    row, j = int(block.rows[i]), i
                    while j + 1 < int(block.bounds[row + 1]) and tags[j + 1] == INSIDE:
                        j += 1
                    origin = points[block.offsets[row]]
                    s, e = int(points[block.starts[i]] - origin), int(points[block.ends[j]] - origin)
                    own = found.setdefault(row, [])
                    if all(e <= a or s >= b for a, b, _ in own):
                        own.append((s, e, 3))
                spans = [
                    [{"kind": KINDS[k], "start": s, "end": e} for s, e, k in sorted(found.get(r, []), key=lambda x: (x[0], x[2]))]
                    for r in range(block.n_rows)
                ]
                kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
                ids = batch.column(0).slice(block.first, block.n_rows)
                yield pa.RecordBatch.from_arrays([ids, batch.column(1).slice(block.first, block.n_rows), pa.array(spans, kind)], names=["im_id", "im_description", "spans"])

    return step


def spans_of(images: DataFrame, tagger: Tagger) -> DataFrame:
    """Base spans and those a learned tagger adds: ``im_id`` (of any type), ``im_description`` and ``spans``."""
    shared = images.sparkSession.sparkContext.broadcast(tagger)
    kind = images.schema["im_id"].dataType.simpleString()
    schema = f"im_id {kind}, im_description string, spans array<struct<kind:string,start:int,end:int>>"
    return in_tasks(described(images), _span_rows(shared), schema)


def secret_spans(images: DataFrame, most_rows: int = 4800) -> DataFrame:
    """Secrets in image descriptions.

    ``images`` has ``im_id`` and ``im_description``.  Base spans are the matches of three fixed patterns (``assign``,
    ``access``, ``hex``); all of them stay.  A linear-chain conditional random field, learned from the base spans of at
    most ``most_rows`` rows (base spans are found in all rows first, and each kind gives its share), tags the tokens of every text as begin, inside or outside from their shape, the words around
    and the text's length and digits; its Viterbi path adds ``tagged`` spans that touch no base span.

    One row per input row: ``im_id``, ``im_description`` and ``spans``, an array of (kind, start, end) in code points, end exclusive, by
    start, then kind.  NULL and empty texts have none.  Without any base span in the table nothing is added.
    """
    return spans_of(images, learned_tagger(images, most_rows))


def without_secrets(spans: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``secret_spans`` rows with each span of the description replaced by ``mark``; overlapping spans are one."""
    start = F.aggregate(
        "spans",
        F.struct(F.lit("").alias("text"), F.lit(0).alias("at")),
        lambda done, span: F.struct(
            F.when(span["end"] <= done["at"], done["text"])
            .when(span["start"] < done["at"], done["text"])
            .otherwise(F.concat(done["text"], F.substring("im_description", done["at"] + 1, span["start"] - done["at"]), F.lit(mark)))
            .alias("text"),
            F.greatest(done["at"], span["end"]).alias("at"),
        ),
        lambda done: F.concat(done["text"], F.substring("im_description", done["at"] + 1, F.length("im_description"))),
    )
    text = F.when(F.size("spans") > 0, start).otherwise(F.col("im_description"))
    return spans.withColumn("im_description", text)
