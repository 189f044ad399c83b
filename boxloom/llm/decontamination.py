"""Held-out descriptions found in training descriptions."""

from __future__ import annotations

import hashlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom.llm import words as W
from boxloom.llm.frames import Batches, described, in_tasks
from boxloom.session import checkpointed, forget

#: Windows of held-out items that are broadcast at once, about 30 bytes each; more are scanned in blocks.
MOST_WINDOWS = 3 << 20
_SLICE = 1 << 16
_WINDOWS = "length int, hash bigint, digest binary, item string"
_STEP = "im_id {kind}, im_description string, starts array<int>, ends array<int>, found array<string>, n_words bigint"


def _digest(words: list[bytes]) -> bytes:
    """128 bits that stand for the words of a window; hits are verified by them."""
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def _item_windows(n_words: int):
    """Windows of held-out descriptions: hash, digest and item of each."""

    def step(batches: Batches) -> Batches:
        for batch in batches:
            items = batch.column(0).to_pylist()
            for block in W.blocks(batch.column(1), W.ALPHANUMERIC, lower=True):
                hashes = W.word_hashes(block)
                for row in range(block.n_rows):
                    low, high = int(block.bounds[row]), int(block.bounds[row + 1])
                    length = min(n_words, high - low)
                    if not length:
                        continue
                    own = W.window_hashes(hashes[low:high], length)
                    # A very long description comes in slices.
                    for first in range(0, len(own), _SLICE):
                        some = own[first : first + _SLICE]
                        words = [block.word(i) for i in range(low + first, low + first + len(some) + length - 1)]
                        digests = [_digest(words[i : i + length]) for i in range(len(some))]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(some), length, np.int32)), pa.array(some.view(np.int64)), pa.array(digests, pa.binary()), pa.array([items[block.first + row]] * len(some), pa.string())],
                            names=["length", "hash", "digest", "item"],
                        )

    return step


class Windows:
    """A block of windows in flat arrays, by length: sorted hashes, digests and item numbers."""

    def __init__(self, rows: pa.Table):
        items = rows["item"].combine_chunks().dictionary_encode()
        items = items.combine_chunks() if isinstance(items, pa.ChunkedArray) else items
        self.items: list[str] = items.dictionary.to_pylist()
        codes = items.indices.to_numpy(zero_copy_only=False).astype(np.int32)
        lengths = rows["length"].to_numpy()
        hashes = rows["hash"].to_numpy().view(np.uint64)
        fixed = pa.concat_arrays([c.cast(pa.binary(16)) for c in rows["digest"].chunks] or [pa.array([], pa.binary(16))])
        digests = np.frombuffer(fixed.buffers()[1] or b"", dtype="V16")[: len(fixed)]
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        for length in sorted(set(lengths.tolist())):
            own = np.flatnonzero(lengths == length)
            own = own[np.argsort(hashes[own], kind="stable")]
            coarse = np.zeros(1 << 20, dtype=bool)
            coarse[(hashes[own] >> np.uint64(44)).astype(np.int64)] = True
            self.by_length[length] = (hashes[own], coarse, digests[own], codes[own])

    def hits(self, block: W.Block) -> tuple[np.ndarray, list[set[str]]]:
        """Words covered by verified windows, and the items found in each row."""
        covered = np.zeros(len(block.starts) + 1, dtype=np.int64)
        found: list[set[str]] = [set() for _ in range(block.n_rows)]
        hashes = W.word_hashes(block)
        for length, (keys, coarse, digests, codes) in self.by_length.items():
            own = W.window_hashes(hashes, length)
            at = np.flatnonzero(coarse[(own >> np.uint64(44)).astype(np.int64)])
            at = at[block.rows[at] == block.rows[at + length - 1]]
            first, beyond = np.searchsorted(keys, own[at], "left"), np.searchsorted(keys, own[at], "right")
            same = beyond > first
            for start, low, high in zip(at[same].tolist(), first[same].tolist(), beyond[same].tolist(), strict=True):
                digest = np.void(_digest([block.word(i) for i in range(start, start + length)]))
                fits = codes[low:high][digests[low:high] == digest]
                if len(fits):
                    covered[start] += 1
                    covered[start + length] -= 1
                    found[block.rows[start]].update(self.items[c] for c in fits.tolist())
        return np.cumsum(covered[:-1]) > 0, found


def _scan(windows, keep_text: bool):
    def step(batches: Batches) -> Batches:
        for batch in batches:
            texts = batch.column(1)
            starts, ends, found, totals = [], [], [], []
            earlier = batch.num_columns > 2
            for block in W.blocks(texts, W.ALPHANUMERIC, lower=True):
                covered, items = windows.value.hits(block)
                for row in range(block.n_rows):
                    low, high = int(block.bounds[row]), int(block.bounds[row + 1])
                    own = covered[low:high]
                    if earlier:
                        at = block.first + row
                        own = own.copy()
                        for s, e in zip(batch.column(2)[at].as_py(), batch.column(3)[at].as_py(), strict=True):
                            own[s:e] = True
                        items[row].update(batch.column(4)[at].as_py())
                    if own.any():
                        step = np.diff(np.concatenate([[0], own.view(np.int8), [0]]))
                        starts.append(np.flatnonzero(step == 1).tolist())
                        ends.append(np.flatnonzero(step == -1).tolist())
                    else:
                        starts.append([])
                        ends.append([])
                    found.append(sorted(items[row]))
                    totals.append(high - low)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    texts if keep_text else pa.nulls(len(texts), pa.string()),
                    pa.array(starts, pa.list_(pa.int32())),
                    pa.array(ends, pa.list_(pa.int32())),
                    pa.array(found, pa.list_(pa.string())),
                    pa.array(totals, pa.int64()),
                ],
                names=["im_id", "im_description", "starts", "ends", "found", "n_words"],
            )

    return step


def held_out_hits(
    images: DataFrame,
    held_out: DataFrame,
    n_words: int = 13,
    least_share: float = 0.05,
    most_windows: int = MOST_WINDOWS,
    keep_text: bool = False,
) -> DataFrame:
    """Words of image descriptions that repeat descriptions of a held-out split.

    ``images`` and ``held_out`` are image rows with ``im_id`` and ``im_description``.  A-Z are lower-cased; words are runs of digits,
    a-z and characters beyond ASCII.  A window is ``n_words`` consecutive words of a held-out description, or the whole
    of a shorter one.  The windows' hash set is broadcast in flat arrays; hits of the training windows are verified by 128-bit digests
    of their words.  More than ``most_windows`` windows are scanned in blocks of about that number, one after the other, without a shuffle.

    One row per row of ``images``: ``im_id``, ``n_words``, ``n_hit`` (words inside any occurrence), ``starts`` and
    ``ends`` (maximal hit runs, in words), ``found`` (sorted held-out ids as strings) and ``contaminated``
    (some hit, and at least ``least_share`` of the words, compared exactly as the decimal number it is written as); ``keep_text`` also returns ``im_description``.  NULL or empty texts have no words and no hits, empty tables
    give none; repeated rows are judged each; a NULL held-out id is the string ``null``.
    """
    kind = images.schema["im_id"].dataType.simpleString()
    rows = described(images)
    items = held_out.select(F.coalesce(F.col("im_id").cast("string"), F.lit("null")).alias("im_id"), "im_description")
    items = items.filter(F.col("im_description").isNotNull())
    windows = in_tasks(items.distinct(), _item_windows(n_words), _WINDOWS).distinct()
    windows = checkpointed(windows)
    n_blocks = max(1, -(-windows.count() // most_windows))
    block = F.pmod(F.xxhash64("hash", "item"), F.lit(n_blocks))
    context = images.sparkSession.sparkContext
    for number in range(n_blocks):
        own = Windows(windows.filter(block == number).toArrow())
        rows = in_tasks(rows, _scan(context.broadcast(own), keep_text or number + 1 < n_blocks), _STEP.format(kind=kind))
    forget(windows)
    sizes = F.zip_with("ends", "starts", lambda end, start: end - start)
    n_hit = F.aggregate(sizes, F.lit(0).cast("bigint"), lambda total, x: total + x)
    text = ["im_description"] if keep_text else []
    rows = rows.select("im_id", *text, "n_words", n_hit.alias("n_hit"), "starts", "ends", "found")
    share = Fraction(str(least_share))
    if share.denominator > 10**18:
        raise ValueError("least_share has too many digits")
    hit = F.col("n_hit").cast("decimal(20,0)") * F.lit(share.denominator).cast("decimal(18,0)")
    least = F.col("n_words").cast("decimal(20,0)") * F.lit(share.numerator).cast("decimal(18,0)")
    return rows.withColumn("contaminated", (F.col("n_hit") > 0) & (hit >= least))
