"""Passages repeated across image descriptions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom.llm import words as W
from boxloom.llm.frames import Batches, described, held_by_several, held_by_smaller, in_tasks
from boxloom.session import checkpointed

#: Words of an anchor run.
ANCHOR = 6
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_CHECK_BASE = np.uint64(0xA0761D6478BD642F)


def _anchors(block: W.Block, hashes: np.ndarray, length: int) -> np.ndarray:
    """For each window its anchor: the least hash of the short runs inside."""
    short = min(ANCHOR, length)
    return W.sliding_min(W.window_hashes(hashes, short), length - short + 1)


def _anchor_rows(length: int):
    def step(batches: Batches) -> Batches:
        for batch in batches:
            for block in W.blocks(batch.column(1), W.BLANKS):
                anchors = _anchors(block, W.word_hashes(block), length)
                at = np.flatnonzero(W.in_one_row(block, length))
                rows, own = block.rows[at], anchors[at]
                new = np.ones(len(at), dtype=bool)
                new[1:] = (own[1:] != own[:-1]) | (rows[1:] != rows[:-1])
                ids = batch.column(0).take(pa.array(rows[new] + block.first))
                yield pa.RecordBatch.from_arrays([ids, pa.array(own[new].view(np.int64))], names=["im_id", "anchor"])

    return step


def _window_rows(length: int):
    def step(batches: Batches) -> Batches:
        for batch in batches:
            shared = batch.column(2)
            for block in W.blocks(batch.column(1), W.BLANKS):
                hashes = W.word_hashes(block)
                own = _anchors(block, hashes, length)
                keep = W.in_one_row(block, length)
                for row in range(block.n_rows):
                    low, high = int(block.bounds[row]), max(int(block.bounds[row]), int(block.bounds[row + 1]) - length + 1)
                    if high > low:
                        known = shared[block.first + row].values.to_numpy(zero_copy_only=False).view(np.uint64)
                        keep[low:high] &= np.isin(own[low:high], known)
                at = np.flatnonzero(keep)
                first, rows = W.window_hashes(hashes, length)[at], block.rows[at]
                # A run that a row holds many times travels once.
                once = np.unique(first + rows.astype(np.uint64) * _SPREAD, return_index=True)[1]
                at, first, rows = at[once], first[once], rows[once]
                second = W.window_hashes(hashes, length, _CHECK_BASE)[at] >> np.uint64(32)
                ids = batch.column(0).take(pa.array(rows + block.first))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(first.view(np.int64)), pa.array(second.astype(np.uint32).view(np.int32))],
                    names=["im_id", "run", "run_check"],
                )

    return step


def _cut(length: int):
    def step(batches: Batches) -> Batches:
        for batch in batches:
            totals, removed, intervals, kept = [], [], [], []
            copies, found = batch.column(2), batch.column(3)
            for block in W.blocks(batch.column(1), W.BLANKS):
                runs = None
                for row in range(block.n_rows):
                    low, high, at = int(block.bounds[row]), int(block.bounds[row + 1]), block.first + row
                    n, gone = high - low, np.zeros(high - low + 1, dtype=np.int64)
                    if copies[at].as_py() and n >= length:
                        gone[0], gone[n] = 1, -1
                    elif found[at].is_valid:
                        if runs is None:
                            runs = W.window_hashes(W.word_hashes(block), length)
                        own = found[at].values.to_numpy(zero_copy_only=False).view(np.uint64)
                        starts = np.flatnonzero(np.isin(runs[low : max(low, high - length + 1)], own))
                        np.add.at(gone, starts, 1)
                        np.add.at(gone, starts + length, -1)
                    stay = np.cumsum(gone[:-1]) == 0
                    text = b" ".join(block.word(low + i) for i in np.flatnonzero(stay).tolist())
                    totals.append(n)
                    removed.append(n - int(stay.sum()))
                    edges = np.diff(np.concatenate([[0], (~stay).view(np.int8), [0]]))
                    intervals.append(np.column_stack([np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)]).tolist())
                    kept.append(text.decode())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(totals, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(intervals, pa.list_(pa.list_(pa.int32()))),
                    pa.array(kept, pa.string()),
                ],
                names=["im_id", "n_words", "n_removed", "intervals", "kept_description"],
            )

    return step


def without_repeats(images: DataFrame, n_words: int = 13) -> DataFrame:
    """Image descriptions without the passages that a smaller ``im_id`` has too.

    ``images`` are image rows with ``im_id`` (of any ordered type) and ``im_description``.  Words are runs without
    ASCII white space.  A window is ``n_words`` consecutive words; a word goes if a window over it also starts in a
    description with a smaller ``im_id``.  Windows are judged on the input.

    Every window has a Rabin-Karp hash; Spark finds the least id of each hash.  Before that, windows are told apart by
    their anchor (the least hash of the runs of six words inside): a window whose anchor no other id has can't repeat
    and isn't shuffled.  Whole copies of a smaller id's text need no windows.  A repeated window is known by 96 bits.

    One row per input row: ``im_id``, ``n_words``, ``n_removed``, ``intervals`` (maximal removed runs of words, end
    exclusive), ``kept_description`` (kept words joined by one blank).  NULL and empty texts give no words; rows with a
    NULL id keep all their words and remove none; rows with equal ids don't remove each other's words.
    """
    rows = described(images)
    kind = images.schema["im_id"].dataType.simpleString()
    named, unnamed = rows.filter(F.col("im_id").isNotNull()), rows.filter(F.col("im_id").isNull())

    digest = F.sha2(F.col("im_description").cast("binary"), 256)
    digests = named.filter(F.octet_length("im_description") > 0).select("im_id", digest.alias("digest"))
    copies = digests.join(digests.groupBy("digest").agg(F.min("im_id").alias("first_id")), "digest")
    # A row is a copy only together with its text: another row may have the same id and a text of its own.
    copies = copies.filter(F.col("first_id") < F.col("im_id")).groupBy("im_id").agg(F.collect_set("digest").alias("copied"))
    marked = named.join(checkpointed(copies), "im_id", "left")
    is_copy = F.coalesce(F.array_contains("copied", digest), F.lit(False))
    marked = marked.select("im_id", "im_description", F.when(F.col("copied").isNull(), False).otherwise(is_copy).alias("is_copy"))
    originals = marked.filter(~F.col("is_copy")).select("im_id", "im_description")

    anchors = in_tasks(originals, _anchor_rows(n_words), f"im_id {kind}, anchor bigint")
    shared = held_by_several(anchors, ["anchor"]).groupBy("im_id").agg(F.collect_set("anchor").alias("anchors"))
    windows = in_tasks(
        marked.filter(~F.col("is_copy")).select("im_id", "im_description").join(shared, "im_id"),
        _window_rows(n_words),
        f"im_id {kind}, run bigint, run_check int",
    )
    repeated = held_by_smaller(windows, ["run", "run_check"]).groupBy("im_id").agg(F.collect_set("run").alias("found"))
    judged = marked.join(repeated, "im_id", "left").select("im_id", "im_description", "is_copy", "found")
    judged = judged.unionByName(
        unnamed.select("im_id", "im_description", F.lit(False).alias("is_copy"), F.lit(None).cast("array<bigint>").alias("found"))
    )
    schema = f"im_id {kind}, n_words bigint, n_removed bigint, intervals array<array<int>>, kept_description string"
    return in_tasks(judged, _cut(n_words), schema)
