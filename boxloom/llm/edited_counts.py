"""Token counts of image descriptions that follow edits."""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom.llm import words as W
from boxloom.llm.frames import Batches, described, in_tasks, lists

#: Pre-token runs of a leaf.
LEAF_RUNS = 32
#: Fixed value: the pattern that splits text into pre-tokens before the ranks are used.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Counter:
    """Tokens of runs; a run is white space and what follows up to the next white space, which no pre-token crosses."""

    def __init__(self, ranks: bytes):
        import tiktoken

        table = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, ranks.splitlines())}
        self.encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        self.known: dict[bytes, int] = {}

    def count(self, run: bytes) -> int:
        n = self.known.get(run)
        if n is None:
            if len(self.known) > 500_000:
                self.known.clear()
            n = self.known[run] = len(self.encoding.encode_ordinary(run.decode()))
        return n


def _wide_blanks(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether the character before each end is white space of the pattern (Unicode White_Space) beyond ASCII."""
    a, b, c = (data[np.maximum(ends - n, 0)] for n in (1, 2, 3))
    two = (b == 0xC2) & ((a == 0x85) | (a == 0xA0))
    general = (b == 0x80) & ((a <= 0x8A) | (a == 0xA8) | (a == 0xA9) | (a == 0xAF)) | (b == 0x81) & (a == 0x9F)
    ogham, ideographic = (c == 0xE1) & (b == 0x9A) & (a == 0x80), (c == 0xE3) & (b == 0x80) & (a == 0x80)
    return two | (c == 0xE2) & general | ogham | ideographic


def run_bounds(block: W.Block) -> np.ndarray:
    """Byte bounds of all runs of the block: each but a row's first starts where a word ends that no white space ends.

    Words are cut at ASCII blanks; where one ends with other white space, a pre-token may go on over the blank.
    """
    ends = block.ends[~_wide_blanks(block.data, block.ends)]
    return np.unique(np.concatenate([block.offsets, ends]))


def run_counts(block: W.Block, bounds: np.ndarray, counter: Counter) -> np.ndarray:
    """Tokens of each run; equal runs of a block are looked up once."""
    if len(bounds) < 2:
        return np.zeros(0, dtype=np.int64)
    buffers = [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(block.data)]
    coded = pa.Array.from_buffers(pa.binary(), len(bounds) - 1, buffers).dictionary_encode()
    distinct = np.array([counter.count(run) for run in coded.dictionary.to_pylist()], dtype=np.int64)
    return distinct[coded.indices.to_numpy()]


def _sums(leaves: np.ndarray) -> np.ndarray:
    """Tree of sums: node i has the children 2i and 2i + 1, leaves are last."""
    width = 1 << max(0, int(len(leaves) - 1).bit_length())
    tree = np.zeros(2 * width, dtype=np.int64)
    tree[width : width + len(leaves)] = leaves
    at = width
    while at > 1:
        tree[at // 2 : at] = tree[at : 2 * at].reshape(-1, 2).sum(axis=1)
        at //= 2
    return tree


def _set(tree: np.ndarray, leaf: int, value: int) -> None:
    node = len(tree) // 2 + leaf
    change = value - tree[node]
    while node >= 1:
        tree[node] += change
        node //= 2


def _find(tree: np.ndarray, place: int) -> tuple[int, int]:
    """Leaf that holds a place of the text, and where the leaf starts."""
    node, width, start = 1, len(tree) // 2, 0
    while node < width:
        node *= 2
        if place >= start + tree[node] and tree[node + 1] > 0:
            start += int(tree[node])
            node += 1
    return node - width, start


def _tree_rows(ranks):
    def step(batches: Batches) -> Batches:
        counter = Counter(ranks.value)
        for batch in batches:
            for block in W.blocks(batch.column(1), W.BLANKS):
                points = np.zeros(len(block.data) + 1, dtype=np.int64)
                np.cumsum((block.data & 0xC0) != 0x80, out=points[1:])
                trees, chars, runs = [], [], []
                all_bounds = run_bounds(block)
                all_counts = run_counts(block, all_bounds, counter)
                first = np.searchsorted(all_bounds, block.offsets)
                for row in range(block.n_rows):
                    bounds = all_bounds[first[row] : first[row + 1] + 1]
                    counts = all_counts[first[row] : first[row + 1]]
                    at = np.arange(0, len(counts), LEAF_RUNS)
                    ends = np.append(at[1:], len(counts)) if len(at) else at
                    trees.append(_sums(np.add.reduceat(counts, at) if len(at) else np.zeros(1, dtype=np.int64)))
                    chars.append(_sums(points[bounds[ends]] - points[bounds[at]] if len(at) else np.zeros(1, dtype=np.int64)))
                    runs.append(len(counts))
                where = slice(block.first, block.first + block.n_rows)
                sizes = [len(t) for t in trees]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[where],
                        batch.column(1)[where],
                        lists(np.concatenate(trees), sizes, pa.int64()),
                        lists(np.concatenate(chars), sizes, pa.int64()),
                        pa.array(runs, pa.int64()),
                    ],
                    names=["im_id", "im_description", "token_tree", "length_tree", "n_runs"],
                )

    return step


def _runs(text: str) -> list[bytes]:
    block = next(W.blocks(pa.array([text]), W.BLANKS))
    cuts = run_bounds(block).tolist()
    data = block.data.tobytes()
    return [data[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def edited(text: str, tokens: np.ndarray, lengths: np.ndarray, edits: list[tuple[int, int, str]], counter: Counter) -> tuple[str, int]:
    """Apply edits, the last first; only the leaves that an edit touches and one beside on each side are counted again.

    The trees are changed in place.  Returns the new text and the number of runs counted again.
    """
    again = 0
    for start, end, replacement in sorted(edits, reverse=True):
        last_leaf = len(lengths) // 2 - 1
        first, begin = _find(lengths, start)
        last, last_begin = _find(lengths, max(start, end - 1))
        finish = last_begin + int(lengths[len(lengths) // 2 + last])
        if first > 0:
            first -= 1
            begin -= int(lengths[len(lengths) // 2 + first])
        if last < last_leaf:
            last += 1
            finish += int(lengths[len(lengths) // 2 + last])
        region = text[begin:start] + replacement + text[end:finish]
        text = text[:start] + replacement + text[end:]
        runs = _runs(region)
        again += len(runs)
        n_leaves = last - first + 1
        share = -(-len(runs) // n_leaves) if runs else 0
        for number in range(n_leaves):
            own = runs[number * share : (number + 1) * share]
            _set(tokens, first + number, sum(map(counter.count, own)))
            _set(lengths, first + number, sum(len(r.decode()) for r in own))
    return text, again


def _edited_rows(ranks):
    def step(batches: Batches) -> Batches:
        counter = Counter(ranks.value)
        for batch in batches:
            texts, before, after, again, trees, chars = [], [], [], [], [], []
            for row in batch.select(["im_description", "token_tree", "length_tree", "edits"]).to_pylist():
                tokens, lengths = np.array(row["token_tree"]), np.array(row["length_tree"])
                before.append(int(tokens[1]))
                text, n = row["im_description"], 0
                edits = [(e["start"], e["end"], e["replacement"] or "") for e in row["edits"] or []]
                if edits:
                    text, n = edited(text or "", tokens, lengths, edits, counter)
                texts.append(text)
                after.append(int(tokens[1]))
                again.append(n)
                trees.append(tokens.tolist())
                chars.append(lengths.tolist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("im_id"),
                    pa.array(texts, pa.string()),
                    pa.array(trees, pa.list_(pa.int64())),
                    pa.array(chars, pa.list_(pa.int64())),
                    batch.column("n_runs"),
                    pa.array(before, pa.int64()),
                    pa.array(after, pa.int64()),
                    pa.array(again, pa.int64()),
                ],
                names=["im_id", "im_description", "token_tree", "length_tree", "n_runs", "n_tokens_before", "n_tokens", "n_recounted"],
            )

    return step


def _ranks(images: DataFrame, ranks_path: str):
    with open(ranks_path, "rb") as file:
        return images.sparkSession.sparkContext.broadcast(file.read())


def token_trees(images: DataFrame, ranks_path: str) -> DataFrame:
    """A segment tree of token counts for each image description.

    ``images`` has ``im_id`` and ``im_description``; ``ranks_path`` is a rank file of byte-level BPE.  A leaf holds some pre-token
    runs (white space and what follows up to the next).  Node i of a tree has the children 2i and 2i + 1; node 1 is the whole.

    One row per input row: ``im_id``, ``im_description``, ``token_tree`` (sums of tokens), ``length_tree`` (sums of code
    points), ``n_runs``.  NULL and empty texts have a tree of zeros.
    """
    kind = images.schema["im_id"].dataType.simpleString()
    schema = f"im_id {kind}, im_description string, token_tree array<bigint>, length_tree array<bigint>, n_runs bigint"
    return in_tasks(described(images), _tree_rows(_ranks(images, ranks_path)), schema)


def edited_trees(trees: DataFrame, edits: DataFrame, ranks_path: str) -> DataFrame:
    """Trees after edits of their descriptions.

    ``trees`` is the result of ``token_trees``; ``edits`` has ``im_id``, ``start``, ``end`` (code points of the text before any edit, end
    exclusive, not overlapping) and ``replacement`` (NULL: nothing).  Only the leaves an edit touches and one beside them
    on each side, which holds every boundary that may move, are encoded again; sums change along their paths.

    One row per tree row, further columns: ``n_tokens_before``, ``n_tokens``, ``n_recounted`` (runs encoded again).  Edits
    of other ids, and those with NULL bounds, have no effect; several rows of an id all get its edits.
    """
    kind = trees.schema["im_id"].dataType.simpleString()
    edits = edits.select("im_id", F.struct("start", "end", "replacement").alias("edit"))
    edits = edits.filter(F.col("edit.start").isNotNull() & F.col("edit.end").isNotNull())
    grouped = edits.groupBy("im_id").agg(F.collect_list("edit").alias("edits"))
    schema = (
        f"im_id {kind}, im_description string, token_tree array<bigint>, length_tree array<bigint>, n_runs bigint, "
        "n_tokens_before bigint, n_tokens bigint, n_recounted bigint"
    )
    return in_tasks(trees.join(grouped, "im_id", "left"), _edited_rows(_ranks(trees, ranks_path)), schema)
