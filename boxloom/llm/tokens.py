"""Token ids of image descriptions through a table of distinct words."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom.llm import words as W
from boxloom.llm.frames import Batches, described, in_tasks, lists, ship

#: Bytes of text whose words share one local list.
CHUNK_BYTES = 8 << 20
#: Words given to the tokenizer at once.
ENCODE_WORDS = 20_000
BLANK = pa.scalar(" ", pa.large_string())


@dataclass
class Chunk:
    """Neighbouring rows: their ids, words per row, each word's place in the list of distinct words."""

    key: int
    ids: pa.Array
    counts: np.ndarray
    places: np.ndarray
    words: pa.Array
    buckets: np.ndarray


def _chunks(batches: Batches, n_buckets: int, size: int) -> Iterator[Chunk]:
    held, held_bytes, number = [], 0, 0
    task = TaskContext.get()
    part = task.partitionId() if task else 0
    for batch in batches:
        for block in W.blocks(batch.column(1), W.BLANKS, size=size):
            ids = batch.column(0).slice(block.first, block.n_rows)
            inside = np.zeros(len(block.data) + 1, dtype=np.int8)
            inside[block.starts] = 1
            inside[block.ends] -= 1
            data = block.data[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)]
            offsets = np.zeros(len(block.starts) + 1, dtype=np.int32)
            np.cumsum(block.ends - block.starts, out=offsets[1:])
            own = pa.StringArray.from_buffers(len(block.starts), pa.py_buffer(offsets), pa.py_buffer(data))
            held.append((ids, np.diff(block.bounds), own))
            held_bytes += len(block.data)
            if held_bytes >= size:
                yield _chunk(held, n_buckets, f"{part} {number}")
                held, held_bytes, number = [], 0, number + 1
    if held:
        yield _chunk(held, n_buckets, f"{part} {number}")


def _chunk(held: list, n_buckets: int, place_of_chunk: str) -> Chunk:
    """The key holds the partition and the number in it: chunks of the same words stay groups of their own."""
    coded = pa.chunked_array([words for _, _, words in held], pa.string()).combine_chunks().dictionary_encode()
    words, places = coded.dictionary, coded.indices.to_numpy()
    offsets = np.frombuffer(words.buffers()[1], dtype=np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    raw = words.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    hashes = W.word_hashes(W.Block(0, data, offsets[[0, -1]], offsets[:-1], offsets[1:], np.array([0, len(words)])))
    buckets = (hashes % np.uint64(n_buckets)).astype(np.int32)
    order = np.argsort(buckets, kind="stable")
    place = np.empty(len(order), dtype=np.uint32)
    place[order] = np.arange(len(order), dtype=np.uint32)
    words = words.take(pa.array(order))
    ids = pa.chunked_array([ids for ids, _, _ in held]).combine_chunks()
    mark = hashlib.blake2b(data.tobytes(), digest_size=8)
    mark.update(offsets.tobytes())
    mark.update(place_of_chunk.encode())
    key = int.from_bytes(mark.digest(), "little", signed=True)
    return Chunk(key, ids, np.concatenate([n for _, n, _ in held]), place[places], words, buckets[order])


def packed(numbers: np.ndarray) -> bytes:
    """32-bit numbers with equal bytes together, compressed."""
    planes = np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, 4).T)
    return pa.Codec("zstd").compress(planes.tobytes(), asbytes=True)


def unpacked(data: bytes, n: int, kind=np.int32) -> np.ndarray:
    planes = pa.Codec("zstd").decompress(data, 4 * n, asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, dtype=np.uint8).reshape(4, n).T).view(kind).ravel()


def _word_rows(n_buckets: int, size: int):
    def step(batches: Batches) -> Batches:
        for chunk in _chunks(batches, n_buckets, size):
            first = np.flatnonzero(np.diff(chunk.buckets, prepend=-1))
            lengths = np.diff(np.append(first, len(chunk.buckets)))
            offsets = np.zeros(len(first) + 1, dtype=np.int32)
            np.cumsum(lengths, out=offsets[1:])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(first), chunk.key)),
                    pa.array(chunk.buckets[first]),
                    pa.ListArray.from_arrays(pa.array(offsets), chunk.words),
                ],
                names=["chunk", "bucket", "words"],
            )

    return step


def _place_rows(n_buckets: int, size: int):
    def step(batches: Batches) -> Batches:
        for chunk in _chunks(batches, n_buckets, size):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([chunk.key]),
                    pa.array([len(chunk.words)], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(chunk.ids)], pa.int32()), chunk.ids),
                    lists(chunk.counts, [len(chunk.counts)], pa.int32()),
                    pa.array([packed(chunk.places)], pa.binary()),
                ],
                names=["chunk", "n_distinct", "ids", "counts", "places"],
            )

    return step


def tokenizer(text: str):
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    out = Tokenizer.from_str(text)
    out.no_truncation()
    out.no_padding()
    return out


def _encoded_rows(model):
    """The distinct words of one bucket, each encoded once, given back to every chunk that has them."""

    def step(table: pa.Table) -> pa.Table:
        own = tokenizer(model.value)
        flat = table.column("words").combine_chunks()
        coded = flat.flatten().dictionary_encode()
        ids, lengths = [], []
        for at in range(0, len(coded.dictionary), ENCODE_WORDS):
            for encoding in own.encode_batch_fast(coded.dictionary[at : at + ENCODE_WORDS].to_pylist(), add_special_tokens=False):
                ids.append(np.array(encoding.ids, dtype=np.int32))
                lengths.append(len(ids[-1]))
        per_word = lists(np.concatenate(ids) if ids else np.zeros(0, dtype=np.int32), lengths, pa.int32())
        lengths = np.array(lengths, dtype=np.int32)
        ends = np.cumsum(pc.list_value_length(flat).to_numpy())
        out_lengths, out_ids, sizes = [], [], []
        places = coded.indices.to_numpy()
        for low, high in zip(np.concatenate([[0], ends[:-1]]), ends, strict=True):
            at = places[low:high]
            own = per_word.take(pa.array(at)).flatten().to_numpy().astype(np.int32)
            out_lengths.append(packed(lengths[at]))
            out_ids.append(packed(own))
            sizes.append((len(at), len(own)))
        return pa.table(
            {
                "chunk": table.column("chunk"),
                "bucket": table.column("bucket"),
                "n_words": pa.array([n for n, _ in sizes], pa.int32()),
                "n_ids": pa.array([n for _, n in sizes], pa.int32()),
                "lengths": pa.array(out_lengths, pa.binary()),
                "token_ids": pa.array(out_ids, pa.binary()),
            }
        )

    return step


def _joined_rows(pieces, kind: pa.DataType):
    """Ids of each row's words by their places, and the text of the ids by the table of pieces."""

    def step(rows: pa.Table, words: pa.Table) -> pa.Table:
        words = words.sort_by("bucket")
        out = []
        buckets = words.column("bucket").to_numpy()
        keep = np.flatnonzero(np.diff(buckets, prepend=-1))
        words = words.take(pa.array(keep))
        lengths, ids = (
            np.concatenate([np.zeros(0, dtype=np.int32), *(unpacked(d, n) for d, n in zip(*(words.column(c).to_pylist() for c in names), strict=True))])
            for names in (("lengths", "n_words"), ("token_ids", "n_ids"))
        )
        per_word = lists(ids, lengths, pa.int32())
        texts = pc.binary_join(lists_of(pieces.value.take(pa.array(ids)), lengths), BLANK)
        for row in range(rows.num_rows):
            if rows.column("n_distinct")[row].as_py() != len(lengths):
                raise RuntimeError("the rows came in another order when they were read again; write them as a table first")
            counts = rows.column("counts")[row].values.to_numpy()
            n = int(counts.sum())
            places = unpacked(rows.column("places")[row].as_py(), n, np.uint32)
            sizes, owner = lengths[places], np.repeat(np.arange(len(counts)), counts)
            flat = per_word.take(pa.array(places)).flatten().to_numpy().astype("<u4")
            totals = np.bincount(owner, weights=sizes, minlength=len(counts)).astype(np.int64)
            ends = np.cumsum(totals)
            said = sizes > 0
            n_said = np.bincount(owner[said], minlength=len(counts))
            decoded = pc.binary_join(lists_of(texts.take(pa.array(places[said])), n_said), BLANK)
            token_bytes = [flat[e - t : e].tobytes() for e, t in zip(ends.tolist(), totals.tolist(), strict=True)]
            out.append(
                pa.table(
                    {
                        "im_id": rows.column("ids")[row].values.cast(kind),
                        "n_tokens": pa.array(totals),
                        "token_ids": pa.array(token_bytes, pa.binary()),
                        "decoded": decoded.cast(pa.string()),
                    }
                )
            )
        return pa.concat_tables(out)

    return step


def lists_of(values: pa.Array, lengths: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths, out=offsets[1:])
    return pa.LargeListArray.from_arrays(pa.array(offsets), values.cast(pa.large_string()))


def piece_table(model: str) -> pa.Array:
    """Piece of each id of a tokenizer file, its added tokens included."""
    own = tokenizer(model)
    vocabulary = own.get_vocab(with_added_tokens=True)
    pieces = [None] * (max(vocabulary.values()) + 1)
    for piece, number in vocabulary.items():
        pieces[number] = piece
    return pa.array(pieces, pa.large_string())


def token_ids(images: DataFrame, tokenizer_path: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Token ids of each image description, and the text they decode to.

    ``images`` are image rows with ``im_id`` and ``im_description``; ``tokenizer_path`` is a file of the tokenizers library whose
    pieces never cross ASCII white space (words are split there) and that has no decoder: decoded pieces are joined by
    blanks. Added tokens are recognised in the text; none are added.

    Tasks split texts into words and list the distinct words of chunks of ``chunk_bytes``. Spark brings equal words of all
    chunks together in buckets, where each distinct word is encoded once, and the ids go back to the chunks and to the
    positions of their words. Ids decode through a table of pieces, bounded by the vocabulary. A very frequent word
    travels once per chunk.

    The rows are read twice and have to come in the same order: give a table or a file scan, as of any files. Another
    order is noticed and raises an error.

    One row per input row: ``im_id``, ``n_tokens``, ``token_ids`` (little-endian unsigned 32-bit integers), ``decoded``.
    A NULL text is an empty one: no tokens, decoded empty. NULL and repeated ids are kept as they are.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        text = file.read()
    json.loads(text)
    rows = described(images)
    spark = images.sparkSession
    ship(spark)
    kind = images.schema["im_id"].dataType.simpleString()
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    size = rows.agg(F.sum(F.octet_length("im_description"))).first()[0] or 0
    n_buckets = max(8, -(-size // chunk_bytes))
    model = spark.sparkContext.broadcast(text)
    pieces = spark.sparkContext.broadcast(piece_table(text))
    words = in_tasks(rows, _word_rows(n_buckets, chunk_bytes), "chunk bigint, bucket int, words array<string>")
    encoded = words.groupBy("bucket").applyInArrow(
        _encoded_rows(model), "chunk bigint, bucket int, n_words int, n_ids int, lengths binary, token_ids binary"
    )
    schema = f"chunk bigint, n_distinct bigint, ids array<{kind}>, counts array<int>, places binary"
    places = in_tasks(rows, _place_rows(n_buckets, chunk_bytes), schema)
    out = f"im_id {kind}, n_tokens bigint, token_ids binary, decoded string"
    return places.groupBy("chunk").cogroup(encoded.groupBy("chunk")).applyInArrow(_joined_rows(pieces, arrow), out)
