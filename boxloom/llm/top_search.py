"""Exact best inner products between image embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxloom.llm.frames import ship

#: Vectors of a shard, queries of a block.
SHARD_ROWS = 8192
BLOCK_ROWS = 512
#: Vectors scored in full to start from.
FIRST_ROWS = 2048
#: Terms probed between two looks at what is still competitive.
PROBED = 8


def weights(embedding: Column, scale: int) -> Column:
    """Whole-number weights; NULL for a vector that is NULL or holds a NULL or a non-finite component."""
    real = F.transform(embedding, lambda x: x.cast("double"))
    bad = F.exists(real, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(embedding.isNotNull() & ~bad, F.transform(real, lambda x: F.floor(x * scale).cast("bigint")))


class Postings:
    """Of each term (dimension) the vectors that have a weight there, and the bounds of the weights."""

    def __init__(self, values: np.ndarray):
        self.values = np.ascontiguousarray(values.T)
        self.n = len(values)
        self.lists = []
        for row in self.values:
            at = np.flatnonzero(row)
            # A list of most vectors is added up whole; zeros change nothing.
            self.lists.append(None if 4 * len(at) > self.n else at)
        self.most = np.maximum(values.max(axis=0), 0) if self.n else np.zeros(values.shape[1], values.dtype)
        self.least = np.minimum(values.min(axis=0), 0) if self.n else np.zeros(values.shape[1], values.dtype)

    def above(self, query: np.ndarray, floor) -> tuple[np.ndarray, np.ndarray]:
        """Vectors that score more than ``floor`` (all with NULL), with their scores.

        MaxScore: terms go by falling bounds.  The last ones whose bounds together don't pass the floor are not essential: a
        vector in none of the other terms' lists can't pass.  Lists of essential terms are added up, the others are
        probed for vectors that can still pass.
        """
        bounds = np.maximum(query * self.most, query * self.least)
        order = np.argsort(-bounds, kind="stable")
        order = order[query[order] != 0]
        rest = np.concatenate([np.cumsum(bounds[order][::-1])[::-1], [0]])
        if floor is None:
            return np.arange(self.n), query @ self.values
        if floor < 0:
            essential, seen = len(order), None
        else:
            essential, seen = int(np.searchsorted(-rest, -floor)), np.zeros(self.n, dtype=bool)
        scores = np.zeros(self.n, dtype=self.values.dtype)
        full = np.array([t for t in order[:essential] if self.lists[t] is None], dtype=np.int64)
        if len(full):
            scores += query[full] @ self.values[full]
            seen = None
        for term in order[:essential]:
            own = self.lists[term]
            if own is not None:
                scores[own] += query[term] * self.values[term][own]
                if seen is not None:
                    seen[own] = True
        alive = scores + rest[essential] > floor
        if seen is not None:
            alive &= seen
        alive = np.flatnonzero(alive)
        scores = scores[alive]
        for first in range(essential, len(order), PROBED):
            terms = order[first : first + PROBED]
            scores = scores + query[terms] @ self.values[np.ix_(terms, alive)]
            keep = scores + rest[min(first + PROBED, len(order))] > floor
            alive, scores = alive[keep], scores[keep]
        keep = scores > floor
        return alive[keep], scores[keep]


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of weights, padded with zeros."""
    flat = column.combine_chunks()
    lengths = np.diff(flat.offsets.to_numpy()) if len(flat) else np.zeros(0, dtype=np.int64)
    out = np.zeros((len(flat), width), dtype=np.int64)
    if len(flat):
        rows = np.repeat(np.arange(len(flat)), lengths)
        places = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        out[rows, places] = flat.flatten().to_numpy(zero_copy_only=False)
    return out


def _exact_kind(one: np.ndarray, two: np.ndarray):
    """A number type that holds every partial sum exactly."""
    size = one.shape[1] * int(np.abs(one).max(initial=0)) * int(np.abs(two).max(initial=0))
    return np.float32 if size < 1 << 24 else np.float64 if size < 1 << 53 else object


def _shard_best(k: int):
    def step(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        names = ["query_id", "query_mark", "im_id", "score"]
        if not vectors.num_rows or not queries.num_rows:
            kinds = [queries.schema.field("im_id").type, pa.int64(), vectors.schema.field("im_id").type, pa.int64()]
            return pa.table([pa.array([], t) for t in kinds], names=names)
        vectors = vectors.sort_by("im_id")
        width = max(int(pa.compute.max(pa.compute.list_value_length(t.column("weights"))).as_py() or 0) for t in (vectors, queries))
        own, asked = _matrix(vectors.column("weights"), width), _matrix(queries.column("weights"), width)
        kind = _exact_kind(own, asked)
        own, asked = own.astype(kind), asked.astype(kind)
        cuts, size = [0], FIRST_ROWS
        while cuts[-1] < len(own):
            cuts.append(min(len(own), cuts[-1] + size))
            size *= 8
        parts = [Postings(own[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        coded = pa.chunked_array([*vectors.column("im_id").chunks, *queries.column("im_id").chunks]).combine_chunks().dictionary_encode()
        codes = coded.indices.to_numpy()
        vector_codes, query_codes = codes[: len(own)], codes[len(own) :]
        out_query, out_vector, out_score = [], [], []
        for number, query in enumerate(asked):
            best, scores, floor = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=kind), None
            for start, part in zip(cuts, parts, strict=False):
                at, found = part.above(query, floor)
                at = at + start
                other = vector_codes[at] != query_codes[number]
                best, scores = np.concatenate([best, at[other]]), np.concatenate([scores, found[other]])
                # Places rise with the ids, so a stable order gives ties to the smaller id.
                order = np.argsort(-scores, kind="stable")[:k]
                order = order[np.lexsort((best[order], -scores[order].astype(np.float64)))] if kind is not object else order
                best, scores = best[order], scores[order]
                floor = scores[-1] if len(scores) == k else None
            out_query.append(np.full(len(best), number))
            out_vector.append(best)
            out_score.append(scores)
        at = pa.array(np.concatenate(out_query))
        score = np.array([min(max(int(s), -(1 << 63)), (1 << 63) - 1) for s in np.concatenate(out_score)], dtype=np.int64)
        columns = [
            queries.column("im_id").take(at),
            queries.column("mark").take(at),
            vectors.column("im_id").take(pa.array(np.concatenate(out_vector))),
            pa.array(score),
        ]
        return pa.table(columns, names=names)

    return step


def best_matches(images: DataFrame, queries: DataFrame, k: int = 20, scale: int = 64) -> DataFrame:
    """The ``k`` best inner products of each query's embedding with those of other images.

    ``images`` and ``queries`` are image rows with ``im_id`` (a number or a string) and ``embedding``; the project has no
    embeddings of its own, so any numeric array will do.  A component x becomes floor(``scale`` * x); the score is the
    inner product of these whole numbers, missing components of a shorter vector are 0.

    Vectors are dealt into shards, queries into blocks, and each shard is searched for each block with MaxScore over
    the postings of its dimensions; each shard's best are merged per query.

    One row per query and rank: ``query_id``, ``rank`` (from 1), ``im_id``, ``score``; ties go to the smaller id; fewer
    than ``k`` if there are fewer.  A query never matches rows of its own id.  Vectors that are NULL or hold a NULL or non-finite
    component, and rows with a NULL id, take no part; empty vectors score 0.  Repeated vectors are matches each;
    repeated queries are asked once.  Scores beyond 64 bits stop at the bounds.
    """
    ship(images.sparkSession)
    kind = images.schema["im_id"].dataType.simpleString()
    vectors = images.select("im_id", weights(F.col("embedding"), scale).alias("weights")).dropna()
    asked = queries.select("im_id", weights(F.col("embedding"), scale).alias("weights")).dropna().distinct()
    asked = asked.withColumn("mark", F.xxhash64("weights"))
    n_shards = max(1, -(-vectors.count() // SHARD_ROWS))
    n_blocks = max(1, -(-asked.count() // BLOCK_ROWS))
    shard = F.pmod(F.xxhash64("im_id", F.lit(3)), F.lit(n_shards)).cast("int").alias("shard")
    block = F.pmod(F.xxhash64("im_id", F.lit(5)), F.lit(n_blocks)).cast("int").alias("block")
    every_block = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block")
    every_shard = F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))).alias("shard")
    left = vectors.select("im_id", "weights", shard, every_block)
    right = asked.select("im_id", "weights", "mark", block, every_shard)
    schema = f"query_id {kind}, query_mark bigint, im_id {kind}, score bigint"
    best = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(_shard_best(k), schema)
    rank = F.row_number().over(Window.partitionBy("query_id", "query_mark").orderBy(F.desc("score"), "im_id"))
    ranked = best.withColumn("rank", rank).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "im_id", "score")
