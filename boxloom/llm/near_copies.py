"""Groups of image descriptions that nearly repeat each other."""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boxloom.llm import words as W
from boxloom.llm.components import components
from boxloom.llm.count_tree import FULL, GROUPS, CountTree, small_groups
from boxloom.llm.frames import Batches, described, held_by_several, in_tasks, lists
from boxloom.session import checkpointed

#: A shingle is looked at as frequent from this many rows of a block on.
BLOCK_REPEATS = 3
#: At most this many shingles are ordered last for being frequent, 8 bytes each.
FREQUENT_LIMIT = 100_000
SMALL_GROUP = 32
LEADERS = 16
#: Rows of one shingle are searched in blocks of about this many, never more than twice as many.
BLOCK_ROWS = 16_384
#: Hash groups whose parities bound the overlap of candidate pairs of the second pass.
PARITY_BITS = 10
#: Groups of the finer counts that candidate pairs are bounded by before their sets are compared.
FINE_BITS = 9
#: Ids of compared rows are broadcast up to this many.
BROADCAST_IDS = 200_000


def _shingle_sets(block: W.Block, n_words: int) -> list[np.ndarray]:
    hashes = W.word_hashes(block)
    runs = W.window_hashes(hashes, n_words)
    out = []
    for row in range(block.n_rows):
        low, high = int(block.bounds[row]), int(block.bounds[row + 1])
        if high - low >= n_words:
            out.append(np.unique(runs[low : high - n_words + 1]))
        elif high > low:
            # Shorter rows are one shingle, told apart by its length.
            out.append(W.window_hashes(hashes[low:high], high - low) * np.uint64(2 * (high - low) + 1))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def _frequent_rows(n_words: int):
    def step(batches: Batches) -> Batches:
        for batch in batches:
            for block in W.blocks(batch.column(1), W.BLANKS, lower=True):
                keys, counts = np.unique(np.concatenate(_shingle_sets(block, n_words)), return_counts=True)
                keep = counts >= BLOCK_REPEATS
                yield pa.RecordBatch.from_arrays([pa.array(keys[keep].view(np.int64)), pa.array(counts[keep])], names=["shingle", "n"])

    return step


def _feature_rows(n_words: int, percent: int, frequent):
    def step(batches: Batches) -> Batches:
        last = frequent.value
        for batch in batches:
            sizes, marks, counts, fine, bits, firsts, lengths = [], [], [], [], [], [], []
            for block in W.blocks(batch.column(1), W.BLANKS, lower=True):
                for own in _shingle_sets(block, n_words):
                    n = len(own)
                    sizes.append(n)
                    marks.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if n else None)
                    groups = np.bincount((own >> np.uint64(64 - PARITY_BITS)).astype(np.int64), minlength=1 << PARITY_BITS)
                    bits.append(np.packbits((groups & 1).astype(np.uint8)).tobytes())
                    groups = groups.reshape(1 << FINE_BITS, -1).sum(axis=1)
                    fine.append(np.minimum(groups, FULL).astype(np.uint8).tobytes())
                    groups = groups.reshape(GROUPS, -1).sum(axis=1)
                    counts.append(np.minimum(groups, FULL).astype(np.uint8).tobytes())
                    keep = n - -(-percent * n // 100) + 1 if n else 0
                    if len(last) and n:
                        place = np.minimum(np.searchsorted(last, own), len(last) - 1)
                        late = last[place] == own
                        own = np.concatenate([own[~late], own[late]])
                    firsts.append(own[:keep])
                    lengths.append(keep)
            flat = np.concatenate(firsts) if firsts else np.zeros(0, dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(marks, pa.binary()),
                    pa.array(counts, pa.binary()),
                    pa.array(fine, pa.binary()),
                    pa.array(bits, pa.binary()),
                    lists(flat.view(np.int64), lengths, pa.int64()),
                ],
                names=["im_id", "n_shingles", "mark", "counts", "fine", "bits", "firsts"],
            )

    return step


def _set_rows(n_words: int):
    def step(batches: Batches) -> Batches:
        for batch in batches:
            for block in W.blocks(batch.column(1), W.BLANKS, lower=True):
                sets = _shingle_sets(block, n_words)
                flat = np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)
                ids = batch.column(0).slice(block.first, block.n_rows)
                yield pa.RecordBatch.from_arrays(
                    [ids, lists(flat.view(np.int64), [len(s) for s in sets], pa.int64())], names=["im_id", "shingles"]
                )

    return step


#: Columns that name a group of rows that are searched together.
GROUP = ["shingle", "block", "other"]


def _borders(table: pa.Table) -> np.ndarray:
    """Where groups of sorted rows start."""
    new = np.zeros(table.num_rows, dtype=bool)
    new[:1] = True
    for name in GROUP:
        keys = table.column(name).to_numpy()
        new[1:] |= keys[1:] != keys[:-1]
    return np.flatnonzero(new)


def _groups(batches: Batches):
    """Rows sorted by group, in portions that hold whole groups."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        if not table.num_rows:
            continue
        cut = int(_borders(table)[-1])
        if cut:
            yield table.slice(0, cut).combine_chunks()
        rest = table.slice(cut)
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks()


def _matrix(column: pa.ChunkedArray, kind, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(-1, width)


def _candidate_rows(percent: int, linked: bool):
    """Pairs that the counts don't rule out.

    In the first pass a large group with very many such pairs gives stars only and its shingle, for the second pass, and
    so does every block of a shingle that has several, with its leaders.  In the second pass rows that are linked
    already make no pair, and of two different blocks only rows of one with rows of the other do.
    """

    def step(batches: Batches) -> Batches:
        for table in _groups(batches):
            ids = table.column("im_id").combine_chunks()
            keys, blocks, others = (table.column(c).to_numpy() for c in GROUP)
            sizes = table.column("n_shingles").to_numpy()
            rests = sizes - table.column("place").to_numpy()
            counts = _matrix(table.column("counts"), np.uint8, GROUPS)
            parts = bits = None
            if linked:
                parts = table.column("component").combine_chunks().dictionary_encode().indices.to_numpy()
                bits = _matrix(table.column("bits"), np.uint64, (1 << PARITY_BITS) // 64)
            starts = _borders(table)
            lengths = np.diff(np.concatenate([starts, [len(keys)]]))
            alone = (lengths <= SMALL_GROUP) & (blocks[starts] == WHOLE)
            small = alone & (lengths > 1)

            def out(one, two, ids=ids):
                ends = [ids.take(pa.array(one)), ids.take(pa.array(two))]
                return pa.RecordBatch.from_arrays([*ends, pa.nulls(len(one), pa.int64())], names=["left", "right", "dense"])

            whole = CountTree(sizes, counts, percent, parts, rests, bits) if small.any() else None
            if whole is not None:
                for one, two in small_groups(starts[small], lengths[small], whole):
                    yield out(one, two)
            for start, length in zip(starts[~alone], lengths[~alone], strict=True):
                own = slice(start, start + length)
                sides = None
                if linked and blocks[start] != others[start]:
                    sides = table.column("side").to_numpy()[own]
                tree = CountTree(sizes[own], counts[own], percent, parts[own] if linked else None, rests[own], bits[own] if linked else None, sides)
                if linked:
                    for one, two in tree.pairs():
                        yield out(one + start, two + start)
                    continue
                held, n = [], 0
                for one, two in tree.pairs():
                    held.append((one + start, two + start))
                    n += len(one)
                    if n > 4 * length:
                        break
                split, leaders = blocks[start] != WHOLE, []
                dense = n > 4 * length
                if dense or split:
                    for one, two in tree.stars(LEADERS):
                        leaders.append(int(one[0]) + start)
                        yield out(one + start, two + start)
                if not dense:
                    for one, two in held:
                        yield out(one, two)
                if dense or split:
                    named = leaders if split and leaders else [None]
                    heads = pa.array(named, pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(heads), pa.nulls(len(named), ids.type), pa.array([int(keys[start])] * len(named), pa.int64())],
                        names=["left", "right", "dense"],
                    )

    return step


#: Block of a shingle whose rows are all in one.
WHOLE = -1


def _if_small(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if table.count() <= BROADCAST_IDS else table


def in_blocks(rows: DataFrame, bins: list[str], block_rows: int) -> DataFrame:
    """Rows of each ``shingle`` with a ``block`` of at most about twice ``block_rows`` rows, neighbouring bins together.

    Bins are counted by an aggregate; running totals of the counts tell blocks apart, and a bin that is too large is
    dealt out by a hash.
    """
    sizes = rows.groupBy("shingle", *bins).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("shingle").orderBy(*bins).rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")
    sizes = sizes.select(
        "shingle", *bins, F.floor(before / block_rows).cast("bigint").alias("_band"), F.ceil(F.col("_n") / block_rows).cast("bigint").alias("_deals")
    )
    deal = F.pmod(F.xxhash64("im_id", "counts"), F.col("_deals"))
    block = F.shiftleft(F.col("_band"), 31) + deal
    return rows.join(_if_small(checkpointed(sizes)), ["shingle", *bins]).withColumn("block", block).drop("_band", "_deals")


def first_blocks(shared: DataFrame, block_rows: int) -> tuple[DataFrame, bool]:
    """Rows of each shingle by ``block`` (``WHOLE`` where there is only one), and whether any shingle has several."""
    many = shared.groupBy("shingle").count().filter(F.col("count") > block_rows).select("shingle")
    many = checkpointed(many)
    if many.isEmpty():
        return shared.withColumn("block", F.lit(WHOLE).cast("bigint")), False
    many = _if_small(many)
    few = shared.join(many, "shingle", "left_anti").withColumn("block", F.lit(WHOLE).cast("bigint"))
    split = in_blocks(shared.join(many, "shingle", "left_semi"), ["n_shingles"], block_rows)
    return few.unionByName(split), True


def second_blocks(again: DataFrame, percent: int, block_rows: int) -> DataFrame:
    """Rows of each pair of blocks that may hold a pair of rows not linked yet: ``block``, ``other`` and ``side``.

    ``again`` has ``component``.  Shingles whose rows are all linked are left out; rows of a component that is large
    within a shingle have blocks of their own, so that two blocks of it are never brought together.
    """
    found = again.groupBy("shingle").agg(F.min("component").alias("_low"), F.max("component").alias("_high"), F.count("*").alias("_n"))
    found = checkpointed(found.filter(F.col("_low") < F.col("_high")).select("shingle", "_n"))
    rows = again.join(_if_small(found), "shingle")
    none = [F.lit(WHOLE).cast("bigint").alias(c) for c in ("block", "other")]
    few = rows.filter(F.col("_n") <= block_rows).drop("_n").select("*", *none, F.lit(0).alias("side"))
    if found.filter(F.col("_n") > block_rows).isEmpty():
        return few
    rows = checkpointed(rows.filter(F.col("_n") > block_rows).drop("_n"))
    large = rows.groupBy("shingle", "component").count().filter(F.col("count") >= block_rows // 4)
    large = checkpointed(large.select("shingle", "component", F.xxhash64("component").alias("_part")))
    rows = rows.join(_if_small(large), ["shingle", "component"], "left").withColumn("_part", F.coalesce("_part", F.lit(0).cast("bigint")))
    rows = in_blocks(rows, ["_part", "n_shingles"], block_rows).drop("_part")
    boxes = checkpointed(
        rows.groupBy("shingle", "block").agg(
            F.min("n_shingles").alias("least"), F.max("n_shingles").alias("most"), F.min("component").alias("low"), F.max("component").alias("high")
        )
    )
    two = boxes.select("shingle", *(F.col(c).alias(f"{c}_two") for c in ("block", "least", "most", "low", "high")))
    pairs = boxes.join(two, "shingle").filter(
        (F.col("block") <= F.col("block_two"))
        & (100 * F.col("most") >= percent * F.col("least_two"))
        & (100 * F.col("most_two") >= percent * F.col("least"))
        & ~((F.col("low") == F.col("high")) & (F.col("low_two") == F.col("high_two")) & (F.col("low") == F.col("low_two")))
    )
    pairs = checkpointed(pairs.select("shingle", F.col("block").alias("_one"), F.col("block_two").alias("other")))
    sides = pairs.select("shingle", "_one", "other", F.col("_one").alias("block"), F.lit(0).alias("side"))
    right = pairs.filter(F.col("_one") != F.col("other")).select("shingle", "_one", "other", F.col("other").alias("block"), F.lit(1).alias("side"))
    split = rows.join(sides.unionByName(right), ["shingle", "block"]).drop("block").withColumnRenamed("_one", "block")
    return few.unionByName(split)


def _searched(rows: DataFrame, percent: int, linked: bool, kind: str) -> DataFrame:
    """Candidate pairs of each group."""
    own = ["im_id", "n_shingles", "place", "counts", *(["component", "bits", "side"] if linked else [])]
    rows = rows.select(*own, *GROUP).repartition(*GROUP).sortWithinPartitions(*GROUP)
    return in_tasks(rows, _candidate_rows(percent, linked), f"left {kind}, right {kind}, dense bigint")


def _bounded_pairs(percent: int):
    """Pairs that the finer counts don't rule out."""

    def step(batches: Batches) -> Batches:
        for batch in batches:
            own, other = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint8) for c in (4, 5))
            own, other = own.reshape(-1, 1 << FINE_BITS), other.reshape(-1, 1 << FINE_BITS)
            bound = np.minimum(own, other).sum(axis=1, dtype=np.int64)
            total = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            keep = ((100 + percent) * bound >= percent * total) | (own == FULL).any(axis=1) | (other == FULL).any(axis=1)
            yield batch.select([0, 1]).filter(pa.array(keep))

    return step


def _verified(pairs: DataFrame, points: DataFrame, texts: DataFrame, kind: str, n_words: int, percent: int) -> DataFrame:
    """Pairs whose shingle sets reach the similarity."""
    pairs = pairs.select(F.least("left", "right").alias("left"), F.greatest("left", "right").alias("right"))
    pairs = pairs.filter(F.col("left") != F.col("right")).distinct()
    one = points.select(F.col("im_id").alias("left"), F.col("n_shingles").alias("n_left"), F.col("fine").alias("fine_left"))
    two = points.select(F.col("im_id").alias("right"), F.col("n_shingles").alias("n_right"), F.col("fine").alias("fine_right"))
    both = pairs.join(one, "left").join(two, "right").select("left", "right", "n_left", "n_right", "fine_left", "fine_right")
    pairs = checkpointed(in_tasks(both, _bounded_pairs(percent), f"left {kind}, right {kind}").distinct())
    ids = pairs.select(F.col("left").alias("im_id")).unionByName(pairs.select(F.col("right").alias("im_id"))).distinct()
    ids = checkpointed(ids)
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    sets = checkpointed(in_tasks(texts.join(ids, "im_id", "left_semi"), _set_rows(n_words), f"im_id {kind}, shingles array<bigint>"))
    one = sets.select(F.col("im_id").alias("left"), F.col("shingles").alias("one"))
    two = sets.select(F.col("im_id").alias("right"), F.col("shingles").alias("two"))
    both = F.size(F.array_intersect("one", "two"))
    fits = (100 + percent) * both >= percent * (F.size("one") + F.size("two"))
    return checkpointed(pairs.join(one, "left").join(two, "right").filter(fits).select("left", "right").distinct())


def near_copy_groups(images: DataFrame, n_words: int = 5, percent: int = 80, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Descriptions joined into groups by the Jaccard similarity of their word shingles.

    ``images`` are image rows with ``im_id`` (of any ordered type) and ``im_description``.  A-Z are lower-cased, words
    are runs without ASCII white space; a row's set are its distinct shingles of ``n_words`` words, or the whole
    sequence of a shorter row.  Rows link when ``100 * |intersection| >= percent * |union|``.

    Method: equal sets become one row first.  A set's shingles are hashed into 64 groups; the group counts are its
    point.  Rows that share one of their first shingles (in an order of all shingles, frequent ones last; similar sets must
    share one) are searched through an R-tree over the points, where the sum of the smaller counts bounds the overlap.
    Pairs left are compared by their sets.  Groups of rows that are nearly all alike are linked through a few leaders,
    and pairs not linked by then are compared in a second pass, so no link between groups is lost.  A shingle of more than
    ``block_rows`` rows is searched in blocks of neighbouring set sizes, in the second pass block against block; the
    leaders of its blocks are compared with each other first.

    One row per input row: ``im_id``, ``n_shingles``, ``component`` (least id reached by links, its own included).
    NULL and empty texts have no shingle and link with nothing; rows with a NULL id have a NULL component and link
    with nothing; rows of one id are one image, linked by any of their texts.
    """
    kind = images.schema["im_id"].dataType.simpleString()
    rows = described(images)
    context = images.sparkSession.sparkContext
    counted = in_tasks(rows, _frequent_rows(n_words), "shingle bigint, n bigint").groupBy("shingle").agg(F.sum("n").alias("n"))
    counted = checkpointed(counted.filter(F.col("n") >= 100))
    total = counted.agg(F.sum("n")).first()[0] or 0
    # At most total / least rows reach the least count.
    least = max(1000, -(-total // FREQUENT_LIMIT))
    frequent = np.array(sorted(r[0] for r in counted.filter(F.col("n") >= least).select("shingle").collect()), dtype=np.int64)
    frequent = context.broadcast(np.sort(frequent.view(np.uint64)))

    schema = f"im_id {kind}, n_shingles bigint, mark binary, counts binary, fine binary, bits binary, firsts array<bigint>"
    features = checkpointed(in_tasks(rows, _feature_rows(n_words, percent, frequent), schema))
    named = features.filter(F.col("im_id").isNotNull() & F.col("mark").isNotNull())
    classes = checkpointed(named.groupBy("mark").agg(F.min("im_id").alias("first_id")))
    firsts = named.join(classes, "mark").filter(F.col("im_id") == F.col("first_id"))

    keys = firsts.select("im_id", "n_shingles", F.posexplode("firsts").alias("place", "shingle"))
    # Equal ids with several texts give several points; those of one size are each taken at all places of that size.
    points = firsts.select("im_id", "n_shingles", "mark", "counts").distinct().drop("mark")
    fine = firsts.select("im_id", "n_shingles", "fine")
    shared = checkpointed(held_by_several(keys, ["shingle"]).distinct().join(points, ["im_id", "n_shingles"]))
    blocked, split = first_blocks(shared, block_rows)
    candidates = checkpointed(_searched(blocked.withColumn("other", F.col("block")), percent, False, kind))
    linkable = candidates.filter(F.col("right").isNotNull())
    dense = checkpointed(candidates.filter(F.col("dense").isNotNull()).select(F.col("dense").alias("shingle")).distinct())
    leaders = candidates.filter(F.col("dense").isNotNull() & F.col("left").isNotNull())
    while split:
        heads = shared.join(leaders.select(F.col("left").alias("im_id"), F.col("dense").alias("shingle")).distinct(), ["im_id", "shingle"], "left_semi")
        blocked, split = first_blocks(checkpointed(heads), block_rows)
        candidates = checkpointed(_searched(blocked.withColumn("other", F.col("block")), percent, False, kind))
        linkable = linkable.unionByName(candidates.filter(F.col("right").isNotNull()))
        leaders = candidates.filter(F.col("dense").isNotNull() & F.col("left").isNotNull())
    links = _verified(linkable, fine, rows, kind, n_words, percent)
    groups = components(links)

    again = shared.join(_if_small(dense), "shingle").join(groups, "im_id", "left")
    again = again.withColumn("component", F.coalesce("component", "im_id"))
    bits = firsts.select("im_id", "n_shingles", "mark", "counts", "bits").distinct().drop("mark")
    again = second_blocks(again, percent, block_rows).join(bits, ["im_id", "n_shingles", "counts"])
    again = _searched(again, percent, True, kind)
    more = _verified(again, fine, rows, kind, n_words, percent)
    if not more.isEmpty():
        groups = components(reduce(DataFrame.unionByName, [links, more]))

    own = groups.select(F.col("im_id").alias("first_id"), "component")
    classes = classes.join(own, "first_id", "left").select("mark", F.coalesce("component", "first_id").alias("component"))
    judged = features.select("im_id", "n_shingles", F.when(F.col("im_id").isNotNull(), F.col("mark")).alias("mark"))
    joined = judged.join(classes, "mark", "left")
    return joined.select("im_id", "n_shingles", F.when(F.col("im_id").isNotNull(), F.coalesce("component", "im_id")).alias("component"))
