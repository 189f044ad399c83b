"""Prefix trie of conversations, as a table of its nodes.

The project itself keeps no conversations, so the operator is general: it takes rows of ``conv_id``, ``turn``, ``role``
and ``text``.  A node is a distinct sequence of first turns; its digest is a polynomial of the turns' hashes modulo a prime,
so the digests of a conversation that several tasks hold are joined by arithmetic.

Sorted turns are cut into chunks of ``chunk_rows`` rows.  Each chunk is a shard: its distinct digests get slots of a minimal
perfect hash, counts are scattered into flat arrays by slot, and sums go up through the array of parent slots, deepest
nodes first.  Equal digests of different chunks are merged by an aggregate.  A chunk that begins inside a conversation
sends the sum of its top node to the earlier chunks of that conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from boxloom.llm.frames import Batches, in_tasks, ship
from boxloom.llm.slot_table import PRIME, SlotTable, minus, plus, powers, running, times
from boxloom.session import checkpointed

CHUNK_ROWS = 1 << 17
_BASES = (0x1B873593CC9E2D51, 0x05EB2F165667B19E)
_TURNS = (
    "conv_id bigint, kind int, m1 bigint, m2 bigint, n_bytes bigint, part int, row bigint, chunk bigint, "
    "depth bigint, p1 bigint, p2 bigint, last boolean"
)
_NODES = (
    "part int, chunk bigint, slot bigint, parent_slot bigint, depth bigint, p1 bigint, p2 bigint, q1 bigint, q2 bigint, m1 bigint, "
    "m2 bigint, n_bytes bigint, n bigint, n_ends bigint, least bigint, ends string, clash boolean"
)
_SUMS = (
    "part int, chunk bigint, p1 bigint, p2 bigint, q1 bigint, q2 bigint, parent_conv_id bigint, n_children bigint, n_leaves bigint, "
    "saved_tokens bigint, orphan boolean, owned boolean"
)
_CARRIED = "p1 bigint, p2 bigint, n_leaves bigint, saved_tokens bigint"
_START, _TURN, _EDGE = 0, 1, 2


def _bases(seed: int) -> tuple[int, int]:
    return tuple((b * (2 * seed + 1) + seed) % PRIME for b in _BASES)


def _np(table, *names: str) -> list[np.ndarray]:
    return [table.column(n).to_numpy(zero_copy_only=False) if isinstance(table, pa.RecordBatch) else table[n].to_numpy() for n in names]


def _marked(turns: DataFrame, conversations: DataFrame | None) -> DataFrame:
    """Narrow rows: a hash of role and text for each turn, and one starting row for each conversation."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
    rows = rows.filter(F.col("conv_id").isNotNull())
    digest = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256)
    marks = [F.conv(F.substring(digest, at, 15), 16, 10).cast("bigint") for at in (1, 16)]
    marked = rows.select("conv_id", F.lit(_TURN).alias("kind"), "turn", marks[0].alias("m1"), marks[1].alias("m2"), F.octet_length("text").cast("bigint").alias("n_bytes"))
    ids = rows.select("conv_id")
    if conversations is not None:
        ids = ids.unionByName(conversations.select(F.col("conv_id").cast("bigint").alias("conv_id")).filter(F.col("conv_id").isNotNull()))
    zero = F.lit(0).cast("bigint")
    starts = ids.distinct().select(
        "conv_id", F.lit(_START).alias("kind"), F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"), zero.alias("m1"), zero.alias("m2"), zero.alias("n_bytes")
    )
    return marked.unionByName(starts)


def _digests(bases: tuple[int, int], chunk_rows: int):
    """Steps over sorted turns: each row's chunk, and its depth and digest counted from the task's first row of it."""

    def step(batches: Batches) -> Batches:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        done, conv, depth, sums, first = 0, None, 0, [0, 0], True
        held: pa.Table | None = None

        def edge() -> pa.RecordBatch:
            row = [[conv], [_EDGE], [0], [0], [0], [part], [done], [0], [depth], [sums[0]], [sums[1]], [True]]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], names)

        names = [c.split()[0] for c in _TURNS.split(", ")]
        types = [{"bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}[c.split()[1]] for c in _TURNS.split(", ")]

        def written(rows: pa.Table, closed: bool) -> Iterator[pa.RecordBatch]:
            nonlocal done, conv, depth, sums, first
            ids, kind, m1, m2, n_bytes = _np(rows, "conv_id", "kind", "m1", "m2", "n_bytes")
            changes = np.flatnonzero(np.concatenate([[conv is None or ids[0] != conv], ids[1:] != ids[:-1]]))
            begins = np.zeros(len(ids), np.int64)
            begins[changes] = changes
            begins = np.maximum.accumulate(begins)
            carried = conv is not None and ids[0] == conv
            go = np.zeros(len(ids), bool)
            if carried:
                go[: changes[0] if len(changes) else len(ids)] = True
            turns = np.cumsum(kind)
            at = turns - (turns - kind)[begins] + np.where(go, depth, 0)
            prefix = []
            for mark, base, before in zip((m1, m2), bases, sums):
                value = np.where(kind == _TURN, times(mark.astype(np.uint64) + np.uint64(1), powers(base, at)), np.uint64(0))
                total = running(value)
                inside = minus(total, minus(total, value)[begins])
                prefix.append(np.where(go, plus(inside, np.uint64(before)), inside))
            if first and conv is not None and len(changes):
                # The task's first conversation ends here; its totals matter when it began in an earlier task.
                stop = changes[0]
                if stop:
                    depth, sums = int(at[stop - 1]), [int(p[stop - 1]) for p in prefix]
                yield edge()
                first = False
            elif first and conv is None and len(changes) > 1:
                conv, depth, sums = int(ids[0]), int(at[changes[1] - 1]), [int(p[changes[1] - 1]) for p in prefix]
                yield edge()
                first = False
            last = np.concatenate([ids[1:] != ids[:-1], [closed]])
            number = done + np.arange(len(ids))
            columns = [ids, kind, m1, m2, n_bytes, np.full(len(ids), part), number, number // chunk_rows, at, prefix[0].astype(np.int64), prefix[1].astype(np.int64), last]
            done += len(ids)
            conv, depth, sums = int(ids[-1]), int(at[-1]), [int(p[-1]) for p in prefix]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, types)], names)

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            if rows.num_rows < 2:
                held = rows
                continue
            # Whether a row is its conversation's last shows in the next row: the last one waits.
            ids = rows["conv_id"].to_numpy()
            held = rows.slice(rows.num_rows - 1)
            yield from written(rows.slice(0, rows.num_rows - 1), bool(ids[-1] != ids[-2]))
        if held is not None and held.num_rows:
            yield from written(held, True)
            yield edge()

    return step


def _spans(turns: DataFrame, bases: tuple[int, int]) -> DataFrame:
    """What precedes each piece of a conversation that several tasks hold; at most two rows a task."""
    edges = turns.filter(F.col("kind") == _EDGE).select("part", "row", "conv_id", "depth", "p1", "p2").distinct().collect()
    pieces: dict[int, dict[int, tuple]] = {}
    for r in sorted(edges):
        pieces.setdefault(r["conv_id"], {})[r["part"]] = (r["depth"], r["p1"], r["p2"])
    rows = []
    for conv, held in pieces.items():
        before = (0, 0, 0)
        for i, part in enumerate(sorted(held)):
            if len(held) > 1:
                rows.append((part, conv, *before, i + 1 < len(held)))
            depth, sums = held[part][0], held[part][1:]
            shifted = [(b + s * pow(base, before[0], PRIME)) % PRIME for b, s, base in zip(before[1:], sums, bases)]
            before = (before[0] + depth, *shifted)
    kinds = "part int, conv_id bigint, before bigint, b1 bigint, b2 bigint, goes_on boolean"
    return turns.sparkSession.createDataFrame(rows, kinds)


def _full_digests(rows, bases: tuple[int, int]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Depth, digest and parent's digest of rows, with what precedes their piece."""
    kind, m1, m2, depth, p1, p2, before, b1, b2 = _np(rows, "kind", "m1", "m2", "depth", "p1", "p2", "before", "b1", "b2")
    full = depth + before
    own, parent = [], []
    for mark, prefix, base, ahead in zip((m1, m2), (p1, p2), bases, (b1, b2)):
        digest = plus(times(prefix.astype(np.uint64), powers(base, before)), ahead.astype(np.uint64))
        value = np.where(kind == _TURN, times(mark.astype(np.uint64) + np.uint64(1), powers(base, full)), np.uint64(0))
        own.append(digest)
        parent.append(minus(digest, value))
    return full, own, parent


def _chunk_nodes(bases: tuple[int, int]):
    """The node table of one chunk: slots, parent slots and scattered counts."""

    def nodes(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("row")
        ids, kind, m1, m2, n_bytes, last = _np(rows, "conv_id", "kind", "m1", "m2", "n_bytes", "last")
        depth, (d1, d2), (q1, q2) = _full_digests(rows, bases)
        order = np.lexsort((d2, d1))
        new = np.concatenate([[True], (d1[order][1:] != d1[order][:-1]) | (d2[order][1:] != d2[order][:-1])])
        slots = SlotTable(d1[order][new], d2[order][new])
        n, at = len(slots), slots.find(d1, d2)
        one = np.empty(n, np.int64)
        one[at] = np.arange(len(at))
        clash = np.zeros(n, bool)
        for seen in (depth, m1, m2, q1, q2):
            np.logical_or.at(clash, at, seen[one][at] != seen)
        least = np.full(n, np.iinfo(np.int64).max)
        np.minimum.at(least, at, ids)
        parent = np.where(depth[one] > 0, slots.find(q1[one], q2[one]), -1)
        ended = np.flatnonzero(last)
        ended = ended[np.argsort(at[ended], kind="stable")]
        texts: list[str | None] = [None] * n
        bounds = np.flatnonzero(np.concatenate([[True], at[ended][1:] != at[ended][:-1]])) if len(ended) else np.empty(0, np.int64)
        for some in np.split(ended, bounds[1:]) if len(ended) else []:
            texts[at[some[0]]] = ",".join(map(str, ids[some].tolist()))
        part, chunk = rows["part"][0].as_py(), rows["chunk"][0].as_py()
        columns = [
            np.full(n, part), np.full(n, chunk), np.arange(n), parent, depth[one], slots.first, slots.second, q1[one], q2[one], m1[one], m2[one],
            n_bytes[one], np.bincount(at, minlength=n), np.bincount(at[last], minlength=n), least,
        ]
        arrays = [pa.array(c.astype(np.int64)) for c in columns] + [pa.array(texts, pa.string()), pa.array(clash)]
        arrays[0] = arrays[0].cast(pa.int32())
        return pa.Table.from_arrays(arrays, names=[c.split()[0] for c in _NODES.split(", ")])

    return nodes


def _chunk_sums(rows: pa.Table) -> pa.Table:
    """Sums over the subtrees inside one chunk, through the parent slots, deepest nodes first."""
    rows = rows.sort_by("slot")
    parent, depth, n_bytes, least, owner, members, all_ends = _np(rows, "parent_slot", "depth", "n_bytes", "least", "owner", "n_convs", "all_ends")
    # Each node counts once, in the chunk of its smallest member.
    owned = least == owner
    leaves = (owned & (members == all_ends)).astype(np.int64)
    saved = np.where(owned, (members - 1) * n_bytes, 0)
    children = np.zeros(len(parent), np.int64)
    child = owned & (parent >= 0)
    np.add.at(children, parent[child], 1)
    order = np.argsort(-depth, kind="stable")
    levels = np.flatnonzero(np.concatenate([[True], np.diff(depth[order]) != 0]))
    for level in np.split(order, levels[1:]):
        level = level[parent[level] >= 0]
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
    orphan = (parent < 0) & (depth > 0)
    above = np.where(child, owner[np.maximum(parent, 0)], 0)
    used = (leaves != 0) | (saved != 0) | (children != 0) | owned
    names = ["part", "chunk", "p1", "p2", "q1", "q2"]
    arrays = [rows[c].combine_chunks() for c in names]
    arrays += [pa.array(above, pa.int64(), mask=~child), pa.array(children), pa.array(leaves), pa.array(saved), pa.array(orphan), pa.array(owned)]
    out = pa.Table.from_arrays(arrays, names=[c.split()[0] for c in _SUMS.split(", ")])
    return out.filter(pa.array(used))


def _carried_rows(bases: tuple[int, int]):
    def step(batches: Batches) -> Batches:
        for batch in batches:
            _, (d1, d2), _ = _full_digests(batch, bases)
            arrays = [pa.array(d1.astype(np.int64)), pa.array(d2.astype(np.int64)), batch.column("n_leaves"), batch.column("saved_tokens")]
            yield pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in _CARRIED.split(", ")])

    return step


def _hashed_ends(batches: Batches) -> Batches:
    """SHA-256 of the joined texts of each digest; rows come sorted by digest, part and chunk."""
    key, state, out = None, None, []

    def flushed() -> pa.RecordBatch:
        arrays = [pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()), pa.array([r[2] for r in out], pa.string())]
        return pa.RecordBatch.from_arrays(arrays, names=["p1", "p2", "ends_sha256"])

    for batch in batches:
        for p1, p2, text in zip(*[batch.column(c).to_pylist() for c in ("p1", "p2", "ends")]):
            if key == (p1, p2):
                state.update(b"," + text.encode())
                continue
            if key is not None:
                out.append((*key, state.hexdigest()))
            key, state = (p1, p2), hashlib.sha256(text.encode())
        if len(out) > 10_000:
            yield flushed()
            out.clear()
    if key is not None:
        out.append((*key, state.hexdigest()))
    if out:
        yield flushed()


def conversation_nodes(turns: DataFrame, conversations: DataFrame | None = None, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Nodes of the prefix trie of ``turns`` (``conv_id``, ``turn``, ``role``, ``text``; further columns take no part).

    One row per distinct sequence of first turns, also the empty one: ``conv_id`` its smallest member, ``depth``,
    ``parent_conv_id`` (NULL for the root), ``n_convs`` members, ``n_children``, ``n_leaves`` childless nodes and
    ``saved_tokens``, members beyond the first times UTF-8 bytes of the last text, both summed over the subtree with its
    top, and ``ends_sha256`` of the ascending comma-joined ids of the members that end there.

    Turns go by ``turn``, NULL first, equal ones by a hash of role and text; repeated rows are turns of their own.  NULL role or text is
    empty.  Rows without ``conv_id`` take no part.  ``conversations`` may add ids without turns, which end at the root.  Without any
    conversation there is no node, not even the root.  One conversation may hold most rows, and any number may be equal.
    """
    spark = turns.sparkSession
    ship(spark)
    by = [F.col("conv_id"), F.col("kind"), F.col("turn").asc_nulls_first(), F.col("m1"), F.col("m2")]
    ranged = _marked(turns, conversations).repartitionByRange(*by).sortWithinPartitions(*by).drop("turn")
    seed = 0
    while True:
        bases = _bases(seed)
        rows = checkpointed(in_tasks(ranged, _digests(bases, chunk_rows), _TURNS))
        spans = _spans(rows, bases)
        some = F.coalesce
        zero = F.lit(0).cast("bigint")
        whole = rows.filter(F.col("kind") != _EDGE).join(F.broadcast(spans), ["part", "conv_id"], "left")
        whole = whole.select(
            "conv_id", "kind", "m1", "m2", "n_bytes", "part", "row", "chunk", "depth", "p1", "p2",
            (F.col("last") & ~some("goes_on", F.lit(False))).alias("last"),
            *[some(c, zero).alias(c) for c in ("before", "b1", "b2")],
        )
        local = checkpointed(whole.groupBy("part", "chunk").applyInArrow(_chunk_nodes(bases), _NODES))
        seen = F.struct("depth", "q1", "q2", "m1", "m2", "n_bytes")
        nodes = local.groupBy("p1", "p2").agg(
            F.sum("n").alias("n_convs"), F.sum("n_ends").alias("all_ends"), F.min("least").alias("owner"), F.min("depth").alias("depth"),
            ((F.min(seen) != F.max(seen)) | F.bool_or("clash")).alias("clash"),
        )
        nodes = checkpointed(nodes)
        if nodes.filter("clash").isEmpty():
            break
        # Two different prefixes with one digest: all digests are taken anew by other bases.
        seed += 1
    known = local.join(nodes.select("p1", "p2", "n_convs", "all_ends", "owner"), ["p1", "p2"])
    sums = checkpointed(known.groupBy("part", "chunk").applyInArrow(_chunk_sums, _SUMS))

    # At most one node a chunk has its parent in another chunk: that of the conversation the chunk begins in.
    orphans = checkpointed(sums.filter("orphan"))
    begins = rows.filter((F.col("kind") != _EDGE) & (F.col("row") % chunk_rows == 0)).select("part", "chunk", "conv_id")
    cut = orphans.filter((F.col("n_leaves") != 0) | (F.col("saved_tokens") != 0)).join(begins, ["part", "chunk"])
    pieces = rows.filter(F.col("kind") != _EDGE).join(cut.select("conv_id").distinct(), "conv_id", "left_semi")
    pieces = pieces.groupBy("conv_id", "part", "chunk").agg(F.count(F.lit(1)).alias("n"))
    after = W.partitionBy("conv_id").orderBy("part", "chunk").rowsBetween(1, W.unboundedFollowing)
    sent = pieces.join(cut.select("conv_id", "part", "chunk", "n_leaves", "saved_tokens"), ["conv_id", "part", "chunk"], "left")
    sent = sent.select("conv_id", "part", "chunk", *[F.coalesce(F.sum(c).over(after), F.lit(0)).cast("bigint").alias(c) for c in ("n_leaves", "saved_tokens")])
    sent = sent.filter((F.col("n_leaves") != 0) | (F.col("saved_tokens") != 0))
    carried = in_tasks(whole.join(sent, ["conv_id", "part", "chunk"]), _carried_rows(bases), _CARRIED)

    none = F.lit(None).cast("bigint")
    kids = orphans.filter("owned")
    above = kids.join(nodes.select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("owner").alias("above")), ["q1", "q2"])
    columns = ["p1", "p2", "parent_conv_id", "n_children", "n_leaves", "saved_tokens"]
    parts = [
        sums.select(*columns),
        carried.select("p1", "p2", none.alias("parent_conv_id"), zero.alias("n_children"), "n_leaves", "saved_tokens"),
        kids.select(F.col("q1").alias("p1"), F.col("q2").alias("p2"), none.alias("parent_conv_id"), F.lit(1).cast("bigint").alias("n_children"), zero.alias("n_leaves"), zero.alias("saved_tokens")),
        above.select("p1", "p2", F.col("above").alias("parent_conv_id"), zero.alias("n_children"), zero.alias("n_leaves"), zero.alias("saved_tokens")),
    ]
    whole_sums = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    whole_sums = whole_sums.groupBy("p1", "p2").agg(F.max("parent_conv_id").alias("parent_conv_id"), *[F.sum(c).alias(c) for c in columns[3:]])

    ends = local.filter(F.col("ends").isNotNull()).select("p1", "p2", "part", "chunk", "ends")
    ends = in_tasks(ends.repartition("p1", "p2").sortWithinPartitions("p1", "p2", "part", "chunk"), _hashed_ends, "p1 bigint, p2 bigint, ends_sha256 string")
    out = nodes.join(whole_sums, ["p1", "p2"]).join(ends, ["p1", "p2"], "left")
    return out.select(
        F.col("owner").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
