"""Nodes of the prefix trie against a plain form; chunks of a few rows cut conversations everywhere."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from boxloom.llm import conversation_trie
from boxloom.llm.conversation_trie import conversation_nodes
from boxloom.llm.slot_table import PRIME, SlotTable, minus, powers, running, times

TURNS = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain_nodes(turns, ids=()):
    seqs = {i: [] for i in ids if i is not None}
    for conv, turn, role, text in sorted((r for r in turns if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        seqs.setdefault(conv, []).append((role or "", text or ""))
    members = {}
    for conv, seq in seqs.items():
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(conv)
    rows, inner = [], {k[:-1] for k in members if k}
    for node, convs in members.items():
        below = [k for k in members if k[: len(node)] == node]
        children = [k for k in below if len(k) == len(node) + 1]
        leaves = [k for k in below if k not in inner]
        saved = sum((len(members[k]) - 1) * len(k[-1][1].encode()) for k in below if k)
        ends = ",".join(map(str, sorted(c for c in convs if len(seqs[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        rows.append((min(convs), len(node), parent, len(convs), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=lambda r: r[:2])


def found(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()), key=lambda r: r[:2])


def dialogues(seed, n):
    chance, rows = random.Random(seed), []
    for conv in range(n):
        for turn in range(chance.randint(0, 6)):
            rows.append((conv, turn, chance.choice(["user", "assistant"]), chance.choice(["a", "bé", ""])))
    return rows


@pytest.mark.parametrize("chunk_rows", [1, 3, 7, 1 << 17])
def test_against_plain_form(spark, chunk_rows):
    rows = dialogues(chunk_rows, 60)
    rows += [(100, t, "user", f"t{t}") for t in range(40)] + [(101, t, "user", f"t{t}") for t in range(40)]
    rows += [(102, t, "user", f"t{t}" if t < 25 else "other") for t in range(60)] + [(-7, t, "user", f"t{t}") for t in range(33)]
    turns = spark.createDataFrame(rows, TURNS).repartition(5)
    assert found(conversation_nodes(turns, chunk_rows=chunk_rows)) == plain_nodes(rows)


def test_conversation_over_many_tasks(spark):
    rows = [(5, t, "user", f"t{t}") for t in range(900)] + [(6, t, "user", f"t{t}") for t in range(450)] + [(9, 0, "user", "t0")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = found(conversation_nodes(spark.createDataFrame(rows, TURNS), chunk_rows=64))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == plain_nodes(rows)


def test_odd_rows(spark):
    rows = [
        (1, None, None, None), (1, 2, "user", "x" * 300_000), (1, 2, "user", "x" * 300_000), (2, 0, "", ""), (2, 5, "user", "x" * 300_000),
        (None, 0, "user", "left out"), (3, 1, "us", "er"), (4, 1, "user", ""), (7, 1, "use", "r"),
    ]
    turns = spark.createDataFrame(rows, TURNS).select("*", F.lit("x").alias("depth"), F.lit("x").alias("p1"), F.lit("x").alias("chunk"))
    ids = spark.createDataFrame([(8,), (8,), (None,), (1,)], "conv_id bigint")
    assert found(conversation_nodes(turns, ids)) == plain_nodes(rows, [8])


def test_no_rows(spark):
    none = spark.createDataFrame([], TURNS)
    assert found(conversation_nodes(none)) == []
    assert found(conversation_nodes(none, spark.createDataFrame([(4,), (2,)], "conv_id bigint"))) == plain_nodes([], [2, 4])


def test_clashing_digests_are_taken_anew(spark, monkeypatch):
    """With the base 1 a prefix's digest forgets the order of its turns."""
    bases = conversation_trie._bases
    monkeypatch.setattr(conversation_trie, "_bases", lambda seed: (1, 1) if seed == 0 else bases(seed))
    rows = [(1, 0, "a", "x"), (1, 1, "a", "y"), (2, 0, "a", "y"), (2, 1, "a", "x")]
    assert found(conversation_nodes(spark.createDataFrame(rows, TURNS))) == plain_nodes(rows)


def test_slots_and_arithmetic():
    chance = random.Random(3)
    a, b = ([chance.randrange(PRIME) for _ in range(5000)] for _ in range(2))
    one, two = np.array(a, np.uint64), np.array(b, np.uint64)
    assert times(one, two).tolist() == [x * y % PRIME for x, y in zip(a, b)]
    assert minus(one, two).tolist() == [(x - y) % PRIME for x, y in zip(a, b)]
    assert powers(12345, one[:50] % np.uint64(10**6)).tolist() == [pow(12345, x % 10**6, PRIME) for x in a[:50]]
    assert running(one).tolist() == [sum(a[: i + 1]) % PRIME for i in range(len(a))]
    slots = SlotTable(one, two)
    at = slots.find(one, two)
    assert sorted(at) == list(range(5000)) and (slots.first[at] == one).all()
    assert (slots.find(two, one) == -1).all() and len(SlotTable(one[:0], two[:0])) == 0
