import random

import pytest
from tests.llm import plain

from boxloom.llm.decontamination import held_out_hits
from boxloom.llm.near_copies import first_blocks, near_copy_groups, second_blocks
from boxloom.llm.substrings import without_repeats


def by_text(rows):
    return sorted(rows, key=str)


def test_repeats(image_rows, odd_rows):
    got = without_repeats(image_rows(odd_rows)).select("im_id", "n_words", "n_removed", "kept_description").collect()
    assert by_text(map(tuple, got)) == by_text(plain.repeats(odd_rows))


def test_repeat_intervals_are_maximal(image_rows):
    text = " ".join(f"p{n}" for n in range(20))
    rows = [(1, text), (2, "a b " + text + " c"), (3, text + " " + text)]
    got = {r.im_id: r.intervals for r in without_repeats(image_rows(rows)).collect()}
    assert got == {1: [], 2: [[2, 22]], 3: [[0, 40]]}


def test_repeats_with_string_ids_and_no_rows(image_rows):
    rows = [("b", "x " * 20), ("a", "x " * 13), ("c", "short")]
    got = without_repeats(image_rows(rows, "string")).select("im_id", "n_words", "n_removed", "kept_description").collect()
    assert by_text(map(tuple, got)) == by_text(plain.repeats(rows))
    assert without_repeats(image_rows([])).count() == 0


@pytest.mark.parametrize("block", [1 << 20, 100])
def test_contamination(image_rows, odd_rows, block):
    passage = " ".join(f"passage{n}" for n in range(40))
    items = [(1, passage), (2, "Word"), (3, None), (4, ""), (5, "w1 w2"), (None, "passage1 passage2 passage3"), (7, "??"), (1, "É naïve")]
    got = held_out_hits(image_rows(odd_rows), image_rows(items), most_windows=block).collect()
    got = [(r.im_id, r.n_words, r.n_hit, tuple(r.found), r.contaminated) for r in got]
    assert by_text(got) == by_text(plain.contamination(odd_rows, items))


def test_contamination_of_empty_tables(image_rows):
    assert held_out_hits(image_rows([]), image_rows([(1, "a")])).count() == 0
    row = held_out_hits(image_rows([(1, "a b")]), image_rows([]), keep_text=True).first()
    assert (row.im_description, row.n_words, row.n_hit, row.contaminated, row.starts, row.found) == ("a b", 2, 0, False, [], [])


def test_groups(image_rows, odd_rows):
    got = near_copy_groups(image_rows(odd_rows)).select("im_id", "n_shingles", "component").collect()
    assert by_text(map(tuple, got)) == by_text(plain.groups(odd_rows))


def test_groups_of_many_near_copies(image_rows):
    """Enough copies that the leaders' pass and the pass after it are both needed."""
    chance = random.Random(3)
    words = [f"w{n}" for n in range(500)]
    rows = []
    for family in range(3):
        origin = [chance.choice(words) for _ in range(120)]
        for _ in range(90):
            copy = list(origin)
            for _ in range(chance.randrange(5)):
                copy[chance.randrange(len(copy))] = f"n{chance.randrange(10**6)}"
            rows.append((len(rows) * 7 % 1000 + family, " ".join(copy)))
    shared = " ".join(f"s{n}" for n in range(60))
    rows += [(5000 + n, shared + " " + " ".join(chance.choice(words) for _ in range(80))) for n in range(60)]
    rows = list({i: (i, t) for i, t in rows}.values())
    got = near_copy_groups(image_rows(rows)).select("im_id", "n_shingles", "component").collect()
    assert by_text(map(tuple, got)) == by_text(plain.groups(rows))


@pytest.mark.parametrize("block_rows", [8, 40])
def test_groups_in_blocks(image_rows, block_rows):
    """Shingles of more rows than a block: near copies, and texts that share most of a template but do not link."""
    chance = random.Random(8)
    words = [f"w{n}" for n in range(500)]
    rows = []
    for family in range(2):
        origin = [chance.choice(words) for _ in range(120)]
        for _ in range(120):
            copy = list(origin)
            for _ in range(chance.randrange(6)):
                copy[chance.randrange(len(copy))] = f"n{chance.randrange(10**6)}"
            rows.append((len(rows), " ".join(copy[: chance.randrange(110, 121)])))
    template = " ".join(f"s{n}" for n in range(110))
    rows += [(5000 + n, template + " " + " ".join(chance.choice(words) for _ in range(30))) for n in range(100)]
    got = near_copy_groups(image_rows(rows), block_rows=block_rows).select("im_id", "n_shingles", "component").collect()
    assert by_text(map(tuple, got)) == by_text(plain.groups(rows))


def test_blocks_of_one_shingle(spark):
    """No task is given more than a few blocks of a shingle that all rows share, and all pairs not linked stay together."""
    from pyspark.sql import functions as F

    shared = spark.range(1000).select(
        F.col("id").alias("im_id"),
        F.lit(7).cast("bigint").alias("shingle"),
        (100 + F.col("id") % 3).alias("n_shingles"),
        F.lit(0).alias("place"),
        F.col("id").cast("string").cast("binary").alias("counts"),
        F.when(F.col("id") < 700, 0).otherwise(F.col("id")).alias("component"),
    )
    blocks, split = first_blocks(shared, 50)
    sizes = [r["count"] for r in blocks.groupBy("block").count().collect()]
    assert split and sum(sizes) == 1000 and max(sizes) <= 100
    rows = second_blocks(shared, 80, 50).collect()
    groups = {}
    for r in rows:
        groups.setdefault((r.block, r.other), []).append(r)
    assert max(map(len, groups.values())) <= 200
    met = set()
    for (block, other), own in groups.items():
        for a in own:
            met |= {(a.im_id, b.im_id) for b in own if block == other or a.side != b.side}
    assert all((a, b) in met for a in range(1000) for b in range(max(a + 1, 700), 1000))
    # Blocks inside the linked 700 rows are not brought together.
    assert sum((a, b) in met for a in range(700) for b in range(a + 1, 700)) < 700 * 699 // 8


def test_groups_without_rows(image_rows):
    assert near_copy_groups(image_rows([])).count() == 0
    assert [tuple(r) for r in near_copy_groups(image_rows([(1, None), (2, "")])).orderBy("im_id").collect()] == [(1, 0, 1), (2, 0, 2)]


def test_least_share_is_exact(image_rows):
    """3 hit words of 10: a share of 0.3 is reached, the next larger decimals are not; shares above a half and one count, too."""
    rows, items = image_rows([(1, "a b c d e f g h i j"), (2, "a b c")]), image_rows([(1, "a b c")])
    for share, expected in ((0.3, {1, 2}), (0.30000000000001, {2}), (0.29, {1, 2}), (0.7, {2}), (1, {2}), (1.5, set()), (0, {1, 2})):
        got = held_out_hits(rows, items, least_share=share).collect()
        assert {r["im_id"] for r in got if r["contaminated"]} == expected


def test_many_windows_take_bounded_memory(image_rows):
    """16 MB of held-out text: one block's windows, as the driver builds and every worker unpickles them."""
    import pickle
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from boxloom.llm.decontamination import MOST_WINDOWS, Windows

    chance = np.random.default_rng(1)
    n = MOST_WINDOWS
    flat = pa.py_buffer(chance.integers(0, 256, 16 * n, dtype=np.uint8).tobytes())
    digests = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), n, [None, flat]).cast(pa.binary())
    names = pa.array([f"item{i}" for i in range(1000)]).take(pa.array(chance.integers(0, 1000, n)))
    rows = pa.table({"length": pa.array(np.full(n, 13, np.int32)), "hash": pa.array(chance.integers(-(2**63), 2**63 - 1, n)), "digest": digests, "item": names})
    tracemalloc.start()
    own = Windows(rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300e6 and len(pickle.dumps(own)) < 150e6
