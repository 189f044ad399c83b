"""Iterative stratification against a plain walk over rows."""

import hashlib
import random
from collections import Counter, defaultdict
from fractions import Fraction

from pyspark.sql import functions as F

from boxloom.operators import dataset as D
from boxloom.operators.strata import filled, stratified_split

PARTS = {"train": Fraction(8, 10), "val": Fraction(1, 10), "test": Fraction(1, 10)}
SCHEMA = "row_id long, concepts string"


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def walked(wanted, n, order):
    got = [0] * len(wanted)
    for _ in range(n):
        got[max(range(len(wanted)), key=lambda s: (wanted[s] - got[s], -order[s]))] += 1
    return got


def plain_split(rows, most_rounds=256):
    sets = defaultdict(list)
    for i, cell in rows:
        sets[",".join(sorted({c.strip() for c in (cell or "").split(",")} - {""}))].append(i)
    support = Counter()
    for labels, ids in sets.items():
        for c in filter(None, labels.split(",")):
            support[c] += len(ids)
    ranked = sorted(support, key=lambda c: (support[c], c))
    main = ranked[max(0, len(ranked) - most_rounds) :]
    strata = defaultdict(list)
    for labels in sets:
        strata[min(filter(None, labels.split(",")), key=lambda c: (support[c], c), default="")].append(labels)
    done, out = {c: [0, 0, 0] for c in [*support, ""]}, {}
    for c in [*[c for c in ranked if c not in main], *main, ""]:
        own = sorted(strata[c], key=md5)
        n = sum(len(sets[x]) for x in own)
        if c in main or c == "":
            all_rows = [s * len(rows) - d for s, d in zip(PARTS.values(), done[""], strict=True)]
            order = sorted(range(3), key=lambda s: (-all_rows[s], s))
            wanted = [s * (support[c] if c else len(rows)) - d for s, d in zip(PARTS.values(), done[c], strict=True)]
            quota = walked(wanted, n, [order.index(s) for s in range(3)])
        else:
            u = Fraction(int(md5(c)[:4], 16) % 1000, 1000)
            ends = [int(n * k / Fraction(10) + u) for k in (0, 1, 2)]
            quota = [None, ends[1] - ends[0], ends[2] - ends[1]]
        val = [quota[1] * x // n for x in range(n + 1)] if n else [0]
        left = n - quota[1] if n else 0
        test = [quota[2] * (x - val[x]) // left if left else 0 for x in range(n + 1)]
        at = 0
        for labels in own:
            end = at + len(sets[labels])
            v, t = val[end] - val[at], test[end] - test[at]
            for place, i in enumerate(sorted(sets[labels], key=lambda i: (md5(f"{i}|42"), i))):
                part = 1 if place < v else 2 if place < v + t else 0
                out[i] = list(PARTS)[part]
                for label in [*filter(None, labels.split(",")), ""]:
                    done[label][part] += 1
            at = end
    return out


def random_rows(n, seed, concepts):
    chance = random.Random(seed)
    odds = [(c, 0.5 / (k + 1)) for k, c in enumerate(concepts)]
    cells = [",".join(c for c, p in odds if chance.random() < p) for _ in range(n)]
    return [(i, None if i % 97 == 5 else f" {cell}, " if i % 7 == 0 else cell) for i, cell in enumerate(cells)]


def test_filled_is_the_walk():
    chance = random.Random(3)
    for _ in range(300):
        wanted = [Fraction(chance.randrange(-40, 90), 10) for _ in range(chance.randrange(1, 5))]
        order = chance.sample(range(len(wanted)), len(wanted))
        n = chance.randrange(30)
        assert filled(wanted, n, order) == walked(wanted, n, order)


def test_split_against_plain_walk(spark):
    for rows, rounds in [(random_rows(1500, 1, [f"c{k}" for k in range(12)]), 256), (random_rows(600, 2, [f"k{k}" for k in range(40)]), 5)]:
        df = spark.createDataFrame(rows, SCHEMA).repartition(5)
        got = {r["row_id"]: r["split"] for r in stratified_split(df, most_rounds=rounds).collect()}
        assert got == plain_split(rows, rounds)


def test_every_concept_has_its_share(spark):
    """Within two rows of 80/10/10 for each of twelve concepts that share rows; the simple strata are further off."""
    rows = random_rows(4000, 8, [f"c{k}" for k in range(12)])
    df = spark.createDataFrame(rows, SCHEMA)

    def off(split):
        counts = split.select("split", F.explode(F.array_distinct(F.split("concepts", "[ ,]+"))).alias("c")).filter("c <> ''").groupBy("c")
        rows = counts.agg(F.count("*").alias("n"), F.count_if(F.col("split") == "val").alias("v"), F.count_if(F.col("split") == "test").alias("t")).collect()
        return max(max(abs(r["v"] - r["n"] / 10), abs(r["t"] - r["n"] / 10)) for r in rows)

    got = stratified_split(df)
    shares = {r["split"]: r["percent"] for r in D.split_shares(got).collect()}
    assert abs(shares["train"] - 80) < 0.1 and abs(shares["val"] - 10) < 0.1
    assert off(got) <= 2 < off(D.split_rows(df))


def test_odd_tables(spark):
    assert stratified_split(spark.createDataFrame([], SCHEMA)).count() == 0
    nothing = stratified_split(spark.createDataFrame([(i, None) for i in range(10)], SCHEMA))
    assert Counter(r["split"] for r in nothing.collect()) == {"train": 8, "val": 1, "test": 1}
    wide = spark.createDataFrame([(i % 3, "a", "x", i) for i in range(20)], "row_id long, concepts string, split_of string, n long")
    got = stratified_split(wide, shares={"fit": 0.5, "rest": 0.5})
    assert got.columns == [*wide.columns, "split"] and Counter(r["split"] for r in got.collect()) == {"fit": 10, "rest": 10}
    assert sorted(r["n"] for r in got.collect()) == list(range(20))
