"""Ranks, parts and first rows when one key holds most of the rows."""

import pytest
from pyspark.sql import functions as F

from boxloom.operators import groups
from boxloom.operators.rollup import annotated_rows, gathered


def skewed(spark, n=3000):
    """Key 0 holds two thirds of the rows; one key is NULL."""
    key = F.when(F.col("id") % 3 != 0, F.lit(0)).when(F.col("id") % 9 == 0, F.lit(None)).otherwise(F.col("id") % 50)
    return spark.range(n).select(key.cast("int").alias("k"), (F.col("id") * 7919 % 104729).alias("v"), "id")


def expected_ranks(df, order):
    groups_, out = {}, {}
    for r in df.collect():
        groups_.setdefault(r["k"], []).append(r)
    for rows in groups_.values():
        for i, r in enumerate(sorted(rows, key=order)):
            out[r["id"]] = i + 1
    return out


def test_ordered_rank(spark):
    df = skewed(spark)
    out = groups.ordered_rank(df, ["k"], "v", pieces=16)
    assert {r["id"]: r["rank"] for r in out.collect()} == expected_ranks(df, lambda r: r["v"])


def test_hashed_rank(spark):
    df = skewed(spark).withColumn("h", groups.seeded_hash(F.col("id"), 3))
    out = groups.hashed_rank(df, ["k"], "h", "id", prefix=2)
    assert {r["id"]: r["rank"] for r in out.collect()} == expected_ranks(df, lambda r: r["h"])


@pytest.mark.parametrize("limit", [0, 1, 7, 10**6])
def test_hashed_head_is_the_start_of_the_rank(spark, limit):
    df = skewed(spark).withColumn("h", groups.seeded_hash(F.col("id"), 3))
    whole = groups.hashed_rank(df, ["k"], "h", "id", prefix=2)
    limits = df.select("k").distinct().withColumn("limit", F.coalesce(F.col("k"), F.lit(0)) + limit)
    want = {(r["id"], r["rank"]) for r in whole.collect() if r["k"] is not None and r["rank"] <= r["k"] + limit}
    got = groups.hashed_head(df, ["k"], "h", "id", limits, prefix=2)
    assert {(r["id"], r["rank"]) for r in got.collect()} == want
    assert groups.hashed_head(df, [], "h", "id", limit).count() == min(limit, df.count())


def test_gathered_is_one_row_in_order(spark):
    df = skewed(spark)
    rows = gathered(df, ["k"], "v", F.col("v")).collect()
    assert len(rows) == len({r["k"] for r in rows})
    for row in rows:
        assert row["items"] == sorted(r["v"] for r in df.collect() if r["k"] == row["k"])


def test_first_and_last_per_key(spark):
    df = skewed(spark)
    rows = df.collect()
    for last in (False, True):
        out = {r["k"]: r["id"] for r in groups.first_per_key(df, ["k"], ["v"], last=last).collect()}
        pick = max if last else min
        assert out == {k: pick((r for r in rows if r["k"] == k), key=lambda r: r["v"])["id"] for k in {r["k"] for r in rows}}


def test_large_groups_only_when_there_are_any(spark):
    df = skewed(spark)
    assert groups.large_groups(df, ["k"], 5000) is None
    assert [r["k"] for r in groups.large_groups(df, ["k"], 500).collect()] == [0]


def test_salted_join_equals_broadcast(spark, monkeypatch):
    df = skewed(spark, 500)
    side = df.select("k").distinct().withColumn("w", F.coalesce("k", F.lit(-1)) * 2)
    plain = sorted(map(str, groups.attach_one_per_key(df, side, ["k"]).collect()))
    monkeypatch.setattr(groups, "BROADCAST_BYTES", 0)
    assert sorted(map(str, groups.attach_one_per_key(df, side, ["k"]).collect())) == plain


def test_images_without_boxes_are_null(spark):
    images = spark.createDataFrame([(1, "u"), (2, "v")], "im_id int, im_url string")
    boxes = spark.createDataFrame([(1, 1, "ring", 0.5, 1.5, 2.5, 3.5)], "im_id int, pos long, name string, x1 double, y1 double, x2 double, y2 double")
    rows = {r["im_id"]: (r["concepts"], r["boxes"]) for r in annotated_rows(images, boxes).collect()}
    assert rows == {1: ("ring", "[0,2,2,4]"), 2: (None, None)}


@pytest.mark.parametrize("limit", [10, 100_000])
def test_placed(spark, limit):
    df = skewed(spark).withColumn("v", F.col("v") % 40)
    out = groups.placed(df, ["k"], [F.col("v"), F.col("id").desc()], limit=limit)
    assert out.columns == [*df.columns, "place"]
    assert {r["id"]: r["place"] for r in out.collect()} == expected_ranks(df, lambda r: (r["v"], -r["id"]))


def test_placed_without_keys(spark):
    df = skewed(spark, 500)
    out = groups.placed(df.repartition(7), [], [F.col("id")])
    assert sorted((r["id"], r["place"]) for r in out.collect()) == [(i, i + 1) for i in range(500)]
    assert groups.placed(df.limit(0), [], [F.col("id")]).count() == 0
