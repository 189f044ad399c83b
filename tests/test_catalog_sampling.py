"""Catalog operators and samplers against small hand-made inputs."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

from boxloom.operators import catalog as K
from boxloom.operators import sampling as S
from boxloom.plans.sampling import category_sample
from checks import ORACLES, QUERIES
from checks.compare import check


def test_first_filled_columns(spark):
    df = spark.createDataFrame([("1", " ", "shoe"), ("2", None, "hat")], "product_id string, title string, name string")
    wanted = {"im_name": K.NAME_COLUMNS, "im_description": K.DESCRIPTION_COLUMNS}
    rows = K.first_filled_columns(df, wanted).orderBy("product_id").collect()
    assert [(r["im_name"], r["im_description"]) for r in rows] == [("shoe", ""), ("hat", "")]


def test_image_column_is_required(spark):
    with pytest.raises(ValueError):
        K.image_column(spark.range(1))


def test_content_dedup_keeps_first(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("d", 4)], "im_url string, pos int")
    hashes = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "x"), ("d", "")], "im_url string, image_content_hash string")
    assert sorted(r["im_url"] for r in K.content_deduplicated(df, hashes).collect()) == ["a", "b"]


def test_exclusion_hashes(spark):
    good = "A" * 32
    table = spark.createDataFrame([("http://a", good), ("http://b", "short"), ("ftp://c", None)], "im_url string, im_name string")
    hashes = spark.createDataFrame([("http://a", "h1"), ("http://b", "h2"), ("ftp://c", "h3")], "im_url string, image_content_hash string")
    assert [r[0] for r in K.exclusion_hashes(table, "im_name", hashes).collect()] == [good]
    assert sorted(r[0] for r in K.exclusion_hashes(table.drop("im_name"), "im_name", hashes).collect()) == ["h1", "h2"]
    filled = {r["im_url"]: r["im_name"] for r in K.with_hash_column(table, "im_name", hashes).collect()}
    assert filled == {"http://a": "h1", "http://b": "h2", "ftp://c": "h3"}


def test_detail_filter_needs_terms(spark):
    with pytest.raises(ValueError):
        K.detail_view_flags(spark.range(1), [" "])


def test_rules_keep_rows_of_the_first_rule(spark):
    df = spark.createDataFrame([("u", "['B']"), ("u", "A"), ("u", "a"), ("w", "B")], "im_url string, category string")
    rules = [K.Rule("one", ["a"]), K.Rule("two", ["b"])]
    rows = sorted((r["im_url"], r["matched_rule"], r["category_clean"]) for r in K.matched_rules(df, rules, "category").collect())
    assert rows == [("u", "one", "A"), ("u", "one", "A"), ("w", "two", "B")]


def walked_budget(pools, total, floor, ceil):
    """Plain loop over one small table, for comparison."""
    weight = {c: math.sqrt(max(n, 1)) for c, n in pools.items()}
    whole = sum(weight.values())
    out = {c: max(floor, min(ceil, round(total * weight[c] / whole), pools[c])) for c in pools}
    for _ in range(10):
        left = total - sum(out.values())
        room = sorted((c for c in sorted(pools) if out[c] < min(ceil, pools[c])), key=lambda c: -pools[c])
        if left <= 0 or not room:
            break
        step = left // len(room) or 1
        for c in room:
            add = min(step, min(ceil, pools[c]) - out[c])
            out[c] += add
            left -= add
            if left <= 0:
                break
    return out


@pytest.mark.parametrize(
    "total, floor, ceil", [(500, 20, 400), (1000, 20, 400), (37, 0, 9), (5000, 20, 400), (90, 5, 1000), (10, 20, 30)]
)
def test_budget(spark, total, floor, ceil):
    pools = {"a": 1000, "b": 350, "c": 40, "d": 40, "e": 3, "f": 1}
    df = spark.createDataFrame(list(pools.items()), "category string, pool_size long")
    got = {r["category"]: r["budget"] for r in S.allocated_budget(df, total, floor, ceil).collect()}
    assert got == walked_budget(pools, total, floor, ceil)


def test_fixed_targets(spark):
    pools = spark.createDataFrame([("Rings", 50), ("Bags", 500), ("Hats", 30)], "category string, pool_size long")
    got = {r["category"]: r["budget"] for r in S.category_budget(pools, 200, 20, 400, {"rings ": "80", "x": 3, "bags": -1}).collect()}
    assert got["Rings"] == 50 and got["Bags"] + got["Hats"] == 150
    with pytest.raises(ValueError):
        S.category_budget(pools, 20, 0, 400, {"rings": 40})
    only = {r["category"]: r["budget"] for r in S.category_budget(pools, 50, 20, 400, {"rings": 50}).collect()}
    assert only == {"Rings": 50, "Bags": 0, "Hats": 0}


def test_fixed_targets_beyond_the_total(spark, sf, tmp_path):
    pools = spark.createDataFrame([("Rings", 50), ("Bags", 500)], "category string, pool_size long")
    got = {r["category"]: r["budget"] for r in S.category_budget(pools, 20, 0, 400, {"rings": 40}, strict=False).collect()}
    assert got == {"Rings": 40, "Bags": 0}
    events = spark.read.parquet(f"{sf}/events.parquet")
    rest = events.limit(500).withColumn("event_type", F.lit("click"))
    many = spark.range(4200).select(F.lit("error").alias("event_type"), F.lit(2).cast("long").alias("user_id"))
    rest.select("event_type", "user_id").unionByName(many).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    ok, note = check(spark, str(tmp_path), "w11_fixed_budget", QUERIES["w11_fixed_budget"], ORACLES["w11_fixed_budget"], con)
    assert ok, note


def test_category_sample_counts(spark):
    rows = [(str(i), "['Ring']" if i % 3 else "Bag", f"http://x/{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "product_id string, category string, image string")
    sample, report = category_sample(df, [K.Rule("r", ["ring", "bag"])], "image", None, "category", None, 60, 5, 100)
    counts = {r["category"]: r["count"] for r in sample.groupBy("category").count().collect()}
    stats = {r["category"]: (r["pool_size"], r["sampled"]) for r in report.collect()}
    assert counts == {c: s[1] for c, s in stats.items()} and sum(counts.values()) == 60
    assert stats["Ring"][0] == 133 and stats["Bag"][0] == 67


def test_ratio_targets():
    assert S.ratio_targets({}) == {"women": 2100, "men": 900}
    assert S.ratio_targets({"women": 10, "men": 2000}, 3000)["men"] == 0


PRESENCE = "im_url string, tags string, category string, image_content_hash string"


def test_presence_rounds_stop_at_target(spark):
    rows = [(f"u{i}", "image_human:model" if i % 2 else "", "bag", f"h{i}") for i in range(100)]
    out = S.presence_sample(spark.createDataFrame(rows, PRESENCE), 10, 3, 5)
    assert out.accepted.count() == 10 and out.stats["accepted"] == 10
    assert out.stats["evaluated"] >= 30 and not out.stats["exhausted"]
    assert out.rejected.filter("accepted").count() == 0


def test_presence_repeats_across_rounds(spark):
    """All images share one content: only rows of the first round can count."""
    rows = [(f"u{i}", "image_human:model", "bag", "same") for i in range(30)]
    out = S.presence_sample(spark.createDataFrame(rows, PRESENCE), 10, 1, 3)
    assert out.stats["rounds"] == 1 and out.accepted.count() == 10
    excluded = spark.createDataFrame([("same",)], "image_content_hash string")
    out = S.presence_sample(spark.createDataFrame(rows, PRESENCE), 10, 1, 3, exclusions=excluded)
    assert out.stats["accepted"] == 0 and out.stats["exhausted"]
    assert {r["tags"] for r in out.evaluated.select("tags").distinct().collect()} == {"deduplicated"}


CLASS = "im_id string, im_url string, category string, tags string, visible_classes string, image_content_hash string"


def class_rows(n):
    out = []
    for i in range(n):
        human = "image_human:model" if i % 4 else ""
        seen = '["ring"]' if i % 5 == 1 else "[]"
        out.append((f"i{i}", f"u{i}", "ring box" if i % 25 == 0 else "bag", human, seen, f"h{i % (n // 2)}" if i % 3 == 0 else f"x{i}"))
    return out


def test_class_sample_fills_from_fallback(spark):
    out = S.class_sample(spark.createDataFrame(class_rows(100), CLASS), 60, 10, ["ring"])
    rows = out.accepted.collect()
    fallback = [r for r in rows if "fallback_sample:true" in r["tags"]]
    assert len(rows) == 60 and out.stats["exhausted"] and fallback
    assert all(r["visible_classes"] == "[]" for r in fallback)
    reasons = {r["reject_reason"] for r in out.rejected.collect()}
    assert "not_human_model" in reasons
    assert {r["im_id"] for r in rows} & {r["im_id"] for r in out.rejected.collect()} == set()


def test_class_sample_must_include(spark):
    out = S.class_sample(spark.createDataFrame(class_rows(100), CLASS), 8, 20, ["ring"], ["ring"])
    rows = out.accepted.collect()
    assert len(rows) == 8
    must = [r for r in rows if "ring" in r["category"]]
    assert len(must) == 4 and out.stats["rounds"] >= 1


def test_object_filter(spark):
    cases = {"": None, "all": None, "top": ["top", "dress"], "top;dress": ["top", "dress"], "zzz": None, "top;other": ["top"], "other": None}
    df = spark.createDataFrame([(k,) for k in cases], "e string")
    got = {r["e"]: r["w"] for r in df.select("e", K.wanted_classes(F.col("e"), ["top", "dress"]).alias("w")).collect()}
    assert got == cases
    plain = K.wanted_classes(F.lit("top"), ["top", "dress"], expand=False)
    assert spark.range(1).select(plain.alias("w")).first()["w"] == ["top"]
