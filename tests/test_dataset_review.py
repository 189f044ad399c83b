"""Row cleaning, verification, split, review and corrections."""

import random

import pytest
from pyspark.sql import functions as F

from boxloom.functions import codecs as C
from boxloom.operators import dataset as D
from boxloom.operators import issues, review
from boxloom.plans import publish

ROW = "row_id long, im_url string, concepts string, boxes string, box_reasons string, issue_types string"


def rows(spark, *values):
    return spark.createDataFrame([(i, f"u{i}", *v) for i, v in enumerate(values)], ROW)


def test_clean_drops_placeholders_and_repeats(spark):
    df = rows(
        spark,
        ("a,,b", "[1,2,3,4],[9,9,9,9],[1,2, 3,4]", '["x","y","z"]', "n,n,n"),
        ("a,a", "[1,2,3,4],[1, 2,3,4]", '["x",manual_bbox_added]', "n,n"),
        ("other", "[1,2,3,4]", "[]", ""),
        ("a", "[0,0,0,0]", "", ""),
    )
    out = {r["row_id"]: r for r in D.cleaned(df).collect()}
    assert (out[0]["concepts"], out[0]["boxes"], out[0]["box_reasons"]) == ("a,b", "[1,2,3,4],[1,2, 3,4]", '["x","z"]')
    assert (out[1]["concepts"], out[1]["duplicate_boxes"], out[1]["status"]) == ("a", 1, "kept")
    assert out[2]["status"] == "single_other" and out[3]["status"] == "empty"
    stats = D.cleaning_stats(D.cleaned(df)).first().asDict()
    assert stats == {
        "input_rows": 4, "compacted": 1, "zero_boxes": 1, "duplicate_boxes": 1, "empty_rows": 1, "single_other_rows": 1, "kept_rows": 2,
    }


def test_verify_raises_on_clipped_duplicates(spark):
    """Cleaning happens before clipping, so clipping may create repeats; they are reported."""
    df = rows(spark, ("a,a", "[-1,2,3,4],[0,2,3,4]", "", ""))
    published = D.published_rows(D.cleaned(df))
    assert [r["rule"] for r in D.violations(published).collect()] == ["duplicate_box"]
    with pytest.raises(ValueError, match="duplicate_box"):
        D.verified(published)


def test_fix_precision_pads_short_columns(spark):
    df = rows(spark, ("a,b,c", "[1,2,3,4],[5,6,7,8]", "", "precision,no_issue,fp_high_conf_incorrect"), ("a", "[1,2,3,4]", "r", ""))
    out = {r["row_id"]: r for r in D.without_precision_issues(df).collect()}
    assert (out[0]["concepts"], out[0]["boxes"], out[0]["issue_types"]) == ("b", "[5,6,7,8]", "no_issue")
    assert out[1]["boxes"] == "[1,2,3,4]" and out[1]["box_reasons"] == "r"


def split_input(spark, n=2000):
    rng = random.Random(1)
    data = []
    for i in range(n):
        names = ["top"] if rng.random() < 0.8 else []
        names += [c for c, p in (("ring", 0.2), ("belt", 0.05), ("tie", 0.02)) if rng.random() < p]
        data.append((i, f"u{i}", ",".join(names), "", "", ""))
    return spark.createDataFrame(data, ROW)


def test_split_is_complete_and_balanced(spark):
    df = split_input(spark)
    out = D.split_rows(df)
    assert out.count() == 2000 and out.select("row_id").distinct().count() == 2000
    shares = {r["split"]: r["percent"] for r in D.split_shares(out).collect()}
    assert abs(shares["train"] - 80) < 1 and abs(shares["val"] - 10) < 1 and abs(shares["test"] - 10) < 1
    drift = {r["concept"]: r["max_drift"] for r in D.split_drift(out).collect()}
    assert set(drift) == {"top", "ring", "belt", "tie"} and max(drift.values()) < 0.06
    again = {r["row_id"]: r["split"] for r in D.split_rows(df.repartition(7)).collect()}
    assert again == {r["row_id"]: r["split"] for r in out.collect()}


def test_rare_concepts(spark):
    df = rows(spark, ("a,b", "", "", ""), ("a", "", "", ""), ("a", "", "", ""))
    assert [r["concept"] for r in D.rare_concepts(df).collect()] == ["b"]


def test_publish_writes_every_part(spark, tmp_path):
    good = [(f"{c},top", "[1,2,3,4],[5,6,7,8]", "", "") for c in ("ring", "belt") for _ in range(20)]
    publish.publish(rows(spark, *good), str(tmp_path), "brand")
    written = spark.read.option("header", True).csv(f"{tmp_path}/splits")
    assert written.count() == 40 and set(written.columns) == {*D.DATASET, "split"}
    counts = spark.read.option("header", True).csv(f"{tmp_path}/brand_dataset_data_distribution")
    assert counts.count() == 29 and counts.filter("concept = 'top'").first()["boxes"] == "40"


CORR = review.CORRECTION + ", position long"


def correction(row, action, at, **values):
    fields = ["concept", "box", "concept_index", "new_concept", "new_box", "new_boxes"]
    return (row, action, *[values.get(f) for f in fields], at)


def aligned(spark):
    schema = "row_id long, " + ", ".join(f"{c} string" for c in C.ALIGNED)
    return spark.createDataFrame(
        [
            (0, "a,b", "[1,1,2,2],[3,3,4,4]", "true,true", "s,s", "m,m", '["r1","r2"]', "i,i"),
            (1, "c", "[0,0,0,0]", "true", "s", "m", '["r"]', "i"),
            (2, "d", "[0,0,0,0]", "true", "s", "m", '["r"]', "i"),
        ],
        schema,
    )


EDITS = [
    correction(0, "add", 0, concept="w", box=[5, 5, 6, 6]),
    correction(0, "remove", 1, concept_index=0),
    correction(0, "replace", 2, concept_index=0, new_concept="z"),
    correction(0, "replace_multi", 3, concept_index=1, new_boxes=[{"concept": "p", "box": [7, 7, 8, 8]}, {"concept": "q", "box": [0, 0, 0, 0]}]),
    correction(1, "add", 4, concept="n", box=[1, 2, 3, 4]),
]


def test_corrections_in_order(spark):
    edits = spark.createDataFrame(EDITS, CORR)
    out = {r["row_id"]: r for r in review.corrected_rows(aligned(spark), edits).collect()}
    first = out[0]
    assert (first["concepts"], first["boxes"]) == ("z,p", "[3,3,4,4],[7,7,8,8]")
    assert (first["box_sources"], first["box_statuses"], first["optional"]) == ("human,human", "human_drawn,human_drawn", "true,true")
    assert first["box_reasons"] == '["r2",manual_bbox_added]'
    # Placeholders go only from rows that were touched.
    assert out[1]["concepts"] == "n" and out[2]["boxes"] == "[0,0,0,0]"


def test_replacing_in_short_columns(spark):
    schema = "row_id int, concepts string, boxes string, box_statuses string, box_sources string, issue_types string"
    rows = spark.createDataFrame([(0, "ring,belt", "[1,1,2,2],[3,3,4,4]", "s", "", "")], schema)
    edits = spark.createDataFrame([correction(0, "replace", 0, concept_index=1, new_concept="bag")], CORR)
    out = review.corrected_rows(rows, edits).first()
    assert (out["concepts"], out["boxes"]) == ("ring,bag", "[1,1,2,2],[3,3,4,4]")
    assert (out["box_statuses"], out["box_sources"], out["issue_types"]) == ("s,human_drawn", ",human", ",no_issue")
    edits = spark.createDataFrame([correction(0, "add", 0, concept="bag", box=[5, 5, 6, 6]), correction(0, "remove", 1, concept_index=9)], CORR)
    out = review.corrected_rows(rows, edits).first()
    assert (out["concepts"], out["box_statuses"], out["box_sources"], out["issue_types"]) == ("ring,belt,bag", "s,human_drawn", "human", "no_issue")


@pytest.mark.parametrize(
    ("bad", "reason"),
    [
        (correction(0, "remove", 0), "no index"),
        (correction(0, "replace", 0, concept_index=-1, new_concept="z"), "negative index"),
        (correction(0, "replace", 0, concept_index=9, new_concept="z"), None),
        (correction(77, "add", 0, concept="z", box=[1, 1, 2, 2]), "unknown row"),
    ],
)
def test_unusable_corrections_fail(spark, bad, reason):
    edits = spark.createDataFrame([bad], CORR)
    with pytest.raises(Exception, match="correction"):
        review.corrected_rows(aligned(spark), edits).collect()
    assert [r["reason"] for r in review.refused_corrections(aligned(spark), edits).collect()] == ([reason] if reason else [])


def test_exported_edits(spark):
    removed = spark.createDataFrame([(1, 0), (1, 4)], "row_index int, concept_index int")
    drawn = spark.createDataFrame([(1, 0, "a", [1, 1, 9, 9]), (1, 1, "b", [1, 1, 4, 9])], "row_index int, draw_no int, concept string, box array<int>")
    out = review.exported_corrections(removed, drawn).orderBy("position").collect()
    assert [(r["action"], r["concept_index"], r["concept"]) for r in out] == [("remove", 4, None), ("remove", 0, None), ("add", None, "a")]


def test_class_lists_differ():
    assert issues.class_list_difference(["a", "b"], ["b", "c"]) == {"only_left": ["a"], "only_right": ["c"]}


def test_recall_keeps_repeated_mentions(spark):
    marks = spark.createDataFrame([("i", "u", "n", "d", '["ring","ring","bag"]', "why")], "im_id string, im_url string, im_name string, im_description string, visible_classes string, gpt_reason string")
    none = spark.createDataFrame([], "im_id string, cluster_id int, cluster_size int, top_class string, top_score double, second_score double, margin double, uncertainty double, top_box array<int>")
    out = issues.missed_classes(none, marks, ["ring"]).collect()
    assert [(r["top_class"], r["issue_type"]) for r in out] == [("ring", "recall"), ("ring", "recall")]


def test_rows_of_very_many_boxes(spark):
    """100,000 entries, each twice: cleaning and checking cost about as much as sorting them, and give what short rows give."""
    import time

    def row(n):
        boxes = ",".join(f"[{i % (n // 2)},1,{i % (n // 2) + 5},9]" for i in range(n))
        return spark.createDataFrame([(1, "u", boxes, ",".join(["ring"] * n))], "row_id long, im_url string, boxes string, concepts string")

    D.cleaned(row(4)).collect()
    D.violations(row(4)).collect()
    begin = time.time()
    for n in (6, 100_000):
        out = D.cleaned(row(n)).first()
        assert (out["duplicate_boxes"], out["status"]) == (n // 2, "kept")
        assert out["boxes"] == ",".join(f"[{i},1,{i + 5},9]" for i in range(n // 2))
        assert [(r["rule"], r["count"]) for r in D.violations(row(n)).collect()] == [("duplicate_box", n // 2)]
    assert time.time() - begin < 60


def test_split_drifts_less_than_a_random_one(spark):
    """A concept of 40 rows among 4,000: the split deals it out almost exactly, one without strata doesn't."""
    rows = [(i, "rare,ring" if i % 100 == 7 else ("ring" if i % 3 else "watch,belt")) for i in range(4000)]
    df = spark.createDataFrame(rows, "row_id long, concepts string")
    drift = {r["concept"]: r for r in D.split_drift(D.split_rows(df)).collect()}
    # 32, 4 and 4 rows of 3,200, 400 and 400, but for one row of the stratum's last block.
    assert drift["rare"]["max_drift"] <= 1.01 / 400 and all(r["max_drift"] < 0.01 for r in drift.values())
    plain = F.pmod(F.crc32(F.col("row_id").cast("string").cast("binary")), F.lit(10))
    split = F.when(plain < 8, "train").when(plain == 8, "val").otherwise("test")
    loose = {r["concept"]: r["max_drift"] for r in D.split_drift(df.withColumn("split", split)).collect()}
    assert max(loose.values()) > 2 * max(r["max_drift"] for r in drift.values())


def test_verdict_keys_are_matched_once(spark):
    from boxloom.operators import review

    keys = ["llm:a:b:ring:[1,2,3,4]:h", "llm::x y:[a:b]:", "llm:1:ring:1,2:h", "llm:7:é:[]:\U0001f600"]
    out = review.verdict_keys(spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key string, position int"))
    assert sorted(tuple(r) for r in out.collect()) == sorted(
        [("a:b", "ring", "[1,2,3,4]", "h", 0), ("", "x y", "[a:b]", "", 1), ("7", "é", "[]", "\U0001f600", 3)]
    )
    plan = out.filter("name = 'ring' and box_text <> ''")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract(") == 1


def test_dirty_rows_deal_boxes_out_once(spark):
    from checks.publish import dirty_rows

    rows = dirty_rows(spark, "/root/testdata/sf0.001")
    assert rows._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
