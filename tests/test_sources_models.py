"""Files, image pixels, incremental annotation, streaming, plans."""

import hashlib
import json
import struct
import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from boxloom.operators import annotate as A
from boxloom.operators import catalog as K
from boxloom.operators import images as pixel
from boxloom.operators import review
from boxloom.operators import suppression as S
from boxloom.plans import annotation
from boxloom.sources import paths, readers, sinks
from boxloom.streaming import incremental


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_csv_round_trip(spark, tmp_path):
    path = write(tmp_path / "in" / "catalog.csv", 'product_id,title,tags\n007,"two\nlines, ""quoted""","[\'a\']"\n8,x,\n')
    df = readers.read_catalog(spark, path)
    rows = df.orderBy("pos").collect()
    assert [r["product_id"] for r in rows] == ["007", "8"] and rows[0]["title"] == 'two\nlines, "quoted"'
    sinks.write_csv(df.withColumn("list", F.array("product_id")), str(tmp_path / "out"))
    back = readers.read_csv(spark, str(tmp_path / "out")).orderBy("pos").collect()
    assert back[0]["title"] == 'two\nlines, "quoted"' and back[0]["list"] == '["007"]'


def test_row_numbers_follow_input(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 3).alias("v"))
    rows = readers.with_row_number(df).collect()
    assert sorted(r["row_id"] for r in rows) == list(range(1000))
    assert all(r["v"] == r["row_id"] * 3 for r in rows)


def test_paths(spark, tmp_path):
    folder = tmp_path / "shop"
    write(folder / "b.csv", "a\n")
    write(folder / "a.csv", "a\n")
    assert paths.catalog_path(spark, None, str(folder)).endswith("a.csv")
    write(folder / "catalog.csv", "a\n")
    assert paths.catalog_path(spark, None, str(folder)).endswith("catalog.csv")
    assert paths.dataset_path(spark, None, str(tmp_path), "shop/a.csv").endswith("shop/a.csv")
    prepared = str(folder / "b.csv")
    assert paths.dataset_path(spark, prepared, str(tmp_path), "shop/a.csv") == prepared
    assert paths.dataset_path(spark, prepared, str(tmp_path), "shop/a.csv", prefer_prepared=False).endswith("a.csv")
    assert paths.input_path(spark, "c.csv", [str(folder)]) if write(folder / "corrections" / "c.csv", "x") else None
    with pytest.raises(FileNotFoundError):
        paths.first_existing(spark, [str(folder / "none.csv")])
    assert paths.stored_image_path("/r/", "abcd") == "/r/ab/abcd" and paths.stored_image_path("/r", "abcd", flat=True) == "/r/abcd"


def test_versions(spark, tmp_path):
    df = spark.createDataFrame([("a",)], "x string")
    assert sinks.write_version(df, str(tmp_path), "brand").endswith("v1/brand_v1_dataset")
    (tmp_path / "v7").mkdir()
    assert paths.next_version(spark, str(tmp_path)) == 8


def test_combined_catalogs(spark, tmp_path):
    head = ",".join(readers.COMBINED)
    write(tmp_path / "c1" / "s.csv", f"{head},extra\nshop1,1,bag,u,i1,n,d,t,e\nshop1,2,bag,v,i2,n,d,t,e\n")
    write(tmp_path / "c2" / "s.csv", f"{head},extra\nshop2,9,bag,u,i1,n,d,t,e\n")
    df = readers.read_combined(spark, f"{tmp_path}/*/s.csv")
    assert {(r["im_id"], r["catalog_name"]) for r in df.collect()} == {("i1", "shop1"), ("i2", "shop1")}
    assert {r["catalog_name"]: r["images"] for r in readers.catalog_counts(df).collect()} == {"shop1": 2}


def test_lists_rules_reviews(spark, tmp_path):
    path = write(tmp_path / "classes.txt", "ring, 0.4\nbelt\n\n")
    assert {r["name"]: r["threshold"] for r in readers.read_thresholds(spark, path, 0.3).collect()} == {"ring": 0.4, "belt": 0.3}
    path = write(tmp_path / "rules.json", json.dumps([{"name": "r", "category_in": ["a"], "gender_equals": "Women"}, {"name": "s"}]))
    assert readers.read_rules(spark, path) == [K.Rule("r", ["a"], "Women"), K.Rule("s", [], "")]
    path = write(
        tmp_path / "review.json",
        json.dumps({"decisions": {"i:ring:1:2:3:4": "rejected"}, "added_boxes": {"i": [{"box": [1, 2, 3, 4], "name": "ring", "source": "human"}]}, "hidden": {"u": True}}),
    )
    decisions, added, hidden = review.review_tables(readers.read_review(spark, path))
    assert decisions.first().asDict() == {"uid": "i:ring:1:2:3:4", "decision": "rejected"}
    assert added.first()["x2"] == 3.0 and hidden.first()["hidden"] is True
    path = write(tmp_path / "corr.json", json.dumps([{"row_index": 1, "action": "remove", "concept_index": 0}, {"row_index": 0, "action": "add", "concept": "a", "box": [1, 2, 3, 4]}]))
    assert [r["action"] for r in readers.read_corrections(spark, path).orderBy("position").collect()] == ["remove", "add"]
    assert readers.job_configs(spark, {"b": 2, "a": 1}, ["ring"]).count() == 2


def test_stage_is_computed_once(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    path = str(tmp_path / "stage")
    assert sinks.stage(build, spark, path).count() == 3 and sinks.stage(build, spark, path).count() == 3
    assert len(calls) == 1


# --- images -----------------------------------------------------------------


def png(width, height, color):
    def chunk(kind, data):
        body = kind + data
        return struct.pack(">I", len(data)) + body + struct.pack(">I", zlib.crc32(body))

    raw = b"".join(b"\x00" + b"".join(bytes(color(x, y)) for x in range(width)) for y in range(height))
    head = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def test_image_sources_and_crops(spark, tmp_path):
    data = png(8, 6, lambda x, y: (x, y, 100))
    folder = tmp_path / "img"
    folder.mkdir()
    (folder / "one.png").write_bytes(data)
    (folder / "two.png").write_bytes(data)
    (folder / "bad.png").write_bytes(b"no image")
    files = readers.read_image_bytes(spark, str(folder))
    assert {r["im_name"] for r in files.collect()} == {"one", "two", "bad"}
    hashes = files.select(F.col("path").alias("im_url"), "image_content_hash")
    assert hashes.filter(F.col("image_content_hash") == hashlib.md5(data).hexdigest()).count() == 2
    audit = K.name_matches_content(files.select("im_name", "content"))
    assert not any(r["name_matches"] for r in audit.collect())
    pixels = readers.read_pixels(spark, str(folder)).withColumn("im_id", F.col("im_name"))
    assert {(r["im_id"], r["image_w"], r["image_h"]) for r in pixels.collect()} == {("one", 8, 6), ("two", 8, 6)}
    boxes = [("one", i, "ring", 2, 1, 4, 3) for i in range(5)] + [("two", 0, "belt", 3, 3, 3, 5)]
    rects = spark.createDataFrame(boxes, "im_id string, pos long, name string, cx1 int, cy1 int, cx2 int, cy2 int")
    crops = pixel.pixel_crops(pixels, rects, limit=2)
    out = crops.collect()
    assert len(out) == 5 and all((r["crop_w"], r["crop_h"]) == (2, 2) for r in out)
    # BGR rows.
    assert bytes(out[0]["crop"]) == bytes([100, 1, 2, 100, 1, 3, 100, 2, 2, 100, 2, 3])
    sinks.write_crops(crops, str(tmp_path / "crops"))
    assert (tmp_path / "crops" / "name=ring").exists()


# --- models -----------------------------------------------------------------


class Echo(A.RowAnnotator):
    fields = ST.StructType([ST.StructField("answer", ST.StringType())])

    def __init__(self, prefix):
        self.prefix = prefix

    def process(self, row):
        if row["k"] == 3:
            raise RuntimeError("down")
        return {"answer": None if row["k"] == 4 else f"{self.prefix}{row['k']}"}


def test_incremental_runs(spark, tmp_path):
    store = A.ResultStore(spark, str(tmp_path / "store"), ["k"])
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (3, "a"), (4, "a")], "k int, v string")
    first = {r["k"]: r["answer"] for r in A.annotated(df, ["k"], Echo("x"), store).collect()}
    assert first == {1: "x1", 2: "x2"}
    # Only keys without stored result are computed again; stored blanks count as stored.
    more = df.unionByName(spark.createDataFrame([(5, "a")], df.schema))
    assert sorted(r["k"] for r in store.pending(more).select("k").distinct().collect()) == [3, 5]
    second = {r["k"]: r["answer"] for r in A.annotated(more, ["k"], Echo("y"), store, rounds=2).collect()}
    assert second == {1: "x1", 2: "x2", 4: None, 5: "y5"}
    store.append(spark.createDataFrame([(1, "new")], "k int, answer string"), store.next_run())
    assert store.latest().filter("k = 1").first()["answer"] == "new"
    small = store.compacted_to(str(tmp_path / "small"))
    assert small.read().count() == 4


class Slow(A.RowAnnotator):
    fields = ST.StructType([ST.StructField("answer", ST.StringType())])

    def process(self, row):
        import time

        if row["k"] == 0:
            time.sleep(3)
        return {"answer": "ok"}


def test_timeouts_are_skipped(spark):
    df = spark.createDataFrame([(0,), (1,)], "k int")
    assert [r["k"] for r in A.run_annotator(df, ["k"], Slow(), timeout=0.5).collect()] == [1]


class Broken(A.RowAnnotator):
    fields = ST.StructType([ST.StructField("answer", ST.StringType())])

    def process(self, row):
        if row["k"] % 2 == 0:
            raise ValueError(f"no answer for {row['k']}")
        return {"answer": "ok"}


def test_failed_calls_are_listed_and_tried_again(spark, tmp_path):
    df = spark.createDataFrame([(k,) for k in range(4)], "k int")
    store = A.ResultStore(spark, str(tmp_path / "store"), ["k"])
    assert store.failed() is None
    for run in (0, 1):
        assert sorted(r["k"] for r in A.annotated(df, ["k"], Broken(), store, tasks=2).collect()) == [1, 3]
        assert sorted((r["k"], r["_run"]) for r in store.failed().collect()) == sorted((k, n) for k in (0, 2) for n in range(run + 1))
    assert {r["_error"] for r in store.failed().collect()} == {"ValueError: no answer for 0", "ValueError: no answer for 2"}


def test_half_written_stage_is_written_again(spark, tmp_path):
    path = str(tmp_path / "half")
    spark.range(2).write.parquet(path)
    (tmp_path / "half" / "_SUCCESS").unlink()
    assert sinks.stage(lambda: spark.range(5), spark, path).count() == 5


def test_stream_annotates_arrivals(spark, tmp_path):
    inbox = tmp_path / "inbox"
    spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string").write.parquet(str(inbox))
    stream = spark.readStream.schema("k int, v string").parquet(str(inbox))
    store = A.ResultStore(spark, str(tmp_path / "store"), ["k"])
    for extra in (None, 5):
        if extra:
            spark.createDataFrame([(extra, "c"), (1, "again")], "k int, v string").write.mode("append").parquet(str(inbox))
        incremental.annotate_arrivals(stream, ["k"], Echo("z"), store.path, str(tmp_path / "log")).awaitTermination()
    assert {r["k"]: r["answer"] for r in store.latest().collect()} == {1: "z1", 2: "z2", 5: "z5"}


class Fine(A.RowAnnotator):
    fields = ST.StructType([ST.StructField("is_valid", ST.BooleanType()), ST.StructField("reason", ST.StringType())])

    def process(self, row):
        return {"is_valid": row["name"] != "belt", "reason": "r"}


def test_annotation_plan(spark, tmp_path):
    images = spark.createDataFrame(
        [(1, "u1", 200, 200, "[1,1,90,90]", "belt"), (2, "u2", 200, 200, None, None)],
        "im_id int, im_url string, image_w int, image_h int, boxes string, concepts string",
    )
    raw = spark.createDataFrame(
        [(1, 10, "ring", 10.0, 10.0, 40.0, 40.0, 0.9, "locate_anything"), (1, 11, "ring", 11.0, 11.0, 40.0, 40.0, 0.8, "fashion_model"), (1, 12, "other", 0.0, 0.0, 9.0, 9.0, 0.8, "m")],
        "im_id int, pos long, name string, x1 double, y1 double, x2 double, y2 double, score double, source string",
    )
    boxes = annotation.stored_boxes(images).unionByName(raw)
    plan = annotation.AnnotationPlan()
    rows = {r["im_id"]: (r["concepts"], r["boxes"]) for r in annotation.annotated_dataset(images, boxes, plan).collect()}
    assert rows == {1: ("belt,ring", "[1,1,90,90],[10,10,40,40]"), 2: (None, None)}
    store = A.ResultStore(spark, str(tmp_path / "v"), ["im_id", "name", "box_text", "settings"])
    judged = annotation.annotated_dataset(images, boxes, plan, Fine(), store, "s1")
    assert {r["im_id"]: r["concepts"] for r in judged.collect()} == {1: "ring", 2: None}
    assert annotation.annotated_dataset(images, boxes, plan, mode="detection_only").count() == 4


def test_curation_plan(spark):
    boxes = spark.createDataFrame(
        [("i", 1, "ring", 0.0, 0.0, 10.0, 10.0, 0.9), ("i", 2, "belt", 1.0, 0.0, 11.0, 10.0, 0.8), ("i", 3, "tie", 50.0, 50.0, 60.0, 60.0, 0.1)],
        "im_id string, pos long, name string, x1 double, y1 double, x2 double, y2 double, score double",
    )
    marks = spark.createDataFrame(
        [("i", "u", "n", "d", '["belt"]', "why"), ("j", "w", "n", "d", '["ring"]', "")],
        "im_id string, im_url string, im_name string, im_description string, visible_classes string, gpt_reason string",
    )
    out = {r["im_id"]: r for r in annotation.curated_issues(boxes, marks, ["ring", "belt"], 0.5).collect()}
    assert (out["i"]["concepts"], out["i"]["issue_types"]) == ("ring,belt", "precision,recall")
    assert (out["i"]["boxes"], out["i"]["box_sources"]) == ("[0,0,10,10],[0,0,0,0]", "model,model_missed")
    assert (out["j"]["box_statuses"], out["j"]["box_reasons"]) == ("type2_missing", '[""]')


def test_policy_keywords():
    assert S.Policy().iou == 0.7


def test_tables_are_deleted(spark):
    from pathlib import Path

    from boxloom.session import checkpoint_dir, checkpointed, forget, tables_of_a_job

    folder = Path(checkpoint_dir(spark).removeprefix("file:")) / "tables"
    before = set(folder.glob("*")) if folder.exists() else set()
    with tables_of_a_job(spark):
        one, two = checkpointed(spark.range(3)), checkpointed(spark.range(4))
        assert len(set(folder.glob("*")) - before) == 2
        forget(one, two.select("id"), spark.range(1))
        assert two.count() == 4
        assert len(set(folder.glob("*")) - before) == 1
    assert set(folder.glob("*")) - before == set()


class SlowFirst(A.RowAnnotator):
    fields = ST.StructType([ST.StructField("answer", ST.StringType())])

    def process(self, row):
        import time

        if row["k"] < 2:
            time.sleep(4)
        return {"answer": "ok"}


def test_hung_calls_do_not_hold_up_other_rows(spark):
    df = spark.range(8).selectExpr("cast(id as int) k").coalesce(1)
    got = A.run_annotator(df, ["k"], SlowFirst(), threads=2, timeout=0.4).collect()
    assert sorted(r["k"] for r in got) == [2, 3, 4, 5, 6, 7]


def test_call_each_keeps_order_and_errors():
    def process(row):
        if row["k"] % 3 == 0:
            raise ValueError(row["k"])
        return row["k"]

    out = A.call_each(process, [{"k": k} for k in range(500)], 4, 5.0)
    assert [r.args[0] if isinstance(r, ValueError) else r for r in out] == list(range(500))
    assert A.call_each(process, [], 4, None) == []


def test_box_text_is_joined_without_a_formatter(spark):
    from boxloom.functions.codecs import box_text

    df = spark.sql("select 0.5D a, 1.5D b, -2.6D c, cast(null as double) d").select(box_text(*[F.col(c) for c in "abcd"]).alias("t"))
    assert df.first()["t"] == "[0,2,-3,null]"
    assert "format_string" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_pixels_are_decoded_beside_their_rectangles(spark, monkeypatch):
    monkeypatch.setattr(pixel, "CROP_BYTES", 20)
    # One image with five rectangles in parts of two, one without any.
    images = spark.createDataFrame([(1, 4, 6, 3), (2, 2, 2, 3)], "im_id long, image_h int, image_w int, channels int")
    decoded = F.expr("cast(repeat(char(65 + im_id), image_h * image_w * channels) as binary)")
    boxes = [(1, i, "ring", i, 0, i + 2, 2) for i in range(5)] + [(1, 9, "belt", 3, 3, 3, 4)]
    rects = spark.createDataFrame(boxes, "im_id long, pos long, name string, cx1 int, cy1 int, cx2 int, cy2 int")
    crops = pixel.pixel_crops(images, rects, limit=2, pixels=decoded)
    rows = sorted((r["box_no"], r["name"], r["crop_h"], r["crop_w"], bytes(r["crop"])) for r in crops.collect())
    assert rows == [(i, "ring", 2, 2, b"B" * 12) for i in range(5)]
    plan = crops._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("repeat(") < plan.index("Join")


class AreaJudge(A.RowAnnotator):
    fields = ST.StructType([ST.StructField("is_valid", ST.BooleanType()), ST.StructField("reason", ST.StringType())])

    def process(self, row):
        if row["cx1"] == 3:
            raise ValueError("no reply")
        return {"is_valid": None if row["cx1"] == 5 else row["cx2"] - row["cx1"] > 4, "reason": "size"}


def test_crops_of_verified_boxes_are_computed_once(spark, tmp_path):
    corners = [(1, 0, 9), (2, 0, 9), (3, 3, 9), (4, 5, 9), (5, 7, 9), (6, 8, 8), (7, 0, 9)]
    rows = [("i", p, "belt" if p == 7 else "ring", float(a), 0.0, float(b), 4.5, 10, 10) for p, a, b in corners]
    boxes = spark.createDataFrame(rows, "im_id string, pos int, name string, x1 double, y1 double, x2 double, y2 double, image_w int, image_h int")
    store = A.ResultStore(spark, str(tmp_path / "v"), ["im_id", "name", "box_text", "settings"])
    expected = {1: (True, "size"), 2: (True, "size"), 3: (False, A.CALL_FAILED), 4: (False, A.CALL_FAILED), 5: (False, "size"), 6: (True, ""), 7: (True, "")}

    def verified(named):
        out = A.verified_boxes(boxes, AreaJudge(), store, {}, named, ["Ring"])
        assert {r["pos"]: (r["is_valid"], r["reason"]) for r in out.collect()} == expected
        return out._jdf.queryExecution().optimizedPlan().toString()

    # The first run's answers are its own rows: they meet the boxes in one join, and no formula of a crop is left in it.
    plan = verified("a")
    assert plan.count("Join ") == 1 and "rint(" not in plan.lower() and "bround(" not in plan
    # Stored answers of this run and of other settings.
    expected[4] = (False, "size")
    verified("a")
    expected[4] = (False, A.CALL_FAILED)
    verified("b")
    assert store.read().count() == 6
