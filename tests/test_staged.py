"""Paid models: calls are counted, stopped at the target and never repeated; buckets are pruned."""

import uuid
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from boxloom.operators import annotate as A
from boxloom.operators import sampling as S
from boxloom.operators.detectors import KEYS, Detector, packed_detections
from boxloom.operators.store import BUCKET, ResultStore
from boxloom.plans import staged
from boxloom.plans.annotation import AnnotationPlan, ProcessedCache, processed_boxes
from boxloom.sources import sinks


def log(folder, text):
    Path(folder, uuid.uuid4().hex).write_text(text)


def calls(folder):
    return sorted(p.read_text() for p in Path(folder).iterdir())


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "calls").mkdir()
    return str(tmp_path / "calls")


class Classes(A.RowAnnotator):
    """Every third image shows a ring; image ``broken`` has no answer."""

    fields = ST.StructType([ST.StructField("visible_classes", ST.StringType()), ST.StructField("gpt_reason", ST.StringType())])

    def __init__(self, folder, broken=None):
        self.folder, self.broken = folder, broken

    def process(self, row):
        log(self.folder, row["im_id"])
        if row["im_id"] == self.broken:
            raise RuntimeError("down")
        return {"visible_classes": '["ring"]' if int(row["im_id"][1:]) % 3 == 0 else "[]", "gpt_reason": row["available_classes"]}


class Tags(A.RowAnnotator):
    fields = ST.StructType([ST.StructField("tags", ST.StringType())])

    def __init__(self, folder):
        self.folder = folder

    def process(self, row):
        log(self.folder, row["im_url"])
        return {"tags": "image_human:model" if int(row["im_url"][1:]) % 2 == 0 else "x"}


POOL = "im_id string, im_url string, category string, image_content_hash string"


def pool(spark, n=120):
    return spark.createDataFrame([(f"i{i}", f"u{i}", "ring box" if i % 40 == 0 else "bag", f"h{i % 100}") for i in range(n)], POOL)


def test_class_sample_stops_at_the_target(spark, folder, tmp_path):
    store = ResultStore(spark, str(tmp_path / "classes"), ["im_id"])
    tags = ResultStore(spark, str(tmp_path / "tags"), ["im_id"])

    def run(target, broken=None):
        asked = staged.Asked(Classes(folder, broken), store), staged.Asked(Tags(folder), tags)
        return staged.staged_class_sample(pool(spark), target, 20, ["ring"], asked[0], asked[1], ["ring"])

    out = run(10)
    made = calls(folder)
    assert out.accepted.count() == 10 and 0 < out.stats["rounds"] < 6 and not out.stats["exhausted"]
    asked = [c for c in made if c.startswith("i")]
    # Nobody is asked twice, and the classifier sees people of the batches that were begun only.
    assert len(asked) == len(set(asked)) <= out.stats["checked"] + 3 and all(int(i[1:]) % 2 == 0 for i in asked)
    assert len([c for c in made if c.startswith("u")]) <= out.stats["checked"] + 3
    # Again: the same sample without a call.
    again = run(10)
    assert calls(folder) == made and again.stats == out.stats
    assert [r["im_id"] for r in again.accepted.collect()] == [r["im_id"] for r in out.accepted.collect()]
    # All answers known, the one-pass sample is the same.
    known = pool(spark).withColumn("n", F.substring("im_id", 2, 9).cast("int"))
    known = known.withColumns({"tags": F.when(F.col("n") % 2 == 0, "image_human:model").otherwise("x"), "visible_classes": F.when(F.col("n") % 3 == 0, '["ring"]').otherwise("[]")})
    whole = S.class_sample(known.drop("n"), 10, 20, ["ring"], ["ring"])
    assert whole.stats == out.stats
    assert [r["im_id"] for r in whole.accepted.collect()] == [r["im_id"] for r in out.accepted.collect()]


def test_class_sample_goes_on_after_failed_calls(spark, folder, tmp_path):
    store = ResultStore(spark, str(tmp_path / "classes"), ["im_id"])
    rows = pool(spark).withColumn("tags", F.lit("image_human:model"))
    first = staged.staged_class_sample(rows, 200, 50, ["ring"], staged.Asked(Classes(folder, "i3"), store))
    assert first.stats["exhausted"] and calls(folder).count("i3") == 1
    second = staged.staged_class_sample(rows, 200, 50, ["ring"], staged.Asked(Classes(folder), store))
    assert calls(folder).count("i3") == 2 and len(calls(folder)) == 101
    shown = {r["im_id"] for r in second.accepted.filter("gpt_reason = 'ring'").collect()}
    assert "i3" in shown and "i3" not in {r["im_id"] for r in first.accepted.filter("gpt_reason = 'ring'").collect()}


def test_empty_pools(spark, folder, tmp_path):
    none = pool(spark).limit(0)
    asked = staged.Asked(Classes(folder), ResultStore(spark, str(tmp_path / "c"), ["im_id"]))
    out = staged.staged_class_sample(none.withColumn("tags", F.lit("")), 5, 10, ["ring"], asked)
    assert out.accepted.count() == 0 and out.stats["exhausted"]
    tagger = staged.Asked(Tags(folder), ResultStore(spark, str(tmp_path / "t"), ["im_url"]))
    got = staged.staged_presence_sample(none, 5, 2, 3, tagger)
    assert got.evaluated.count() == 0 and got.stats["exhausted"] and calls(folder) == []


def test_presence_over_catalogs(spark, folder, tmp_path):
    """Three catalogs with the same images: the later ones have only content that nobody looked at yet."""
    tagger = staged.Asked(Tags(folder), ResultStore(spark, str(tmp_path / "tags"), ["im_url"]))
    rows = spark.createDataFrame([(f"u{i}", "bag", f"h{i}") for i in range(60)], "im_url string, category string, image_content_hash string")
    seen = staged.SeenContent(spark, str(tmp_path / "seen"))
    pools = {"a": rows, "b": rows, "c": rows.limit(0), "d": rows}
    out = staged.catalog_presence_samples(pools, 8, 2, 10, seen, tagger)
    stats = {r["catalog_name"]: r for r in out.stats.collect()}
    assert stats["a"]["accepted"] == 8 and stats["b"]["accepted"] == 8 and stats["c"]["exhausted"] and stats["c"]["evaluated"] == 0
    accepted = [(r["catalog_name"], r["im_url"]) for r in out.accepted.collect()]
    assert len({u for _, u in accepted}) == len(accepted)
    looked = {r["image_content_hash"] for r in out.evaluated.collect()}
    assert {r["image_content_hash"] for r in seen.among(rows).collect()} == looked
    made = calls(folder)
    assert len(made) == len(set(made)) == len(looked)


def test_lookups_read_their_buckets_only(spark, tmp_path):
    store = ResultStore(spark, str(tmp_path / "s"), ["k"], buckets=16)
    store.append(spark.range(200).select(F.col("id").alias("k"), F.lit("x").alias("v")), store.next_run())
    few = spark.createDataFrame([(3,), (500,)], "k int")
    plan = store.stored(few)._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull({BUCKET}" in plan or f"PartitionFilters: [{BUCKET}" in plan
    assert [r["k"] for r in store.stored(few).collect()] == [3]
    assert [r["k"] for r in store.pending(few).collect()] == [500]
    # A store opened with another number keeps that of its first append.
    other = ResultStore(spark, store.path, ["k"], buckets=4)
    assert other.buckets == 16 and other.pending(few).count() == 1


def test_compaction_keeps_the_last_result(spark, tmp_path):
    store = ResultStore(spark, str(tmp_path / "s"), ["k"], buckets=2)
    for n in range(3):
        store.append(spark.range(10 + n).select(F.col("id").alias("k"), F.lit(n).alias("v")), store.next_run())
    before = {(r["k"], r["v"]) for r in store.latest().collect()}
    assert sorted(store.compact(most_files=1)) == [0, 1] and store.compact(most_files=1) == []
    assert store.read().count() == 12 and {(r["k"], r["v"]) for r in store.latest().collect()} == before
    assert store.next_run() == 3


def test_claims(spark, tmp_path):
    store = ResultStore(spark, str(tmp_path / "s"), ["k"])
    df = spark.range(3).select(F.col("id").cast("string").alias("v"))
    with ThreadPoolExecutor(4) as pool_:
        runs = list(pool_.map(lambda _: store.next_run(), range(4)))
        paths = list(pool_.map(lambda _: sinks.write_version(df, str(tmp_path / "d"), "b"), range(4)))
    assert sorted(runs) == [0, 1, 2, 3]
    assert sorted(p.rsplit("/", 2)[1] for p in paths) == ["v1", "v2", "v3", "v4"]
    assert all(spark.read.option("header", True).csv(p).count() == 3 for p in paths)


def prompted(folder, broken=()):
    def load():
        def request(rows, prompts):
            log(folder, ",".join(sorted(str(r["im_id"]) for r in rows)) + "|" + ",".join(prompts))
            if any(r["im_id"] in broken for r in rows):
                raise RuntimeError("down")
            return [[{"name": p, "box": [0, 0, 30, 30]} for p in prompts] if r["im_id"] % 2 else [] for r in rows]

        return request

    return load


def test_requests_are_packed_and_cached(spark, folder, tmp_path):
    store = ResultStore(spark, str(tmp_path / "s"), KEYS)
    images = spark.range(10).select(F.col("id").alias("im_id"), F.lit("u").alias("im_url"))
    images = images.unionByName(images)
    model = Detector("m", prompted(folder), ("ring", "ear_ring", "belt"), class_aliases={"belt": ["sash"]}, per_prompt=2, batch=4)
    got = {r["im_id"]: [d["name"] for d in r["detections"]] for r in packed_detections(images, model, store, tasks=1).collect()}
    assert got == {i: ["ring", "ear_ring", "belt"] if i % 2 else [] for i in range(10)}
    made = calls(folder)
    # 10 images in requests of 4, two class groups.
    assert len(made) == 6 and {c.split("|")[1] for c in made} == {"ring,ear ring", "sash"}
    packed_detections(images, model, store).collect()
    assert calls(folder) == made
    # Other settings are asked anew, the size of requests doesn't matter.
    packed_detections(images, Detector("m", prompted(folder), model.classes, class_aliases=model.class_aliases, per_prompt=2, batch=1), store).collect()
    assert calls(folder) == made
    packed_detections(images, Detector("m", prompted(folder), ("ring",), batch=20), store, tasks=1).collect()
    assert len(calls(folder)) == 7


def test_failed_requests_are_split(spark, folder, tmp_path):
    store = ResultStore(spark, str(tmp_path / "s"), KEYS)
    images = spark.range(4).select(F.col("id").alias("im_id"))
    out = packed_detections(images, Detector("m", prompted(folder, {1}), ("ring",), batch=4), store, tasks=1)
    assert {r["im_id"]: len(r["detections"]) for r in out.collect()} == {0: 0, 1: 0, 2: 0, 3: 1}
    assert len(calls(folder)) == 5 and [r["im_id"] for r in store.failed().collect()] == [1]
    out = packed_detections(images, Detector("m", prompted(folder), ("ring",), batch=4), store)
    assert {r["im_id"]: len(r["detections"]) for r in out.collect()} == {0: 0, 1: 1, 2: 0, 3: 1}
    assert len(calls(folder)) == 6


def test_no_images_or_classes(spark, folder, tmp_path):
    store = ResultStore(spark, str(tmp_path / "s"), KEYS)
    images = spark.range(2).select(F.col("id").alias("im_id"))
    assert packed_detections(images.limit(0), Detector("m", prompted(folder), ("ring",)), store).count() == 0
    assert [r["detections"] for r in packed_detections(images, Detector("m", prompted(folder)), store).collect()] == [[], []]
    assert calls(folder) == []


class Judge(A.RowAnnotator):
    fields = ST.StructType([ST.StructField("is_valid", ST.BooleanType()), ST.StructField("reason", ST.StringType())])

    def __init__(self, folder, broken=None):
        self.folder, self.broken = folder, broken

    def process(self, row):
        log(self.folder, f"judge {row['im_id']}")
        if row["im_id"] == self.broken:
            raise RuntimeError("down")
        return {"is_valid": row["im_id"] != 7, "reason": ""}


def test_processed_images_make_no_call(spark, folder, tmp_path):
    cache = ProcessedCache.at(spark, str(tmp_path / "c"))
    verdicts = ResultStore(spark, str(tmp_path / "v"), ["im_id", "name", "box_text", "settings"])
    images = spark.range(8).select(F.col("id").alias("im_id"), F.lit("u").alias("im_url"), F.lit(60).alias("image_w"), F.lit(60).alias("image_h"))

    def run(broken=(), silent=None, plan=AnnotationPlan()):
        model = Detector("m", prompted(folder, set(broken)), ("ring",), batch=2)
        out = processed_boxes(images, [model], cache, plan, Judge(folder, silent), verdicts)
        return sorted((r["im_id"], r["name"]) for r in out.collect())

    # Image 3 fails in detection, image 5 in verification; both are worked on again, the others are not.
    assert run({3}, 5) == [(1, "ring")]
    made = len(calls(folder))
    assert run() == [(1, "ring"), (3, "ring"), (5, "ring")]
    later = calls(folder)
    assert len(later) == made + 3 and later.count("3|ring") == 2 and later.count("judge 5") == 2
    assert run() == [(1, "ring"), (3, "ring"), (5, "ring")] and calls(folder) == later
    # Another plan verifies again from the stored detections.
    assert run(plan=AnnotationPlan(per_class=3)) == [(1, "ring"), (3, "ring"), (5, "ring")]
    assert [c for c in calls(folder) if "|" in c] == [c for c in later if "|" in c]


def test_images_are_asked_for_their_own_classes(spark, folder, tmp_path):
    store = ResultStore(spark, str(tmp_path / "s"), KEYS)
    rows = spark.createDataFrame([(1, ["ring"]), (2, ["belt", "ring"]), (3, ["ring"]), (4, [])], "im_id long, wanted_classes array<string>")
    model = Detector("m", prompted(folder), ("ring", "belt"), batch=4)
    got = {r["im_id"]: [d["name"] for d in r["detections"]] for r in packed_detections(rows, model, store, tasks=1).collect()}
    assert got == {1: ["ring"], 2: [], 3: ["ring"], 4: []}
    assert calls(folder) == ["1,3|ring", "2|belt,ring"]
    packed_detections(rows, model, store).collect()
    assert len(calls(folder)) == 2
    # Another list of classes is another answer.
    packed_detections(rows.filter("im_id = 1").withColumn("wanted_classes", F.array(F.lit("belt"))), model, store).collect()
    assert calls(folder)[-1] == "2|belt,ring" and len(calls(folder)) == 3
