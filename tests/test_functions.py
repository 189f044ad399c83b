"""Literal cases of codecs, geometry and text rules."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from boxloom.functions import codecs as C
from boxloom.functions import geometry as G
from boxloom.functions import text as T


def one(spark, **columns):
    row = spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()
    return row if len(columns) > 1 else row[0]


def lit_box(*v):
    return G.Box(*[F.lit(float(x)) for x in v])


@pytest.mark.parametrize(
    "cell, expected",
    [(None, []), ("  ", []), ('["a", "b"]', ["a", "b"]), ("['a', 'b ']", ["a", "b"]), ("plain", ["plain"]), ("[broken", ["[broken"])],
)
def test_list_cells(spark, cell, expected):
    assert one(spark, x=C.list_cell(F.lit(cell).cast("string"))) == expected


@pytest.mark.parametrize(
    "boxes, concepts, names, firsts",
    [
        ("[10,20,30,40],[50,60,70,80]", "belt,bag", ["belt", "bag"], [10.0, 50.0]),
        ("10,20,30,40", "earring", ["earring"], [10.0]),
        ("[10,20,30,40],[50,60,70,80]", "belt", ["belt"], [10.0]),
        ("[10,20,30],[50,60,70,x],[1,2,3,4]", "belt,bag", ["belt"], [1.0]),
        (None, "belt", [], []),
        ("[1,2,3,4]", "", [], []),
    ],
)
def test_existing_detections(spark, boxes, concepts, names, firsts):
    found = one(spark, x=C.existing_detections(F.lit(boxes).cast("string"), F.lit(concepts)))
    assert [d["name"] for d in found] == names
    assert [d["box"][0] for d in found] == firsts
    assert all(d["score"] == 1.0 and d["source"] == "original" for d in found)


def test_multiplicity(spark):
    rows = one(spark, x=C.class_multiplicity(F.lit('["shoes","dress (multiple)"]')))
    assert {r["class_name"]: r["multiplicity"] for r in rows} == {"shoes": "singular", "dress": "multiple"}
    assert one(spark, x=C.class_multiplicity(F.lit(""))) == []


def test_overlap_measures(spark):
    big, inner, far = lit_box(0, 0, 10, 10), lit_box(0, 0, 5, 5), lit_box(20, 20, 30, 30)
    row = one(spark, a=G.io_min(big, inner), b=G.io_min(big, far), c=G.iou(big, inner), d=G.iou(big, lit_box(5, 5, 5, 5)))
    assert (row.a, row.b, row.c, row.d) == (1.0, 0.0, 0.25, 0.0)


def test_area_and_rounding(spark):
    assert one(spark, x=G.area(lit_box(10, 10, 5, 5))) == 0.0
    assert one(spark, x=G.ordering_area(lit_box(10, 10, 5, 5))) == 25.0
    row = one(spark, **dict(zip("abcd", G.pixels(lit_box(10.1, 20.9, 30.5, 40.0)))))
    assert tuple(row) == (10, 21, 30, 40)


def test_crop_rectangle(spark):
    none = F.lit(None).cast("int")
    rect = G.crop_rectangle(lit_box(10, 10, 20, 20), F.lit(100), F.lit(100), F.lit(0.1), none, none)
    assert tuple(one(spark, **dict(zip("abcd", rect)))) == (9, 9, 21, 21)
    tiny = G.crop_rectangle(lit_box(10.2, 10.2, 10.4, 14.0), F.lit(100), F.lit(100), F.lit(0.0), none, none)
    assert tuple(one(spark, **dict(zip("abcd", tiny)))) == (10, 10, 10, 14)


def test_upscaled_size(spark):
    w, h = G.upscaled_size(F.lit(4), F.lit(4), F.lit(64), F.lit(96))
    row = one(spark, w=w, h=h)
    assert min(row) >= 64 and max(row) >= 96
    same = G.upscaled_size(F.lit(200), F.lit(300), F.lit(64), F.lit(96))
    assert tuple(one(spark, w=same[0], h=same[1])) == (200, 300)


def test_grown_box_without_image_size(spark):
    null = F.lit(None).cast("double")
    grown = G.grown_to_area(lit_box(0, 0, 2, 2), F.lit(16.0), null, null)
    # Unknown image: only the lower edge is clamped.
    assert tuple(one(spark, **dict(zip("abcd", grown)))) == (0.0, 0.0, 3.0, 3.0)


def test_clipped_boxes(spark):
    assert one(spark, x=C.clipped_boxes(F.lit("[-1,2,3,4],[1,2,3],[5,6,7,-8]"))) == "[0,2,3,4],[5,6,7,0]"
    # A decimal counts as two integers, so the entry has five and is dropped.
    assert one(spark, x=C.clipped_boxes(F.lit("[12.5,2,3,4]"))) == ""


@pytest.mark.parametrize("text", ["Co-Ord sets", "women's TOP", "3d print", "élan vital", ""])
def test_title_case(spark, text):
    assert one(spark, x=T.title_case(F.lit(text))) == text.title()


def test_reasons_round_trip(spark):
    assert one(spark, x=C.box_reasons(F.lit('["a",manual_bbox_added,loose,"b, c"]'))) == ["a", "manual_bbox_added", "loose", "b, c"]
    assert one(spark, x=C.reasons_text(F.array(F.lit('say "x"'), F.lit("manual_bbox_added")))) == '["say ""x""",manual_bbox_added]'


def test_names_and_modes(spark):
    assert T.run_mode(" Full ") == "full"
    with pytest.raises(ValueError):
        T.run_mode("half")
    assert T.class_groups(["a", "b", "c"], 2, {"a": ["x", "y"]}) == [["x", "y", "b"], ["c"]]
    assert T.class_groups(["a", "b"]) == [["a", "b"]]
    assert T.class_groups(["a", "b"], 1, {"b": ["z"]}, given=[["b", "a"]]) == [["z", "a"]]
    assert T.class_of_alias({"a": ["big hat", " ", None], "b": None}) == {"big hat": "a", "big_hat": "a"}
    assert T.run_stamp(dt.datetime(2024, 5, 3, 14, 7)) == "1407_030524"
    assert T.dataset_label("/data/cool_brand/spring-sample") == "cool brand spring"
    assert one(spark, x=T.full_model_name(F.lit("Nano"))) == "gpt-4.1-nano"
    assert one(spark, x=T.full_model_name(F.lit("other-model"))) == "other-model"
    assert T.settings_hash({"b": 1, "a": 2}) == T.settings_hash({"a": 2, "b": 1})


def test_flags(spark):
    assert one(spark, x=T.flag_of(F.lit("[flagged blurry] no"))) == "blurry"
    assert one(spark, x=T.without_flag(F.lit("[FLAGGED BLURRY] no"))) == "no"
    assert one(spark, x=T.flagged_reason(F.lit(False), F.lit("Out of FOCUS"))) == "[FLAGGED BLURRY] Out of FOCUS"
    assert one(spark, x=T.flagged_reason(F.lit(True), F.lit("blurry"))) == "blurry"


def test_hosted_key(spark):
    key = "0123456789abcdef0123456789abcdef"
    pattern = r"^https?://img\.test/o/([0-9a-f]{32})$"
    assert one(spark, x=T.hosted_image_key(F.lit(f"https://img.test/o/{key}"), pattern)) == key
    assert one(spark, x=T.hosted_image_key(F.lit(key), pattern)) == key
    with pytest.raises(Exception, match="not a hosted image"):
        one(spark, x=T.hosted_image_key(F.lit("nothing"), pattern))


def test_stored_image_id(spark):
    import hashlib

    assert one(spark, x=T.image_id(F.lit("http://x"))) == hashlib.md5(b"http://x").hexdigest()[:16]
    assert one(spark, x=T.catalog_image_id(F.lit("c"), F.lit("p"), F.lit("u"))) == hashlib.md5(b"c|p|u").hexdigest()[:16]
