"""Compact, clean, verify, measure, split; ground truth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom.functions import codecs as C
from boxloom.operators import dataset as D
from boxloom.operators import gallery
from boxloom.operators.rollup import gathered
from boxloom.operators.strata import stratified_split
from checks.registry import query
from checks.views import detections, table

# A dirty row: blank concepts, placeholder boxes, negative corners, repeated boxes.
DIRTY_BOXES = """SELECT im_id, pos, CASE WHEN pos % 7 = 0 THEN '' WHEN im_id % 10 = 3 THEN 'other' ELSE name END AS c,
    CASE WHEN pos % 5 = 0 OR im_id % 17 = 0 THEN '[0,0,0,0]' WHEN pos % 6 = 0 THEN '[-3,1,9,9]'
         ELSE '[' || CAST(x1 AS BIGINT) || ',' || CAST(y1 AS BIGINT) || ', ' || CAST(x2 AS BIGINT) || ',' || CAST(y2 AS BIGINT) || ']' END AS b,
    CASE WHEN pos % 4 = 2 THEN 'precision' WHEN pos % 4 = 3 THEN 'recall' ELSE 'no_issue' END AS t,
    source AS s FROM detections
  UNION ALL SELECT im_id, pos + 100000, 'ring', '[5,5,20,20]', 'no_issue', 'human' FROM detections WHERE pos = 1 AND im_id % 4 = 0
  UNION ALL SELECT im_id, pos + 200000, 'ring', '[5,5, 20,20]', 'no_issue', 'human' FROM detections WHERE pos = 1 AND im_id % 4 = 0"""


def dirty_boxes(spark, sf) -> DataFrame:
    d = detections(spark, sf)
    x1, y1, x2, y2 = [F.col(c).cast("long").cast("string") for c in ("x1", "y1", "x2", "y2")]
    text = F.concat(F.lit("["), x1, F.lit(","), y1, F.lit(", "), x2, F.lit(","), y2, F.lit("]"))
    one = F.struct(
        "pos",
        F.when(F.col("pos") % 7 == 0, "").when(F.col("im_id") % 10 == 3, "other").otherwise(F.col("name")).alias("c"),
        F.when((F.col("pos") % 5 == 0) | (F.col("im_id") % 17 == 0), "[0,0,0,0]").when(F.col("pos") % 6 == 0, "[-3,1,9,9]").otherwise(text).alias("b"),
        F.when(F.col("pos") % 4 == 2, "precision").when(F.col("pos") % 4 == 3, "recall").otherwise("no_issue").alias("t"),
        F.col("source").alias("s"),
    )
    more = [
        F.struct((F.col("pos") + shift).alias("pos"), F.lit("ring").alias("c"), F.lit(box).alias("b"), F.lit("no_issue").alias("t"), F.lit("human").alias("s"))
        for shift, box in ((100000, "[5,5,20,20]"), (200000, "[5,5, 20,20]"))
    ]
    # Further boxes beside the first one, not from scans of their own: boxes stay dealt by image.
    entries = F.when((F.col("pos") == 1) & (F.col("im_id") % 4 == 0), F.array(one, *more)).otherwise(F.array(one))
    return d.select("im_id", F.inline(entries))


def dirty_rows(spark, sf) -> DataFrame:
    rows = gathered(dirty_boxes(spark, sf), ["im_id"], "pos", F.struct("c", "b", "t", "s"))

    def joined(f: str):
        return F.array_join(F.transform("items", lambda x: x[f]), ",")

    return rows.select(
        F.col("im_id").alias("row_id"),
        F.concat(F.lit("http://img.test/"), F.col("im_id").cast("string"), F.lit(".jpg")).alias("im_url"),
        F.concat(F.lit("image "), (F.col("im_id") % 500).cast("string")).alias("im_name"),
        F.col("im_id").cast("string").alias("im_id"),
        joined("c").alias("concepts"), joined("b").alias("boxes"), joined("t").alias("issue_types"), joined("s").alias("box_sources"),
    )


# Compacting keeps entry i of a column where concept i is not blank.
COMPACT = f"SELECT * FROM ({DIRTY_BOXES}) WHERE trim(c) <> ''"
FIRSTS = f"""SELECT *, row_number() OVER (PARTITION BY im_id, replace(b, ' ', ''), c ORDER BY pos) AS copy
  FROM ({COMPACT}) WHERE replace(b, ' ', '') <> '[0,0,0,0]'"""
KEPT = f"""SELECT f.* FROM ({FIRSTS}) f JOIN (SELECT im_id, count(*) AS n, max(c) AS c FROM ({FIRSTS}) WHERE copy = 1 GROUP BY im_id) k
  ON k.im_id = f.im_id WHERE f.copy = 1 AND NOT (k.n = 1 AND k.c = 'other')"""


@query(
    "e3_compact",
    f"""SELECT r.im_id AS row_id, coalesce(string_agg(c, ',' ORDER BY pos), '') AS concepts, coalesce(string_agg(b, ',' ORDER BY pos), '') AS boxes,
        coalesce(string_agg(s, ',' ORDER BY pos), '') AS box_sources, r.n - count(c) AS compacted
        FROM (SELECT im_id, count(*) AS n FROM ({DIRTY_BOXES}) GROUP BY im_id) r LEFT JOIN ({COMPACT}) e ON e.im_id = r.im_id GROUP BY r.im_id, r.n""",
)
def e3(spark, sf):
    return D.compacted(dirty_rows(spark, sf)).select("row_id", "concepts", "boxes", "box_sources", F.col("compacted").cast("long").alias("compacted"))


@query(
    "e4_clean",
    f"""SELECT im_id AS row_id, string_agg(c, ',' ORDER BY pos) AS concepts, string_agg(b, ',' ORDER BY pos) AS boxes,
        string_agg(t, ',' ORDER BY pos) AS issue_types FROM ({KEPT}) GROUP BY im_id""",
)
def e4(spark, sf):
    out = D.cleaned(dirty_rows(spark, sf)).filter("status = 'kept'")
    return out.select("row_id", "concepts", "boxes", "issue_types")


@query(
    "a14_cleaning_stats",
    f"""WITH r AS (SELECT im_id FROM ({DIRTY_BOXES}) GROUP BY im_id), f AS ({FIRSTS}),
        p AS (SELECT im_id, count(*) AS n, max(c) AS c FROM f WHERE copy = 1 GROUP BY im_id)
        SELECT (SELECT count(*) FROM r) AS input_rows,
          (SELECT count(*) FROM ({DIRTY_BOXES}) WHERE trim(c) = '') AS compacted,
          (SELECT count(*) FROM ({COMPACT}) WHERE b = '[0,0,0,0]') AS zero_boxes,
          (SELECT count(*) FROM f WHERE copy > 1) AS duplicate_boxes,
          (SELECT count(*) FROM r WHERE im_id NOT IN (SELECT im_id FROM p)) AS empty_rows,
          (SELECT count(*) FROM p WHERE n = 1 AND c = 'other') AS single_other_rows,
          (SELECT count(*) FROM p WHERE NOT (n = 1 AND c = 'other')) AS kept_rows""",
)
def a14(spark, sf):
    return D.cleaning_stats(D.cleaned(dirty_rows(spark, sf)))


@query(
    "e5_verify",
    f"""WITH b AS (SELECT *, row_number() OVER (PARTITION BY im_id ORDER BY pos) AS i, trim(c) = '' AS blank FROM ({DIRTY_BOXES})),
    cc AS (SELECT im_id, c, row_number() OVER (PARTITION BY im_id ORDER BY pos) AS i FROM ({COMPACT})),
    k AS (SELECT b.im_id, replace(b.b, ' ', '') AS box, coalesce(cc.c, '') AS c FROM b LEFT JOIN cc USING (im_id, i))
    SELECT * FROM (
      SELECT im_id AS row_id, 'negative_coordinate' AS rule, count(*) AS count FROM b WHERE b LIKE '%-%' GROUP BY im_id
      UNION ALL SELECT im_id, 'zero_box', count(*) FROM b WHERE b = '[0,0,0,0]' GROUP BY im_id
      UNION ALL SELECT im_id, 'duplicate_box', count(*) - count(DISTINCT box || c) FROM k GROUP BY im_id
      UNION ALL SELECT im_id, 'blank_concept', count(*) FROM b WHERE blank GROUP BY im_id
      UNION ALL SELECT im_id, 'count_mismatch', CASE WHEN count(*) FILTER (blank) > 0 THEN 1 ELSE 0 END FROM b GROUP BY im_id
      UNION ALL SELECT im_id, 'single_other', CASE WHEN count(*) = 1 AND max(c) = 'other' THEN 1 ELSE 0 END FROM b GROUP BY im_id)
    WHERE count > 0""",
)
def e5(spark, sf):
    return D.violations(dirty_rows(spark, sf))


@query(
    "e6_published",
    f"""SELECT im_id AS row_id, string_agg(c, ',' ORDER BY pos) AS concepts, '' AS im_description, '' AS labels,
        string_agg(replace(regexp_replace(b, '-[0-9]+', '0', 'g'), ' ', ''), ',' ORDER BY pos) AS boxes FROM ({KEPT}) GROUP BY im_id""",
)
def e6(spark, sf):
    out = D.published_rows(D.cleaned(dirty_rows(spark, sf)))
    return out.select("row_id", "concepts", "im_description", "labels", "boxes")


CLASS_ROWS = ", ".join(f"({i}, '{c}')" for i, c in enumerate(D.CLASSES))


@query(
    "a3_distribution",
    f"""SELECT CAST(k.place AS INTEGER) AS place, k.concept, count(d.c) AS boxes, count(DISTINCT d.im_id) AS images
        FROM (VALUES {CLASS_ROWS}) AS k(place, concept) LEFT JOIN ({COMPACT}) d ON trim(d.c) = k.concept GROUP BY ALL""",
)
def a3(spark, sf):
    return D.distribution(dirty_rows(spark, sf))


@query("a3_unlisted", f"SELECT c AS concept, count(*) AS boxes, count(DISTINCT im_id) AS images FROM ({COMPACT}) WHERE c = 'other' GROUP BY c")
def a3_unlisted(spark, sf):
    return D.unlisted_classes(dirty_rows(spark, sf))


@query(
    "a5_prevalence",
    f"""SELECT c AS concept, count(DISTINCT im_id) AS support,
        round(count(DISTINCT im_id) / CAST((SELECT count(DISTINCT im_id) FROM detections) AS DOUBLE), 6) AS share FROM ({COMPACT}) GROUP BY c""",
)
def a5(spark, sf):
    return D.prevalence(dirty_rows(spark, sf)).select("concept", "support", F.round("share", 6).alias("share"))


def bucketed(spark, sf) -> DataFrame:
    """Rows with a given split, to measure drift."""
    rows = dirty_rows(spark, sf)
    return rows.withColumn("split", F.when(F.col("row_id") % 10 < 8, "train").when(F.col("row_id") % 10 == 8, "val").otherwise("test"))


@query(
    "a7_drift",
    f"""WITH s AS (SELECT DISTINCT im_id, CASE WHEN im_id % 10 < 8 THEN 'train' WHEN im_id % 10 = 8 THEN 'val' ELSE 'test' END AS split FROM detections),
    n AS (SELECT split, count(*) AS n FROM s GROUP BY split), c AS (SELECT DISTINCT im_id, c FROM ({COMPACT})),
    p AS (SELECT c.c AS concept, count(*) / CAST((SELECT sum(n) FROM n) AS DOUBLE) AS f,
      count(*) FILTER (split = 'train') / CAST((SELECT n FROM n WHERE split = 'train') AS DOUBLE) AS tr,
      count(*) FILTER (split = 'val') / CAST((SELECT n FROM n WHERE split = 'val') AS DOUBLE) AS va,
      count(*) FILTER (split = 'test') / CAST((SELECT n FROM n WHERE split = 'test') AS DOUBLE) AS te
      FROM c JOIN s USING (im_id) GROUP BY c.c)
    SELECT concept, round(f, 6) AS "full", round(tr, 6) AS train, round(va, 6) AS val, round(te, 6) AS test,
      round(greatest(abs(tr - f), abs(va - f), abs(te - f)), 6) AS max_drift FROM p""",
)
def a7(spark, sf):
    drift = D.split_drift(bucketed(spark, sf))
    return drift.select("concept", *[F.round(c, 6).alias(c) for c in ("full", "train", "val", "test", "max_drift")])


@query(
    "a19_split_shares",
    """WITH s AS (SELECT DISTINCT im_id, CASE WHEN im_id % 10 < 8 THEN 'train' WHEN im_id % 10 = 8 THEN 'val' ELSE 'test' END AS split FROM detections)
       SELECT split, count(*) AS rows, round(count(*) * 100.0 / CAST((SELECT count(*) FROM s) AS DOUBLE), 6) AS percent FROM s GROUP BY split""",
)
def a19(spark, sf):
    return D.split_shares(bucketed(spark, sf)).select("split", "rows", F.round("percent", 6).alias("percent"))


SPLIT = f"""WITH c AS (SELECT DISTINCT im_id, c FROM ({COMPACT})), n AS (SELECT c, count(*) AS s FROM c GROUP BY c),
    t AS (SELECT im_id, c AS stratum FROM (SELECT im_id, c.c, row_number() OVER (PARTITION BY im_id ORDER BY s, c.c) AS place FROM c JOIN n USING (c)) WHERE place = 1),
    r AS (SELECT d.im_id, coalesce(t.stratum, '') AS stratum FROM (SELECT DISTINCT im_id FROM detections) d LEFT JOIN t ON t.im_id = d.im_id),
    k AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY md5(im_id || '|42'), im_id) AS place FROM r),
    o AS (SELECT im_id, (place - 1 + CAST('0x' || substr(md5(stratum), 1, 4) AS INTEGER)) % 10 AS slot FROM k)
    SELECT im_id AS row_id, CASE WHEN slot < 8 THEN 'train' WHEN slot = 8 THEN 'val' ELSE 'test' END AS split FROM o"""


@query("w16_split", SPLIT)
def w16(spark, sf):
    return D.split_rows(dirty_rows(spark, sf)).select("row_id", "split")


@query("w16_stratified")
def w16_stratified(spark, sf):
    """Iterative stratification; its rounds have no SQL form, tests hold it against a plain walk over rows."""
    return stratified_split(dirty_rows(spark, sf)).select("row_id", "split")


@query(
    "f18_fix_precision",
    f"""SELECT r.im_id AS row_id, coalesce(string_agg(c, ',' ORDER BY pos), '') AS concepts, coalesce(string_agg(b, ',' ORDER BY pos), '') AS boxes,
        coalesce(string_agg(t, ',' ORDER BY pos), '') AS issue_types FROM (SELECT DISTINCT im_id FROM detections) r
        LEFT JOIN (SELECT * FROM ({DIRTY_BOXES}) WHERE t <> 'precision') e ON e.im_id = r.im_id GROUP BY r.im_id""",
)
def f18(spark, sf):
    return D.without_precision_issues(dirty_rows(spark, sf)).select("row_id", "concepts", "boxes", "issue_types")


@query(
    "e7_box_editor",
    f"""WITH d AS (SELECT *, b = '[0,0,0,0]' AS zero FROM ({DIRTY_BOXES})),
    m AS (SELECT im_id, string_agg(c, '|' ORDER BY p) AS missing FROM (SELECT im_id, c, min(pos) AS p FROM d WHERE t = 'recall' GROUP BY im_id, c) GROUP BY im_id)
    SELECT d.im_id AS row_id, coalesce(string_agg(c, '|' ORDER BY pos) FILTER (NOT zero), '') AS concepts,
      coalesce(string_agg(replace(b, ' ', ''), '|' ORDER BY pos) FILTER (NOT zero), '') AS boxes,
      coalesce(max(m.missing), '') AS missing_concepts, CASE WHEN max(m.im_id) IS NULL THEN '' ELSE 'recall' END AS filter_reasons
    FROM d LEFT JOIN m ON m.im_id = d.im_id GROUP BY d.im_id""",
)
def e7(spark, sf):
    out = D.box_editor_rows(dirty_rows(spark, sf))
    boxes = F.transform("boxes", lambda b: F.concat(F.lit("["), F.array_join(b.cast("array<string>"), ","), F.lit("]")))
    return out.select(
        "row_id", F.array_join("concepts", "|").alias("concepts"), F.array_join(boxes, "|").alias("boxes"),
        F.array_join("missing_concepts", "|").alias("missing_concepts"), F.array_join("filter_reasons", "|").alias("filter_reasons"),
    )


@query(
    "f24_recall_items",
    f"SELECT count(DISTINCT im_id) AS images FROM ({DIRTY_BOXES}) WHERE t = 'recall'",
)
def f24_recall(spark, sf):
    return gallery.items_with_issue(D.box_editor_rows(dirty_rows(spark, sf)), "recall").agg(F.count(F.lit(1)).alias("images"))


@query(
    "e8_viewer",
    f"""WITH b AS (SELECT *, row_number() OVER (PARTITION BY im_id ORDER BY pos) AS i FROM ({DIRTY_BOXES})),
    c AS (SELECT im_id, c, row_number() OVER (PARTITION BY im_id ORDER BY pos) AS i FROM ({COMPACT}))
    SELECT r.im_id AS row_id, coalesce(string_agg(c.c || replace(b.b, ' ', ''), '|' ORDER BY i) FILTER (b.b <> '[0,0,0,0]'), '') AS annotations
    FROM (SELECT DISTINCT im_id FROM detections) r LEFT JOIN (c JOIN b USING (im_id, i)) ON c.im_id = r.im_id GROUP BY r.im_id""",
)
def e8(spark, sf):
    out = D.viewer_rows(dirty_rows(spark, sf))
    text = F.transform(
        "annotations", lambda a: F.concat(a["concept"], F.lit("["), F.array_join(a["box"].cast("array<string>"), ","), F.lit("]"))
    )
    return out.select("row_id", F.array_join(text, "|").alias("annotations"))


@query(
    "c5_existing",
    f"""WITH b AS (SELECT *, row_number() OVER (PARTITION BY im_id ORDER BY pos) AS i FROM ({DIRTY_BOXES})),
    c AS (SELECT im_id, c, row_number() OVER (PARTITION BY im_id ORDER BY pos) AS i FROM ({COMPACT}))
    SELECT im_id AS row_id, i - 1 AS at, c.c AS name, replace(b.b, ' ', '') AS box FROM c JOIN b USING (im_id, i)""",
)
def c5(spark, sf):
    found = C.existing_detections(F.col("boxes"), F.col("concepts"))
    out = dirty_rows(spark, sf).select("row_id", F.posexplode(found).alias("at", "d"))
    box = F.concat(F.lit("["), F.array_join(F.col("d.box").cast("array<bigint>").cast("array<string>"), ","), F.lit("]"))
    return out.select("row_id", F.col("at").cast("long").alias("at"), F.col("d.name").alias("name"), box.alias("box"))


PAIRS = f"""SELECT c.im_id, c.c AS concept, replace(b.b, ' ', '') AS box, i
  FROM (SELECT *, row_number() OVER (PARTITION BY im_id ORDER BY pos) AS i FROM ({DIRTY_BOXES})) b
  JOIN (SELECT im_id, c, row_number() OVER (PARTITION BY im_id ORDER BY pos) AS i FROM ({COMPACT})) c USING (im_id, i)"""


@query(
    "a15_ground_truth",
    f"""WITH k AS (SELECT *, CASE WHEN im_id % 3 = 0 THEN NULL ELSE 'image ' || (im_id % 500) END AS nm FROM ({PAIRS})),
    u AS (SELECT im_id, 'unknown_' || (row_number() OVER (ORDER BY im_id) - 1) AS nm FROM (SELECT DISTINCT im_id FROM detections WHERE im_id % 9 = 0))
    SELECT coalesce(k.nm, u.nm, CAST(k.im_id AS VARCHAR)) AS product, 'http://img.test/' || k.im_id || '.jpg' AS im_url, k.concept, k.box,
      min(k.im_id) AS row FROM k LEFT JOIN u ON u.im_id = k.im_id GROUP BY ALL""",
)
def a15(spark, sf):
    """Product key: name, else id, else a counter."""
    rows = dirty_rows(spark, sf)
    rows = rows.withColumn("im_name", F.when(F.col("row_id") % 3 != 0, F.col("im_name")))
    rows = rows.withColumn("im_id", F.when(F.col("row_id") % 9 == 0, "nan").otherwise(F.col("im_id")))
    gt = D.ground_truth(rows)
    box = F.concat(F.lit("["), F.array_join(F.col("box").cast("array<bigint>").cast("array<string>"), ","), F.lit("]"))
    return gt.select("product", "im_url", "concept", box.alias("box"), "row")


@query(
    "a17_product_items",
    f"""SELECT 'image ' || (im_id % 500) AS product, string_agg(concept || box, '|' ORDER BY im_id, i) AS items
        FROM (SELECT im_id, concept, box, min(i) AS i FROM ({PAIRS}) GROUP BY ALL) GROUP BY 1""",
)
def a17(spark, sf):
    out = D.product_json(D.ground_truth(dirty_rows(spark, sf)))
    items = F.from_json("items", "array<struct<im_url:string,box_concept:string,box:array<double>>>")
    text = F.transform(
        items, lambda a: F.concat(a["box_concept"], F.lit("["), F.array_join(a["box"].cast("array<bigint>").cast("array<string>"), ","), F.lit("]"))
    )
    return out.select("product", F.array_join(text, "|").alias("items"))


@query(
    "a16_nested_truth",
    """SELECT CAST(im_id % 300 AS VARCHAR) AS product, 'u' || im_id AS im_url, CASE name WHEN 'ring' THEN 'finger_ring' ELSE name END AS concept,
       x1, y2 FROM detections WHERE pos % 5 <> 0""",
)
def a16(spark, sf):
    """Items written as Python-like text, some with an unreadable box; one class renamed."""
    d = detections(spark, sf)
    box = F.when(F.col("pos") % 5 == 0, "1,2").otherwise(F.concat_ws(",", *[F.col(c).cast("string") for c in ("x1", "y1", "x2", "y2")]))
    cell = F.concat(
        F.lit("[{'im_url': 'u"), F.col("im_id").cast("string"), F.lit("', 'box': '"), box, F.lit("', 'box_concept': '"), F.col("name"), F.lit("'}]")
    )
    rows = d.select((F.col("im_id") % 300).cast("string").alias("product"), cell.alias("search_gt_outfits"))
    gt = D.nested_ground_truth(rows, renamed={"ring": "finger_ring"})
    return gt.select("product", "im_url", "concept", F.get("box", F.lit(0)).alias("x1"), F.get("box", F.lit(3)).alias("y2"))


@query(
    "f19_only_products",
    f"SELECT DISTINCT 'image ' || (im_id % 500) AS product, concept FROM ({PAIRS}) WHERE 'image ' || (im_id % 500) IN (SELECT 'image ' || p_partkey FROM part WHERE p_type = 'PROMO')",
)
def f19(spark, sf):
    wanted = table(spark, sf, "part").filter("p_type = 'PROMO'").select(F.concat(F.lit("image "), F.col("p_partkey").cast("string")).alias("product"))
    return D.only_products(D.ground_truth(dirty_rows(spark, sf)), wanted).select("product", "concept").distinct()


REASONS = """SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '["seen",manual_bbox_added,"' || lang || '"]'
    WHEN 1 THEN '[loose text,"' || source || '"]' WHEN 2 THEN '' ELSE '["a, b" , "' || lang || ' x"]' END AS cell, lang, source FROM documents"""


@query(
    "c13_reasons",
    f"""SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'seen|manual_bbox_added|' || lang WHEN 1 THEN 'loose text|' || source WHEN 2 THEN ''
        ELSE 'a, b|' || lang || ' x' END AS items,
        CASE doc_id % 4 WHEN 0 THEN '["seen",manual_bbox_added,"' || lang || '"]' WHEN 1 THEN '["loose text","' || source || '"]'
        WHEN 2 THEN '[]' ELSE '["a, b","' || lang || ' x"]' END AS written FROM ({REASONS})""",
)
def c13(spark, sf):
    kind = F.col("doc_id") % 4
    cell = (
        F.when(kind == 0, F.concat(F.lit('["seen",manual_bbox_added,"'), "lang", F.lit('"]')))
        .when(kind == 1, F.concat(F.lit('[loose text,"'), "source", F.lit('"]')))
        .when(kind == 2, "")
        .otherwise(F.concat(F.lit('["a, b" , "'), "lang", F.lit(' x"]')))
    )
    items = C.box_reasons(cell)
    docs = table(spark, sf, "documents").select("doc_id", items.alias("i"))
    return docs.select("doc_id", F.array_join("i", "|").alias("items"), C.reasons_text(F.col("i")).alias("written"))
