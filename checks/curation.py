"""Issues, roll-up, review, corrections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom.functions import codecs as C
from boxloom.functions import geometry as G
from boxloom.operators import clusters, dataset, gallery, issues, review, rollup
from boxloom.plans import annotation
from checks.registry import query
from checks.views import annotations, detections, images, plain_annotations

CORNERS = list(G.Box._fields)
RELEVANT = ["ring", "earring"]


def summary(spark, sf) -> DataFrame:
    return clusters.cluster_summary(clusters.overlap_clusters(detections(spark, sf), 0.5))


SEEN = "EXISTS (SELECT 1 FROM visible v WHERE v.im_id = c.im_id AND v.name = c.top_class)"
WRONG = f"(c.top_class IN ('ring', 'earring') AND NOT {SEEN})"


@query(
    "j12_precision",
    f"""SELECT c.im_id, c.cluster_id, c.top_class, CASE WHEN {WRONG} THEN 'fp_incorrect' ELSE 'no_issue' END AS box_status,
        CASE WHEN {WRONG} THEN 'precision' ELSE 'no_issue' END AS issue_type,
        coalesce('seen by ' || o.o_custkey, '') AS gpt_reason
        FROM confident c LEFT JOIN orders o ON o.o_orderkey = c.im_id""",
)
def j12(spark, sf):
    out = issues.labelled_detections(summary(spark, sf), plain_annotations(spark, sf), RELEVANT)
    return out.select("im_id", "cluster_id", "top_class", "box_status", "issue_type", "gpt_reason")


MISSED = """SELECT v.im_id, v.name AS top_class FROM visible v WHERE v.name IN ('ring', 'earring')
  AND NOT EXISTS (SELECT 1 FROM confident c WHERE c.im_id = v.im_id AND c.top_class = v.name)"""


@query("j11_recall", MISSED)
def j11(spark, sf):
    return issues.missed_classes(summary(spark, sf), plain_annotations(spark, sf), RELEVANT).select("im_id", "top_class")


@query(
    "e11_issue_counts",
    f"""WITH t AS (SELECT CASE WHEN {WRONG} THEN 'precision' ELSE 'no_issue' END AS issue_type, c.top_class, c.im_id FROM confident c
        UNION ALL SELECT 'recall', top_class, im_id FROM ({MISSED}))
        SELECT issue_type, top_class, count(*) AS boxes, count(DISTINCT im_id) AS images FROM t GROUP BY ALL""",
)
def e11(spark, sf):
    table = issues.issue_table(summary(spark, sf), plain_annotations(spark, sf), RELEVANT)
    per_image = table.groupBy("issue_type", "top_class", "im_id").agg(F.count(F.lit(1)).alias("n"))
    return per_image.groupBy("issue_type", "top_class").agg(F.sum("n").alias("boxes"), F.count(F.lit(1)).alias("images"))


CONFIRMED = """SELECT d.im_id, d.pos, d.name, d.x1, d.y1, d.x2, d.y2, d.score, 'model' AS source FROM detections d
  JOIN images i ON i.im_id = d.im_id
  WHERE d.name NOT IN ('ring', 'earring') OR EXISTS (SELECT 1 FROM visible v WHERE v.im_id = d.im_id AND v.name = d.name)"""
SHORT = f"""SELECT v.im_id, v.name AS class_name, v.multiplicity, count(c.pos) AS found
  FROM visible v LEFT JOIN ({CONFIRMED}) c ON c.im_id = v.im_id AND c.name = v.name
  WHERE v.name IN ('ring', 'earring') GROUP BY ALL
  HAVING (v.multiplicity = 'multiple' AND count(c.pos) <= 1) OR (v.multiplicity = 'singular' AND count(c.pos) = 0)"""


def confirmed(spark, sf) -> DataFrame:
    d = detections(spark, sf).withColumn("top_class", F.upper("name"))
    return issues.confirmed_detections(d, annotations(spark, sf), RELEVANT)


@query("j13_confirmed", f"SELECT im_id, pos, name FROM ({CONFIRMED})")
def j13(spark, sf):
    return confirmed(spark, sf).select("im_id", "pos", "name")


@query("a13_multiplicity", SHORT)
def a13(spark, sf):
    return issues.classes_to_recover(confirmed(spark, sf), annotations(spark, sf), RELEVANT)


@query(
    "a4_visible_counts",
    "SELECT name AS class_name, count(*) AS images, (SELECT count(*) FROM orders) AS total_images FROM visible GROUP BY name",
)
def a4(spark, sf):
    return issues.visible_class_counts(annotations(spark, sf))


ROLLUP = """SELECT 'http://img.test/' || im_id || '.jpg' AS im_url, string_agg(name, ',' ORDER BY pos) AS concepts,
  string_agg('[' || CAST(x1 AS BIGINT) || ',' || CAST(y1 AS BIGINT) || ',' || CAST(x2 AS BIGINT) || ',' || CAST(y2 AS BIGINT) || ']', ',' ORDER BY pos) AS boxes,
  string_agg('true', ',') AS optional, string_agg('no_issue', ',') AS box_statuses, string_agg(source, ',' ORDER BY pos) AS box_sources,
  '[' || string_agg('"box ' || pos || '"', ',' ORDER BY pos) || ']' AS box_reasons
  FROM ({boxes}) GROUP BY im_id"""


def as_rows(d: DataFrame) -> DataFrame:
    return d.select(
        "pos",
        F.concat(F.lit("http://img.test/"), F.col("im_id").cast("string"), F.lit(".jpg")).alias("im_url"),
        "im_id",
        F.lit("").alias("im_name"),
        F.lit("").alias("im_description"),
        F.col("name").alias("top_class"),
        F.array(*CORNERS).alias("top_box"),
        F.col("source").alias("box_source"),
        F.concat(F.lit("box "), F.col("pos").cast("string")).alias("gpt_reason"),
    )


ROLLED = ["im_url", "concepts", "boxes", "optional", "box_statuses", "box_sources", "box_reasons"]


@query("a9_rollup", ROLLUP.replace("{boxes}", "SELECT * FROM detections"))
def a9(spark, sf):
    return rollup.image_rows(as_rows(detections(spark, sf))).select(*ROLLED)


@query(
    "a9_annotated_rows",
    """SELECT i.im_id, string_agg(d.name, ',' ORDER BY d.pos) AS concepts,
       string_agg('[' || CAST(x1 AS BIGINT) || ',' || CAST(y1 AS BIGINT) || ',' || CAST(x2 AS BIGINT) || ',' || CAST(y2 AS BIGINT) || ']', ',' ORDER BY d.pos) AS boxes
       FROM images i LEFT JOIN (SELECT * FROM detections WHERE score > 0.5) d ON d.im_id = i.im_id GROUP BY i.im_id""",
)
def a9_annotated(spark, sf):
    """Images without boxes keep NULL columns."""
    out = rollup.annotated_rows(images(spark, sf), detections(spark, sf).filter("score > 0.5"))
    return out.select("im_id", "concepts", "boxes")


# Found again: every second image has one more box per class that is short.
AGAIN = f"""SELECT im_id, 1099511627777 AS pos, class_name AS name, 5.0 AS x1, 5.0 AS y1, 30.0 AS x2, 30.0 AS y2, 0.5 AS score,
  'locate_anything' AS source FROM ({SHORT}) WHERE im_id % 2 = 0"""


@query(
    "e12_recovered",
    f"""WITH b AS (SELECT * FROM ({CONFIRMED}) UNION ALL SELECT * FROM ({AGAIN})),
    n AS (SELECT *, row_number() OVER (PARTITION BY im_id, name ORDER BY greatest(0.0, (x2 - x1) * (y2 - y1)), pos) AS rn FROM b),
    h AS (SELECT n.im_id, n.name, n.rn, coalesce((SELECT list(a.rn) FROM n a WHERE a.im_id = n.im_id AND a.name = n.name AND a.rn < n.rn
          AND ({{iou(a,n)}} >= 0.7 OR {{iomin(a,n)}} >= 0.7)), CAST([] AS BIGINT[])) AS hits FROM n),
    w AS (SELECT im_id, name, rn, CAST([1] AS BIGINT[]) AS kept, true AS ok FROM h WHERE rn = 1
      UNION ALL SELECT h.im_id, h.name, h.rn, CASE WHEN list_has_any(w.kept, h.hits) THEN w.kept ELSE list_append(w.kept, h.rn) END,
        NOT list_has_any(w.kept, h.hits) FROM w JOIN h ON h.im_id = w.im_id AND h.name = w.name AND h.rn = w.rn + 1),
    k AS (SELECT n.* FROM n JOIN w USING (im_id, name, rn) WHERE w.ok)
    SELECT im_id, string_agg(name, ',' ORDER BY pos, name) AS concepts, string_agg(source, ',' ORDER BY pos, name) AS box_sources FROM k GROUP BY im_id""",
)
def e12(spark, sf):
    """Curation with recovery: confirmed boxes plus boxes found again, smaller boxes first."""
    marks = annotations(spark, sf)
    sure = confirmed(spark, sf).drop("top_class").withColumn("source", F.lit("model"))
    short = issues.classes_to_recover(sure.withColumn("top_class", F.col("name")), marks, RELEVANT)
    number = F.when(F.col("class_name") == "earring", 1).otherwise(2)
    again = short.filter("im_id % 2 = 0").select(
        "im_id", number.cast("long").alias("pos"), F.col("class_name").alias("name"), F.lit(5.0).alias("x1"), F.lit(5.0).alias("y1"),
        F.lit(30.0).alias("x2"), F.lit(30.0).alias("y2"), F.lit(0.5).alias("score"), F.lit("locate_anything").alias("source"),
    )
    columns = ["im_id", "pos", "name", *CORNERS, "score", "source"]
    meta = marks.select("im_id", "im_url", "im_name", "im_description", "gpt_reason")
    out = annotation.recovered_rows(sure.select(*columns), again.select(*columns), meta)
    return out.select("im_id", "concepts", "box_sources")


# --- review -----------------------------------------------------------------


UID = "im_id || ':' || name || ':' || CAST(x1 AS BIGINT) || ':' || CAST(y1 AS BIGINT) || ':' || CAST(x2 AS BIGINT) || ':' || CAST(y2 AS BIGINT)"


def judged(spark, sf) -> DataFrame:
    """Boxes with a verdict; repeats of the same geometry share it."""
    d = detections(spark, sf)
    return d.withColumn("is_valid", (F.col("x1") + F.col("y1")) % 3 != 0).withColumn("llm_validated", F.col("x1") % 2 == 0).withColumn(
        "reason", F.when(F.col("y1") % 2 == 0, "[FLAGGED BLURRY] Crop is blurred").otherwise("fine")
    )


JUDGED = """SELECT *, (x1 + y1) % 3 <> 0 AS is_valid, x1 % 2 = 0 AS llm_validated,
  CASE WHEN y1 % 2 = 0 THEN '[FLAGGED BLURRY] Crop is blurred' ELSE 'fine' END AS reason FROM detections"""


def decisions(spark, sf) -> DataFrame:
    d = review.with_uid(detections(spark, sf)).filter("im_id % 13 < 2")
    return d.select("uid", F.when(F.col("im_id") % 13 == 0, "rejected").otherwise("approved").alias("decision")).distinct()


def added(spark, sf) -> DataFrame:
    return images(spark, sf).filter("im_id % 29 = 0").select(
        "im_id", F.lit(0).alias("added_no"), F.lit("ring").alias("name"), F.lit("human").alias("source"),
        *[F.lit(float(v)).alias(c) for c, v in zip(CORNERS, (1, 2, 11, 12))],
    )


@query(
    "j8_verdicts",
    """WITH v AS (SELECT im_id, name, x1, y1, x2, y2, pos, pos % 3 <> 0 AS ok FROM detections WHERE pos % 4 <> 0),
       f AS (SELECT im_id, name, x1, y1, x2, y2, arg_min(ok, pos) AS ok, min(pos) AS p FROM v GROUP BY ALL)
       SELECT d.im_id, d.pos, f.p IS NOT NULL AS llm_validated, coalesce(f.ok, true) AS is_valid,
              coalesce('verdict ' || f.p, '') AS reason
       FROM detections d LEFT JOIN f USING (im_id, name, x1, y1, x2, y2)""",
)
def j8(spark, sf):
    """Verdicts looked up through their cache key text."""
    d = detections(spark, sf).filter("pos % 4 <> 0")
    box = C.box_text(*[F.col(c) for c in CORNERS])
    key = F.concat(F.lit("llm:"), F.col("im_id").cast("string"), F.lit(":"), "name", F.lit(":"), box, F.lit(":h"), F.col("pos").cast("string"))
    cache = d.select(
        key.alias("key"), F.col("pos").alias("position"), (F.col("pos") % 3 != 0).alias("is_valid"),
        F.concat(F.lit("verdict "), F.col("pos").cast("string")).alias("reason"),
    )
    verdicts = review.verdict_keys(cache).withColumn("im_id", F.col("im_id").cast("long"))
    return review.with_verdicts(detections(spark, sf), verdicts).select("im_id", "pos", "llm_validated", "is_valid", "reason")


@query(
    "j10_review",
    f"""SELECT im_id, name, x1, y1, x2, y2, false AS drawn FROM ({JUDGED}) WHERE im_id % 13 = 1 OR (im_id % 13 <> 0 AND is_valid)
        UNION ALL SELECT im_id, 'ring', 1.0, 2.0, 11.0, 12.0, true FROM images WHERE im_id % 29 = 0""",
)
def j10(spark, sf):
    out = review.reviewed_boxes(judged(spark, sf), decisions(spark, sf), added(spark, sf))
    return out.select("im_id", "name", *CORNERS, "drawn")


@query(
    "a20_review_counts",
    """SELECT count(*) FILTER (im_id % 13 = 0) AS rejected, count(*) FILTER (im_id % 13 = 1) AS approved,
       (SELECT count(*) FROM images WHERE im_id % 29 = 0) AS added FROM detections""",
)
def a20(spark, sf):
    return review.review_counts(judged(spark, sf), decisions(spark, sf), added(spark, sf))


@query(
    "p15_review_status",
    f"""SELECT im_id, pos, CASE im_id % 13 WHEN 0 THEN 'rejected' WHEN 1 THEN 'approved' ELSE
          CASE WHEN llm_validated AND NOT is_valid THEN 'invalid' ELSE 'valid' END END AS status, NOT is_valid AS is_hidden,
        CASE WHEN y1 % 2 = 0 THEN 'BLURRY' ELSE '' END AS flag, CASE WHEN y1 % 2 = 0 THEN 'Crop is blurred' ELSE 'fine' END AS plain
        FROM ({JUDGED})""",
)
def p15(spark, sf):
    """Status of every box (P15) with its reason split into flag and text."""
    from boxloom.functions.text import flag_of, without_flag

    out = review.with_review_status(judged(spark, sf), decisions(spark, sf))
    return out.select(
        "im_id", "pos", "status", "is_hidden", flag_of(F.col("reason")).alias("flag"), without_flag(F.col("reason")).alias("plain")
    )


# --- corrections ------------------------------------------------------------


def rolled(spark, sf) -> DataFrame:
    return rollup.image_rows(as_rows(detections(spark, sf))).withColumn("row_id", F.col("im_id"))


def corrections(spark, sf) -> DataFrame:
    """Per image: two edits chosen by the image id."""
    kind = F.col("im_id") % 11
    base = detections(spark, sf).filter("pos = 1").select("im_id").withColumn("kind", kind)
    box = F.array(F.lit(1), F.lit(2), F.lit(3), F.lit(4))
    null = F.lit(None)
    pieces = F.array(
        F.struct(F.lit("belt").alias("concept"), box.alias("box")),
        F.struct(F.lit("tie").alias("concept"), F.array(*[F.lit(0)] * 4).alias("box")),
    )
    first = base.filter("kind < 4").select(
        F.col("im_id").alias("row_index"),
        F.lit(0).cast("long").alias("position"),
        F.element_at(C.strings("remove", "replace", "add", "replace_multi"), F.col("kind").cast("int") + 1).alias("action"),
        F.when(F.col("kind") == 2, "watch").alias("concept"),
        F.when(F.col("kind") == 2, box).alias("box"),
        F.when(F.col("kind") != 2, 0).alias("concept_index"),
        F.when(F.col("kind") == 1, "scarf").alias("new_concept"),
        F.when(F.col("kind") == 1, F.array(F.lit(7), F.lit(7), F.lit(9), F.lit(9))).alias("new_box"),
        F.when(F.col("kind") == 3, pieces).alias("new_boxes"),
    )
    second = base.filter("kind = 2").select(
        F.col("im_id").alias("row_index"), F.lit(1).cast("long").alias("position"), F.lit("remove").alias("action"),
        null.cast("string").alias("concept"), null.cast("array<int>").alias("box"), F.lit(0).alias("concept_index"),
        null.cast("string").alias("new_concept"), null.cast("array<int>").alias("new_box"),
        F.lit(None).cast(first.schema["new_boxes"].dataType).alias("new_boxes"),
    )
    return first.unionByName(second)


@query(
    "e9_corrections",
    """WITH c AS (SELECT im_id, im_id % 11 AS k, pos, name, source, 'no_issue' AS st,
         '[' || CAST(x1 AS BIGINT) || ',' || CAST(y1 AS BIGINT) || ',' || CAST(x2 AS BIGINT) || ',' || CAST(y2 AS BIGINT) || ']' AS box FROM detections),
    e AS (
      SELECT im_id, pos, CASE WHEN k = 1 AND pos = 1 THEN 'scarf' ELSE name END AS name,
             CASE WHEN k = 1 AND pos = 1 THEN 'human' ELSE source END AS source,
             CASE WHEN k = 1 AND pos = 1 THEN 'human_drawn' ELSE st END AS st,
             CASE WHEN k = 1 AND pos = 1 THEN '[7,7,9,9]' ELSE box END AS box
      FROM c WHERE NOT (k IN (0, 2, 3) AND pos = 1)
      UNION ALL SELECT im_id, 1000000, CASE k WHEN 2 THEN 'watch' ELSE 'belt' END, 'human', 'human_drawn', '[1,2,3,4]' FROM c WHERE pos = 1 AND k IN (2, 3))
    SELECT r.im_id AS row_id, coalesce(string_agg(e.name, ',' ORDER BY e.pos), '') AS concepts, coalesce(string_agg(e.box, ',' ORDER BY e.pos), '') AS boxes,
      coalesce(string_agg(e.source, ',' ORDER BY e.pos), '') AS box_sources, coalesce(string_agg(e.st, ',' ORDER BY e.pos), '') AS box_statuses
    FROM (SELECT DISTINCT im_id FROM detections) r LEFT JOIN e ON e.im_id = r.im_id GROUP BY r.im_id""",
)
def e9(spark, sf):
    out = review.corrected_rows(rolled(spark, sf), corrections(spark, sf))
    return out.select("row_id", "concepts", "boxes", "box_sources", "box_statuses")


@query(
    "e10_export_edits",
    """SELECT im_id AS row_index, 'remove' AS action, CAST(NULL AS VARCHAR) AS concept, CAST(pos - 1 AS INTEGER) AS concept_index, -(pos - 1) AS position
       FROM detections WHERE score < 0.2
       UNION ALL SELECT im_id, 'add', name, NULL, pos + 1 FROM detections WHERE score >= 0.9 AND x2 - x1 >= 5 AND y2 - y1 >= 5""",
)
def e10(spark, sf):
    d = detections(spark, sf)
    removed = d.filter("score < 0.2").select(F.col("im_id").alias("row_index"), (F.col("pos") - 1).cast("int").alias("concept_index"))
    drawn = d.filter("score >= 0.9").select(
        F.col("im_id").alias("row_index"), F.col("pos").alias("draw_no"), F.col("name").alias("concept"),
        F.array(*[F.col(c).cast("int") for c in CORNERS]).alias("box"),
    )
    return review.exported_corrections(removed, drawn).drop("box")


# --- galleries --------------------------------------------------------------


def gallery_items(spark, sf) -> DataFrame:
    j = judged(spark, sf)
    element = F.struct("name", "is_valid", "reason")
    items = rollup.gathered(j, ["im_id"], "pos", element).withColumnRenamed("items", "detections")
    return items.withColumn("im_url", F.concat(F.lit("http://img.test/"), F.col("im_id").cast("string"), F.lit(".jpg")))


@query(
    "f22_gallery",
    f"""SELECT DISTINCT im_id FROM ({JUDGED}) j WHERE
        EXISTS (SELECT 1 FROM ({JUDGED}) a WHERE a.im_id = j.im_id AND a.name = 'earring' AND a.is_valid)
        AND EXISTS (SELECT 1 FROM ({JUDGED}) b WHERE b.im_id = j.im_id AND NOT b.is_valid)
        AND (CAST(im_id AS VARCHAR) LIKE '%blur%' OR EXISTS (SELECT 1 FROM ({JUDGED}) c WHERE c.im_id = j.im_id AND lower(c.reason) LIKE '%blur%'))""",
)
def f22(spark, sf):
    out = gallery.matching_images(gallery_items(spark, sf), "Earring", "invalid_only", " Blur ", hide_invalid=True)
    return out.select("im_id")


@query(
    "f24_crop_gallery",
    f"""SELECT count(*) AS crops, count(DISTINCT im_id) AS images, count(*) FILTER (is_valid) AS valid, count(*) FILTER (NOT is_valid) AS invalid
        FROM ({JUDGED}) WHERE llm_validated AND name IN ('ring', 'bracelet')""",
)
def f24(spark, sf):
    crops = judged(spark, sf).filter("llm_validated")
    return gallery.crop_counts(gallery.matching_crops(crops, ["ring", "bracelet"]))
