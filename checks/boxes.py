"""Box geometry, suppression, caps, clusters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxloom.functions import codecs as C
from boxloom.functions import geometry as G
from boxloom.operators import annotate, clusters, groups, scoring
from boxloom.operators import images as pixel
from boxloom.operators import suppression as S
from checks.registry import query
from checks.views import detections, greedy_sql, images

CORNERS = list(G.Box._fields)


def six(c: Column) -> Column:
    return F.round(c, 6)


def neighbours(spark, sf) -> DataFrame:
    """Each box with the next box of its image: one pair per box."""
    d = detections(spark, sf)
    n = d.select("im_id", (F.col("pos") - 1).alias("pos"), *[F.col(c).alias(f"n_{c}") for c in CORNERS])
    return d.join(n, ["im_id", "pos"])


NEXT = "FROM detections a JOIN detections b ON b.im_id = a.im_id AND b.pos = a.pos + 1"


@query("g1_iou", "SELECT a.im_id, a.pos, round({iou(a,b)}, 6) AS iou " + NEXT)
def g1(spark, sf):
    return neighbours(spark, sf).select("im_id", "pos", six(G.iou(G.box(), G.box("n_"))).alias("iou"))


@query("g2_iomin", "SELECT a.im_id, a.pos, round({iomin(a,b)}, 6) AS io_min " + NEXT)
def g2(spark, sf):
    return neighbours(spark, sf).select("im_id", "pos", six(G.io_min(G.box(), G.box("n_"))).alias("io_min"))


@query(
    "g3_area",
    """SELECT a.im_id, a.pos, {area(a)} AS area,
       round({area(a)} / CAST(i.image_w * i.image_h AS DOUBLE), 6) AS area_ratio
       FROM detections a JOIN images i ON i.im_id = a.im_id""",
)
def g3(spark, sf):
    d = detections(spark, sf).join(images(spark, sf), "im_id")
    ratio = G.area_ratio(G.box(), F.col("image_h"), F.col("image_w"))
    return d.select("im_id", "pos", G.area(G.box()).alias("area"), six(ratio).alias("area_ratio"))


HALF = "CAST(round_even({c} / 2.0, 0) AS INTEGER) AS {c}"


@query(
    "g5_normalize",
    "SELECT im_id, pos, " + ", ".join(HALF.replace("{c}", c) for c in CORNERS) + " FROM detections",
)
def g5(spark, sf):
    """Half-even pixels; halved coordinates hit many ties."""
    halves = G.Box(*(F.col(c) / 2.0 for c in CORNERS))
    return detections(spark, sf).select("im_id", "pos", *[v.alias(c) for c, v in zip(CORNERS, G.pixels(halves))])


@query(
    "g6_explode",
    """SELECT im_id, pos - 1 AS pos, name, score, CAST(round_even(x1 / 2.0, 0) AS DOUBLE) AS x1,
       CAST(round_even(y1 / 2.0, 0) AS DOUBLE) AS y1, CAST(round_even(x2 / 2.0, 0) AS DOUBLE) AS x2,
       CAST(round_even(y2 / 2.0, 0) AS DOUBLE) AS y2
       FROM detections WHERE pos % 9 <> 0 AND pos % 8 <> 0""",
)
def g6(spark, sf):
    """Detection lists back to rows; some carry no score or a three-number box."""
    d = detections(spark, sf)
    corners = [F.col(c) / 2.0 for c in CORNERS]
    short = F.array(*corners[:3])
    det = F.struct(
        "name",
        F.when(F.col("pos") % 9 != 0, F.col("score")).alias("score"),
        F.when(F.col("pos") % 8 == 0, short).otherwise(F.array(*corners)).alias("box"),
    )
    from boxloom.operators.rollup import gathered

    lists = gathered(d, ["im_id"], "pos", det).withColumnRenamed("items", "detections")
    out = clusters.exploded_detections(lists.select("im_id", "detections"))
    return out.select("im_id", F.col("pos").cast("long").alias("pos"), "name", "score", *CORNERS)


def priority_boxes(spark, sf) -> DataFrame:
    special = F.when(F.col("pos") % 3 == 0, "jewelry product").when(F.col("pos") % 7 == 1, "Other").otherwise(F.col("name"))
    return detections(spark, sf).withColumn("name", special)


@query(
    "g7_priority",
    """WITH p AS (SELECT im_id, pos, x1, y1, x2, y2, CASE WHEN pos % 3 = 0 THEN 'jewelry product'
                   WHEN pos % 7 = 1 THEN 'Other' ELSE name END AS name FROM detections)
       SELECT b.im_id, b.pos, b.name FROM p b
       WHERE lower(b.name) <> 'other' AND (b.name = 'jewelry product' OR NOT EXISTS (
         SELECT 1 FROM p a WHERE a.im_id = b.im_id AND a.name = 'jewelry product' AND {iou(a,b)} > 0.8))""",
)
def g7(spark, sf):
    return S.clean_before_suppression(priority_boxes(spark, sf)).select("im_id", "pos", "name")


BOTH = "({iou(a,b)} >= 0.7 OR {iomin(a,b)} >= 0.7)"
KEPT = "SELECT im_id, pos, name FROM decided WHERE owner = rn"
KEPT_SOURCE = (
    "SELECT im_id, pos, name, sources AS source FROM decided JOIN merged USING (gk, rn) WHERE owner = rn"
)
AREA = "greatest(0.0, (x2 - x1) * (y2 - y1))"


def by_policy(spark, sf, policy: S.Policy) -> DataFrame:
    out = S.suppress_by_policy(detections(spark, sf), {"general": policy})
    return out.select("im_id", "pos", "name", "source")


@query(
    "g8_keep_biggest",
    greedy_sql("SELECT * FROM detections", "im_id, name", f"{AREA} DESC, score DESC, pos", BOTH, KEPT_SOURCE, True),
)
def g8_biggest(spark, sf):
    return by_policy(spark, sf, S.Policy(0.7, 0.7, "keep biggest"))


@query(
    "g8_keep_smallest",
    greedy_sql("SELECT * FROM detections", "im_id, name", f"{AREA}, score DESC, pos", BOTH, KEPT_SOURCE, True),
)
def g8_smallest(spark, sf):
    return by_policy(spark, sf, S.Policy(0.7, 0.7, "keep smallest"))


@query(
    "g8_keep_source",
    greedy_sql(
        "SELECT * FROM detections", "im_id, name",
        "CASE WHEN source = 'locate_anything' THEN 0 ELSE 1 END, score DESC, pos",
        "({iou(a,b)} >= 0.4 OR {iomin(a,b)} >= 0.6)", KEPT_SOURCE, True,
    ),
)
def g8_source(spark, sf):
    return by_policy(spark, sf, S.Policy(0.4, 0.6, "keep locate anything box"))


@query(
    "g8_keep_score",
    greedy_sql("SELECT * FROM detections", "im_id, name", "score DESC, pos", BOTH, KEPT_SOURCE, True),
)
def g8_score(spark, sf):
    return by_policy(spark, sf, S.Policy(0.7, 0.7, ""))


@query(
    "g9_encloses",
    greedy_sql(
        """SELECT a.*, (SELECT count(*) FROM detections b WHERE b.im_id = a.im_id AND b.name = a.name AND b.pos <> a.pos
             AND greatest(0.0, (b.x2 - b.x1) * (b.y2 - b.y1)) < greatest(0.0, (a.x2 - a.x1) * (a.y2 - a.y1))
             AND ({iou(a,b)} >= 0.4 OR {iomin(a,b)} >= 0.7)) >= 2 AS encloses FROM detections a""",
        "im_id, name", f"encloses, {AREA} DESC, pos", "({iou(a,b)} >= 0.4 OR {iomin(a,b)} >= 0.7)", KEPT_SOURCE, True,
    ),
)
def g9(spark, sf):
    return by_policy(spark, sf, S.Policy(0.4, 0.7, "keep smaller_if_encloses_multiple"))


@query(
    "g10_policies",
    greedy_sql(
        "SELECT *, CASE name WHEN 'ring' THEN 0.3 ELSE 0.6 END AS t FROM detections WHERE name <> 'bracelet'",
        "im_id, name", f"CASE name WHEN 'ring' THEN {AREA} ELSE -{AREA} END, score DESC, pos",
        "({iou(a,b)} >= b.t OR {iomin(a,b)} >= 0.9)",
        "SELECT im_id, pos, name FROM decided WHERE owner = rn UNION ALL SELECT im_id, pos, name FROM detections WHERE name = 'bracelet'",
    ),
)
def g10(spark, sf):
    """Own policies for two classes; the third has none and passes."""
    policies = {"ring": S.Policy(0.3, 0.9, "keep smallest"), "earring": S.Policy(0.6, 0.9, "keep biggest")}
    return S.suppress_by_policy(detections(spark, sf), policies).select("im_id", "pos", "name")


@query(
    "g11_smallest_first",
    greedy_sql("SELECT * FROM detections", "im_id, name", f"{AREA}, pos", BOTH, KEPT),
)
def g11(spark, sf):
    return S.suppress_smallest_first(detections(spark, sf)).select("im_id", "pos", "name")


@query(
    "g12_same_class",
    greedy_sql(
        "SELECT *, 'hand' AS m FROM detections WHERE name <> 'earring'", "im_id, m", "score DESC, pos",
        "{iou(a,b)} >= 0.4",
        "SELECT im_id, pos, name FROM decided WHERE owner = rn UNION ALL SELECT im_id, pos, name FROM detections WHERE name = 'earring'",
    ),
)
def g12(spark, sf):
    return S.suppress_same_class(detections(spark, sf), {"ring": "hand", "bracelet": "hand"}, 0.4).select("im_id", "pos", "name")


@query(
    "g13_cross_class",
    """SELECT b.im_id, b.pos, b.name FROM detections b WHERE NOT EXISTS (
         SELECT 1 FROM detections a WHERE a.im_id = b.im_id AND a.pos <> b.pos AND {iou(a,b)} >= 0.3
         AND ((a.name = 'ring' AND b.name IN ('earring', 'bracelet')) OR (a.name = 'earring' AND b.name = 'bracelet')))""",
)
def g13(spark, sf):
    rules = {"ring": ["earring", "bracelet"], "earring": ["bracelet"]}
    return S.suppress_across_classes(detections(spark, sf), rules, 0.3).select("im_id", "pos", "name")


@query(
    "g14_ground_truth",
    greedy_sql("SELECT * FROM detections", "im_id, name", "(x2 - x1) * (y2 - y1) DESC, pos", "{iou(a,b)} >= 0.4", KEPT),
)
def g14(spark, sf):
    return S.suppress_ground_truth(detections(spark, sf), 0.4).select("im_id", "pos", "name")


@query(
    "g15_nms_inclusive",
    greedy_sql("SELECT * FROM detections", "im_id, name", "score DESC, pos", "{iouplus(a,b)} > 0.4", KEPT),
)
def g15(spark, sf):
    return S.suppress_inclusive(detections(spark, sf), 0.4).select("im_id", "pos", "name")


@query(
    "g16_clusters",
    "SELECT im_id, pos, cluster_id FROM clusters",
)
def g16(spark, sf):
    return clusters.overlap_clusters(detections(spark, sf), 0.5).select("im_id", "pos", "cluster_id")


@query(
    "a8_cluster_summary",
    """SELECT im_id, cluster_id, cluster_size, top_class, top_pos, round(top_score, 6) AS top_score,
       round(second_score, 6) AS second_score,
       round(CASE WHEN cluster_size > 1 THEN top_score - second_score ELSE top_score END, 6) AS margin,
       round(1.0 - CASE WHEN cluster_size > 1 THEN top_score - second_score ELSE top_score END, 6) AS uncertainty
       FROM summary""",
)
def a8(spark, sf):
    s = clusters.cluster_summary(clusters.overlap_clusters(detections(spark, sf), 0.5))
    numbers = ["top_score", "second_score", "margin", "uncertainty"]
    return s.select("im_id", "cluster_id", "cluster_size", "top_class", "top_pos", *[six(F.col(c)).alias(c) for c in numbers])


SMALL = """SELECT d.im_id, d.pos, name, x1, y1, x1 + (x2 - x1) / 8.0 AS x2, y1 + (y2 - y1) / 6.0 AS y2, image_w, image_h
           FROM detections d JOIN images i ON i.im_id = d.im_id"""


def small_boxes(spark, sf) -> DataFrame:
    """Shrunken boxes, many under the minimum area of their class."""
    d = detections(spark, sf).join(images(spark, sf).select("im_id", "image_w", "image_h"), "im_id")
    return d.withColumns(
        {"x2": F.col("x1") + (F.col("x2") - F.col("x1")) / 8.0, "y2": F.col("y1") + (F.col("y2") - F.col("y1")) / 6.0}
    )


@query(
    "g17_target_area",
    f"""WITH s AS ({SMALL}),
    t AS (SELECT *, CASE name WHEN 'ring' THEN 78.8 WHEN 'earring' THEN 216.0 END AS target, x2 - x1 AS w, y2 - y1 AS h FROM s),
    g AS (SELECT *, coalesce(w * h > 0 AND w * h < target, false) AS grow,
          CASE WHEN w * h > 0 AND w * h < target THEN sqrt(target / (w * h)) ELSE 1.0 END AS k FROM t),
    n AS (SELECT *, x1 + w / 2.0 - w * k / 2.0 AS a1, x1 + w / 2.0 + w * k / 2.0 AS a2,
          y1 + h / 2.0 - h * k / 2.0 AS b1, y1 + h / 2.0 + h * k / 2.0 AS b2 FROM g),
    l AS (SELECT *, CASE WHEN a1 < 0 THEN 0.0 ELSE a1 END AS c1, CASE WHEN a1 < 0 THEN a2 - a1 ELSE a2 END AS c2,
          CASE WHEN b1 < 0 THEN 0.0 ELSE b1 END AS e1, CASE WHEN b1 < 0 THEN b2 - b1 ELSE b2 END AS e2 FROM n),
    r AS (SELECT *, CASE WHEN c2 > image_w THEN c1 - (c2 - image_w) ELSE c1 END AS f1, least(c2, image_w) AS f2,
          CASE WHEN e2 > image_h THEN e1 - (e2 - image_h) ELSE e1 END AS h1, least(e2, image_h) AS h2 FROM l)
    SELECT im_id, pos,
      round(CASE WHEN grow THEN least(image_w, greatest(0.0, f1)) ELSE x1 END, 6) AS x1,
      round(CASE WHEN grow THEN least(image_h, greatest(0.0, h1)) ELSE y1 END, 6) AS y1,
      round(CASE WHEN grow THEN f2 ELSE x2 END, 6) AS x2, round(CASE WHEN grow THEN h2 ELSE y2 END, 6) AS y2 FROM r""",
)
def g17(spark, sf):
    grown = G.grown_to_area(G.box(), G.min_area_for(F.col("name")), F.col("image_w"), F.col("image_h"))
    return small_boxes(spark, sf).select("im_id", "pos", *[six(v).alias(c) for c, v in zip(CORNERS, grown)])


CROP_SETTINGS = {
    "general": {"padding": 0.13, "min_box_padding": 24},
    "ring": {"flat_padding_px": 7},
    "bracelet": {"padding": 0.0, "min_box_padding": None},
}


def crop_sql(lo: str, hi: str, size: str) -> str:
    """Padded interval of one axis."""
    m = f"CASE name WHEN 'ring' THEN 7.0 WHEN 'earring' THEN ({hi} - {lo}) * 0.13 END"
    return f"""CASE WHEN name = 'bracelet' THEN {lo} ELSE greatest(0.0, {lo} - {m}) END AS p_{lo},
      CASE WHEN name = 'bracelet' THEN {hi} ELSE least(CAST({size} AS DOUBLE), {hi} + {m}) END AS p_{hi}"""


@query(
    "g18_crop_rect",
    f"""WITH s AS ({SMALL}),
    p AS (SELECT *, {crop_sql('x1', 'x2', 'image_w')}, {crop_sql('y1', 'y2', 'image_h')} FROM s),
    g AS (SELECT *, greatest(0.0, (24.0 - (p_x2 - p_x1)) / 2.0) * CASE WHEN name = 'bracelet' THEN 0 ELSE 1 END AS gx,
          greatest(0.0, (24.0 - (p_y2 - p_y1)) / 2.0) * CASE WHEN name = 'bracelet' THEN 0 ELSE 1 END AS gy FROM p),
    e AS (SELECT *, CASE WHEN gx > 0 THEN greatest(0.0, p_x1 - gx) ELSE p_x1 END AS q_x1,
          CASE WHEN gx > 0 THEN least(CAST(image_w AS DOUBLE), p_x2 + gx) ELSE p_x2 END AS q_x2,
          CASE WHEN gy > 0 THEN greatest(0.0, p_y1 - gy) ELSE p_y1 END AS q_y1,
          CASE WHEN gy > 0 THEN least(CAST(image_h AS DOUBLE), p_y2 + gy) ELSE p_y2 END AS q_y2 FROM g),
    i AS (SELECT *, greatest(0, CAST(round_even(q_x1, 0) AS INTEGER)) AS i1, greatest(0, CAST(round_even(q_y1, 0) AS INTEGER)) AS j1,
          least(image_w, CAST(round_even(q_x2, 0) AS INTEGER)) AS i2, least(image_h, CAST(round_even(q_y2, 0) AS INTEGER)) AS j2 FROM e)
    SELECT im_id, pos,
      CASE WHEN i2 <= i1 OR j2 <= j1 THEN greatest(0, CAST(trunc(x1) AS INTEGER)) ELSE i1 END AS cx1,
      CASE WHEN i2 <= i1 OR j2 <= j1 THEN greatest(0, CAST(trunc(y1) AS INTEGER)) ELSE j1 END AS cy1,
      CASE WHEN i2 <= i1 OR j2 <= j1 THEN least(image_w, CAST(trunc(x2) AS INTEGER)) ELSE i2 END AS cx2,
      CASE WHEN i2 <= i1 OR j2 <= j1 THEN least(image_h, CAST(trunc(y2) AS INTEGER)) ELSE j2 END AS cy2 FROM i""",
)
def g18(spark, sf):
    return annotate.crop_rectangles(small_boxes(spark, sf), CROP_SETTINGS).select("im_id", "pos", "cx1", "cy1", "cx2", "cy2")


@query(
    "g19_resize",
    """WITH s AS (SELECT im_id, image_w AS w, image_h AS h FROM images),
    k AS (SELECT *, greatest(1.0, 72.0 / least(w, h), 96.0 / greatest(w, h)) AS up,
          least(90.0 / greatest(w, h), 64.0 / least(w, h)) AS fit, least(80.0 / greatest(w, h), 1.0) AS shrink FROM s)
    SELECT im_id, greatest(1, CAST(round_even(w * up, 0) AS INTEGER)) AS up_w, greatest(1, CAST(round_even(h * up, 0) AS INTEGER)) AS up_h,
      CAST(trunc(w * fit) AS INTEGER) AS fit_w, CAST(trunc(h * fit) AS INTEGER) AS fit_h, round(shrink, 6) AS shrink FROM k""",
)
def g19(spark, sf):
    """Sizes: enlarged to minimum sides (G19), fitted inside (G20), shrunk to a longest side."""
    w, h = F.col("image_w"), F.col("image_h")
    up = G.upscaled_size(w, h, F.lit(72), F.lit(96))
    fit = G.fit_inside(w, h, 90, 64)
    return images(spark, sf).select(
        "im_id", up[0].alias("up_w"), up[1].alias("up_h"), fit[0].alias("fit_w"), fit[1].alias("fit_h"),
        six(G.shrink_scale(h, w, 80.0)).alias("shrink"),
    )


@query(
    "g23_rescale",
    "SELECT im_id, pos, " + ", ".join(f"CAST(trunc({c} / 0.37 + 0.5) AS INTEGER) AS {c}" for c in CORNERS) + " FROM detections",
)
def g23(spark, sf):
    scaled = G.rescale(G.box(), F.lit(0.37))
    return detections(spark, sf).select("im_id", "pos", *[v.alias(c) for c, v in zip(CORNERS, scaled)])


@query(
    "g24_objectness",
    """WITH d AS (SELECT a.im_id, pos, score, x1, y1, x2, y2, CAST(image_w AS DOUBLE) AS w, CAST(image_h AS DOUBLE) AS h,
         CASE name WHEN 'ring' THEN 0.25 ELSE 1.0 / 6.0 END AS sigma, CASE name WHEN 'earring' THEN 0.8 ELSE 1.0 END AS prior
         FROM detections a JOIN images i ON i.im_id = a.im_id),
    s AS (SELECT *, power(least(x2 - x1 + 1, y2 - y1 + 1), 2) / (w * h) AS size_s,
         exp(-0.5 * (power((x1 + x2) / 2.0 / least(w, h) - (w + 1) / 2.0 / least(w, h), 2)
             + power((y1 + y2) / 2.0 / least(w, h) - (h + 1) / 2.0 / least(w, h), 2)) / (sigma * sigma)) AS centre_s,
         power(0.8, (CASE WHEN y1 <= 5 THEN 1 ELSE 0 END + CASE WHEN y2 > h - 5 THEN 1 ELSE 0 END)
             * (CASE WHEN x1 <= 5 THEN 1 ELSE 0 END + CASE WHEN x2 > w - 5 THEN 1 ELSE 0 END)) AS corner_s FROM d),
    o AS (SELECT *, sqrt(power(size_s, 0.25) * power(centre_s, 3) * power(corner_s, 0.25)) * prior AS obj FROM s)
    SELECT im_id, pos, round(score * obj / max(obj) OVER (PARTITION BY im_id), 6) AS score FROM o""",
)
def g24(spark, sf):
    d = detections(spark, sf).join(images(spark, sf).select("im_id", "image_w", "image_h"), "im_id")
    out = scoring.rescored(d, {"ring": 0.25}, {"earring": 0.8})
    return out.select("im_id", "pos", six(F.col("score")).alias("score"))


@query(
    "w3_caps",
    """WITH c AS (SELECT *, row_number() OVER (PARTITION BY im_id, name ORDER BY score DESC, pos) AS rc FROM detections),
    i AS (SELECT *, row_number() OVER (PARTITION BY im_id ORDER BY score DESC, pos) AS ri FROM c WHERE rc <= 2)
    SELECT im_id, pos, name FROM i WHERE ri <= 4""",
)
def w3(spark, sf):
    return S.cap_boxes(detections(spark, sf), 2, 4).select("im_id", "pos", "name")


@query(
    "w4_best_box",
    """SELECT im_id, pos, name FROM (SELECT *, row_number() OVER (PARTITION BY im_id ORDER BY score DESC, pos) AS r
       FROM detections) WHERE r = 1""",
)
def w4(spark, sf):
    return S.detection_limit(detections(spark, sf), multiple=False, limit=10).select("im_id", "pos", "name")


def flat_images(spark, sf) -> DataFrame:
    return images(spark, sf).select("im_id", "image_h", "image_w", F.lit(3).alias("channels"))


def flat_pixels() -> Column:
    """Single-coloured images: every pixel byte is a letter chosen by the image id."""
    return F.expr("cast(repeat(char(65 + im_id % 26), image_h * image_w * 3) as binary)")


@query(
    "g21_crops",
    """SELECT d.im_id, pos AS box_no, name, CAST(least(image_h, y2) - y1 AS INTEGER) AS crop_h,
       CAST(least(image_w, x2) - x1 AS INTEGER) AS crop_w,
       md5(repeat(chr(CAST(65 + d.im_id % 26 AS INTEGER)), CAST((least(image_h, y2) - y1) * (least(image_w, x2) - x1) * 3 AS BIGINT))) AS crop_md5
       FROM detections d JOIN images i ON i.im_id = d.im_id WHERE least(image_h, y2) > y1 AND least(image_w, x2) > x1""",
    python=True,
)
def g21(spark, sf):
    d = detections(spark, sf).join(images(spark, sf).select("im_id", "image_w", "image_h"), "im_id")
    rects = annotate.crop_rectangles(d, {}).select("im_id", "pos", "name", "cx1", "cy1", "cx2", "cy2")
    crops = pixel.pixel_crops(flat_images(spark, sf), rects, pixels=flat_pixels())
    return crops.select("im_id", "box_no", "name", "crop_h", "crop_w", F.md5("crop").alias("crop_md5"))


@query(
    "f10_class_threshold",
    "SELECT im_id, pos, name FROM detections WHERE score >= CASE name WHEN 'ring' THEN 0.6 WHEN 'earring' THEN 0.2 ELSE 0.45 END",
)
def f10(spark, sf):
    from boxloom.operators.catalog import class_thresholds

    listed = spark.createDataFrame([("ring", 0.6), ("earring", 0.2)], "name string, threshold double")
    return class_thresholds(detections(spark, sf), listed, 0.45).select("im_id", "pos", "name")


@query(
    "g22_clip",
    """WITH b AS (SELECT im_id, string_agg('[' || CAST(CAST(x1 AS BIGINT) - 10 AS VARCHAR) || ',' || CAST(CAST(y1 AS BIGINT) AS VARCHAR) || ','
         || CAST(CAST(x2 AS BIGINT) AS VARCHAR) || ',' || CAST(CAST(y2 AS BIGINT) - 20 AS VARCHAR) || ']', ',' ORDER BY pos) AS boxes FROM detections GROUP BY im_id)
    SELECT im_id, regexp_replace(boxes, '-[0-9]+', '0', 'g') AS boxes FROM b""",
)
def g22(spark, sf):
    from boxloom.operators.rollup import gathered

    d = detections(spark, sf)
    text = C.box_text(F.col("x1") - 10, F.col("y1"), F.col("x2"), F.col("y2") - 20)
    rows = gathered(d, ["im_id"], "pos", text).select("im_id", F.array_join("items", ",").alias("boxes"))
    return rows.select("im_id", C.clipped_boxes(F.col("boxes")).alias("boxes"))
