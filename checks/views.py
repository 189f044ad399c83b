"""Inputs derived from the given tables.

The tables hold no images or boxes, so boxes come from lineitem, images and
annotations from orders, catalogs from part, content from documents.  Each
view exists twice: as DataFrame code for Spark and as SQL text for DuckDB.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- boxes ------------------------------------------------------------------


def detections(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "im_id")
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]
    return li.withColumn("pos", F.row_number().over(W.partitionBy("im_id").orderBy(*order)).cast("long")).select(
        "im_id",
        "pos",
        F.when(F.col("l_returnflag") == "A", "ring").when(F.col("l_returnflag") == "N", "earring").otherwise("bracelet").alias("name"),
        (F.col("l_partkey") % 40).cast("double").alias("x1"),
        (F.col("l_suppkey") % 40).cast("double").alias("y1"),
        ((F.col("l_partkey") % 40) + F.col("l_quantity")).alias("x2"),
        ((F.col("l_suppkey") % 40) + F.col("l_quantity")).alias("y2"),
        (F.col("l_discount") * 10).alias("score"),
        F.when(F.col("l_linestatus") == "O", "locate_anything").otherwise("fashion_model").alias("source"),
    )


def images(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        key.alias("im_id"),
        F.concat(F.lit("http://img.test/"), key.cast("string"), F.lit(".jpg")).alias("im_url"),
        (F.lit(60) + F.col("o_custkey") % 41).cast("int").alias("image_w"),
        (F.lit(60) + key % 41).cast("int").alias("image_h"),
        F.col("o_orderpriority").alias("im_name"),
        F.col("o_orderstatus").alias("im_description"),
    )


def annotations(spark: SparkSession, sf: str) -> DataFrame:
    """One row per image; visible_classes is JSON text with ``(multiple)`` marks."""
    items = []
    for k, name in enumerate(["ring", "earring", "bracelet"]):
        many = (F.col("o_custkey") + k) % 2 == 0
        text = F.when(many, f'"{name} (multiple)"').otherwise(f'"{name}"')
        items.append(F.when((F.col("o_orderkey") + k) % 3 != 0, text))
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("im_id"),
        F.concat(F.lit("http://img.test/"), F.col("o_orderkey").cast("string"), F.lit(".jpg")).alias("im_url"),
        F.col("o_orderpriority").alias("im_name"),
        F.col("o_orderstatus").alias("im_description"),
        F.concat(F.lit("["), F.concat_ws(",", *items), F.lit("]")).alias("visible_classes"),
        F.concat(F.lit("seen by "), F.col("o_custkey").cast("string")).alias("gpt_reason"),
    )


def plain_annotations(spark: SparkSession, sf: str) -> DataFrame:
    """As ``annotations`` without multiplicity marks."""
    return annotations(spark, sf).withColumn(
        "visible_classes", F.replace("visible_classes", F.lit(" (multiple)"), F.lit(""))
    )


VIEWS: dict[str, str] = {
    "detections": """
  SELECT l_orderkey AS im_id,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity,
                            l_extendedprice, l_shipdate) AS pos,
         CASE l_returnflag WHEN 'A' THEN 'ring' WHEN 'N' THEN 'earring' ELSE 'bracelet' END AS name,
         CAST(l_partkey % 40 AS DOUBLE) AS x1, CAST(l_suppkey % 40 AS DOUBLE) AS y1,
         CAST(l_partkey % 40 AS DOUBLE) + l_quantity AS x2, CAST(l_suppkey % 40 AS DOUBLE) + l_quantity AS y2,
         l_discount * 10 AS score,
         CASE l_linestatus WHEN 'O' THEN 'locate_anything' ELSE 'fashion_model' END AS source
  FROM lineitem""",
    "images": """
  SELECT o_orderkey AS im_id, 'http://img.test/' || o_orderkey || '.jpg' AS im_url,
         CAST(60 + o_custkey % 41 AS INTEGER) AS image_w, CAST(60 + o_orderkey % 41 AS INTEGER) AS image_h,
         o_orderpriority AS im_name, o_orderstatus AS im_description
  FROM orders""",
    "visible": """
  SELECT o_orderkey AS im_id, k, name,
         CASE WHEN (o_custkey + k) % 2 = 0 THEN 'multiple' ELSE 'singular' END AS multiplicity
  FROM orders, (VALUES (0, 'ring'), (1, 'earring'), (2, 'bracelet')) AS c(k, name)
  WHERE (o_orderkey + k) % 3 <> 0""",
    "clusters": """
  SELECT d.*, CAST(dense_rank() OVER (PARTITION BY d.im_id ORDER BY l.label) - 1 AS INTEGER) AS cluster_id
  FROM detections d JOIN labels_of l USING (im_id, pos)""",
    "labels_of": """
  SELECT im_id, pos, min(reach) AS label FROM reach_of GROUP BY im_id, pos""",
    "reach_of": """
  SELECT im_id, pos, pos AS reach FROM detections
  UNION
  SELECT r.im_id, e.b AS pos, r.reach
  FROM reach_of r JOIN close_pairs e ON e.im_id = r.im_id AND e.a = r.pos""",
    "close_pairs": """
  SELECT a.im_id, a.pos AS a, b.pos AS b
  FROM detections a JOIN detections b ON a.im_id = b.im_id AND a.pos <> b.pos
  WHERE {iou(a,b)} >= 0.5""",
    "summary": """
  SELECT im_id, cluster_id, CAST(count(*) AS INTEGER) AS cluster_size,
         max(CASE WHEN rn = 1 THEN name END) AS top_class, max(CASE WHEN rn = 1 THEN score END) AS top_score,
         coalesce(max(CASE WHEN rn = 2 THEN score END), 0.0) AS second_score,
         max(CASE WHEN rn = 1 THEN pos END) AS top_pos
  FROM (SELECT *, row_number() OVER (PARTITION BY im_id, cluster_id ORDER BY score DESC, pos) AS rn FROM clusters)
  GROUP BY im_id, cluster_id""",
    "confident": """
  SELECT s.*, d.x1, d.y1, d.x2, d.y2
  FROM summary s JOIN detections d ON d.im_id = s.im_id AND d.pos = s.top_pos
  WHERE s.top_score >= 0.3""",
}


def _inter(a: str, b: str) -> str:
    return (
        f"(greatest(0.0, least({a}.x2, {b}.x2) - greatest({a}.x1, {b}.x1))"
        f" * greatest(0.0, least({a}.y2, {b}.y2) - greatest({a}.y1, {b}.y1)))"
    )


def _area(a: str) -> str:
    return f"(greatest(0.0, {a}.x2 - {a}.x1) * greatest(0.0, {a}.y2 - {a}.y1))"


def sql_iou(a: str, b: str) -> str:
    i = _inter(a, b)
    return f"(CASE WHEN {i} > 0 THEN {i} / ({_area(a)} + {_area(b)} - {i}) ELSE 0.0 END)"


def sql_io_min(a: str, b: str) -> str:
    i = _inter(a, b)
    return f"(CASE WHEN {i} > 0 THEN {i} / least({_area(a)}, {_area(b)}) ELSE 0.0 END)"


def sql_iou_inclusive(a: str, b: str) -> str:
    def full(c: str) -> str:
        return f"(({c}.x2 - {c}.x1 + 1) * ({c}.y2 - {c}.y1 + 1))"

    i = (
        f"(greatest(0.0, least({a}.x2, {b}.x2) - greatest({a}.x1, {b}.x1) + 1)"
        f" * greatest(0.0, least({a}.y2, {b}.y2) - greatest({a}.y1, {b}.y1) + 1))"
    )
    return f"({i} / ({full(a)} + {full(b)} - {i}))"


def expand(sql: str) -> str:
    """Fill the geometry marks {iou(a,b)}, {iomin(a,b)}, {iouplus(a,b)}, {area(a)}."""
    forms = {"iou": sql_iou, "iomin": sql_io_min, "iouplus": sql_iou_inclusive}
    sql = re.sub(r"\{(iou|iomin|iouplus)\((\w+),(\w+)\)\}", lambda m: forms[m[1]](m[2], m[3]), sql)
    return re.sub(r"\{area\((\w+)\)\}", lambda m: _area(m[1]), sql)


def with_views(sql: str, extra: dict[str, str] | None = None) -> str:
    """Prefix the views a statement uses, in an order that defines them first."""
    known = {**VIEWS, **(extra or {})}
    ordered: list[str] = []

    def visit(text: str, own: str = "") -> None:
        for name in known:
            if name != own and name not in ordered and re.search(rf"\b(FROM|JOIN|,)\s*{name}\b", text):
                visit(known[name], name)
                if name not in ordered:
                    ordered.append(name)

    visit(sql)
    if not ordered:
        return expand(sql)
    views = ",\n".join(f"{n} AS ({known[n]})" for n in ordered)
    body = sql.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return expand(f"WITH RECURSIVE {views},\n{body[len('WITH RECURSIVE '):]}")
    if body.upper().startswith("WITH "):
        return expand(f"WITH RECURSIVE {views},\n{body[len('WITH '):]}")
    return expand(f"WITH RECURSIVE {views}\n{body}")


def greedy_sql(boxes: str, group: str, order: str, hit: str, select: str, merge_source: bool = False) -> str:
    """Recursive form of greedy suppression.

    ``hit`` tests an earlier box ``a`` against a later box ``b``.  Step k
    decides the k-th box of every group from the kept ranks so far.
    """
    owners = "list_min(list_intersect(w.kept, h.hits))"
    merged = (
        """,
merged AS (SELECT gk, owner AS rn, string_agg(source, ', ' ORDER BY first_rn) AS sources
  FROM (SELECT gk, owner, source, min(rn) AS first_rn FROM decided GROUP BY gk, owner, source) GROUP BY gk, owner)"""
        if merge_source
        else ""
    )
    return f"""WITH RECURSIVE numbered AS (
  SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY {order}) AS rn,
         dense_rank() OVER (ORDER BY {group}) AS gk
  FROM ({boxes})),
pairs AS (SELECT b.gk, b.rn, a.rn AS earlier FROM numbered a JOIN numbered b
  ON a.gk = b.gk AND a.rn < b.rn WHERE {hit}),
h AS (SELECT n.gk, n.rn, coalesce(p.hits, CAST([] AS BIGINT[])) AS hits
  FROM numbered n LEFT JOIN (SELECT gk, rn, list(earlier) AS hits FROM pairs GROUP BY gk, rn) p USING (gk, rn)),
w AS (
  SELECT gk, rn, CAST([1] AS BIGINT[]) AS kept, rn AS owner FROM h WHERE rn = 1
  UNION ALL
  SELECT h.gk, h.rn,
         CASE WHEN list_has_any(w.kept, h.hits) THEN w.kept ELSE list_append(w.kept, h.rn) END,
         CASE WHEN list_has_any(w.kept, h.hits) THEN {owners} ELSE h.rn END
  FROM w JOIN h ON h.gk = w.gk AND h.rn = w.rn + 1),
decided AS (SELECT n.*, w.owner FROM numbered n JOIN w USING (gk, rn)){merged}
{select}"""


# --- catalogs and content ---------------------------------------------------


def products(spark: SparkSession, sf: str) -> DataFrame:
    """Product catalog from part: list cells, mixed URL schemes, tags."""
    key = F.col("p_partkey")
    shared = (key * 7) % 500
    extra = F.concat(
        F.lit('["http://img.test/'), shared.cast("string"), F.lit('.jpg", "ftp://x", "https://img.test/p'),
        key.cast("string"), F.lit('.jpg", "http://img.test/'), shared.cast("string"), F.lit('.jpg"]'),
    )
    main = F.when(key % 11 == 0, F.lit("ftp://img.test/none")).otherwise(
        F.concat(F.lit(" http://img.test/"), (key % 700).cast("string"), F.lit(".jpg"))
    )
    tags = (
        F.when(F.col("p_size") % 4 == 0, "['Women', 'dress']")
        .when(F.col("p_size") % 4 == 1, '["men","Boy"]')
        .when(F.col("p_size") % 4 == 2, "['kids']")
        .otherwise("['Lady', 'male']")
    )
    return table(spark, sf, "part").select(
        key.alias("pos"), key.cast("string").alias("product_id"), F.col("p_name").alias("title"), F.col("p_brand").alias("brand"),
        F.concat(F.lit("['"), F.col("p_type"), F.lit("', 'ALL']")).alias("category"),
        F.when(F.col("p_size") % 3 == 0, "Women").when(F.col("p_size") % 3 == 1, "Men").otherwise("Unisex").alias("gender"),
        main.alias("main_image_url"), F.when(key % 5 != 0, extra).alias("additional_image_url"), tags.alias("tags"),
        F.lit("").alias("name"), F.col("p_size"),
    )


def content(spark: SparkSession, sf: str) -> DataFrame:
    """Image content stand-in: documents and the md5 of their text."""
    d = table(spark, sf, "documents")
    return d.select(
        F.concat(F.lit("doc://"), F.col("doc_id").cast("string")).alias("im_url"),
        F.when(F.col("doc_id") % 19 == 0, "").otherwise(F.md5(F.col("text").cast("binary"))).alias("image_content_hash"),
        F.col("doc_id").alias("pos"), F.col("lang").alias("category"), "n_chars", "source",
    )


def exclusions(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").filter("doc_id % 17 = 0")
    return d.select(F.md5(F.col("text").cast("binary")).alias("image_content_hash")).distinct()


VIEWS.update(
    {
        "products": """
  SELECT p_partkey AS pos, CAST(p_partkey AS VARCHAR) AS product_id, p_name AS title, p_brand AS brand, p_type AS primary_category,
         CASE p_size % 3 WHEN 0 THEN 'Women' WHEN 1 THEN 'Men' ELSE 'Unisex' END AS gender, p_size
  FROM part""",
        "product_images": """
  SELECT product_id, url AS im_url, min(n) AS n FROM (
    SELECT product_id, 0 AS n, 'http://img.test/' || (pos % 700) || '.jpg' AS url FROM products WHERE pos % 11 <> 0
    UNION ALL SELECT product_id, 1, 'http://img.test/' || (pos * 7 % 500) || '.jpg' FROM products WHERE pos % 5 <> 0
    UNION ALL SELECT product_id, 2, 'https://img.test/p' || pos || '.jpg' FROM products WHERE pos % 5 <> 0)
  GROUP BY product_id, url""",
        "content": """
  SELECT 'doc://' || doc_id AS im_url, CASE WHEN doc_id % 19 = 0 THEN '' ELSE md5(text) END AS image_content_hash, doc_id AS pos,
         lang AS category, n_chars, source FROM documents""",
        "exclusions": """
  SELECT DISTINCT md5(text) AS image_content_hash FROM documents WHERE doc_id % 17 = 0""",
        "ruled": """
  SELECT i.im_url, p.product_id, p.gender, p.title, p.brand, p.primary_category,
         CASE WHEN primary_category IN ('ECONOMY', 'PROMO') AND gender = 'Women' THEN 0
              WHEN primary_category IN ('PROMO', 'SMALL') THEN 1 WHEN primary_category = 'LARGE' THEN 2 END AS rule
  FROM products p JOIN product_images i USING (product_id)""",
        "matched": """
  SELECT r.* FROM ruled r WHERE r.rule = (SELECT min(q.rule) FROM ruled q WHERE q.im_url = r.im_url)""",
    }
)
