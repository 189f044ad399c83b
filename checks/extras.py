"""Operators that the other modules do not query."""

from __future__ import annotations

from pyspark.sql import functions as F

from boxloom.functions import codecs as C
from boxloom.functions import text as T
from boxloom.operators import catalog as K
from boxloom.operators import dataset as D
from boxloom.operators import review
from checks.publish import COMPACT, SPLIT, dirty_rows
from checks.registry import query
from checks.views import table


@query(
    "c2_url_list",
    """SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'http://a.test/' || p_partkey || '|https://b.test/x' WHEN 1 THEN 'https://c.test/' || p_size
       ELSE '' END AS urls FROM part""",
)
def c2(spark, sf):
    """Lists in both quotings, other schemes, cells that are no list."""
    kind, key = F.col("p_size") % 4, F.col("p_partkey").cast("string")
    cell = (
        F.when(kind == 0, F.concat(F.lit('["http://a.test/'), key, F.lit('", "ftp://z", " https://b.test/x "]')))
        .when(kind == 1, F.concat(F.lit("['https://c.test/"), F.col("p_size").cast("string"), F.lit("', 'x']")))
        .when(kind == 2, F.lit("http://not.a.list/"))
        .otherwise(F.lit("[broken"))
    )
    return table(spark, sf, "part").select("p_partkey", F.array_join(C.url_list_cell(cell), "|").alias("urls"))


@query(
    "p10_safe_text",
    "SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN '' WHEN 1 THEN '' WHEN 2 THEN '' ELSE p_name END AS safe FROM part",
)
def p10(spark, sf):
    kind = F.col("p_size") % 4
    cell = F.when(kind == 0, "nan").when(kind == 1, "None").when(kind == 3, F.concat(F.lit("  "), "p_name", F.lit(" ")))
    return table(spark, sf, "part").select("p_partkey", T.safe_text(cell).alias("safe"))


@query(
    "f12_plain_filter",
    """SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'top' WHEN 1 THEN 'top|bag' ELSE 'all' END AS classes FROM part""",
)
def f12_plain(spark, sf):
    """Object filter without expansions."""
    expr = F.element_at(C.strings("top", "top;bag;top;zzz", "wholeimage"), F.col("p_size") % 3 + 1)
    wanted = K.wanted_classes(expr, ["top", "dress", "outerwear", "bag"], expand=False)
    return table(spark, sf, "part").select("p_partkey", F.coalesce(F.array_join(wanted, "|"), F.lit("all")).alias("classes"))


@query(
    "c22_template",
    "SELECT p_partkey, 'Is ' || p_name || ' a {kind} of ' || p_brand || '? ' || p_name AS prompt FROM part",
)
def c22(spark, sf):
    prompt = T.filled_template("Is {name} a {kind} of {brand}? {name}", {"name": F.col("p_name"), "brand": F.col("p_brand")})
    return table(spark, sf, "part").select("p_partkey", prompt.alias("prompt"))


@query(
    "a18_product_images",
    """SELECT product, image, CAST(min(n) AS INTEGER) AS at FROM (
         SELECT p_partkey AS product, 0 AS n, 'i' || (p_partkey % 50) AS image FROM part WHERE p_size % 3 <> 0
         UNION ALL SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 0 ELSE 1 END, 'a' || p_size FROM part WHERE p_size % 4 <> 0
         UNION ALL SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 1 ELSE 2 END, 'i' || (p_partkey % 50) FROM part WHERE p_size % 4 <> 0)
       GROUP BY product, image""",
)
def a18(spark, sf):
    """Main and further images, each once at its first place."""
    key = F.concat(F.lit("i"), (F.col("p_partkey") % 50).cast("string"))
    main = F.when(F.col("p_size") % 3 != 0, key).otherwise("nan")
    more = F.when(F.col("p_size") % 4 != 0, F.concat(F.lit(" a"), F.col("p_size").cast("string"), F.lit(",,"), key, F.lit(",nan")))
    rows = table(spark, sf, "part").select(F.col("p_partkey").alias("product"), main.alias("main"), more.alias("more"))
    return D.product_images(rows, "main", "more").select("product", "image", "at")


@query(
    "a6_rare_concepts",
    f"""WITH c AS (SELECT DISTINCT im_id, c FROM ({COMPACT})), n AS (SELECT count(DISTINCT im_id) AS n FROM detections)
    SELECT c AS concept, count(*) AS support, count(*) / max(n) AS share FROM c, n GROUP BY c HAVING count(*) < 0.2 * max(n)""",
)
def a6(spark, sf):
    rows = dirty_rows(spark, sf)
    return D.rare_concepts(rows, 0.2 * rows.count()).select("concept", "support", "share")


@query(
    "w16_drift_bound",
    f"""WITH s AS ({SPLIT}), c AS (SELECT DISTINCT im_id AS row_id, c FROM ({COMPACT})),
    n AS (SELECT count(*) AS n, count(*) FILTER (split = 'train') AS tr, count(*) FILTER (split = 'val') AS va, count(*) FILTER (split = 'test') AS te FROM s),
    p AS (SELECT c.c AS concept, count(*) / CAST(any_value(n.n) AS DOUBLE) AS f, count(*) FILTER (split = 'train') / CAST(any_value(n.tr) AS DOUBLE) AS tr,
      count(*) FILTER (split = 'val') / CAST(any_value(n.va) AS DOUBLE) AS va, count(*) FILTER (split = 'test') / CAST(any_value(n.te) AS DOUBLE) AS te
      FROM c JOIN s USING (row_id), n GROUP BY c.c)
    SELECT concept, round(f, 6) AS "full", round(tr, 6) AS train, round(va, 6) AS val, round(te, 6) AS test,
      round(greatest(abs(tr - f), abs(va - f), abs(te - f)), 6) AS max_drift FROM p""",
)
def w16_drift(spark, sf):
    """How frequent each concept is overall and in every part of the split, and the largest difference."""
    drift = D.split_drift(D.split_rows(dirty_rows(spark, sf)))
    return drift.select("concept", *[F.round(c, 6).alias(c) for c in ("full", "train", "val", "test", "max_drift")])


@query(
    "e9_refused",
    """SELECT im_id AS row_index, CASE WHEN im_id % 9 = 0 THEN 'unknown row' WHEN im_id % 9 = 1 THEN 'no index' ELSE 'negative index' END AS reason
    FROM (SELECT DISTINCT im_id FROM detections) WHERE im_id % 9 IN (0, 1, 2)""",
)
def e9_refused(spark, sf):
    """Corrections that can't be applied, with the reason."""
    rows = dirty_rows(spark, sf)
    kind = F.col("row_id") % 9
    edits = rows.select(
        F.col("row_id").alias("row_index"),
        F.when(kind.isin(0, 3), "add").when(kind == 1, "remove").otherwise("replace").alias("action"),
        F.when(kind == 2, -1).when(kind > 3, 0).cast("int").alias("concept_index"),
    )
    known = rows.filter(kind != 0)
    return review.refused_corrections(known, edits).select("row_index", "reason")
