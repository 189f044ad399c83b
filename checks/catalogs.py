"""Catalogs, columns, rules, lookups, content hashes, small text rules."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom.functions import codecs as C
from boxloom.functions import text as T
from boxloom.operators import catalog as K
from boxloom.operators import gallery
from boxloom.session import checkpoint_dir
from boxloom.sources.ranges import read_large_catalog
from boxloom.sources.sinks import write_csv
from checks.registry import query
from checks.views import content, detections, exclusions, images, products, table

RULES = [
    K.Rule("r1", ["Economy", "promo "], "Women"),
    K.Rule("r2", ["PROMO", "small"]),
    K.Rule("r3", ["large"]),
    K.Rule("empty", []),
]


def pool(spark, sf) -> DataFrame:
    return K.expanded_images(products(spark, sf), "main_image_url", "additional_image_url")


def ruled(spark, sf) -> DataFrame:
    return K.matched_rules(pool(spark, sf), RULES, "category", "gender")


@query(
    "w6_expand",
    """SELECT product_id, im_url, row_number() OVER (PARTITION BY product_id ORDER BY n) - 1 AS image_no,
       substr(md5('shop|' || product_id || '|' || im_url), 1, 16) AS im_id, substr(md5(im_url), 1, 16) AS url_id FROM product_images""",
)
def w6(spark, sf):
    """One row per product image (W6) with both kinds of stable id."""
    ids = T.catalog_image_id(F.lit("shop"), F.col("product_id"), F.col("im_url"))
    out = pool(spark, sf).select("product_id", "im_url", F.col("image_no").cast("long").alias("image_no"), ids.alias("im_id"))
    return out.withColumn("url_id", T.image_id(F.col("im_url")))


@query(
    "w5_catalog_pool",
    """WITH e AS (SELECT i.*, p.pos FROM product_images i JOIN products p USING (product_id) WHERE p.pos % 11 <> 0 AND p.primary_category IN ('ECONOMY', 'PROMO')),
    k AS (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY n) AS rn FROM e),
    f AS (SELECT im_url, min(pos * 10 + n) AS at FROM k WHERE rn <= 2 GROUP BY im_url)
    SELECT 'shop' AS catalog_name, CAST(CAST(trunc(f.at / 10) AS BIGINT) AS VARCHAR) AS product_id, f.im_url FROM f""",
)
def w5(spark, sf):
    """Category terms, at most two images per product, one row per URL."""
    out = K.catalog_pool(products(spark, sf), "shop", "main_image_url", "additional_image_url", terms=["economy", "Promo"], per_product=2)
    return out.select("catalog_name", "product_id", "im_url")


@query(
    "f3_rules",
    """SELECT product_id, im_url, CASE rule WHEN 0 THEN 'r1' WHEN 1 THEN 'r2' ELSE 'r3' END AS matched_rule,
       upper(primary_category[1]) || lower(primary_category[2:]) AS category_clean FROM matched""",
)
def f3(spark, sf):
    return ruled(spark, sf).select("product_id", "im_url", "matched_rule", "category_clean")


@query(
    "a1_pool_size",
    "SELECT upper(primary_category[1]) || lower(primary_category[2:]) AS category, count(*) AS pool_size FROM matched GROUP BY 1",
)
def a1(spark, sf):
    return K.pool_size(ruled(spark, sf))


@query(
    "a2_value_counts",
    """WITH c AS (SELECT gender, count(*) AS rows FROM products GROUP BY gender)
       SELECT gender, rows, round(rows / CAST((SELECT max(rows) FROM c) AS DOUBLE), 6) AS share_of_top FROM c""",
)
def a2(spark, sf):
    return K.value_counts(products(spark, sf), "gender").withColumn("share_of_top", F.round("share_of_top", 6))


@query(
    "f2_category_terms",
    """SELECT product_id, primary_category LIKE '%MEDIUM%' AS must FROM products
       WHERE (primary_category LIKE '%E%') AND NOT (primary_category LIKE '%LARGE%')""",
)
def f2(spark, sf):
    """Any-term filter (F2), excluded terms (F4), must-include mark."""
    p = products(spark, sf).withColumn("category", T.primary_category(F.col("category")))
    kept = K.without_terms(K.with_any_term(p, "category", ["e", " "]), "category", ["Large"])
    return kept.select("product_id", K.contains_any(F.col("category"), ["medium"]).alias("must"))


@query(
    "f7_detail_view",
    """SELECT doc_id, doc_id % 4 = 1 AS is_detail_view, lang IN ('en', 'fr') AS detail_allowed_category,
       (doc_id % 4 <> 1) OR lang IN ('en', 'fr') AS passes_detail_filter, doc_id % 2 = 0 AS human FROM documents""",
)
def f7(spark, sf):
    """Detail views (F7) and the person tag."""
    tags = F.when(F.col("doc_id") % 4 == 1, " image_detail:detail ,x").when(F.col("doc_id") % 2 == 0, "a, image_human:model").otherwise("")
    docs = table(spark, sf, "documents").select("doc_id", F.upper("lang").alias("category"), tags.alias("tags"))
    out = K.detail_view_flags(docs, ["en", "fr"])
    return out.select(
        "doc_id", "is_detail_view", "detail_allowed_category", "passes_detail_filter",
        K.has_tag(F.col("tags"), K.HUMAN_TAG).alias("human"),
    )


@query(
    "f8_relevant_class",
    "SELECT o_orderkey AS im_id, o_orderkey % 3 <> 0 OR (o_orderkey + 1) % 3 <> 0 AS relevant FROM orders",
)
def f8(spark, sf):
    from checks.views import plain_annotations

    a = plain_annotations(spark, sf)
    return a.select("im_id", K.has_relevant_class(F.col("visible_classes"), ["ring", "earring"]).alias("relevant"))


@query(
    "c12_canonical",
    """SELECT im_id, pos, CASE name WHEN 'ring' THEN 'finger_ring' ELSE 'ear_jewel' END AS name FROM detections WHERE name <> 'bracelet'""",
)
def c12(spark, sf):
    """Labels in any spelling to class names; only requested classes stay."""
    label = F.when(F.col("name") == "ring", " Finger Ring").when(F.col("name") == "earring", "STUD").otherwise("bangle")
    d = detections(spark, sf).withColumn("name", label)
    return K.canonical_classes(d, {"stud": "ear_jewel", "hoop": "ear_jewel"}, ["finger_ring", "ear_jewel"]).select("im_id", "pos", "name")


@query(
    "f12_object_filter",
    """SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN 'top|dress|outerwear' WHEN 1 THEN 'top|bag' WHEN 2 THEN 'all' WHEN 3 THEN 'all' WHEN 4 THEN 'dress|outerwear|top' ELSE 'all' END AS classes,
       CASE p_size % 6 WHEN 0 THEN 'top' WHEN 1 THEN '' WHEN 2 THEN '' WHEN 3 THEN 'zzz' WHEN 4 THEN 'dress' ELSE '' END AS label FROM part""",
)
def f12(spark, sf):
    kind = F.col("p_size") % 6
    words = ["top", "top; bag", "bag;all", "zzz", "dress", ""]
    expr = F.element_at(C.strings(*words), kind + 1)
    wanted = K.wanted_classes(expr, ["top", "dress", "outerwear", "bag"])
    label = K.output_label(expr)
    return table(spark, sf, "part").select("p_partkey", F.coalesce(F.array_join(wanted, "|"), F.lit("all")).alias("classes"), label.alias("label"))


# --- columns ----------------------------------------------------------------


@query(
    "p4_first_filled",
    "SELECT product_id, title AS im_name, '' AS im_description, substr(md5('http://img.test/' || (pos % 700) || '.jpg'), 1, 16) AS im_id FROM products WHERE pos % 11 <> 0",
)
def p4(spark, sf):
    """Column choice (P4), image column and id."""
    p = products(spark, sf).filter("pos % 11 <> 0").withColumnRenamed("main_image_url", "image_url")
    p = p.withColumn("title2", F.col("title")).withColumn("description", F.lit(" "))
    names = {"im_name": ["name", "missing", "title2"], "im_description": ["description"]}
    return K.with_image_key(K.first_filled_columns(p, names)).select("product_id", "im_name", "im_description", "im_id")


@query(
    "p13_audience",
    "SELECT product_id, CASE p_size % 4 WHEN 0 THEN 'women' WHEN 1 THEN 'men' WHEN 2 THEN 'kids' ELSE 'unisex' END AS audience FROM products",
)
def p13(spark, sf):
    return products(spark, sf).select("product_id", T.audience(F.col("tags")).alias("audience"))


@query(
    "p9_category_text",
    """SELECT product_id, primary_category || ', ALL' AS category, upper(primary_category[1]) || lower(primary_category[2:]) AS titled,
       'Title: ' || title || CASE WHEN p_size % 2 = 0 THEN ', Gender: ' || gender ELSE '' END || ', Colour: red, Brand: ' || brand AS details FROM products""",
)
def p9(spark, sf):
    """Category text (P8, P9) and product text."""
    p = products(spark, sf)
    blank = F.lit("")
    gender = F.when(F.col("p_size") % 2 == 0, F.col("gender"))
    details = T.product_text(F.col("title"), blank, gender, blank, F.lit("red"), F.lit(None).cast("string"), F.col("brand"))
    return p.select(
        "product_id", T.category_text(F.col("category")).alias("category"),
        T.title_case(T.primary_category(F.col("category"))).alias("titled"), details.alias("details"),
    )


@query(
    "p11_merged_tags",
    """SELECT o_orderkey AS im_id, 'ring,ring,x' || CASE WHEN (o_orderkey + 1) % 3 <> 0 THEN ',earring' ELSE '' END
       || CASE WHEN (o_orderkey + 2) % 3 <> 0 THEN ',bracelet' ELSE '' END || ',fallback_sample:true' AS tags FROM orders""",
)
def p11(spark, sf):
    from checks.views import plain_annotations

    merged = T.merged_tags(F.lit("ring, ring,,x"), F.from_json("visible_classes", "array<string>"))
    return plain_annotations(spark, sf).select("im_id", T.with_tag(merged, "fallback_sample:true").alias("tags"))


@query(
    "c1_list_cell",
    """SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN '' WHEN 1 THEN p_type || '|' || p_name WHEN 2 THEN p_type || '|b' WHEN 3 THEN p_name ELSE '[broken' END AS items,
       CASE p_size % 5 WHEN 1 THEN '' WHEN 2 THEN '' ELSE '' END AS urls FROM part""",
)
def c1(spark, sf):
    kind = F.col("p_size") % 5
    cell = (
        F.when(kind == 0, "  ")
        .when(kind == 1, F.concat(F.lit('["'), "p_type", F.lit(' ", "'), "p_name", F.lit('"]')))
        .when(kind == 2, F.concat(F.lit("['"), "p_type", F.lit("', 'b']")))
        .when(kind == 3, F.col("p_name"))
        .otherwise("[broken")
    )
    return table(spark, sf, "part").select(
        "p_partkey", F.array_join(C.list_cell(cell), "|").alias("items"), F.array_join(C.url_list_cell(cell), "|").alias("urls")
    )


@query(
    "c3_class_list",
    """SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'ring|bag' WHEN 1 THEN 'ring|tie' WHEN 2 THEN '' ELSE 'tie|belt|tie' END AS classes,
       CASE p_size % 4 WHEN 0 THEN 'ring:multiple|bag:singular' WHEN 1 THEN 'ring:singular|tie:singular' WHEN 2 THEN '' ELSE 'tie:singular|belt:singular' END AS counts FROM part""",
)
def c3(spark, sf):
    """Class lists (C3) and multiplicity, last mention wins (C4)."""
    kind = F.col("p_size") % 4
    cell = F.when(kind == 0, '["Ring ","bag"]').when(kind == 1, "Ring, tie,,").when(kind == 2, "").otherwise("['TIE','belt','tie']")
    many = F.when(kind == 0, '["ring","Ring (multiple)","bag"]').when(kind == 3, "['tie (multiple)','belt','tie']").otherwise(cell)
    counts = F.transform(C.class_multiplicity(many), lambda m: F.concat(m["class_name"], F.lit(":"), m["multiplicity"]))
    return table(spark, sf, "part").select(
        "p_partkey", F.array_join(C.class_list_cell(cell), "|").alias("classes"), F.array_join(counts, "|").alias("counts")
    )


@query(
    "c15_url_slug",
    r"""WITH p AS (SELECT page_id, url, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path FROM pages),
    n AS (SELECT page_id, url, regexp_extract(path, '([^/]*)/*$', 1) AS name FROM p),
    s AS (SELECT *, regexp_replace(name, '^(.+)\.[^.]*$', '\1') AS stem FROM n)
    SELECT page_id, url LIKE 'http://%' OR url LIKE 'https://%' AS is_http, CASE WHEN stem = '' THEN 'image' ELSE substr(stem, 1, 80) END AS slug,
      substr(md5(url), 1, 2) || '/' || md5(url) AS stored_at FROM s""",
)
def c15(spark, sf):
    """URL slug (C15), http test (F1), content-addressed place."""
    key = F.md5(F.col("url").cast("binary"))
    return table(spark, sf, "pages").select(
        "page_id", C.is_http(F.col("url")).alias("is_http"), T.url_slug(F.col("url")).alias("slug"),
        F.concat(F.substring(key, 1, 2), F.lit("/"), key).alias("stored_at"),
    )


@query(
    "c14_flagged_reason",
    """SELECT doc_id, CASE WHEN doc_id % 2 = 0 AND doc_id % 3 = 0 THEN '[FLAGGED BLURRY] Out of Focus ' || lang
       WHEN doc_id % 3 = 0 THEN 'Out of Focus ' || lang ELSE 'wrong class' END AS reason FROM documents""",
)
def c14(spark, sf):
    docs = table(spark, sf, "documents")
    reason = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("Out of Focus "), "lang")).otherwise("wrong class")
    return docs.select("doc_id", T.flagged_reason(F.col("doc_id") % 2 != 0, reason).alias("reason"))


@query(
    "c10_template",
    "SELECT doc_id, 'Is this a ' || lang || '? {other} ' || source AS prompt, lang IN ('en', 'fr') AS truthy FROM documents",
)
def c10(spark, sf):
    """Template fill (C10), flag text."""
    docs = table(spark, sf, "documents")
    prompt = T.filled_template("Is this a {class}? {other} {task}", {"class": F.col("lang"), "task": F.col("source")})
    flag = F.when(F.col("lang") == "en", " YES ").when(F.col("lang") == "fr", "on").otherwise("0")
    return docs.select("doc_id", prompt.alias("prompt"), C.truthy(flag).alias("truthy"))


# --- content hashes ---------------------------------------------------------


@query(
    "e13_content_dedup",
    """SELECT image_content_hash, min(pos) AS pos, arg_min(im_url, pos) AS im_url FROM content WHERE image_content_hash <> '' GROUP BY 1""",
)
def e13(spark, sf):
    c = content(spark, sf)
    out = K.content_deduplicated(c.drop("image_content_hash"), c.select("im_url", "image_content_hash"))
    return out.select("image_content_hash", "pos", "im_url")


@query(
    "e14_exclusion_hashes",
    "SELECT DISTINCT image_content_hash FROM content WHERE image_content_hash <> '' AND pos % 17 = 0",
)
def e14(spark, sf):
    """No usable hash column: hashes are found through the URLs."""
    c = content(spark, sf).withColumn("im_url", F.replace("im_url", F.lit("doc:"), F.lit("http:")))
    listed = c.filter("pos % 17 = 0").select("im_url", F.lit("not a hash").alias("im_name"))
    return K.exclusion_hashes(listed, "im_name", c.select("im_url", "image_content_hash"))


@query(
    "f14_exclusion_tag",
    """SELECT pos, CASE WHEN image_content_hash IN (SELECT image_content_hash FROM exclusions) THEN 'deduplicated' ELSE source END AS tags FROM content""",
)
def f14(spark, sf):
    c = content(spark, sf).withColumn("tags", F.col("source"))
    return K.with_exclusion_tag(c, exclusions(spark, sf)).select("pos", "tags")


@query(
    "w18_repeated",
    """SELECT pos, image_content_hash <> '' AND (image_content_hash IN (SELECT image_content_hash FROM exclusions)
       OR pos > min(pos) OVER (PARTITION BY image_content_hash)) AS repeated FROM content""",
)
def w18(spark, sf):
    return K.repeated_content(content(spark, sf), exclusions(spark, sf)).select("pos", "repeated")


@query(
    "e15_name_audit",
    "SELECT doc_id, doc_id % 2 = 0 AS name_matches, NOT (doc_id % 2 <> 0 AND doc_id % 3 = 0) AS is_md5 FROM documents",
)
def e15(spark, sf):
    """Stored name against content (E15), md5 form."""
    name = F.when(F.col("doc_id") % 2 == 0, F.md5(F.col("text").cast("binary"))).when(F.col("doc_id") % 3 == 0, "x").otherwise(F.lit("A" * 32))
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").cast("binary").alias("content"), name.alias("im_name"))
    return K.name_matches_content(docs).select("doc_id", "name_matches", T.is_md5(F.col("im_name")).alias("is_md5"))


# --- lookups ----------------------------------------------------------------


@query(
    "j1_catalog_tags",
    """SELECT i.im_id, CASE WHEN p.product_id IS NULL THEN 'unknown' ELSE CASE p.p_size % 4 WHEN 0 THEN 'women' WHEN 1 THEN 'men' WHEN 2 THEN 'kids' ELSE 'unisex' END END AS gender
       FROM images i LEFT JOIN products p ON p.product_id = CAST(i.im_id % 2500 AS VARCHAR)""",
)
def j1(spark, sf):
    p = products(spark, sf)
    twice = p.unionByName(p.withColumn("pos", F.col("pos") + 1000000).withColumn("tags", F.lit("['kids']")))
    sample = images(spark, sf).select("im_id", (F.col("im_id") % 2500).cast("string").alias("product_id"))
    return K.with_catalog_tags(sample, twice).select("im_id", "gender")


@query(
    "j3_pool_details",
    """SELECT i.im_id, i.im_url, f.product_id FROM images i LEFT JOIN
       (SELECT im_url, arg_min(product_id, CAST(product_id AS BIGINT)) AS product_id FROM product_images GROUP BY im_url) f USING (im_url)""",
)
def j3(spark, sf):
    details = pool(spark, sf).withColumn("pos", F.col("pos") * 10 + F.col("image_no"))
    return K.with_pool_details(images(spark, sf).select("im_id", "im_url"), details, ["product_id"])


@query(
    "s4_combined",
    """SELECT substr(md5(im_url), 1, 16) AS im_id, min(CAST(product_id AS BIGINT) * 10 + n) AS first_at, count(*) AS n FROM product_images GROUP BY 1""",
)
def s4(spark, sf):
    """First row per image id over catalogs."""
    rows = pool(spark, sf).withColumn("im_id", T.image_id(F.col("im_url")))
    # Place inside the product: main image 0, shared image 1, own image 2.
    slot = F.when(F.trim("main_image_url") == F.col("im_url"), 0).when(F.col("im_url").startswith("https"), 2).otherwise(1)
    rows = rows.withColumn("first_at", F.col("product_id").cast("long") * 10 + slot)
    counts = rows.groupBy("im_id").agg(F.count(F.lit(1)).alias("n"))
    firsts = K.combined_catalogs(rows, ["im_id", "product_id"], "first_at")
    return firsts.select("im_id", "first_at").join(counts, "im_id")


@query(
    "e16_upload_map",
    """WITH u AS (SELECT DISTINCT im_url FROM images UNION SELECT DISTINCT im_url FROM product_images),
       m AS (SELECT im_url AS original_url, md5(im_url) AS vis_uri, 'https://host.test/' || md5(im_url) AS new_url FROM u WHERE substr(md5(im_url), 1, 1) < '8')
       SELECT im_id, m.new_url AS im_url, m.vis_uri, i.im_url AS original_url FROM images i JOIN m ON m.original_url = i.im_url""",
)
def e16(spark, sf):
    """One distinct URL list over two tables (A10), upload map (E16), failures dropped."""
    urls = K.distinct_urls([images(spark, sf), pool(spark, sf)])
    key = F.md5(F.col("im_url").cast("binary"))
    done = urls.filter(F.substring(key, 1, 1) < "8").select(
        F.col("im_url").alias("original_url"), key.alias("vis_uri"), F.concat(F.lit("https://host.test/"), key).alias("im_url")
    )
    return K.with_uploaded_urls(images(spark, sf).select("im_id", "im_url"), done)


@query(
    "c23_signed_urls",
    """SELECT im_id, CASE WHEN im_id % 3 = 0 THEN 'https://own.test/' || im_id WHEN im_id % 2 = 0 THEN 'https://own.test/signed' || im_id ELSE im_url END AS im_url FROM images""",
)
def c23(spark, sf):
    own = F.concat(F.lit("https://own.test/"), F.col("im_id").cast("string"))
    rows = images(spark, sf).select("im_id", F.when(F.col("im_id") % 3 == 0, own).otherwise(F.col("im_url")).alias("im_url"))
    signed = rows.filter("im_id % 2 = 0").select(F.col("im_url").alias("url"), F.concat(F.lit("https://own.test/signed"), F.col("im_id").cast("string")).alias("signed_url"))
    return K.with_signed_urls(rows, signed, "own.test")


@query(
    "f23_card_gallery",
    "SELECT product_id FROM products WHERE p_size % 4 = 0 AND primary_category IN ('PROMO', 'SMALL') AND lower(title) LIKE '%ring%' AND lower(brand) LIKE '%brand%'",
)
def f23(spark, sf):
    p = products(spark, sf).withColumn("tags", F.when(F.col("p_size") % 4 == 0, "women, new").otherwise("men,new"))
    p = p.withColumn("category", T.primary_category(F.col("category")))
    return gallery.matching_cards(p, ["women", "new"], ["PROMO", "SMALL"], " RING  brand", ["title", "brand"]).select("product_id")


@query(
    "f24_catalog_gallery",
    "SELECT product_id FROM products WHERE gender = 'Men' AND (lower(title) LIKE '%ring%' OR lower(brand) LIKE '%ring%' OR lower(primary_category) LIKE '%ring%')",
)
def f24(spark, sf):
    p = products(spark, sf).withColumn("catalog_name", F.col("gender"))
    return gallery.matching_catalog_rows(p, "Men", "Ring").select("product_id")


@query(
    "s2_large_csv",
    """SELECT CAST(o_orderkey AS VARCHAR) AS im_id, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos,
      CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'ring, "' || o_orderstatus || '"' || chr(10) || o_orderpriority END AS im_description FROM orders""",
    python=True,
)
def s2_large_csv(spark, sf):
    """Catalog file with quoted line ends, written from a table and read back by ranges, in order."""
    text = F.concat(F.lit('ring, "'), F.col("o_orderstatus"), F.lit('"\n'), F.col("o_orderpriority"))
    rows = table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 5 != 0, text).alias("im_description"))
    path = f"{checkpoint_dir(spark)}/catalogs/{uuid.uuid4().hex}"
    write_csv(rows.select(F.col("o_orderkey").alias("im_id"), "im_description").orderBy("im_id"), path)
    return read_large_catalog(spark, path).select("im_id", "pos", "im_description")
