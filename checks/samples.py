"""Sampling and model annotation."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from boxloom.functions import codecs as C
from boxloom.functions import geometry as G
from boxloom.functions.text import settings_hash
from boxloom.operators import annotate as A
from boxloom.operators import catalog as K
from boxloom.operators import groups
from boxloom.operators import sampling as S
from boxloom.plans.sampling import category_sample
from boxloom.session import checkpoint_dir
from checks.catalogs import RULES, ruled
from checks.registry import query
from checks.views import content, detections, exclusions, images, plain_annotations, products, table

CORNERS = list(G.Box._fields)


@query(
    "w7_shuffle",
    """SELECT o_orderkey, row_number() OVER (ORDER BY md5(o_orderkey || '|7'), o_orderkey) AS rank,
       CAST(trunc((row_number() OVER (ORDER BY md5(o_orderkey || '|7'), o_orderkey) - 1) / 2000) AS BIGINT) AS batch FROM orders""",
)
def w7(spark, sf):
    """Seeded order (W7) cut into batches."""
    orders = table(spark, sf, "orders").select("o_orderkey")
    return S.batches(S.shuffled(orders, "o_orderkey", 7), 2000)


@query(
    "w9_random_rows",
    "SELECT o_orderkey FROM orders ORDER BY md5(o_orderkey || '|3'), o_orderkey LIMIT 500",
)
def w9(spark, sf):
    return S.random_rows(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 500, seed=3)


# Redistribution rounds; ``cap`` is the room of a category.
BUDGET = """WITH RECURSIVE pools AS ({pools}),
rounds AS (
  SELECT 0 AS n, category, pool_size, greatest({floor}, least({ceil}, pool_size,
         CAST(round_even({total} * sqrt(greatest(pool_size, 1)) / (SELECT sum(sqrt(greatest(pool_size, 1))) FROM pools), 0) AS BIGINT))) AS budget FROM pools
  UNION ALL
  SELECT n + 1, category, pool_size, budget + CASE WHEN gone < left_over THEN step ELSE 0 END FROM (
    SELECT *, coalesce(sum(step) OVER (ORDER BY pool_size DESC, category ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gone FROM (
      SELECT *, CASE WHEN budget < least({ceil}, pool_size) AND left_over > 0
             THEN least(greatest(1, left_over // greatest(1, openings)), least({ceil}, pool_size) - budget) ELSE 0 END AS step FROM (
        SELECT *, {total} - sum(budget) OVER () AS left_over, sum(CASE WHEN budget < least({ceil}, pool_size) THEN 1 ELSE 0 END) OVER () AS openings
        FROM rounds WHERE n < 10))))
"""


def budget_sql(pools: str, total: str, floor: int, ceil: int) -> str:
    sql = BUDGET
    for key, value in {"pools": pools, "total": total, "floor": str(floor), "ceil": str(ceil)}.items():
        sql = sql.replace("{" + key + "}", value)
    return sql


USER_POOLS = "SELECT event_type || (user_id % 20) AS category, count(*) AS pool_size FROM events GROUP BY 1"


def user_pools(spark, sf) -> DataFrame:
    name = F.concat("event_type", (F.col("user_id") % 20).cast("string"))
    return table(spark, sf, "events").groupBy(name.alias("category")).agg(F.count(F.lit(1)).alias("pool_size"))


@query(
    "w10_budget",
    budget_sql(USER_POOLS, "4000", 3, 60) + "SELECT category, pool_size, CAST(budget AS BIGINT) AS budget FROM rounds WHERE n = 10",
)
def w10(spark, sf):
    return S.allocated_budget(user_pools(spark, sf), 4000, 3, 60)


@query(
    "w11_fixed_budget",
    budget_sql(
        f"SELECT * FROM ({USER_POOLS}) WHERE category NOT IN ('error1', 'error2')",
        f"(4000 - (SELECT sum(least(pool_size, CASE category WHEN 'error1' THEN 10 ELSE 100000 END)) FROM ({USER_POOLS}) WHERE category IN ('error1', 'error2')))",
        0, 90,
    )
    + f"""SELECT category, pool_size, CAST(budget AS BIGINT) AS budget FROM rounds WHERE n = 10
        UNION ALL SELECT category, pool_size, least(pool_size, CASE category WHEN 'error1' THEN 10 ELSE 100000 END) FROM ({USER_POOLS}) WHERE category IN ('error1', 'error2')""",
)
def w11(spark, sf):
    fixed = {" ERROR1": "10", "error2": 100000, "nothing": 4, "error3": "many", "error4": -2}
    # Pools grow with the input, the total doesn't: fixed targets may come to exceed it.
    return S.category_budget(user_pools(spark, sf), 4000, 3, 90, fixed, strict=False)


MATCHED_POOL = "SELECT upper(primary_category[1]) || lower(primary_category[2:]) AS category, count(*) AS pool_size FROM matched GROUP BY 1"
DRAWN = """drawn AS (
  SELECT m.*, row_number() OVER (PARTITION BY m.category ORDER BY md5(m.k || '|42'), m.k) AS rank FROM (
    SELECT upper(primary_category[1]) || lower(primary_category[2:]) AS category, product_id || '|' || im_url AS k, product_id, im_url FROM matched) m)"""


@query(
    "w12_stratified",
    budget_sql(MATCHED_POOL, "900", 20, 400)
    + f""", {DRAWN}, chosen AS (SELECT d.* FROM drawn d JOIN rounds r ON r.n = 10 AND r.category = d.category WHERE d.rank <= r.budget)
    SELECT category, im_url, product_id FROM (SELECT *, row_number() OVER (PARTITION BY im_url ORDER BY category, rank) AS copy FROM chosen) WHERE copy = 1""",
)
def w12(spark, sf):
    """Rules, budget and seeded draw, one row per image."""
    sample, _ = category_sample(products(spark, sf), RULES, "main_image_url", "additional_image_url", "category", "gender", total=900)
    return sample.select("category", "im_url", "product_id")


@query(
    "a11_budget_report",
    budget_sql(MATCHED_POOL, "900", 20, 400)
    + "SELECT category, pool_size, CAST(budget AS BIGINT) AS allocated, CAST(least(budget, pool_size) AS BIGINT) AS sampled FROM rounds WHERE n = 10",
)
def a11(spark, sf):
    return S.budget_report(S.category_budget(K.pool_size(ruled(spark, sf)), 900, 20, 400))


RATIO_IN = """SELECT o_orderkey AS im_id, CASE o_orderkey % 5 WHEN 0 THEN 'men' WHEN 1 THEN 'kids' ELSE 'women' END AS gender,
  lower(o_orderpriority) AS category FROM orders WHERE o_orderpriority NOT LIKE '%LOW%'"""


@query(
    "w13_ratio",
    f"""WITH r AS (SELECT *, category LIKE '%urgent%' AS must FROM ({RATIO_IN})),
    c AS (SELECT count(*) FILTER (must AND gender = 'women') AS w, count(*) FILTER (must AND gender = 'men') AS m FROM r),
    t AS (SELECT *, greatest(3000, CAST(trunc(m / CAST(0.30 AS DOUBLE)) AS BIGINT), CAST(trunc(w / CAST(0.70 AS DOUBLE)) AS BIGINT)) AS total FROM c),
    q AS (SELECT greatest(0, CAST(trunc(total * CAST(0.70 AS DOUBLE)) AS BIGINT) - w) AS women, greatest(0, CAST(trunc(total * CAST(0.30 AS DOUBLE)) AS BIGINT) - m) AS men FROM t),
    s AS (SELECT im_id, gender, must, row_number() OVER (PARTITION BY gender ORDER BY md5(im_id || '|42'), im_id) AS n FROM r WHERE NOT must AND gender IN ('women', 'men')),
    u AS (SELECT im_id, gender, true AS must_include FROM r WHERE must UNION ALL
      SELECT im_id, gender, false FROM s, q WHERE n <= CASE gender WHEN 'women' THEN women ELSE men END)
    SELECT *, row_number() OVER (ORDER BY md5(im_id || '|43'), im_id) AS rank FROM u""",
)
def w13(spark, sf):
    rows = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("im_id"),
        F.when(F.col("o_orderkey") % 5 == 0, "men").when(F.col("o_orderkey") % 5 == 1, "kids").otherwise("women").alias("gender"),
        F.col("o_orderpriority").alias("category"),
    )
    return S.ratio_sample(rows, always=["Urgent"], never=["low"]).select("im_id", "gender", "must_include", "rank")


TAGGED = """SELECT im_url, image_content_hash, pos, category, pos % 4 = 1 AS detail, pos % 2 = 0 OR pos % 4 = 1 AS human FROM content"""


def tagged(spark, sf) -> DataFrame:
    c = content(spark, sf)
    tags = F.when(F.col("pos") % 4 == 1, "image_detail:detail,image_human:model").when(F.col("pos") % 2 == 0, "image_human:model").otherwise("")
    return c.select("im_url", "image_content_hash", "pos", "category", tags.alias("tags"))


@query(
    "w14_presence_rounds",
    f"""WITH RECURSIVE r AS (SELECT *, row_number() OVER (ORDER BY md5(im_url || '|42'), im_url) AS rank FROM ({TAGGED})),
    f AS (SELECT r.*, CASE WHEN image_content_hash = '' THEN rank ELSE min(rank) OVER (PARTITION BY image_content_hash) END AS first_rank,
      image_content_hash IN (SELECT image_content_hash FROM exclusions) AS excluded,
      human AND (NOT detail OR category IN ('en', 'fr')) AS fine FROM r),
    n AS (SELECT count(*) AS size FROM f),
    w AS (SELECT 0 AS round, CAST(0 AS BIGINT) AS lo, CAST(0 AS BIGINT) AS hi, CAST(0 AS BIGINT) AS got
      UNION ALL
      SELECT round + 1, hi, hi + step, got + (SELECT count(*) FROM f WHERE f.rank > v.hi AND f.rank <= v.hi + v.step AND f.fine AND NOT f.excluded AND f.first_rank > v.hi)
      FROM (SELECT w.*, least(size - hi, greatest(150 - got, (150 - got) * 2)) AS step FROM w, n WHERE got < 150 AND hi < size AND round < 6) v)
    SELECT f.im_url, w.round, f.fine AND NOT f.excluded AND f.first_rank > w.lo AS accepted FROM f JOIN w ON f.rank > w.lo AND f.rank <= w.hi""",
)
def w14(spark, sf):
    """Rounds of twice the missing number; excluded or earlier content does not count."""
    out = S.presence_sample(tagged(spark, sf), 150, 2, 6, exclusions(spark, sf), ["en", "fr"])
    return out.evaluated.select("im_url", "round", "accepted")


CLASS_POOL = """SELECT o_orderkey AS im_id, 'http://img.test/' || o_orderkey || '.jpg' AS im_url, md5(CAST(o_custkey * 7 + o_orderkey % 9 AS VARCHAR)) AS h,
  o_orderkey % 4 <> 0 AS human, o_orderkey % 3 <> 0 OR (o_orderkey + 1) % 3 <> 0 AS relevant FROM orders"""


def class_pool(spark, sf) -> DataFrame:
    marks = plain_annotations(spark, sf).withColumn("visible_classes", F.when(F.col("im_id") % 7 < 3, "[]").otherwise(F.col("visible_classes")))
    h = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("im_id"),
        F.md5((F.col("o_custkey") * 7 + F.col("o_orderkey") % 9).cast("string").cast("binary")).alias("image_content_hash"),
    )
    tags = F.when(F.col("im_id") % 4 != 0, "x,image_human:model").otherwise("x")
    rows = marks.join(h, "im_id").withColumn("tags", tags)
    return rows.select("im_id", "im_url", F.lower("im_name").alias("category"), "tags", "visible_classes", "image_content_hash")


@query(
    "w15_batches",
    """WITH r AS (SELECT o_orderkey AS im_id, row_number() OVER (ORDER BY md5(o_orderkey || '|42'), o_orderkey) AS rank, o_orderkey % 4 <> 0 AND o_orderkey % 7 >= 3 AS good FROM orders),
    b AS (SELECT CAST(trunc((rank - 1) / 500) AS BIGINT) AS batch, count(*) FILTER (good) AS good, count(*) AS rows FROM r GROUP BY 1)
    SELECT *, CAST(sum(good) OVER (ORDER BY batch) AS BIGINT) AS running, CAST(sum(good) OVER (ORDER BY batch) + 5 AS BIGINT) AS accepted_so_far FROM b""",
)
def w15_batches(spark, sf):
    ranked = S.batches(S.shuffled(class_pool(spark, sf), "im_id"), 500)
    good = (F.col("im_id") % 4 != 0) & (F.col("im_id") % 7 >= 3)
    return S.batch_progress(ranked, good, offset=5)


@query(
    "w15_class_sample",
    """WITH p AS (SELECT o_orderkey AS im_id, 'http://img.test/' || o_orderkey || '.jpg' AS im_url, md5(CAST(o_custkey * 7 + o_orderkey % 9 AS VARCHAR)) AS h,
         o_orderkey % 4 <> 0 AS human, o_orderkey % 7 >= 3 AS seen, o_orderpriority LIKE '%URGENT%' AND o_orderpriority LIKE '%1%' AS must FROM orders),
    r AS (SELECT *, row_number() OVER (ORDER BY md5(im_id || '|42'), im_id) AS rank FROM p),
    m AS (SELECT *, row_number() OVER (PARTITION BY h ORDER BY rank) AS copy FROM (SELECT * FROM r WHERE must ORDER BY rank LIMIT 4000)),
    l AS (SELECT *, row_number() OVER (ORDER BY md5(im_id || '|42'), im_id) AS n FROM p WHERE NOT must),
    b AS (SELECT *, CAST(trunc((n - 1) / 500) AS BIGINT) AS batch, row_number() OVER (PARTITION BY h ORDER BY n) > 1 OR h IN (SELECT h FROM m) AS again FROM l),
    g AS (SELECT batch, sum(count(*) FILTER (human AND seen AND NOT again)) OVER (ORDER BY batch) AS running FROM b GROUP BY batch),
    stop AS (SELECT coalesce(min(batch), 1000000) AS last FROM g WHERE running > 0 AND running + (SELECT count(*) FROM m WHERE copy = 1) >= 4000),
    k AS (SELECT b.* FROM b, stop WHERE b.batch <= stop.last),
    a AS (SELECT im_id, rank AS seq FROM m WHERE copy = 1 UNION ALL SELECT im_id, 1000000000 + n FROM k WHERE human AND seen AND NOT again),
    f AS (SELECT im_id, 2000000000 + n AS seq FROM k WHERE human AND NOT again AND NOT seen ORDER BY n LIMIT greatest(0, 4000 - (SELECT count(*) FROM a)))
    SELECT im_id FROM (SELECT * FROM a UNION ALL SELECT * FROM f) ORDER BY seq LIMIT 4000""",
)
def w15(spark, sf):
    """Batches until 4000 images: must-include branch, positives, then the fallback pool."""
    return S.class_sample(class_pool(spark, sf), 4000, 500, ["ring", "earring", "bracelet"], ["1-urgent"]).accepted.select("im_id")


@query(
    "w17_facets",
    """WITH t AS (SELECT doc_id, 0 AS i, lang AS value FROM documents UNION ALL SELECT doc_id, 1, source FROM documents)
       SELECT value, CASE value WHEN 'fr' THEN 0 WHEN 'en' THEN 1 ELSE 2 END AS priority, min(doc_id) AS first_row FROM t GROUP BY value""",
)
def w17(spark, sf):
    docs = table(spark, sf, "documents").withColumnRenamed("doc_id", "pos")
    out = S.facet_order(docs, F.array("lang", "source"), ["fr", "en"])
    return out.select("value", "priority", "first_row")


@query(
    "a11_acceptance",
    "SELECT o_orderstatus AS catalog_name, count(*) AS evaluated, count(*) FILTER (o_orderkey % 3 = 0) AS accepted, round(count(*) FILTER (o_orderkey % 3 = 0) * 100.0 / CAST(count(*) AS DOUBLE), 1) AS acceptance_percent FROM orders GROUP BY 1",
)
def a11_acceptance(spark, sf):
    stats = table(spark, sf, "orders").groupBy(F.col("o_orderstatus").alias("catalog_name")).agg(
        F.count(F.lit(1)).alias("evaluated"), F.sum((F.col("o_orderkey") % 3 == 0).cast("long")).alias("accepted")
    )
    return S.acceptance_percent(stats)


# --- models -----------------------------------------------------------------


class TextDigest(A.RowAnnotator):
    """Stand-in for a remote model: md5 prefix of the text; every ninth key has no answer, every tenth fails."""

    fields = ST.StructType([ST.StructField("digest", ST.StringType())])

    def process(self, row: dict) -> dict:
        import hashlib

        if row["conv_id"] % 10 == 7:
            raise RuntimeError("no reply")
        if row["conv_id"] % 9 == 4:
            return {"digest": None}
        return {"digest": hashlib.md5(row["text"].encode()).hexdigest()[:8]}


def new_store(spark, keys: list[str]) -> A.ResultStore:
    return A.ResultStore(spark, f"{checkpoint_dir(spark)}/stores/{uuid.uuid4().hex}", keys)


@query(
    "u2_incremental",
    """SELECT conv_id, turn, CASE WHEN turn = 0 THEN 'cached' ELSE substr(md5(text), 1, 8) END AS digest FROM conversations
       WHERE turn = 0 OR (conv_id % 10 <> 7 AND conv_id % 9 <> 4)""",
    python=True,
)
def u2(spark, sf):
    """First turns are in the store; the model runs for the others only."""
    keys = ["conv_id", "turn"]
    talks = table(spark, sf, "conversations").select(*keys, "text")
    store = new_store(spark, keys)
    store.append(talks.filter("turn = 0").select(*keys, F.lit("cached").alias("digest")), 0)
    return A.annotated(talks, keys, TextDigest(), store, rounds=2)


@query(
    "j5_pending",
    "SELECT conv_id, turn FROM conversations WHERE turn <> 0",
)
def j5(spark, sf):
    keys = ["conv_id", "turn"]
    talks = table(spark, sf, "conversations").select(*keys, "text")
    store = new_store(spark, keys)
    store.append(talks.filter("turn = 0").select(*keys), 0)
    return store.pending(talks).select(*keys)


@query(
    "s7_cache_latest",
    "SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN 1 ELSE 0 END AS answer FROM conversations WHERE role = 'user'",
)
def s7(spark, sf):
    """Append twice, read the last answer per key (W2), for the requested keys."""
    keys = ["conv_id", "turn"]
    talks = table(spark, sf, "conversations").select(*keys, "role").dropDuplicates(keys)
    store = new_store(spark, keys)
    store.append(talks.select(*keys, F.lit(0).alias("answer")), store.next_run())
    store.append(talks.filter("turn % 2 = 0").select(*keys, F.lit(1).alias("answer")), store.next_run())
    return groups.join_on(store.latest(), talks.filter("role = 'user'"), keys, "left_semi").select(*keys, "answer")


@query(
    "j2_annotation_defaults",
    "SELECT im_id, CASE WHEN im_id % 4 = 0 THEN '[]' ELSE 'x' END AS visible_classes, CASE WHEN im_id % 4 = 0 THEN 'llm_failed' ELSE 'r' END AS gpt_reason FROM images",
)
def j2(spark, sf):
    marks = images(spark, sf).filter("im_id % 4 <> 0").select("im_id", F.lit("x").alias("visible_classes"), F.lit("r").alias("gpt_reason"))
    out = A.with_annotations(images(spark, sf).select("im_id"), marks, {"visible_classes": "[]", "gpt_reason": "llm_failed"})
    return out


class SizeJudge(A.RowAnnotator):
    """Stand-in for a verification model: large crops are fine."""

    fields = ST.StructType([ST.StructField("is_valid", ST.BooleanType()), ST.StructField("reason", ST.StringType())])

    def process(self, row: dict) -> dict:
        area = (row["cx2"] - row["cx1"]) * (row["cy2"] - row["cy1"])
        if area % 11 == 0:
            raise RuntimeError("no reply")
        return {"is_valid": area > 400, "reason": "large" if area > 400 else "too blurry"}


@query(
    "u5_verify",
    """WITH b AS (SELECT d.im_id, pos, name, CAST((least(image_w, x2) - x1) AS BIGINT) AS w, CAST((least(image_h, y2) - y1) AS BIGINT) AS h
         FROM detections d JOIN images i ON i.im_id = d.im_id),
    a AS (SELECT *, name <> 'bracelet' AS asked, CASE WHEN w > 0 AND h > 0 THEN w * h END AS area FROM b)
    SELECT im_id, pos, asked AS llm_validated, CASE WHEN asked AND area IS NOT NULL THEN area % 11 <> 0 AND area > 400 ELSE true END AS is_valid,
      CASE WHEN NOT asked OR area IS NULL THEN '' WHEN area % 11 = 0 THEN 'verification call failed' WHEN area > 400 THEN 'large' ELSE '[FLAGGED BLURRY] too blurry' END AS reason FROM a""",
    python=True,
)
def u5(spark, sf):
    """Verify boxes of two classes; the third passes unasked."""
    d = detections(spark, sf).join(images(spark, sf).select("im_id", "image_w", "image_h"), "im_id")
    store = new_store(spark, ["im_id", "name", "box_text", "settings"])
    out = A.verified_boxes(d, SizeJudge(), store, {}, settings_hash({"judge": "size"}), ["ring", "EARRING"])
    return out.select("im_id", "pos", "llm_validated", "is_valid", "reason")


def load_detector():
    """Detector that refuses batches with an odd-even mix and never answers for some images."""

    def model(rows: list[dict]) -> list[list[dict]]:
        if len({r["im_id"] % 2 for r in rows}) > 1:
            raise RuntimeError("mixed batch")
        return [
            [] if r["im_id"] % 5 == 0 else [{"name": "ring", "score": 0.5, "box": [0, 0, r["image_w"] // 2, r["image_h"] // 2]}] for r in rows
        ]

    return model


@query(
    "u4_detect",
    "SELECT im_id, CASE WHEN im_id % 5 = 0 THEN 0 ELSE 1 END AS boxes, CASE WHEN im_id % 5 <> 0 THEN CAST(image_w // 2 AS DOUBLE) END AS x2 FROM images",
    python=True,
)
def u4(spark, sf):
    out = A.detected(images(spark, sf).select("im_id", "image_w", "image_h"), load_detector, batch=4)
    return out.select("im_id", F.size("detections").alias("boxes"), F.get(F.get("detections", F.lit(0))["box"], F.lit(2)).alias("x2"))


@query(
    "u6_reply_tags",
    """SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '' ELSE array_to_string(list_sort([lang, 'image_human:model', source]), ',') END AS tags, doc_id % 3 <> 0 AS has_human FROM documents""",
)
def u6(spark, sf):
    def tag(c):
        return F.concat(F.lit('{"tag":"'), c, F.lit('"}'))

    docs = table(spark, sf, "documents")
    status = F.when(F.col("doc_id") % 3 == 0, "ERROR").otherwise("OK")
    reply = F.concat(
        F.lit('{"status":"'), status, F.lit('","result":[{"objects":[{"tags":['), tag(F.col("lang")), F.lit(","), tag(F.lit("image_human:model")),
        F.lit(',{"tag":""}]}]},{"objects":[{"tags":['), tag(F.col("source")), F.lit("]},{}]},{}]}"),
    )
    tags = A.reply_tags(reply)
    return docs.select("doc_id", F.array_join(tags, ",").alias("tags"), F.array_contains(tags, K.HUMAN_TAG).alias("has_human"))
