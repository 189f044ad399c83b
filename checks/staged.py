"""Samples that ask models round by round, stored results by bucket, packed requests."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from boxloom.operators import annotate as A
from boxloom.operators.detectors import KEYS, Detector, packed_detections
from boxloom.plans import staged
from boxloom.plans.annotation import AnnotationPlan, ProcessedCache, processed_boxes, recovered_dataset
from boxloom.session import checkpoint_dir
from checks.registry import query
from checks.samples import TAGGED, class_pool, new_store, tagged
from checks.views import annotations, detections, exclusions, images

TARGET, OVERSAMPLE, ROUNDS = 150, 2, 6
CATALOGS = ["c0", "c1", "c2"]


def rounds_sql(name: str, pool: str, excluded: str, target: int) -> str:
    """Common table expressions of the rounds over one catalog; ``e_<name>`` are the rows that they look at."""
    return f"""
    r_{name} AS (SELECT *, row_number() OVER (ORDER BY md5(im_url || '|42'), im_url) AS rank FROM ({pool})),
    f_{name} AS (SELECT r.*, CASE WHEN image_content_hash = '' THEN rank ELSE min(rank) OVER (PARTITION BY image_content_hash) END AS first_rank,
      image_content_hash IN ({excluded}) AS excluded, human AND (NOT detail OR category IN ('en', 'fr')) AS fine FROM r_{name} r),
    w_{name} AS (SELECT 0 AS round, CAST(0 AS BIGINT) AS lo, CAST(0 AS BIGINT) AS hi, CAST(0 AS BIGINT) AS got
      UNION ALL
      SELECT round + 1, hi, hi + step, got + (SELECT count(*) FROM f_{name} f WHERE f.rank > v.hi AND f.rank <= v.hi + v.step AND f.fine AND NOT f.excluded AND f.first_rank > v.hi)
      FROM (SELECT w.*, least(size - hi, greatest({target} - got, ({target} - got) * {OVERSAMPLE})) AS step FROM w_{name} w, (SELECT count(*) AS size FROM f_{name})
            WHERE got < {target} AND hi < size AND round < {ROUNDS}) v),
    e_{name} AS (SELECT f.*, w.round, f.fine AND NOT f.excluded AND f.first_rank > w.lo AS accepted FROM f_{name} f JOIN w_{name} w ON f.rank > w.lo AND f.rank <= w.hi)"""


def catalogs_sql(last: str) -> str:
    parts, excluded = [], "SELECT image_content_hash FROM exclusions WHERE image_content_hash <> ''"
    for n, name in enumerate(CATALOGS):
        parts.append(rounds_sql(name, f"SELECT * FROM ({TAGGED}) WHERE pos % 3 = {n}", excluded, 60))
        excluded += f" UNION ALL SELECT image_content_hash FROM e_{name} WHERE image_content_hash <> ''"
    return "WITH RECURSIVE " + ",".join(parts) + "\n" + last


class Presence(A.RowAnnotator):
    """Stand-in for a tagging service: the tags that the table of this check has for the image's number."""

    fields = ST.StructType([ST.StructField("tags", ST.StringType())])

    def process(self, row: dict) -> dict:
        pos = int(row["pos"])
        return {"tags": "image_detail:detail,image_human:model" if pos % 4 == 1 else "image_human:model" if pos % 2 == 0 else ""}


class PosTagger(staged.Asked):
    """The stand-in's requests carry the image's number instead of its pixels."""

    def answers(self, rows: DataFrame, columns: list[str], defaults: dict[str, str]) -> DataFrame:
        return super().answers(rows, [*columns, "pos"], defaults)


def new_folder(spark) -> str:
    return f"{checkpoint_dir(spark)}/stores/{uuid.uuid4().hex}"


def seen_content(spark, sf) -> staged.SeenContent:
    seen = staged.SeenContent(spark, new_folder(spark))
    seen.add(exclusions(spark, sf))
    return seen


def catalogs(spark, sf, tagger=None) -> staged.CatalogSamples:
    rows = tagged(spark, sf) if tagger is None else tagged(spark, sf).drop("tags")
    pools = {name: rows.filter(F.col("pos") % 3 == n) for n, name in enumerate(CATALOGS)}
    terms = {name: ["en", "fr"] for name in CATALOGS}
    return staged.catalog_presence_samples(pools, 60, OVERSAMPLE, ROUNDS, seen_content(spark, sf), tagger, terms)


@query(
    "w14_catalogs",
    catalogs_sql(" UNION ALL ".join(f"SELECT '{c}' AS catalog_name, im_url, round, accepted FROM e_{c}" for c in CATALOGS)),
)
def w14_catalogs(spark, sf):
    """Three catalogs that share content, one after the other; what an earlier one looked at does not count again."""
    return catalogs(spark, sf).evaluated.select("catalog_name", "im_url", "round", "accepted")


@query(
    "w14_catalog_stats",
    catalogs_sql(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS catalog_name, (SELECT count(*) FROM f_{c}) AS pool_size, count(*) AS evaluated,
            least(60, count(*) FILTER (accepted)) AS accepted, CAST(60 AS BIGINT) AS target, CAST(max(round) AS BIGINT) AS rounds,
            count(*) >= (SELECT count(*) FROM f_{c}) AS exhausted FROM e_{c}"""
            for c in CATALOGS
        )
    ),
    python=True,
)
def w14_catalog_stats(spark, sf):
    """Counters per catalog, with the tags asked for round by round."""
    return catalogs(spark, sf, PosTagger(Presence(), new_store(spark, ["im_url"]))).stats


@query(
    "w14_staged",
    "WITH RECURSIVE " + rounds_sql("one", TAGGED, "SELECT image_content_hash FROM exclusions", TARGET) + " SELECT im_url, round, accepted FROM e_one",
    python=True,
)
def w14_staged(spark, sf):
    tagger = PosTagger(Presence(), new_store(spark, ["im_url"]))
    pool = tagged(spark, sf).drop("tags")
    out = staged.staged_presence_sample(pool, TARGET, OVERSAMPLE, ROUNDS, tagger, exclusions(spark, sf), ["en", "fr"])
    return out.evaluated.select("im_url", "round", "accepted")


class VisibleClasses(A.RowAnnotator):
    """Stand-in for a vision model: the classes that the table of this check has for the image."""

    fields = ST.StructType([ST.StructField("visible_classes", ST.StringType()), ST.StructField("gpt_reason", ST.StringType())])

    def process(self, row: dict) -> dict:
        return {"visible_classes": "[]" if int(row["im_id"]) % 7 < 3 else '["ring"]', "gpt_reason": "seen"}


@query(
    "w15_staged",
    """WITH p AS (SELECT o_orderkey AS im_id, md5(CAST(o_custkey * 7 + o_orderkey % 9 AS VARCHAR)) AS h, o_orderkey % 4 <> 0 AS human, o_orderkey % 7 >= 3 AS seen,
         o_orderpriority LIKE '%URGENT%' AND o_orderpriority LIKE '%1%' AND o_orderkey % 50 = 1 AS must FROM orders),
    r AS (SELECT *, row_number() OVER (ORDER BY md5(im_id || '|42'), im_id) AS rank FROM p),
    m AS (SELECT *, row_number() OVER (PARTITION BY h ORDER BY rank) AS copy FROM (SELECT * FROM r WHERE must ORDER BY rank LIMIT 1200)),
    l AS (SELECT *, row_number() OVER (ORDER BY md5(im_id || '|42'), im_id) AS n FROM p WHERE NOT must),
    b AS (SELECT *, CAST(trunc((n - 1) / 500) AS BIGINT) AS batch, row_number() OVER (PARTITION BY h ORDER BY n) > 1 OR h IN (SELECT h FROM m) AS again FROM l),
    g AS (SELECT batch, sum(count(*) FILTER (human AND seen AND NOT again)) OVER (ORDER BY batch) AS running FROM b GROUP BY batch),
    stop AS (SELECT coalesce(min(batch), 1000000) AS last FROM g WHERE running > 0 AND running + (SELECT count(*) FROM m WHERE copy = 1) >= 1200),
    k AS (SELECT b.* FROM b, stop WHERE b.batch <= stop.last),
    a AS (SELECT im_id, rank AS seq FROM m WHERE copy = 1 UNION ALL SELECT im_id, 1000000000 + n FROM k WHERE human AND seen AND NOT again),
    f AS (SELECT im_id, 2000000000 + n AS seq FROM k WHERE human AND NOT again AND NOT seen ORDER BY n LIMIT greatest(0, 1200 - (SELECT count(*) FROM a)))
    SELECT im_id FROM (SELECT * FROM a UNION ALL SELECT * FROM f) ORDER BY seq LIMIT 1200""",
    python=True,
)
def w15_staged(spark, sf):
    """Batches are asked until 1200 images are accepted; later batches never reach the model."""
    pool = class_pool(spark, sf).drop("visible_classes")
    few = F.when(F.col("im_id") % 50 == 1, F.col("category")).otherwise("other")
    classifier = staged.Asked(VisibleClasses(), new_store(spark, ["im_id"]))
    out = staged.staged_class_sample(pool.withColumn("category", few), 1200, 500, ["ring", "earring"], classifier, must_terms=["1-urgent"])
    return out.accepted.select("im_id")


def load_prompted():
    """Prompted detector: one box per prompt; some images have none, and some always fail on the second class group."""

    def request(rows: list[dict], prompts: list[str]) -> list[list[dict]]:
        if "sash" in prompts and any(r["im_id"] % 11 == 3 for r in rows):
            raise RuntimeError("no reply")
        box = [[{"name": p, "score": 0.5, "box": [0, 0, r["image_w"] // 2, r["image_h"] // 2]} for p in prompts] for r in rows]
        return [[] if r["im_id"] % 5 == 0 else b for r, b in zip(rows, box)]

    return request


@query(
    "u3_requests",
    """SELECT im_id, CASE WHEN im_id % 11 = 3 OR im_id % 5 = 0 THEN '' ELSE 'ring,ear_ring,belt,belt' END AS names,
       CASE WHEN im_id % 11 <> 3 AND im_id % 5 <> 0 THEN CAST(image_w // 2 AS DOUBLE) END AS x2 FROM images""",
    python=True,
)
def u3_requests(spark, sf):
    """Images by class groups in packed requests; the second run asks only images without a stored answer."""
    model = Detector("prompted", load_prompted, ("ring", "ear_ring", "belt"), class_aliases={"belt": ["waist belt", "sash"]}, per_prompt=2, batch=4)
    store = A.ResultStore(spark, new_folder(spark), KEYS)
    rows = images(spark, sf).select("im_id", "image_w", "image_h")
    packed_detections(rows.filter("im_id % 2 = 0"), model, store)
    out = packed_detections(rows, model, store)
    first = F.get("detections", F.lit(0))
    return out.select("im_id", F.array_join(F.transform("detections", lambda d: d["name"]), ",").alias("names"), F.get(first["box"], F.lit(2)).alias("x2"))


def load_boxes():
    """Detector with a ring, a smaller copy of it for every third image, and an earring elsewhere."""

    def request(rows: list[dict], prompts: list[str]) -> list[list[dict]]:
        out = []
        for r in rows:
            dets = [{"name": "ring", "score": 0.9, "box": [0, 0, 24, 24]}, {"name": "earring", "score": 0.8, "box": [30, 30, 55, 55]}]
            if r["im_id"] % 3 == 0:
                dets.append({"name": "ring", "score": 0.4, "box": [0, 0, 24, 22]})
            out.append([] if r["im_id"] % 5 == 0 else dets)
        return out

    return request


class NoEarring(A.RowAnnotator):
    """Stand-in for a verification model: earrings of every fourth image are wrong."""

    fields = ST.StructType([ST.StructField("is_valid", ST.BooleanType()), ST.StructField("reason", ST.StringType())])

    def process(self, row: dict) -> dict:
        return {"is_valid": row["name"] != "earring" or row["im_id"] % 4 != 1, "reason": ""}


@query(
    "j9_processed",
    """SELECT im_id, 'ring' AS name, 0.9 AS score, CAST(24 AS DOUBLE) AS x2, 'boxes' AS source FROM images WHERE im_id % 5 <> 0
       UNION ALL SELECT im_id, 'earring', 0.8, CAST(55 AS DOUBLE), 'boxes' FROM images WHERE im_id % 5 <> 0 AND im_id % 4 <> 1""",
    python=True,
)
def j9(spark, sf):
    """Half of the images were processed before; the rest is detected, suppressed and verified, all are read back."""
    folder = new_folder(spark)
    cache, verdicts = ProcessedCache.at(spark, folder), A.ResultStore(spark, f"{folder}/verdicts", ["im_id", "name", "box_text", "settings"])
    rows = images(spark, sf).select("im_id", "im_url", "image_w", "image_h")
    model = Detector("boxes", load_boxes, ("ring", "earring"))
    for some in (rows.filter("im_id % 2 = 0"), rows):
        out = processed_boxes(some, [model], cache, AnnotationPlan(), NoEarring(), verdicts)
    return out.select("im_id", "name", "score", "x2", "source")


# Raw detections as clusters; a cluster stays if its class is visible or of no interest.
SURE = """SELECT s.im_id, CAST(s.cluster_id AS BIGINT) AS pos, d.name, d.x1, d.y1, d.x2, d.y2, d.score, 'model' AS source
  FROM summary s JOIN detections d ON d.im_id = s.im_id AND d.pos = s.top_pos
  WHERE d.name NOT IN ('ring', 'earring') OR EXISTS (SELECT 1 FROM visible v WHERE v.im_id = d.im_id AND v.name = d.name)"""
ASKED = f"""SELECT v.im_id, v.name FROM visible v LEFT JOIN ({SURE}) c ON c.im_id = v.im_id AND c.name = v.name WHERE v.name IN ('ring', 'earring')
  GROUP BY v.im_id, v.name, v.multiplicity HAVING (v.multiplicity = 'multiple' AND count(c.pos) <= 1) OR (v.multiplicity = 'singular' AND count(c.pos) = 0)"""


def load_second_look():
    """Finds one box for each class it is asked for, in every image but each fifth."""

    def request(rows: list[dict], prompts: list[str]) -> list[list[dict]]:
        side = {"ring": 30, "earring": 40}
        return [[] if r["im_id"] % 5 == 0 else [{"name": p, "score": 0.5, "box": [5, 5, side[p], side[p]]} for p in prompts] for r in rows]

    return request


@query(
    "e12_recovery",
    f"""WITH b AS (SELECT * FROM ({SURE}) UNION ALL
      SELECT im_id, 1099511627776 * 2 + row_number() OVER (PARTITION BY im_id ORDER BY name) AS pos, name, 5.0 AS x1, 5.0 AS y1,
        CASE name WHEN 'ring' THEN 30.0 ELSE 40.0 END AS x2, CASE name WHEN 'ring' THEN 30.0 ELSE 40.0 END AS y2, 0.5 AS score, 'again' AS source
      FROM ({ASKED}) WHERE im_id % 5 <> 0),
    n AS (SELECT *, row_number() OVER (PARTITION BY im_id, name ORDER BY greatest(0.0, (x2 - x1) * (y2 - y1)), pos) AS rn FROM b),
    h AS (SELECT n.im_id, n.name, n.rn, coalesce((SELECT list(a.rn) FROM n a WHERE a.im_id = n.im_id AND a.name = n.name AND a.rn < n.rn
          AND ({{iou(a,n)}} >= 0.7 OR {{iomin(a,n)}} >= 0.7)), CAST([] AS BIGINT[])) AS hits FROM n),
    w AS (SELECT im_id, name, rn, CAST([1] AS BIGINT[]) AS kept, true AS ok FROM h WHERE rn = 1
      UNION ALL SELECT h.im_id, h.name, h.rn, CASE WHEN list_has_any(w.kept, h.hits) THEN w.kept ELSE list_append(w.kept, h.rn) END,
        NOT list_has_any(w.kept, h.hits) FROM w JOIN h ON h.im_id = w.im_id AND h.name = w.name AND h.rn = w.rn + 1),
    k AS (SELECT n.* FROM n JOIN w USING (im_id, name, rn) WHERE w.ok)
    SELECT im_id, string_agg(name, ',' ORDER BY pos, name) AS concepts, string_agg(source, ',' ORDER BY pos, name) AS box_sources FROM k GROUP BY im_id""",
    python=True,
)
def e12_recovery(spark, sf):
    """Curation from raw detections: clusters, confirmed classes, a second look for those that are short, suppression."""
    model = Detector("again", load_second_look, ("ring", "earring"), batch=4, per_prompt=4)
    store = A.ResultStore(spark, new_folder(spark), KEYS)
    out = recovered_dataset(detections(spark, sf), annotations(spark, sf), ["ring", "earring"], model, store)
    return out.select("im_id", "concepts", "box_sources")
