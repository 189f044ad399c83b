"""From image rows and raw detections to annotated rows."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom.functions import geometry as G
from boxloom.functions.codecs import existing_detections
from boxloom.functions.text import run_mode, settings_hash
from boxloom.operators import annotate, catalog, clusters, detectors, groups, issues, rollup
from boxloom.operators import suppression as S
from boxloom.operators.store import ResultStore
from boxloom.session import checkpointed


@dataclass(frozen=True)
class AnnotationPlan:
    policies: dict[str, S.Policy] = field(default_factory=lambda: {"general": S.Policy()})
    per_class: int = 6
    per_image: int = 20
    settings: dict[str, dict] = field(default_factory=dict)
    verify_classes: list[str] = field(default_factory=list)


def stored_boxes(images: DataFrame) -> DataFrame:
    """Detections already present in the boxes/concepts columns, one row per box."""
    exploded = images.select("im_id", F.posexplode(existing_detections(F.col("boxes"), F.col("concepts"))).alias("pos", "d"))
    corners = G.box_at(F.col("d.box"))
    return exploded.select(
        "im_id", F.col("pos").cast("long").alias("pos"), F.col("d.name").alias("name"),
        *[v.alias(c) for c, v in zip(G.Box._fields, corners)],
        F.col("d.score").alias("score"), F.col("d.source").alias("source"),
    )


def group_limit(boxes: DataFrame) -> int | None:
    """One look at the box counts per image; None when every image is small.

    Later steps only remove boxes or group more finely, so they need no look
    of their own.
    """
    return None if groups.large_groups(boxes, ["im_id"]) is None else groups.GROUP_LIMIT


def cleaned_boxes(
    boxes: DataFrame, sizes: DataFrame, policies: dict[str, S.Policy], limit: int | None = groups.GROUP_LIMIT
) -> DataFrame:
    """Global cleanup, suppression by policy, minimum class area."""
    kept = S.clean_before_suppression(boxes, limit=limit)
    if policies:
        kept = S.suppress_by_policy(kept, policies, limit=limit)
    sized = groups.join_on(kept, sizes.select("im_id", "image_w", "image_h"), ["im_id"], "left")
    grown = G.grown_to_area(G.box(), G.min_area_for(F.col("name")), F.col("image_w"), F.col("image_h"))
    return sized.withColumns({c: v for c, v in zip(G.Box._fields, grown)})


def annotated_dataset(
    images: DataFrame,
    boxes: DataFrame,
    plan: AnnotationPlan,
    judge: annotate.RowAnnotator | None = None,
    store: annotate.ResultStore | None = None,
    settings_hash: str = "",
    mode: str = "full",
) -> DataFrame:
    """Annotated rows; in mode ``detection_only`` the raw detections.

    ``images``: im_id, im_url, image_w, image_h; ``boxes``: one row per raw detection.
    Without a judge nothing is capped or verified.
    """
    if run_mode(mode) == "detection_only":
        return boxes
    limit = group_limit(boxes)
    final = cleaned_boxes(boxes, images, plan.policies, limit)
    if judge is not None:
        capped = checkpointed(S.cap_boxes(final, plan.per_class, plan.per_image))
        final = annotate.verified_boxes(
            capped, judge, store, plan.settings, settings_hash, plan.verify_classes
        ).filter("is_valid")
    return rollup.annotated_rows(images, final.drop("image_w", "image_h"))


def described(images: DataFrame) -> DataFrame:
    """Name and description from whichever columns the catalog fills."""
    return catalog.first_filled_columns(
        images, {"im_name": catalog.NAME_COLUMNS, "im_description": catalog.DESCRIPTION_COLUMNS}
    )


def curated_issues(
    boxes: DataFrame, annotations: DataFrame, relevant: list[str], iou: float, min_score: float = 0.3
) -> DataFrame:
    """Cluster detections, classify issues, roll up to image rows."""
    summary = clusters.cluster_summary(clusters.overlap_clusters(boxes, iou))
    table = issues.issue_table(summary, annotations, relevant, min_score)
    return rollup.image_rows(table)


def recovered_rows(
    confirmed: DataFrame, recovered: DataFrame, annotations: DataFrame, iou: float = 0.7, io_min: float = 0.7
) -> DataFrame:
    """Confirmed boxes plus boxes found again for missed classes, suppressed and rolled up.

    Both inputs: im_id, pos, name, corners, score, source.
    """
    later = recovered.withColumn("pos", F.col("pos") + F.lit(1 << 40))
    kept = S.suppress_smallest_first(confirmed.unionByName(later), iou, io_min)
    described_boxes = groups.join_on(kept, annotations, ["im_id"])
    table = described_boxes.withColumn("top_class", F.col("name")).withColumn(
        "top_box", F.array(*[F.col(c) for c in G.Box._fields])
    )
    return rollup.image_rows(table.withColumn("box_source", F.col("source")))


BOXES = "array<struct<pos:bigint,name:string,x1:double,y1:double,x2:double,y2:double,score:double,source:string>>"


@dataclass(frozen=True)
class ProcessedCache:
    """Final boxes per image and settings, and before them raw detections per image, model and settings."""

    processed: ResultStore
    detections: ResultStore

    @staticmethod
    def at(spark, folder: str) -> "ProcessedCache":
        return ProcessedCache(
            ResultStore(spark, f"{folder}/processed", ["im_id", "settings"]), ResultStore(spark, f"{folder}/detections", detectors.KEYS)
        )


def raw_boxes(images: DataFrame, models: list[detectors.Detector], store: ResultStore, keep_boxes: bool = False, repeated: bool = True) -> DataFrame:
    """One row per detection of every model, after the boxes that the rows already have with ``keep_boxes``."""
    parts = [stored_boxes(images)] if keep_boxes else []
    for number, model in enumerate(models, 1):
        found = detectors.packed_detections(images.drop("concepts", "boxes"), model, store, repeated=repeated)
        dets = found.select("im_id", F.posexplode("detections").alias("at", "d")).filter(F.size("d.box") >= 4)
        corners = G.box_at(F.col("d.box"))
        parts.append(
            dets.select(
                "im_id", (F.col("at") + F.lit(number << 40)).cast("long").alias("pos"), F.col("d.name").alias("name"),
                *[v.alias(c) for c, v in zip(G.Box._fields, corners)], F.col("d.score").alias("score"), F.col("d.source").alias("source"),
            )
        )
    if not parts:
        raise ValueError("no detection model and no boxes to keep")
    return reduce(DataFrame.unionByName, parts)


def processed_boxes(
    images: DataFrame,
    models: list[detectors.Detector],
    cache: ProcessedCache,
    plan: AnnotationPlan,
    judge: annotate.RowAnnotator | None = None,
    verdicts: ResultStore | None = None,
    settings: dict | None = None,
    keep_boxes: bool = False,
) -> DataFrame:
    """Final boxes of every image (im_id, pos, name, corners, score, source), through two caches.

    An image whose final boxes are stored for these settings is neither detected, suppressed nor verified again; a new plan with the same
    models reuses the raw detections.  Images without boxes are stored, too.  Images with a failed detection or
    verification give what was found and are worked on again next time.

    ``images``: im_id, im_url, image_w, image_h, and boxes and concepts with ``keep_boxes``.  ``settings`` names further
    choices that results depend on, such as the judge's.
    """
    spark = images.sparkSession
    named = settings_hash({"plan": asdict(plan), "models": [(m.model, m.settings_hash()) for m in models], "keep": keep_boxes, "more": settings or {}, "judged": judge is not None})
    images = groups.first_per_key(images, ["im_id"], ["im_url"])
    asked = checkpointed(images.withColumn("settings", F.lit(named)))
    buckets = cache.processed.touched(asked)
    waiting = checkpointed(cache.processed.pending(asked, buckets).drop("settings"))
    fresh = None
    if not waiting.isEmpty():
        raw = checkpointed(raw_boxes(waiting, models, cache.detections, keep_boxes, repeated=False))
        limit = group_limit(raw)
        final = cleaned_boxes(raw, waiting, plan.policies, limit).drop("image_w", "image_h")
        failed = _unanswered(waiting, models, cache.detections)
        if judge is not None:
            capped = checkpointed(S.cap_boxes(final, plan.per_class, plan.per_image))
            sized = groups.join_on(capped, waiting.select("im_id", "image_w", "image_h"), ["im_id"], "left")
            judged = checkpointed(annotate.verified_boxes(sized, judge, verdicts, plan.settings, named, plan.verify_classes))
            failed = failed.unionByName(judged.filter(F.col("llm_validated") & (F.col("reason") == annotate.CALL_FAILED)).select("im_id")).distinct()
            final = judged.filter("is_valid")
        entry = F.struct(*[F.col(c) for c in ("pos", "name", *G.Box._fields, "score", "source")])
        listed = rollup.gathered(final, ["im_id"], "pos", entry)
        rows = groups.join_on(waiting.select("im_id"), listed, ["im_id"], "left")
        fresh = checkpointed(rows.select("im_id", F.lit(named).alias("settings"), F.coalesce(F.col("items").cast(BOXES), F.array().cast(BOXES)).alias("final")))
        cache.processed.append(groups.join_on(fresh, failed, ["im_id"], "left_anti"), cache.processed.next_run())
        fresh = groups.join_on(fresh, failed, ["im_id"], "left_semi")
    found = cache.processed.latest(buckets) if cache.processed.exists() else None
    if found is not None:
        found = groups.join_on(found, asked.select("im_id", "settings"), ["im_id", "settings"], "left_semi").select("im_id", "settings", "final")
        fresh = found if fresh is None else found.unionByName(fresh)
    if fresh is None:
        fresh = spark.createDataFrame([], f"im_id {asked.schema['im_id'].dataType.simpleString()}, settings string, final {BOXES}")
    return fresh.select("im_id", F.explode("final").alias("b")).select("im_id", "b.*")


def _unanswered(images: DataFrame, models: list[detectors.Detector], store: ResultStore) -> DataFrame:
    """Images that have no stored answer of some model, as their call failed."""
    parts = [images.select("im_id").filter(F.lit(False))]
    for model in models:
        keyed = images.select("im_id", F.lit(model.model).alias("model"), F.lit(model.settings_hash()).alias("settings"))
        parts.append(store.pending(keyed).select("im_id"))
    return reduce(DataFrame.unionByName, parts).distinct()


def recovered_dataset(
    boxes: DataFrame,
    annotations: DataFrame,
    relevant: list[str],
    detector: detectors.Detector,
    store: ResultStore,
    cluster_iou: float = 0.5,
    iou: float = 0.7,
    io_min: float = 0.7,
) -> DataFrame:
    """Curated image rows from raw detections: what the annotator saw and the model missed is asked for again.

    ``boxes``: raw detections; ``annotations``: im_id, im_url, im_name, im_description, gpt_reason and visible_classes, one row per image.
    Detections are clustered, and a cluster stays if its class is visible or of no interest.  A visible relevant class with
    too few boxes left (one for ``multiple``, none for ``singular``) goes to ``detector``: each image is asked for its own classes only, once, as answers
    come from ``store``.  Boxes found again join the confirmed ones, and smaller boxes go first when they overlap.
    """
    summary = checkpointed(clusters.cluster_summary(clusters.overlap_clusters(boxes, cluster_iou)))
    confirmed = checkpointed(issues.confirmed_detections(summary, annotations, relevant))
    short = issues.classes_to_recover(confirmed, annotations, relevant)
    wanted = short.groupBy("im_id").agg(F.sort_array(F.collect_set("class_name")).alias(detectors.WANTED))
    requests = groups.join_on(annotations.select("im_id", "im_url"), wanted, ["im_id"])
    again = raw_boxes(requests, [detector], store)
    corners = G.box_at(F.col("top_box").cast("array<double>"))
    sure = confirmed.select(
        "im_id", F.col("cluster_id").cast("long").alias("pos"), F.col("top_class").alias("name"),
        *[v.alias(c) for c, v in zip(G.Box._fields, corners)], F.col("top_score").alias("score"), F.lit("model").alias("source"),
    )
    meta = annotations.select("im_id", "im_url", "im_name", "im_description", "gpt_reason")
    return recovered_rows(sure, again, meta, iou, io_min)
