"""Compare detected classes with the classes an annotator saw."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from boxloom.functions.codecs import class_list_cell, class_multiplicity, strings
from boxloom.operators import groups
from boxloom.session import checkpointed


def labelled_detections(
    clusters: DataFrame, annotations: DataFrame, relevant: list[str], min_score: float = 0.3
) -> DataFrame:
    """Precision view: each confident detection is confirmed, unconfirmed or of no interest.

    A relevant class the annotator did not see is a precision issue; every
    other detection has no issue.  Descriptive columns of the image come along.
    """
    confident = clusters.filter(F.col("top_score") >= min_score).withColumn("top_class", F.lower("top_class"))
    described = [c for c in annotations.columns if c == "im_id" or c not in clusters.columns]
    joined = groups.join_on(confident, annotations.select(*described), ["im_id"], "left")
    seen = class_list_cell(F.coalesce("visible_classes", F.lit("[]")))
    wrong = F.col("top_class").isin(relevant) & ~F.array_contains(seen, F.col("top_class"))
    return joined.select(
        *confident.columns,
        *[c for c in described if c not in ("im_id", "visible_classes", "gpt_reason")],
        F.coalesce("gpt_reason", F.lit("")).alias("gpt_reason"),
        F.when(wrong, "fp_incorrect").otherwise("no_issue").alias("box_status"),
        F.lit("model").alias("box_source"),
        F.when(wrong, "precision").otherwise("no_issue").alias("issue_type"),
    )


def detected_classes(clusters: DataFrame, min_score: float = 0.3) -> DataFrame:
    """Distinct (im_id, class) among confident detections."""
    return (
        clusters.filter(F.col("top_score") >= min_score)
        .select("im_id", F.trim(F.lower("top_class")).alias("top_class"))
        .distinct()
    )


def missed_classes(
    clusters: DataFrame, annotations: DataFrame, relevant: list[str], min_score: float = 0.3
) -> DataFrame:
    """Recall view: relevant classes seen by the annotator but not detected, as placeholder boxes.

    A class named twice by the annotator is reported twice.
    """
    carried = [c for c in annotations.columns if c not in ("visible_classes",)]
    wanted = annotations.select(
        *carried, F.posexplode(class_list_cell(F.col("visible_classes"))).alias("mention", "top_class")
    ).filter(F.col("top_class").isin(relevant))
    missing = groups.join_on(wanted, detected_classes(clusters, min_score), ["im_id", "top_class"], "left_anti")
    zero = F.array(*[F.lit(0) for _ in range(4)])
    return missing.select(
        *carried,
        "mention",
        "top_class",
        F.lit(-1).alias("cluster_id"),
        F.lit(0).alias("cluster_size"),
        F.lit(0.0).alias("top_score"),
        F.lit(0.0).alias("second_score"),
        F.lit(0.0).alias("margin"),
        F.lit(1.0).alias("uncertainty"),
        zero.alias("top_box"),
        F.lit("type2_missing").alias("box_status"),
        F.lit("model_missed").alias("box_source"),
        F.lit("recall").alias("issue_type"),
    )


def issue_table(
    clusters: DataFrame, annotations: DataFrame, relevant: list[str], min_score: float = 0.3
) -> DataFrame:
    """Precision, no-issue and recall rows in one table; ``pos`` orders them inside an image.

    Precision rows come first, then confirmed boxes, then missed classes.
    """
    # Both sides read the clusters: written once, not clustered twice.
    clusters = checkpointed(clusters)
    found = labelled_detections(clusters, annotations, relevant, min_score)
    rank = F.when(F.col("issue_type") == "precision", 0).otherwise(1)
    spread = F.lit(1 << 40).cast("long")
    found = found.withColumn("pos", rank * spread + F.col("cluster_id").cast("long"))
    missed = missed_classes(clusters, annotations, relevant, min_score)
    missed = missed.withColumn("pos", F.lit(2) * spread + F.col("mention").cast("long")).drop("mention")
    return found.unionByName(missed, allowMissingColumns=True)


def visible_multiplicity(annotations: DataFrame, relevant: list[str] | None = None) -> DataFrame:
    """One row per (image, visible class) with multiplicity singular or multiple."""
    exploded = annotations.select("im_id", F.explode(class_multiplicity(F.col("visible_classes"))).alias("_m"))
    out = exploded.select("im_id", "_m.class_name", "_m.multiplicity")
    return out if relevant is None else out.filter(F.col("class_name").isin(relevant))


def confirmed_detections(clusters: DataFrame, annotations: DataFrame, relevant: list[str]) -> DataFrame:
    """Keep classes of no interest always, relevant classes only when visible."""
    named = clusters.withColumn("top_class", F.trim(F.lower("top_class")))
    visible = visible_multiplicity(annotations, relevant).select("im_id", F.col("class_name").alias("top_class"))
    interesting = named.filter(F.col("top_class").isin(relevant))
    known_images = annotations.select("im_id").distinct()
    others = groups.join_on(named.filter(~F.col("top_class").isin(relevant)), known_images, ["im_id"], "left_semi")
    return groups.join_on(interesting, visible, ["im_id", "top_class"], "left_semi").unionByName(others)


def classes_to_recover(confirmed: DataFrame, annotations: DataFrame, relevant: list[str]) -> DataFrame:
    """Visible classes with too few boxes: ``multiple`` needs two, ``singular`` needs one."""
    counts = confirmed.groupBy("im_id", F.col("top_class").alias("class_name")).agg(
        F.count(F.lit(1)).alias("found")
    )
    wanted = visible_multiplicity(annotations, relevant)
    found = F.coalesce("found", F.lit(0))
    short = ((F.col("multiplicity") == "multiple") & (found <= 1)) | (
        (F.col("multiplicity") == "singular") & (found == 0)
    )
    return (
        groups.join_on(wanted, counts, ["im_id", "class_name"], "left")
        .filter(short)
        .select("im_id", "class_name", "multiplicity", found.cast("long").alias("found"))
    )


def visible_class_counts(annotations: DataFrame) -> DataFrame:
    """How many annotations name each class, and the number of images overall."""
    # Every image also emits a NULL class; its count is the number of images.
    marked = F.concat(F.array(F.lit(None).cast("string")), F.array_distinct(_base_classes()))
    exploded = annotations.select(F.explode(marked).alias("class_name"))
    counts = exploded.groupBy("class_name").agg(F.count(F.lit(1)).alias("images"))
    total = F.max(F.when(F.col("class_name").isNull(), F.col("images"))).over(W.partitionBy(F.lit(0)))
    return counts.withColumn("total_images", total).filter(F.col("class_name").isNotNull())


def _base_classes() -> Column:
    return F.coalesce(F.transform(class_multiplicity(F.col("visible_classes")), lambda m: m["class_name"]), strings())


def class_list_difference(left: list[str], right: list[str]) -> dict[str, list[str]]:
    """Configuration check: names that occur on one side only."""
    return {"only_left": sorted(set(left) - set(right)), "only_right": sorted(set(right) - set(left))}
