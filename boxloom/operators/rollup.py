"""Boxes to image rows and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxloom.functions.codecs import box_text
from boxloom.operators import groups

# Columns of an image row, in file order.
IMAGE_ROW = [
    "original_url", "im_url", "im_id", "crop_box", "crop_box_concept", "im_name", "im_description", "labels",
    "concepts", "boxes", "optional", "box_statuses", "box_sources", "box_reasons", "issue_types",
]


def gathered(df: DataFrame, keys: list[str], order: str, element: Column) -> DataFrame:
    """Ordered array ``items`` per key: one row, however many entries it has.

    An entry is short; an image with 100,000 boxes is a row of a few MB.
    """
    listed = df.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct(F.col(order).alias("at"), element.alias("item")))).alias("items")
    )
    return listed.withColumn("items", F.transform("items", lambda x: x["item"]))


def image_rows(
    df: DataFrame,
    optional: str = "true",
    status: str = "no_issue",
    source: str = "model",
    order: str = "pos",
) -> DataFrame:
    """Image rows with the seven aligned columns as text.

    Input: one row per box with im_url, im_id, im_name, im_description,
    top_class, top_box and, where known, box_status, box_source, gpt_reason
    and issue_type.
    """

    def text(column: str, default: str) -> Column:
        if column not in df.columns:
            return F.lit(default)
        return F.coalesce(F.nullif(F.col(column).cast("string"), F.lit("")), F.lit(default))

    element = F.struct(
        F.col("top_class").alias("concept"),
        box_text(*[F.get("top_box", F.lit(i)) for i in range(4)]).alias("box"),
        text("box_status", status).alias("status"),
        text("box_source", source).alias("source"),
        text("gpt_reason", "").alias("reason"),
        text("issue_type", "no_issue").alias("issue"),
        *[F.col(c).alias(c) for c in ("im_id", "im_name", "im_description")],
    )
    rows = gathered(df, ["im_url"], order, element)

    def joined(field: str) -> Column:
        return F.array_join(F.transform("items", lambda x: x[field]), ",")

    def last(field: str) -> Column:
        return F.element_at("items", -1)[field]

    blank = F.lit("")
    return rows.select(
        F.col("im_url").alias("original_url"),
        "im_url",
        *[last(c).alias(c) for c in ("im_id",)],
        blank.alias("crop_box"),
        blank.alias("crop_box_concept"),
        last("im_name").alias("im_name"),
        last("im_description").alias("im_description"),
        blank.alias("labels"),
        joined("concept").alias("concepts"),
        joined("box").alias("boxes"),
        F.array_join(F.transform("items", lambda x: F.lit(optional)), ",").alias("optional"),
        joined("status").alias("box_statuses"),
        joined("source").alias("box_sources"),
        F.to_json(F.transform("items", lambda x: x["reason"])).alias("box_reasons"),
        joined("issue").alias("issue_types"),
    )


def annotated_rows(images: DataFrame, boxes: DataFrame, key: str = "im_id") -> DataFrame:
    """Input rows with their final boxes as ``concepts``/``boxes`` text.

    Images without boxes keep their row with NULL in both columns.
    """
    element = F.struct(F.col("name").alias("name"), box_text(*[F.col(c) for c in ("x1", "y1", "x2", "y2")]).alias("box"))
    rows = gathered(boxes, [key], "pos", element).select(
        key,
        F.array_join(F.transform("items", lambda x: x["name"]), ",").alias("concepts"),
        F.array_join(F.transform("items", lambda x: x["box"]), ",").alias("boxes"),
    )
    base = images.drop("concepts", "boxes")
    return groups.join_on(base, rows, [key], "left")
