"""Detector post-processing on tables: objectness rescoring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxloom.functions import geometry as G
from boxloom.operators import groups

# Fixed values of the objectness model.
DEFAULT_SIGMA = 1.0 / 6.0
CORNER_FACTOR = 0.8
CORNER_PIXELS = 5
CORNER_SIDE = 320.0


def _class_value(values: dict[str, float], default: float) -> Column:
    prefix = F.get(F.split("name", "-"), F.lit(0))
    expr = F.lit(float(default))
    for name, value in values.items():
        expr = F.when(prefix == name, F.lit(float(value))).otherwise(expr)
    return expr


def size_score(b: G.Box, w: Column, h: Column) -> Column:
    """Squared shorter side (pixel-inclusive) relative to the image area."""
    side = F.least(b.x2 - b.x1 + 1, b.y2 - b.y1 + 1)
    return side * side / (w * h).cast("double")


def centre_score(b: G.Box, w: Column, h: Column, sigma: Column) -> Column:
    """Gaussian closeness of box centre and image centre, in units of the shorter side."""
    unit = F.least(w, h).cast("double")
    dx = (b.x1 + b.x2) / 2.0 / unit - (w + 1) / 2.0 / unit
    dy = (b.y1 + b.y2) / 2.0 / unit - (h + 1) / 2.0 / unit
    return F.exp(F.lit(-0.5) * (dx * dx + dy * dy) / (sigma * sigma))


def corner_score(b: G.Box, w: Column, h: Column) -> Column:
    """0.8 per image corner the box touches, on an image shrunk to 320 pixels."""
    scale = F.least(F.lit(CORNER_SIDE) / F.greatest(w, h), F.lit(1.0))
    top = (b.y1 * scale <= CORNER_PIXELS).cast("int")
    left = (b.x1 * scale <= CORNER_PIXELS).cast("int")
    bottom = (b.y2 * scale > G.to_pixel(h * scale) - CORNER_PIXELS).cast("int")
    right = (b.x2 * scale > G.to_pixel(w * scale) - CORNER_PIXELS).cast("int")
    return F.pow(F.lit(CORNER_FACTOR), (top + bottom) * (left + right))


def rescored(
    df: DataFrame, sigma: dict[str, float] | None = None, prior: dict[str, float] | None = None, image: str = "im_id"
) -> DataFrame:
    """Multiply scores by the objectness relative to the best of the image.

    The image maximum is a combining aggregate joined back.
    """
    b, w, h = G.box(), F.col("image_w"), F.col("image_h")
    parts = (
        F.pow(size_score(b, w, h), F.lit(0.25))
        * F.pow(centre_score(b, w, h, _class_value(sigma or {}, DEFAULT_SIGMA)), F.lit(3.0))
        * F.pow(corner_score(b, w, h), F.lit(0.25))
    )
    scored = df.withColumn("objectness", F.sqrt(parts) * _class_value(prior or {}, 1.0))
    best = scored.groupBy(image).agg(F.max("objectness").alias("_best"))
    relative = F.when(F.col("_best") > 0, F.col("objectness") / F.col("_best")).otherwise(F.col("objectness"))
    joined = groups.join_on(scored, best, [image]).withColumn("objectness", relative)
    return joined.withColumn("score", F.col("score") * F.col("objectness")).drop("_best")
