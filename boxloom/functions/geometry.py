"""Bounding-box arithmetic as Column expressions.

A box is four DOUBLE columns x1, y1, x2, y2 (``Box``).  Everything here stays
inside Catalyst expressions, so it is folded, pushed and code-generated like
any other projection.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

# Smallest sensible box area per class, in square pixels.
MIN_CLASS_AREA = {"ring": 78.8, "earring": 216.0}


class Box(NamedTuple):
    x1: Column
    y1: Column
    x2: Column
    y2: Column


def box(prefix: str = "") -> Box:
    """Box made of the columns ``<prefix>x1`` .. ``<prefix>y2``."""
    return Box(*(F.col(f"{prefix}{c}") for c in Box._fields))


def box_in(struct: Column) -> Box:
    """Box held in the fields of a struct column or lambda variable."""
    return Box(*(struct[c] for c in Box._fields))


def box_at(array: Column) -> Box:
    """Box held in a four-element array."""
    return Box(*(F.get(array, F.lit(i)) for i in range(4)))


def width(b: Box) -> Column:
    return F.greatest(F.lit(0.0), b.x2 - b.x1)


def height(b: Box) -> Column:
    return F.greatest(F.lit(0.0), b.y2 - b.y1)


def area(b: Box) -> Column:
    """Area with each side clamped at zero."""
    return width(b) * height(b)


def ordering_area(b: Box) -> Column:
    """Area used only for ordering: the product is clamped, not the sides."""
    return F.greatest(F.lit(0.0), (b.x2 - b.x1) * (b.y2 - b.y1))


def intersection(a: Box, b: Box) -> Column:
    return F.greatest(F.lit(0.0), F.least(a.x2, b.x2) - F.greatest(a.x1, b.x1)) * F.greatest(
        F.lit(0.0), F.least(a.y2, b.y2) - F.greatest(a.y1, b.y1)
    )


def iou_of(shared: Column, area_a: Column, area_b: Column) -> Column:
    """``iou`` from the intersection and both areas, for lambdas: there nothing is computed once by itself."""
    return F.when(shared > 0, shared / (area_a + area_b - shared)).otherwise(0.0)


def io_min_of(shared: Column, area_a: Column, area_b: Column) -> Column:
    """``io_min`` from the intersection and both areas."""
    return F.when(shared > 0, shared / F.least(area_a, area_b)).otherwise(0.0)


def iou(a: Box, b: Box) -> Column:
    """Intersection over union, exclusive pixel edges; 0 without overlap."""
    return iou_of(intersection(a, b), area(a), area(b))


def io_min(a: Box, b: Box) -> Column:
    """Intersection over the smaller of the two areas."""
    return io_min_of(intersection(a, b), area(a), area(b))


def iou_inclusive(a: Box, b: Box) -> Column:
    """IoU where the right and bottom pixel belong to the box (+1 sides)."""

    def full(c: Box) -> Column:
        return (c.x2 - c.x1 + 1) * (c.y2 - c.y1 + 1)

    shared = F.greatest(F.lit(0.0), F.least(a.x2, b.x2) - F.greatest(a.x1, b.x1) + 1) * F.greatest(
        F.lit(0.0), F.least(a.y2, b.y2) - F.greatest(a.y1, b.y1) + 1
    )
    return F.coalesce(F.try_divide(shared, full(a) + full(b) - shared), F.lit(0.0))


def area_ratio(b: Box, image_h: Column, image_w: Column) -> Column:
    total = (image_h * image_w).cast("double")
    return F.when(total > 0, area(b) / total).otherwise(0.0)


def to_pixel(value: Column) -> Column:
    """Half-even rounding to an integer pixel."""
    return F.rint(value).cast("int")


def pixels(b: Box) -> Box:
    return Box(*(to_pixel(v) for v in b))


def rescale(b: Box, scale: Column) -> Box:
    """Coordinates of a shrunken image mapped to the original (truncating)."""
    return Box(*(F.when(scale > 0, (v / scale + 0.5).cast("int")).otherwise(v.cast("int")) for v in b))


def shrink_scale(h: Column, w: Column, max_side: float = 1024.0) -> Column:
    """Factor that brings the longer side down to ``max_side``; never above 1."""
    return F.least(F.lit(float(max_side)) / F.greatest(h, w), F.lit(1.0))


def fit_inside(w: Column, h: Column, long_side: int = 2000, short_side: int = 768) -> tuple[Column, Column]:
    """Target size bounded by a long and a short side, truncated; may enlarge."""
    scale = F.least(
        F.lit(float(long_side)) / F.greatest(w, h), F.lit(float(short_side)) / F.least(w, h)
    )
    return (w * scale).cast("int"), (h * scale).cast("int")


def upscaled_size(w: Column, h: Column, min_short: Column, min_long: Column) -> tuple[Column, Column]:
    """Size after enlarging so both minimum sides hold; keeps the ratio, never shrinks."""
    scale = F.greatest(
        F.lit(1.0),
        F.greatest(F.lit(1), min_short) / F.least(w, h).cast("double"),
        F.greatest(F.lit(1), min_long) / F.greatest(w, h).cast("double"),
    )
    empty = F.least(w, h) <= 0
    return (
        F.when(empty, w).otherwise(F.greatest(F.lit(1), to_pixel(w * scale))),
        F.when(empty, h).otherwise(F.greatest(F.lit(1), to_pixel(h * scale))),
    )


def _shift_inside(lo: Column, hi: Column, size: Column) -> tuple[Column, Column]:
    """Slide an interval into [0, size], then clamp what still sticks out.

    A NULL size means the image size is unknown: only the lower edge is clamped.
    """
    first = F.greatest(lo, F.lit(0.0))
    last = hi - F.least(lo, F.lit(0.0))
    low = F.greatest(F.lit(0.0), first - F.greatest(F.lit(0.0), last - size))
    known = size.isNotNull()
    return (
        F.when(known, F.least(size, low)).otherwise(first),
        F.when(known, F.least(size, last)).otherwise(hi),
    )


def grown_to_area(b: Box, target: Column, image_w: Column, image_h: Column) -> Box:
    """Scale a too small box about its centre up to ``target`` area, kept inside the image.

    Boxes that are large enough, empty, or without a target pass unchanged.
    """
    w, h = width(b), height(b)
    grow = target.isNotNull() & (w * h > 0) & (w * h < target)
    scale = F.sqrt(F.when(grow, target / (w * h)).otherwise(1.0))
    cx, cy = b.x1 + w / 2.0, b.y1 + h / 2.0
    x1, x2 = _shift_inside(cx - w * scale / 2.0, cx + w * scale / 2.0, image_w.cast("double"))
    y1, y2 = _shift_inside(cy - h * scale / 2.0, cy + h * scale / 2.0, image_h.cast("double"))
    return Box(*(F.when(grow, new).otherwise(old) for new, old in zip((x1, y1, x2, y2), b)))


def min_area_for(class_name: Column, targets: dict[str, float] | None = None) -> Column:
    targets = MIN_CLASS_AREA if targets is None else targets
    expr = F.lit(None).cast("double")
    for name, value in targets.items():
        expr = F.when(F.lower(F.trim(class_name)) == name, F.lit(float(value))).otherwise(expr)
    return expr


def _padded(lo: Column, hi: Column, size: Column, padding: Column, flat: Column, min_side: Column):
    margin = F.when(F.coalesce(flat, F.lit(0)) > 0, flat.cast("double")).when(
        F.coalesce(padding, F.lit(0.0)) > 0, (hi - lo) * padding
    )
    a = F.when(margin.isNotNull(), F.greatest(F.lit(0.0), lo - margin)).otherwise(lo)
    z = F.when(margin.isNotNull(), F.least(size, hi + margin)).otherwise(hi)
    extra = (min_side - (z - a)) / 2.0
    grow = (F.coalesce(min_side, F.lit(0)) > 0) & (extra > 0)
    return (
        F.when(grow, F.greatest(F.lit(0.0), a - extra)).otherwise(a),
        F.when(grow, F.least(size, z + extra)).otherwise(z),
    )


def crop_rectangle(
    b: Box, image_w: Column, image_h: Column, padding: Column, flat_padding: Column, min_side: Column
) -> Box:
    """Integer pixel rectangle to cut out for a box.

    Flat padding wins over proportional padding; then each side grows to
    ``min_side``.  If rounding leaves nothing, the truncated raw box is used.
    """
    w, h = image_w.cast("double"), image_h.cast("double")
    x1, x2 = _padded(b.x1, b.x2, w, padding, flat_padding, min_side)
    y1, y2 = _padded(b.y1, b.y2, h, padding, flat_padding, min_side)
    wi, hi = image_w.cast("int"), image_h.cast("int")
    main = Box(
        F.greatest(F.lit(0), to_pixel(x1)),
        F.greatest(F.lit(0), to_pixel(y1)),
        F.least(wi, to_pixel(x2)),
        F.least(hi, to_pixel(y2)),
    )
    raw = Box(
        F.greatest(F.lit(0), b.x1.cast("int")),
        F.greatest(F.lit(0), b.y1.cast("int")),
        F.least(wi, b.x2.cast("int")),
        F.least(hi, b.y2.cast("int")),
    )
    empty = (main.x2 <= main.x1) | (main.y2 <= main.y1)
    return Box(*(F.when(empty, r).otherwise(m) for m, r in zip(main, raw)))


def grid_cells(b: Box, cell: Column) -> Column:
    """ARRAY<STRUCT<cx, cy>> of the square grid cells a box touches."""

    def span(lo: Column, hi: Column) -> Column:
        first = F.floor(lo / cell)
        return F.sequence(first, F.greatest(first, F.floor(hi / cell)))

    return F.flatten(
        F.transform(
            span(b.x1, b.x2),
            lambda cx: F.transform(span(b.y1, b.y2), lambda cy: F.struct(cx.alias("cx"), cy.alias("cy"))),
        )
    )
