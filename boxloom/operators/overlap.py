"""Overlap tests between boxes of the same image.

The join key is the image.  For images with very many boxes the key is
(image, grid cell).  A box has cells of its own size, a power of two, and is also
entered in the cells of every larger size that boxes of the image have: two boxes that
overlap share a cell of the larger one's size.  Small boxes in a crowd are
compared with their neighbours only, whatever the largest box of the image is.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxloom.functions import geometry as G
from boxloom.operators import groups

Predicate = Callable[[DataFrame, DataFrame], Column]


def frame_box(df: DataFrame) -> G.Box:
    return G.Box(df["x1"], df["y1"], df["x2"], df["y2"])


def gridded(df: DataFrame, keys: list[str], pad: float = 0.0) -> DataFrame:
    """One row per (box, touched cell) with columns cell (its size), cx, cy and native: whether the size is the box's own.

    Meant for large groups.  ``pad`` widens boxes to the right and bottom.  Of two boxes in a cell, one must be native to be compared there.
    """
    b = G.box()
    wide = G.Box(b.x1, b.y1, b.x2 + pad, b.y2 + pad)
    side = F.greatest(G.width(wide), G.height(wide), F.lit(1e-6))
    sized = df.withColumn("_size", F.pow(F.lit(2.0), F.ceil(F.log2(side))))
    # The sizes of a group are few: one for each power of two between its smallest and its largest box.
    sizes = sized.groupBy(*keys).agg(F.collect_set("_size").alias("_sizes"))
    placed = groups.attach_one_per_key(sized, sizes, keys)
    placed = placed.withColumn("cell", F.explode(F.filter("_sizes", lambda s: s >= F.col("_size"))))
    placed = placed.withColumn("_cells", G.grid_cells(wide, F.col("cell")))
    return placed.select(*df.columns, "cell", (F.col("cell") == F.col("_size")).alias("native"), F.inline("_cells"))


CELL = ["cell", "cx", "cy"]
# Boxes of one cell that one task compares with each other.
CELL_ROWS = 2048


def split_cells(cells: DataFrame, group: list[str], slack: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """Two sides of the pairs inside cells: rows meet where ``_other`` of the first side is ``_block`` of the second.

    A crowded cell is cut into blocks of ``CELL_ROWS`` boxes in the order of their left edge.  Blocks whose extents lie
    more than ``slack`` apart don't meet; each other pair of blocks is a join key of its own, so the pairs of a
    cell spread over tasks.
    """
    keys = [*group, *CELL]
    none = F.lit(0).cast("long")
    crowded = cells.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > CELL_ROWS)
    if crowded.isEmpty():
        return cells.withColumn("_other", none), cells.withColumn("_block", none)
    crowded = groups.checkpointed(crowded.select(*keys))
    loose = groups.join_null_safe(cells, crowded, keys, "left_anti")
    dense = groups.placed(groups.join_null_safe(cells, crowded, keys, "left_semi"), keys, [F.col("x1"), F.col("x2")], "_place")
    dense = groups.checkpointed(dense.withColumn("_block", F.floor((F.col("_place") - 1) / CELL_ROWS)).drop("_place"))
    extents = dense.groupBy(*keys, "_block").agg(*[f(c).alias(f"_{c}") for f, c in ((F.min, "x1"), (F.min, "y1"), (F.max, "x2"), (F.max, "y2"))])
    a, b = extents.alias("a"), extents.alias("b")
    near = reduce(lambda x, y: x & y, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys])
    for low, high in (("_x1", "_x2"), ("_y1", "_y2")):
        near = near & (F.col(f"a.{low}") <= F.col(f"b.{high}") + slack) & (F.col(f"b.{low}") <= F.col(f"a.{high}") + slack)
    pairs = a.join(b, near).select(*[F.col(f"a.{k}").alias(k) for k in keys], F.col("a._block").alias("_block"), F.col("b._block").alias("_other"))
    sent = groups.join_null_safe(dense, groups.checkpointed(pairs), [*keys, "_block"]).drop("_block")
    return loose.withColumn("_other", none).unionByName(sent), loose.withColumn("_block", none).unionByName(dense)


def once_per_pair(a: G.Box, b: G.Box, cell: Column, cx: Column, cy: Column) -> Column:
    """True in exactly one of the cells two overlapping boxes share: that of their common corner."""
    return (F.floor(F.greatest(a.x1, b.x1) / cell) == cx) & (F.floor(F.greatest(a.y1, b.y1) / cell) == cy)


def without_overlapped(
    boxes: DataFrame,
    suppressors: Callable[[DataFrame], DataFrame],
    predicate: Predicate,
    image: str = "im_id",
    pos: str = "pos",
    limit: int | None = groups.GROUP_LIMIT,
    everywhere: bool = False,
) -> DataFrame:
    """Rows of ``boxes`` that no suppressor row of the same image hits.

    ``suppressors`` picks and renames the suppressing rows (columns get the
    prefix ``s_``).  The test does not depend on any order, so it is one
    left-anti join.  ``everywhere`` says that boxes needn't overlap to hit: then
    the first and the last suppressor of each class of an image stand for all.
    """

    def prefixed(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(c).alias(f"s_{c}") for c in df.columns])

    if everywhere:
        ends = suppressors(boxes)
        row = F.struct(*[F.col(c) for c in ends.columns])
        ends = ends.groupBy(image, "name").agg(F.array_distinct(F.array(F.min_by(row, F.col(pos)), F.max_by(row, F.col(pos)))).alias("_ends"))
        right = prefixed(ends.select(F.inline("_ends")))
        return boxes.join(right, (boxes[image] == right[f"s_{image}"]) & predicate(boxes, right), "left_anti")
    small, large = groups.split_by_size(boxes, [image], limit)
    right = prefixed(suppressors(small))
    kept = small.join(right, (small[image] == right[f"s_{image}"]) & predicate(small, right), "left_anti")
    if large is None:
        return kept
    cells, others = split_cells(groups.checkpointed(gridded(groups.checkpointed(large), [image])), [image])
    right = prefixed(suppressors(others))
    hit = cells.join(
        right,
        (cells[image] == right[f"s_{image}"])
        & reduce(lambda x, y: x & y, [cells[c] == right[f"s_{c}"] for c in CELL])
        & (cells["_other"] == right["s__block"])
        & (cells["native"] | right["s_native"])
        & predicate(cells, right),
        "left_semi",
    ).select(image, pos).distinct()
    return kept.unionByName(large.join(hit, [image, pos], "left_anti"))


def suppressor_box(df: DataFrame) -> G.Box:
    return G.Box(df["s_x1"], df["s_y1"], df["s_x2"], df["s_y2"])
