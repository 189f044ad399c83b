"""Overlap clusters: connected boxes of one image, and their summary.

Boxes are connected when their IoU reaches a threshold; a cluster is a
connected component, numbered by its lowest box position.

Ordinary images are solved in one fold over the image's boxes.  For very large
images the boxes are first contracted: boxes whose quantised geometry is so
close that their IoU must reach the threshold form one node.  Only pairs of
nodes are kept, and labels spread over that small graph by joins.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from boxloom.functions import geometry as G
from boxloom.functions.codecs import let
from boxloom.operators import groups
from boxloom.operators.overlap import CELL, gridded, split_cells


def exploded_detections(df: DataFrame, detections: str = "detections") -> DataFrame:
    """One row per usable detection with integer corners; broken ones are skipped."""
    rest = [c for c in df.columns if c != detections]
    det = F.col("_d")
    usable = (
        det["name"].isNotNull() & det["score"].isNotNull() & (F.size(det["box"]) == 4)
        & ~F.exists(det["box"], lambda v: v.isNull())
    )
    exploded = df.select(*rest, F.posexplode(detections).alias("pos", "_d")).filter(usable)
    corners = G.pixels(G.box_at(det["box"]))
    return exploded.select(
        *rest,
        "pos",
        det["name"].alias("name"),
        det["score"].cast("double").alias("score"),
        *[v.cast("double").alias(c) for c, v in zip(G.Box._fields, corners)],
    )


def overlap_clusters(
    df: DataFrame, iou: float, image: str = "im_id", pos: str = "pos", limit: int | None = groups.GROUP_LIMIT
) -> DataFrame:
    """Add ``cluster_id`` (0-based per image) and ``cluster_size`` to every box.

    At a threshold of zero or less every pair is linked: an image is one cluster.
    """
    if iou <= 0:
        sizes = df.groupBy(image).agg(F.count(F.lit(1)).cast("int").alias("cluster_size"))
        whole = groups.attach_one_per_key(df.withColumn("cluster_id", F.lit(0)), sizes, [image])
        return whole.select(*df.columns, "cluster_id", "cluster_size")
    small, large = groups.split_by_size(df, [image], limit)
    out = _fold_clusters(small, iou, image, pos)
    if large is not None:
        out = out.unionByName(_graph_clusters(groups.checkpointed(large), iou, image, pos).select(*out.columns))
    return out


def _component_labels(boxes: Column, iou: float) -> Column:
    """Per box of a position-ordered array (with ``area``): the lowest index it is connected to."""

    def linked(a: Column, b: Column) -> Column:
        # Lambdas are interpreted: the intersection is bound, the areas come with the boxes.
        return let(G.intersection(G.box_in(a), G.box_in(b)), lambda shared: G.iou_of(shared, a["area"], b["area"]) >= iou)

    def extended(labels: Column, i: Column) -> Column:
        touched = let(
            F.get(boxes, i),
            lambda mine: F.filter(
                F.transform(F.slice(boxes, 1, i), lambda b, j: F.when(linked(b, mine), F.get(labels, j))),
                lambda label: label.isNotNull(),
            ),
        )
        return let(
            touched,
            lambda t: F.when(F.size(t) == 0, F.concat(labels, F.array(i))).otherwise(
                let(
                    F.array_min(t),
                    lambda low: F.concat(
                        F.transform(labels, lambda label: F.when(F.array_contains(t, label), low).otherwise(label)),
                        F.array(low),
                    ),
                )
            ),
        )

    return F.aggregate(F.sequence(F.lit(0), F.size(boxes) - 1), F.array().cast("array<int>"), extended)


def _fold_clusters(df: DataFrame, iou: float, image: str, pos: str) -> DataFrame:
    rest = [c for c in df.columns if c != image]
    row = F.struct(*[F.col(c) for c in rest])
    element = F.struct(F.col(pos).alias("at"), *G.Box._fields, G.area(G.box()).alias("area"), row.alias("row"))
    gathered = df.groupBy(image).agg(F.sort_array(F.collect_list(element)).alias("boxes"))

    def numbered(boxes: Column) -> Column:
        return let(
            _component_labels(boxes, iou),
            lambda labels: let(
                F.sort_array(F.array_distinct(labels)),
                lambda order: F.transform(
                    labels,
                    lambda mine: F.struct(
                        (F.array_position(order, mine) - 1).cast("int").alias("cluster_id"),
                        F.size(F.filter(labels, lambda other: other == mine)).alias("cluster_size"),
                    ),
                ),
            ),
        )

    # Numbers only come out of the lambdas, which copy their results; the rows are put beside them.
    # The image column is the grouping column, so later work per image needs no shuffle.
    found = gathered.select(image, F.col("boxes.row").alias("row"), numbered(F.col("boxes")).alias("found"))
    exploded = found.select(image, F.inline(F.arrays_zip("row", "found")))
    return exploded.select(
        *[F.col(c) if c == image else F.col("row")[c].alias(c) for c in df.columns], "found.cluster_id", "found.cluster_size"
    )


def _node_columns(iou: float, pos: str) -> list[Column]:
    """Quantised geometry; equal values imply an IoU of at least ``iou``.

    With side lengths within a factor r = 1 + e and corners within e of the
    shorter side, IoU >= (1-e)^2 / (2 r^2 - (1-e)^2).  Solved for e, with a
    small safety margin for rounding.  At iou = 1 only identical boxes qualify.
    """
    b = G.box()
    s = math.sqrt(2 * iou / (1 + iou))
    e = 0.98 * (1 - s) / (1 + s)
    empty = (G.width(b) <= 0) | (G.height(b) <= 0)
    if iou <= 0 or e < 1e-6:
        parts = [b.x1, b.y1, b.x2, b.y2]
    else:
        base = math.log(1 + e)
        level_w = F.floor(F.log(F.greatest(G.width(b), F.lit(1e-12))) / F.lit(base))
        level_h = F.floor(F.log(F.greatest(G.height(b), F.lit(1e-12))) / F.lit(base))
        parts = [
            level_w,
            level_h,
            F.floor(b.x1 / (F.lit(e) * F.exp(level_w * F.lit(base)))),
            F.floor(b.y1 / (F.lit(e) * F.exp(level_h * F.lit(base)))),
        ]
    alone = F.when(empty, F.col(pos).cast("long")).otherwise(F.lit(-1).cast("long"))
    return [*[p.cast("double").alias(f"_q{i}") for i, p in enumerate(parts)], alone.alias("_q4")]


def _graph_clusters(df: DataFrame, iou: float, image: str, pos: str) -> DataFrame:
    quantised = df.select("*", *_node_columns(iou, pos))
    cell_keys = [image, *[f"_q{i}" for i in range(5)]]
    nodes = quantised.groupBy(*cell_keys).agg(F.min(pos).alias("node"))
    placed = groups.checkpointed(groups.join_null_safe(quantised, nodes, cell_keys).drop(*cell_keys[1:]))
    # Identical boxes of a node find the same neighbours; one of them is enough.
    distinct_boxes = placed.select(image, "node", *G.Box._fields).distinct()
    one, two = split_cells(groups.checkpointed(gridded(groups.checkpointed(distinct_boxes), [image])), [image])
    a, b = one.alias("a"), two.alias("b")
    box_a, box_b = (G.Box(*(F.col(f"{s}.{c}") for c in G.Box._fields)) for s in ("a", "b"))
    edges = (
        a.join(
            b,
            (F.col(f"a.{image}").eqNullSafe(F.col(f"b.{image}")))
            & reduce(lambda x, y: x & y, [F.col(f"a.{c}") == F.col(f"b.{c}") for c in CELL])
            & (F.col("a._other") == F.col("b._block"))
            & (F.col("a.native") | F.col("b.native"))
            & (F.col("a.node") < F.col("b.node"))
            & (G.iou(box_a, box_b) >= iou),
        )
        .select(F.col(f"a.{image}").alias(image), F.col("a.node").alias("u"), F.col("b.node").alias("v"))
        .distinct()
    )
    labels = _spread_labels(placed.select(image, "node").distinct(), groups.checkpointed(edges), image)
    labelled = groups.join_null_safe(placed, labels, [image, "node"])
    numbers = groups.ordered_rank(labels.select(image, "label").distinct(), [image], "label", "_n")
    numbers = numbers.select(image, "label", (F.col("_n") - 1).cast("int").alias("cluster_id"))
    sizes = labelled.groupBy(image, "label").agg(F.count(F.lit(1)).cast("int").alias("cluster_size"))
    numbers = groups.join_null_safe(numbers, sizes, [image, "label"])
    return groups.join_null_safe(labelled, numbers, [image, "label"]).drop("node", "label")


def _spread_labels(nodes: DataFrame, edges: DataFrame, image: str) -> DataFrame:
    """Lowest connected node per node.

    Parents are lowered in rounds: a node offers the lowest grandparent among
    its neighbours to itself and to its parent, and skips to its grandparent
    (FastSV: Zhang, Azad, Hu, SIAM PP 2020).  All offers meet in one minimum,
    which combines before the shuffle.
    """
    both = groups.checkpointed(edges.unionByName(edges.select(image, F.col("v").alias("u"), F.col("u").alias("v"))))
    state = groups.checkpointed(nodes.withColumns({"parent": F.col("node"), "grand": F.col("node")}))
    while True:
        heard = (
            groups.join_null_safe(both, state.select(image, F.col("node").alias("v"), "grand"), [image, "v"])
            .groupBy(image, F.col("u").alias("node"))
            .agg(F.min("grand").alias("low"))
        )
        known = groups.checkpointed(groups.join_null_safe(state, heard, [image, "node"], "left"))
        to_self = known.select(image, "node", F.least("parent", "grand", "low").alias("parent"))
        to_parent = known.filter("low is not null").select(image, F.col("parent").alias("node"), F.col("low").alias("parent"))
        lowered = to_self.unionByName(to_parent).groupBy(image, "node").agg(F.min("parent").alias("parent"))
        lowered = groups.checkpointed(lowered)
        parents = lowered.select(image, F.col("node").alias("parent"), F.col("parent").alias("grand"))
        # Many nodes share a parent: the parent side is unique, a hot one is split by the adaptive join.
        after = groups.join_null_safe(lowered, parents, [image, "parent"])
        before = known.select(image, "node", F.col("grand").alias("was"))
        after = groups.checkpointed(groups.join_null_safe(after, before, [image, "node"]))
        state = after.select(image, "node", "parent", "grand")
        if after.filter("grand <> was").isEmpty():
            return state.select(image, "node", F.col("grand").alias("label"))


def cluster_summary(df: DataFrame, image: str = "im_id", carry: list[str] | None = None) -> DataFrame:
    """One row per cluster: size, best box, runner-up score, margin and uncertainty.

    Takes the result of ``overlap_clusters``.  The two best boxes come from a
    constant rank limit, which cuts large clusters before any shuffle.
    """
    keys = [image, "cluster_id"]
    best = W.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("pos"))
    top_two = df.withColumn("_rank", F.row_number().over(best)).filter(F.col("_rank") <= 2)
    first = F.col("_rank") == 1
    box = F.array(*[F.col(c).cast("int") for c in G.Box._fields])
    tops = top_two.groupBy(*keys).agg(
        *[F.max(F.when(first, F.col(c))).alias(c) for c in carry or []],
        F.max("cluster_size").alias("cluster_size"),
        F.max(F.when(first, F.col("name"))).alias("top_class"),
        F.max(F.when(first, F.col("score"))).alias("top_score"),
        F.coalesce(F.max(F.when(~first, F.col("score"))), F.lit(0.0)).alias("second_score"),
        F.max(F.when(first, box)).alias("top_box"),
        F.max(F.when(first, F.col("pos"))).alias("top_pos"),
    )
    margin = F.when(F.col("cluster_size") > 1, F.col("top_score") - F.col("second_score")).otherwise(F.col("top_score"))
    return tops.withColumn("margin", margin).withColumn("uncertainty", F.lit(1.0) - F.col("margin"))
