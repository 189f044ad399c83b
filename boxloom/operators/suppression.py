"""Suppression of duplicate boxes.

Greedy suppression walks the boxes of a group by priority and keeps a box
unless an already kept one overlaps it.  The result depends on the order, so
it is not a plain join.  Two exact plans are used:

* groups of ordinary size are gathered once (one shuffle) and decided by a
  fold over the sorted array, inside the JVM;
* larger groups are spread over grid cells and decided in rounds.  A box that
  beats every undecided box it may meet in its cells is kept; it removes what it
  overlaps there.  Such boxes don't overlap, so a round is about
  linear in the boxes.  Where this no longer removes much, few overlaps are
  left: they become a conflict table, and a box is kept once no undecided
  better box conflicts with it.  Both steps only take decisions that the long
  walk would take too.  (Parallel greedy independent sets: Blelloch, Fineman,
  Shun, SPAA 2012.)
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from boxloom.functions import geometry as G
from boxloom.functions.codecs import let
from boxloom.functions.text import class_key
from boxloom.operators import groups
from boxloom.operators.overlap import CELL, frame_box, gridded, once_per_pair, split_cells, suppressor_box, without_overlapped
from boxloom.session import forget

CORNERS = ["x1", "y1", "x2", "y2"]
# Columns the plans below add to a box table; dropped from every result.
HELPERS = ["k0", "k1", "t_iou", "t_min", "by_enclosing"]

# Names of the keep policies (underscores and blanks are equal).
KEEP_BIGGEST = "keep biggest"
KEEP_SMALLEST = "keep smallest"
KEEP_ENCLOSED = "keep smaller if encloses multiple"
KEEP_SOURCE = {
    "keep locate anything box": "locate_anything",
    "keep fashion model box": "fashion_model",
}
# Class that wins over all others, and the overlap at which it does.
PRIORITY_CLASS = "jewelry product"
PRIORITY_IOU = 0.8

Overlap = Callable[[Column, Column], Column]


@dataclass(frozen=True)
class Policy:
    """Inclusive overlap thresholds and keep rule of one class."""

    iou: float = 0.7
    io_min: float = 0.7
    keep: str = KEEP_BIGGEST


# --- overlap tests: a kept box against a later one, both as structs ---------


def by_iou_or_io_min(kept: Column, later: Column) -> Column:
    a, b = G.box_in(kept), G.box_in(later)
    return (G.iou(a, b) >= later["t_iou"]) | (G.io_min(a, b) >= later["t_min"])


def by_iou(kept: Column, later: Column) -> Column:
    return G.iou(G.box_in(kept), G.box_in(later)) >= later["t_iou"]


def by_inclusive_iou(kept: Column, later: Column) -> Column:
    return G.iou_inclusive(G.box_in(kept), G.box_in(later)) > later["t_iou"]


def _either_in_fold(kept: Column, later: Column) -> Column:
    areas = kept["area"], later["area"]
    return let(
        G.intersection(G.box_in(kept), G.box_in(later)),
        lambda shared: (G.iou_of(shared, *areas) >= later["t_iou"]) | (G.io_min_of(shared, *areas) >= later["t_min"]),
    )


def _iou_in_fold(kept: Column, later: Column) -> Column:
    return let(
        G.intersection(G.box_in(kept), G.box_in(later)),
        lambda shared: G.iou_of(shared, kept["area"], later["area"]) >= later["t_iou"],
    )


# The same tests inside lambdas, which are interpreted: the intersection is bound, the areas come with the boxes.
IN_FOLD: dict[Overlap, Overlap] = {by_iou_or_io_min: _either_in_fold, by_iou: _iou_in_fold}


# --- the greedy plans -------------------------------------------------------


def _labels(source: str | None) -> Column:
    if source is None:
        return F.array().cast("array<string>")
    return F.transform(F.split(F.coalesce(F.col(source), F.lit("")), ","), lambda s: F.trim(s))


def _element(columns: list[str], position: str, source: str | None) -> Column:
    """One box as a sortable struct: priority, position, geometry, labels, whole row."""
    return F.struct(
        F.struct("k0", "k1").alias("key"),
        F.col(position).alias("at"),
        F.struct(
            *CORNERS, "t_iou", "t_min", "by_enclosing", G.area(G.box()).alias("area"), G.ordering_area(G.box()).alias("order_area")
        ).alias("b"),
        _labels(source).alias("labels"),
        F.struct(*[F.col(c) for c in columns]).alias("row"),
    )


def _owners(boxes: Column, overlap: Overlap) -> Column:
    """Per box of a sorted array: its own index if kept, else that of the first kept box it hits."""

    def owner_of(owners: Column, i: Column) -> Column:
        return let(
            F.get(boxes, i)["b"],
            lambda b: F.get(
                F.filter(owners, lambda o, j: (o == j) & let(F.get(boxes, j)["b"], lambda kept: overlap(kept, b))), F.lit(0)
            ),
        )

    return F.aggregate(
        F.sequence(F.lit(0), F.size(boxes) - 1),
        F.array().cast("array<int>"),
        lambda owners, i: F.concat(owners, F.array(F.coalesce(owner_of(owners, i), i))),
    )


def _kept(boxes: Column, own: Column, merge: bool) -> Column:
    """Row and labels of each kept box; ``own`` are the owners."""

    def labels_of(i: Column) -> Column:
        hits = F.filter(boxes, lambda x, m: F.get(own, m) == i)
        return F.array_distinct(F.flatten(F.transform(hits, lambda x: x["labels"])))

    def survivor(i: Column) -> Column:
        box = F.get(boxes, i)
        return F.struct(box["row"].alias("row"), (labels_of(i) if merge else box["labels"]).alias("labels"))

    return F.transform(F.filter(own, lambda o, i: o == i), survivor)


def _enclosing_last(boxes: Column) -> Column:
    """Boxes under the enclosing rule get the key (overlaps two or more smaller ones, -area)."""

    def rekeyed(a: Column) -> Column:
        smaller = F.filter(
            boxes,
            lambda o: (o["b"]["order_area"] < a["b"]["order_area"]) & _either_in_fold(o["b"], a["b"]),
        )
        flag = F.when((F.size(boxes) > 2) & (F.size(smaller) >= 2), 1.0).otherwise(0.0)
        key = F.struct(flag.alias("k0"), a["key"]["k1"].alias("k1"))
        return F.when(
            a["b"]["by_enclosing"],
            F.struct(key.alias("key"), *[a[f].alias(f) for f in ("at", "b", "labels", "row")]),
        ).otherwise(a)

    return F.transform(boxes, rekeyed)


def _fold(
    df: DataFrame, group: list[str], element: Column, overlap: Overlap, merge: bool, enclosing: bool
) -> DataFrame:
    """Survivors of groups that fit one array."""
    overlap = IN_FOLD.get(overlap, overlap)
    gathered = df.groupBy(*group).agg(F.collect_list(element).alias("boxes"))
    raw = _enclosing_last(F.col("boxes")) if enclosing else F.col("boxes")
    # Lambdas copy their results, so only numbers come out of the walk and each kept row is built once.
    boxes = F.col("boxes")
    one = F.array(F.lit(0))
    walked = gathered.select(*group, F.sort_array(raw).alias("boxes"))
    walked = walked.select(*group, "boxes", F.when(F.size(boxes) == 1, one).otherwise(_owners(boxes, overlap)).alias("own"))
    return walked.select(*group, F.explode(_kept(boxes, F.col("own"), merge)).alias("kept"))


def _rows(kept: DataFrame, group: list[str], columns: list[str], source: str | None) -> DataFrame:
    # Group columns stay the grouping columns: later work per group needs no shuffle.
    out = []
    for c in columns:
        if c in group:
            out.append(F.col(c))
            continue
        if c == source:
            named = F.filter(F.col("kept.labels"), lambda s: s != "")
            out.append(F.array_join(named, ", ").alias(c))
        elif c not in HELPERS:
            out.append(F.col("kept.row")[c].alias(c))
    return kept.select(*out)


def greedy_suppress(
    df: DataFrame,
    group: list[str],
    overlap: Overlap,
    position: str = "pos",
    source: str | None = None,
    enclosing: bool = False,
    limit: int | None = groups.GROUP_LIMIT,
) -> DataFrame:
    """Rows that survive greedy suppression inside each group.

    ``df`` carries the box corners and the helper columns: ``k0``, ``k1``
    (ascending priority; ties fall to ``position``, unique in the group) and
    the thresholds ``t_iou``, ``t_min``.  With ``source`` the labels of a
    suppressed box join those of the first kept box it hits.
    """
    if "by_enclosing" not in df.columns:
        df = df.withColumn("by_enclosing", F.lit(False))
    columns = df.columns
    # A threshold that every pair reaches leaves the first box of each group, however the boxes lie.
    reached = (F.col("t_iou") < 0) if overlap is by_inclusive_iou else (F.col("t_iou") <= 0)
    if overlap is by_iou_or_io_min:
        reached = reached | (F.col("t_min") <= 0)
    reached = F.coalesce(reached, F.lit(False))
    alone = _first_of_groups(df.filter(reached), group, position, source, enclosing)
    df = df.filter(~reached)
    small, large = groups.split_by_size(df, group, limit)
    element = _element(columns, position, source)
    out = _rows(_fold(small, group, element, overlap, source is not None, enclosing), group, df.columns, source)
    if large is not None:
        pad = 1.0 if overlap is by_inclusive_iou else 0.0
        large = groups.checkpointed(large)
        if enclosing:
            large = _flag_enclosing(large, group, position)
        out = out.unionByName(_suppress_in_rounds(large, group, overlap, position, source, pad).select(*out.columns))
    return out.unionByName(alone.select(*out.columns))


def _first_of_groups(df: DataFrame, group: list[str], position: str, source: str | None, enclosing: bool) -> DataFrame:
    """First box by rank of each group, with the labels of all in order of rank: every box hits every other."""
    if enclosing:
        # Under the enclosing rule a box with two smaller ones comes last: only the two smallest areas matter.
        area = G.ordering_area(G.box())
        least = df.groupBy(*group).agg(F.min(area).alias("_least"))
        marked = groups.join_null_safe(df, least, group)
        beside = marked.groupBy(*group).agg(
            F.count(F.when(area == F.col("_least"), 1)).alias("_n"), F.min(F.when(area > F.col("_least"), area)).alias("_next")
        )
        second = F.when(F.col("_n") >= 2, F.col("_least")).otherwise(F.coalesce("_next", "_least"))
        late = F.when(area > second, 1.0).otherwise(0.0)
        marked = groups.join_null_safe(marked, beside, group)
        df = marked.withColumn("k0", F.when(F.col("by_enclosing"), late).otherwise(F.col("k0"))).select(*df.columns)
    ranked = df.withColumn("_rank", F.struct("k0", "k1", position))
    rest = [c for c in df.columns if c not in group]
    first = ranked.groupBy(*group).agg(F.min_by(F.struct(*rest), F.col("_rank")).alias("_row"))
    out = first.select(*[F.col(c) if c in group else F.col("_row")[c].alias(c) for c in df.columns])
    if source is not None:
        labels = ranked.select(*group, "_rank", F.explode(_labels(source)).alias("label"))
        labels = labels.groupBy(*group, "label").agg(F.min("_rank").alias("_rank")).filter(F.col("label") != "")
        joined = labels.groupBy(*group).agg(F.sort_array(F.collect_list(F.struct("_rank", "label"))).alias("_all"))
        texts = joined.select(*group, F.array_join(F.transform("_all", lambda x: x["label"]), ", ").alias("_text"))
        out = groups.join_null_safe(out, texts, group, "left").withColumn(source, F.coalesce("_text", F.lit(""))).drop("_text")
    return out.drop(*HELPERS)


def _sides(cells: DataFrame, group: list[str]) -> tuple[DataFrame, DataFrame, Column]:
    """A cell table twice, as ``a`` and ``b``, and the condition "same group, same cell, blocks that meet"."""
    same = [F.col(f"a.{g}").eqNullSafe(F.col(f"b.{g}")) for g in group]
    same += [F.col(f"a.{c}") == F.col(f"b.{d}") for c, d in (*zip(CELL, CELL), ("_other", "_block"))]
    same.append(F.col("a.native") | F.col("b.native"))
    a, b = split_cells(cells, group)
    return a.alias("a"), b.alias("b"), reduce(lambda x, y: x & y, same)


def _side_box(side: str) -> G.Box:
    return G.Box(*(F.col(f"{side}.{c}") for c in CORNERS))


def _side_struct(side: str) -> Column:
    return F.struct(*[F.col(f"{side}.{c}").alias(c) for c in (*CORNERS, "t_iou", "t_min")])


def _flag_enclosing(rows: DataFrame, group: list[str], position: str) -> DataFrame:
    """Set ``k0`` of large groups by the enclosing rule; overlaps are counted, not listed."""
    a, o, same = _sides(groups.checkpointed(gridded(rows, group)), group)
    a = a.filter("by_enclosing")
    box_a, box_o = _side_box("a"), _side_box("b")
    once = once_per_pair(box_a, box_o, F.col("a.cell"), F.col("a.cx"), F.col("a.cy"))
    smaller = G.ordering_area(box_o) < G.ordering_area(box_a)
    hits = (G.iou(box_a, box_o) >= F.col("a.t_iou")) | (G.io_min(box_a, box_o) >= F.col("a.t_min"))
    keys = [*group, position]
    flagged = (
        a.join(o, same & once & smaller & hits, "inner")
        .groupBy(*[F.col(f"a.{k}").alias(k) for k in keys])
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter("_n >= 2")
    )
    flag = F.when(F.col("_n").isNotNull(), 1.0).otherwise(0.0)
    k0 = F.when(F.col("by_enclosing"), flag).otherwise(F.col("k0"))
    return groups.join_null_safe(rows, flagged, keys, "left").withColumn("k0", k0).select(*rows.columns)


# A round of local winners must settle this share of the boxes, else conflicts are listed.
WORTHWHILE = 0.15


def _suppress_in_rounds(
    rows: DataFrame, group: list[str], overlap: Overlap, position: str, source: str | None, pad: float
) -> DataFrame:
    """Exact greedy suppression of large groups; see the module text."""
    keys = [*group, position]
    narrow = rows.select(*keys, F.struct("k0", "k1", position).alias("rank"), *CORNERS, "t_iou", "t_min")
    first = groups.checkpointed(_without_twins(narrow, group, overlap, position))
    cells = groups.checkpointed(gridded(first, group, pad))
    kept: list[DataFrame] = []
    pending, left = cells, first.count()
    while left:
        winners = groups.checkpointed(_local_winners(pending, group, position))
        beaten = _beaten(pending, winners, keys, group, overlap, position)
        won = winners.select(*keys).distinct()
        decided = won.unionByName(beaten)
        before, pending = pending, groups.checkpointed(groups.join_null_safe(pending, decided, keys, "left_anti"))
        if before is not cells:
            forget(before)
        kept.append(won)
        now = pending.select(*keys).distinct().count()
        settled, left = left - now, now
        if settled < WORTHWHILE * (settled + left):
            break
    if left:
        kept.append(_conflict_free(pending, group, overlap, position))
    chosen = groups.checkpointed(reduce(DataFrame.unionByName, kept))
    out = groups.join_null_safe(rows, chosen, keys, "left_semi")
    if source is not None:
        out = _with_merged_labels(out, rows, gridded(narrow, group, pad), chosen, group, overlap, position, source)
    return out.drop(*HELPERS)


def _without_twins(narrow: DataFrame, group: list[str], overlap: Overlap, position: str) -> DataFrame:
    """Best ranked of the boxes of one geometry: what suppresses it suppresses its twins, else it does so itself."""
    me = F.struct(*CORNERS, "t_iou", "t_min")
    hit = F.coalesce(overlap(me, me), F.lit(False))
    best = narrow.filter(hit).groupBy(*group, *CORNERS, "t_iou", "t_min").agg(F.min("rank").alias("rank"))
    best = best.withColumn(position, F.col("rank")[position])
    return narrow.filter(~hit).unionByName(best.select(*narrow.columns))


def _local_winners(cells: DataFrame, group: list[str], position: str) -> DataFrame:
    """Boxes that rank before all they may meet in the cells they touch, one row per cell."""
    keys = [*group, position]
    best = cells.groupBy(*group, *CELL).agg(F.min("rank").alias("_best"), F.min(F.when(F.col("native"), F.col("rank"))).alias("_native"))
    met = groups.join_null_safe(cells, best, [*group, *CELL])
    first = F.when(F.col("native"), F.col("rank") <= F.col("_best")).otherwise(F.col("_native").isNull() | (F.col("rank") < F.col("_native")))
    won = met.groupBy(*keys).agg(F.bool_and(first).alias("_won")).filter("_won").select(*keys)
    return groups.join_null_safe(cells, won, keys, "left_semi")


def _beaten(
    cells: DataFrame, winners: DataFrame, keys: list[str], group: list[str], overlap: Overlap, position: str
) -> DataFrame:
    """Boxes that a winner of one of their cells overlaps."""
    sides = winners.select(*group, *CELL, F.col("native").alias("w_native"), F.col(position).alias("w_pos"), F.struct(*CORNERS).alias("w_box"))
    met = groups.join_null_safe(cells, sides, [*group, *CELL]).filter(F.col("native") | F.col("w_native"))
    me = F.struct(*CORNERS, "t_iou", "t_min")
    return met.filter((F.col("w_pos") != F.col(position)) & overlap(F.col("w_box"), me)).select(*keys).distinct()


def _conflict_free(cells: DataFrame, group: list[str], overlap: Overlap, position: str) -> DataFrame:
    """Keys of the boxes kept among the undecided ones, by rounds over their conflicts."""
    keys = [*group, position]
    a, b, same = _sides(cells, group)
    once = once_per_pair(_side_box("a"), _side_box("b"), F.col("a.cell"), F.col("a.cx"), F.col("a.cy"))
    conflicts = a.join(
        b, same & (F.col("a.rank") < F.col("b.rank")) & once & overlap(_side_struct("a"), _side_struct("b"))
    ).select(*[F.col(f"a.{g}").alias(g) for g in group], F.col(f"a.{position}").alias("better"), F.col(f"b.{position}").alias("worse"))
    conflicts = groups.checkpointed(conflicts)
    undecided = groups.checkpointed(cells.select(*keys).distinct())
    kept = []
    while True:
        waiting = conflicts.select(*group, F.col("worse").alias(position)).distinct()
        free = groups.checkpointed(groups.join_null_safe(undecided, waiting, keys, "left_anti"))
        kept.append(free)
        if conflicts.isEmpty():
            return reduce(DataFrame.unionByName, kept)
        by_free = groups.join_null_safe(conflicts, free.withColumnRenamed(position, "better"), [*group, "better"], "left_semi")
        lost = groups.checkpointed(by_free.select(*group, F.col("worse").alias(position)).distinct())
        settled = free.unionByName(lost)
        before = undecided, conflicts, lost
        undecided = groups.checkpointed(groups.join_null_safe(undecided, settled, keys, "left_anti"))
        conflicts = groups.join_null_safe(conflicts, settled.withColumnRenamed(position, "better"), [*group, "better"], "left_anti")
        conflicts = groups.join_null_safe(conflicts, lost.withColumnRenamed(position, "worse"), [*group, "worse"], "left_anti")
        conflicts = groups.checkpointed(conflicts)
        forget(*before)


def _with_merged_labels(
    out: DataFrame, rows: DataFrame, cells: DataFrame, chosen: DataFrame, group: list[str], overlap: Overlap, position: str, source: str
) -> DataFrame:
    """Labels of each suppressed box go to the best kept box it overlaps, in order of rank.

    Kept boxes do not overlap each other much, so a box meets few of them.
    """
    keys = [*group, position]
    keepers = groups.join_null_safe(cells, chosen, keys, "left_semi")
    others = groups.join_null_safe(cells, chosen, keys, "left_anti")
    sides = keepers.select(*group, *CELL, F.col("native").alias("w_native"), F.col("rank").alias("w_rank"), F.struct(*CORNERS).alias("w_box"))
    me = F.struct(*CORNERS, "t_iou", "t_min")
    met = groups.join_null_safe(others, sides, [*group, *CELL]).filter(
        (F.col("native") | F.col("w_native")) & (F.col("w_rank") < F.col("rank")) & overlap(F.col("w_box"), me)
    )
    owner = met.groupBy(*keys).agg(F.min("w_rank").alias("w_rank"), F.min("rank").alias("rank"))
    labelled = groups.join_null_safe(owner, rows.select(*keys, _labels(source).alias("labels")), keys)
    given = labelled.select(*group, F.col("w_rank")[position].alias("_at"), "rank", F.explode("labels").alias("label"))
    per_box = (
        given.groupBy(*group, "_at", "label")
        .agg(F.min("rank").alias("rank"))
        .groupBy(*group, "_at")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "label"))).alias("late"))
        .withColumnRenamed("_at", position)
    )
    joined = groups.join_null_safe(out, per_box, keys, "left")
    late = F.coalesce(F.transform("late", lambda x: x["label"]), F.array().cast("array<string>"))
    merged = F.filter(F.array_distinct(F.concat(_labels(source), late)), lambda s: s != "")
    return joined.withColumn(source, F.array_join(merged, ", ")).drop("late")


# --- the suppression operators ----------------------------------------------


def _by_class(class_name: Column, policies: dict[str, Policy], value) -> Column:
    """Value of the class's policy, else of ``general``, else NULL."""
    general = policies.get("general")
    expr = F.lit(value(general)) if general else F.lit(None)
    for name, policy in policies.items():
        if name != "general":
            expr = F.when(class_name == name, F.lit(value(policy))).otherwise(expr)
    return expr


def _policy_keys(df: DataFrame, keep: Column) -> DataFrame:
    area = G.ordering_area(G.box())
    source = F.lower(F.trim(F.coalesce(F.col("source"), F.lit(""))))
    score = F.coalesce(F.col("score"), F.lit(1.0))
    first = F.when(keep == KEEP_BIGGEST, -area).when(keep == KEEP_SMALLEST, area)
    for name, label in KEEP_SOURCE.items():
        first = first.when(keep == name, F.when(source == label, 0.0).otherwise(1.0))
    return (
        df.withColumn("k0", first.otherwise(0.0))
        .withColumn("k1", F.when(keep == KEEP_ENCLOSED, -area).otherwise(-score))
        .withColumn("by_enclosing", F.coalesce(keep == KEEP_ENCLOSED, F.lit(False)))
    )


def suppress_by_policy(
    df: DataFrame, policies: dict[str, Policy], image: str = "im_id", limit: int | None = groups.GROUP_LIMIT
) -> DataFrame:
    """Greedy suppression per (image, class) under per-class policies.

    Classes without a policy use ``general``; without that they pass.
    Needs columns image, pos, name, score, source and the corners.
    """

    def plain(policy: Policy) -> str:
        return policy.keep.strip().lower().replace("_", " ")

    keyed = df.withColumn("t_iou", _by_class(F.col("name"), policies, lambda p: float(p.iou)).cast("double"))
    keyed = keyed.withColumn("t_min", _by_class(F.col("name"), policies, lambda p: float(p.io_min)).cast("double"))
    keyed = _policy_keys(keyed, _by_class(F.col("name"), policies, plain).cast("string"))
    ruled = keyed.filter(F.col("t_iou").isNotNull()) if "general" not in policies else keyed
    enclosing = any(plain(p) == KEEP_ENCLOSED for p in policies.values())
    out = greedy_suppress(ruled, [image, "name"], by_iou_or_io_min, source="source", enclosing=enclosing, limit=limit)
    if "general" not in policies:
        free = keyed.filter(F.col("t_iou").isNull()).select(*df.columns)
        out = out.select(*df.columns).unionByName(free)
    return out.select(*df.columns)


def _with_thresholds(df: DataFrame, iou: float, io_min: float | None, k0: Column) -> DataFrame:
    return (
        df.withColumn("t_iou", F.lit(float(iou)))
        .withColumn("t_min", F.lit(io_min).cast("double"))
        .withColumn("k0", k0.cast("double"))
        .withColumn("k1", F.lit(0.0))
    )


def suppress_smallest_first(
    df: DataFrame, iou: float = 0.7, io_min: float = 0.7, image: str = "im_id", limit: int | None = groups.GROUP_LIMIT
) -> DataFrame:
    """Per (image, class): smaller boxes win."""
    ready = _with_thresholds(df, iou, io_min, G.area(G.box()))
    return greedy_suppress(ready, [image, "name"], by_iou_or_io_min, limit=limit).select(*df.columns)


def suppress_same_class(
    df: DataFrame, class_map: dict[str, str], iou: float, image: str = "im_id", limit: int | None = groups.GROUP_LIMIT
) -> DataFrame:
    """Per (image, mapped class): higher scores win; unmapped classes pass."""
    mapped = F.lit(None).cast("string")
    for name, target in class_map.items():
        mapped = F.when(F.col("name") == name, target).otherwise(mapped)
    tagged = df.withColumn("mapped_class", mapped)
    ready = _with_thresholds(tagged.filter("mapped_class is not null"), iou, None, -F.col("score"))
    out = greedy_suppress(ready, [image, "mapped_class"], by_iou, limit=limit).select(*df.columns)
    return out.unionByName(tagged.filter("mapped_class is null").select(*df.columns))


def suppress_ground_truth(
    df: DataFrame, iou: float, image: str = "im_id", limit: int | None = groups.GROUP_LIMIT
) -> DataFrame:
    """Per (image, class): larger annotated boxes win."""
    b = G.box()
    ready = _with_thresholds(df, iou, None, -((b.x2 - b.x1) * (b.y2 - b.y1)))
    return greedy_suppress(ready, [image, "name"], by_iou, limit=limit).select(*df.columns)


def suppress_inclusive(
    df: DataFrame, iou: float, group: list[str] | None = None, limit: int | None = groups.GROUP_LIMIT
) -> DataFrame:
    """Detector form: pixel-inclusive IoU strictly above ``iou`` suppresses; higher scores win."""
    ready = _with_thresholds(df, iou, None, -F.col("score"))
    return greedy_suppress(ready, group or ["im_id", "name"], by_inclusive_iou, limit=limit).select(*df.columns)


def suppress_across_classes(
    df: DataFrame, rules: dict[str, list[str]], iou: float, image: str = "im_id", limit: int | None = groups.GROUP_LIMIT
) -> DataFrame:
    """A class removes overlapping boxes of the classes listed for it.

    Removed boxes still remove others, so no order is involved.
    """

    def hits(left: DataFrame, right: DataFrame) -> Column:
        listed = F.lit(False)
        for winner, losers in rules.items():
            listed = listed | ((right["s_name"] == winner) & left["name"].isin(losers))
        apart = left["pos"] != right["s_pos"]
        return listed & apart & (G.iou(suppressor_box(right), frame_box(left)) >= iou)

    winners = [w for w, losers in rules.items() if losers]
    return without_overlapped(df, lambda d: d.filter(F.col("name").isin(winners)), hits, image, limit=limit, everywhere=iou <= 0)


def clean_before_suppression(
    df: DataFrame, iou: float = PRIORITY_IOU, image: str = "im_id", limit: int | None = groups.GROUP_LIMIT
) -> DataFrame:
    """Drop class ``other`` and every box that the priority class covers (IoU strictly above ``iou``)."""
    named = df.filter(F.lower(F.coalesce(F.col("name"), F.lit(""))) != "other")

    def hits(left: DataFrame, right: DataFrame) -> Column:
        return (F.coalesce(class_key(left["name"]), F.lit("")) != PRIORITY_CLASS) & (
            G.iou(suppressor_box(right), frame_box(left)) > iou
        )

    return without_overlapped(
        named, lambda d: d.filter(class_key(F.col("name")) == PRIORITY_CLASS), hits, image, limit=limit, everywhere=iou < 0
    )


def cap_boxes(
    df: DataFrame, per_class: int | None, per_image: int | None, image: str = "im_id"
) -> DataFrame:
    """Best ``per_class`` boxes of each class in an image, then best ``per_image`` of the image.

    Constant limits, so Spark cuts every group before the shuffle.
    """
    best = [F.coalesce(F.col("score"), F.lit(1.0)).desc(), F.col("pos")]
    for keys, cap in (([image, "name"], per_class), ([image], per_image)):
        if cap is not None:
            ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*best)))
            df = ranked.filter(F.col("_rank") <= cap).drop("_rank")
    return df


def detection_limit(df: DataFrame, multiple: bool, limit: int, image: str = "im_id") -> DataFrame:
    """Only the best box of an image, or its best ``limit`` boxes when several are wanted."""
    cap = 1 if not multiple else (limit if limit >= 0 else None)
    return cap_boxes(df, None, cap, image)
