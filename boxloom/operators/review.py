"""Verdicts, human review and corrections on boxes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxloom.functions import codecs as C
from boxloom.functions.codecs import let
from boxloom.operators import groups

# What an added box carries in the aligned columns.
ADDED = {
    "optional": "true",
    "box_statuses": "human_drawn",
    "box_sources": "human",
    "box_reasons": C.MANUAL_REASON,
    "issue_types": "no_issue",
}
# What a replaced box carries.
REPLACED = {"box_statuses": "human_drawn", "box_sources": "human", "issue_types": "no_issue"}
SMALLEST_DRAWN = 5

CORRECTION = (
    "row_index int, action string, concept string, box array<int>, concept_index int, new_concept string, "
    "new_box array<int>, new_boxes array<struct<concept:string,box:array<int>>>"
)
REVIEW = (
    "decisions map<string,string>, added_boxes map<string,array<struct<box:array<int>,name:string,source:string>>>, "
    "hidden map<string,boolean>"
)


def box_uid(image: Column, name: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    corners = [F.rint(v).cast("long").cast("string") for v in (x1, y1, x2, y2)]
    return F.concat_ws(":", image.cast("string"), name, *corners)


def with_uid(df: DataFrame) -> DataFrame:
    return df.withColumn("uid", box_uid(*[F.col(c) for c in ("im_id", "name", "x1", "y1", "x2", "y2")]))


def verdict_keys(cache: DataFrame, key: str = "key") -> DataFrame:
    """Split verdict cache keys ``llm:<image>:<class>:[x1,y1,x2,y2]:<hash>`` into columns."""
    pattern = r"^llm:(.*):([^:]*):(\[[^\]]*\]):([^:]*)$"
    # One match, out of a generator, so filters on the parts do not copy it; class and settings hold no colon, so lengths cut the rest.
    parts = F.struct(F.regexp_extract(key, pattern, 1).alias("_im"), F.col(key).alias("_key"))
    rows = cache.filter(F.col(key).rlike(pattern)).select("*", F.inline(F.array(parts)))
    after = F.substring(F.col("_key"), F.length("_im") + 6, F.length("_key"))
    name, settings = F.substring_index(after, ":", 1), F.substring_index(after, ":", -1)
    box = F.substring(after, F.length(name) + 2, F.length(after) - F.length(name) - F.length(settings) - 2)
    rest = [c for c in cache.columns if c != key]
    return rows.select(F.col("_im").alias("im_id"), name.alias("name"), box.alias("box_text"), settings.alias("settings"), *rest)


def with_verdicts(df: DataFrame, verdicts: DataFrame, order: str = "position") -> DataFrame:
    """Verdict of the same image, class and rounded box; the earliest entry counts.

    Settings are ignored.  Boxes without verdict count as valid, not validated.
    """
    keys = ["im_id", "name", "box_text"]
    firsts = groups.first_per_key(verdicts.select(*keys, order, "is_valid", "reason"), keys, [order])
    corners = [F.col(c) for c in ("x1", "y1", "x2", "y2")]
    keyed = df.withColumn("box_text", C.box_text(*corners))
    found = firsts.select(*keys, F.col("is_valid").alias("_valid"), F.col("reason").alias("_reason"), F.lit(True).alias("_hit"))
    joined = groups.join_on(keyed, found, keys, "left")
    return joined.select(
        *[c for c in df.columns if c not in ("is_valid", "reason", "llm_validated")],
        F.coalesce("_hit", F.lit(False)).alias("llm_validated"),
        F.coalesce("_valid", F.lit(True)).alias("is_valid"),
        F.coalesce("_reason", F.lit("")).alias("reason"),
    )


def review_tables(review: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Decisions, added boxes and visibility switches of a review file as tables."""
    decisions = review.select(F.explode("decisions").alias("uid", "decision"))
    added = review.select(F.explode("added_boxes").alias("im_id", "_b")).select(
        "im_id", F.posexplode("_b").alias("added_no", "_a")
    )
    corners = [F.get("_a.box", F.lit(i)).cast("double").alias(c) for i, c in enumerate(("x1", "y1", "x2", "y2"))]
    added = added.select("im_id", "added_no", F.col("_a.name").alias("name"), F.col("_a.source").alias("source"), *corners)
    hidden = review.select(F.explode("hidden").alias("uid", "hidden"))
    return decisions, added, hidden


def reviewed_boxes(df: DataFrame, decisions: DataFrame, added: DataFrame) -> DataFrame:
    """Boxes after human review.

    Rejected boxes go, approved boxes stay whatever the verdict, undecided
    boxes stay when valid; boxes drawn by people follow the others.
    """
    decided = groups.join_on(with_uid(df), decisions, ["uid"], "left")
    choice = F.coalesce("decision", F.lit(""))
    kept = decided.filter((choice == "approved") | ((choice != "rejected") & F.coalesce("is_valid", F.lit(True))))
    columns = ["im_id", "pos", "name", "x1", "y1", "x2", "y2"]
    # Drawn boxes come after every detected box of their image.
    drawn = added.withColumn("pos", F.col("added_no").cast("long") + F.lit(1 << 40))
    return kept.select(*columns, F.lit(False).alias("drawn")).unionByName(
        drawn.select(*columns, F.lit(True).alias("drawn"))
    )


def review_counts(df: DataFrame, decisions: DataFrame, added: DataFrame) -> DataFrame:
    """Boxes rejected, boxes approved, boxes drawn by people."""
    decided = groups.join_on(with_uid(df).select("uid"), decisions, ["uid"]).select("decision")
    events = decided.unionByName(added.select(F.lit("added").alias("decision")))

    def count(kind: str) -> Column:
        return F.coalesce(F.sum((F.col("decision") == kind).cast("long")), F.lit(0)).alias(kind)

    return events.agg(count("rejected"), count("approved"), count("added"))


def with_review_status(
    df: DataFrame, decisions: DataFrame, hidden: DataFrame | None = None, show_all: bool = False
) -> DataFrame:
    """Add ``status`` (approved/rejected/new/invalid/valid) and ``is_hidden``.

    Decisions beat everything; drawn boxes are new; a negative verdict makes
    invalid.  Invalid boxes are hidden unless switched or everything is shown.
    """
    out = groups.join_on(with_uid(df), decisions, ["uid"], "left")
    drawn = F.col("drawn") if "drawn" in df.columns else F.lit(False)
    status = (
        F.when(F.col("decision").isin("approved", "rejected"), F.col("decision"))
        .when(drawn, "new")
        .when(F.col("llm_validated") & ~F.col("is_valid"), "invalid")
        .otherwise("valid")
    )
    default = F.lit(False) if show_all else ~F.coalesce("is_valid", F.lit(True))
    if hidden is not None:
        out = groups.join_on(out, hidden.withColumnRenamed("hidden", "_h"), ["uid"], "left")
        default = F.coalesce("_h", default)
    return out.withColumn("status", status).withColumn("is_hidden", default).select(
        *df.columns, "uid", "status", "is_hidden"
    )


# --- corrections ------------------------------------------------------------


def _entry(columns: list[str], values: dict[str, Column]) -> Column:
    return F.struct(*[values.get(c, F.lit("")).cast("string").alias(c) for c in columns])


def _int_box(box: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(box.cast("array<string>"), ","), F.lit("]"))


def _added(columns: list[str], concept: Column, box: Column) -> Column:
    fixed = {k: F.lit(v) for k, v in ADDED.items()}
    return _entry(columns, {"concepts": F.coalesce(concept, F.lit("")), "boxes": _int_box(box), **fixed})


def corrected_rows(df: DataFrame, corrections: DataFrame, order: str = "position") -> DataFrame:
    """Apply add / remove / replace / replace_multi corrections to image rows in order.

    Indices refer to the row as earlier corrections left it, so the
    corrections of a row are folded over its entries; rows without any are
    passed on unread.  Rows that were touched lose placeholder boxes at the
    end.  A correction of an unknown row, one that needs an index and has none, and a replacement
    beyond the end of its row fail the job; ``refused_corrections`` lists those that need no fold to be seen.
    """
    columns = [c for c in C.ALIGNED if c in df.columns]
    fields = ["action", "concept", "box", "concept_index", "new_concept", "new_box", "new_boxes"]
    edits = corrections.groupBy(F.col("row_index").alias("row_id")).agg(
        F.sort_array(F.collect_list(F.struct(order, *fields))).alias("edits")
    )
    # Unknown rows come out of the outer join without aligned columns.
    known = df.select("row_id").distinct().withColumn("_known", F.lit(True))
    checked = groups.join_on(edits, known, ["row_id"], "left")
    unknown = F.raise_error(F.concat(F.lit("correction of an unknown row: "), F.coalesce(F.col("row_id").cast("string"), F.lit("NULL"))))
    checked = checked.withColumn("edits", F.when(F.col("_known"), F.col("edits")).otherwise(unknown)).drop("_known")
    joined = groups.join_on(df, checked, ["row_id"], "left")
    width = F.greatest(*[F.size(C.aligned_parts(c, F.col(c))) for c in columns])
    folded = F.aggregate("edits", C.aligned_entries(columns, width), lambda entries, e: _apply(columns, entries, e))
    real = F.filter(folded, lambda e: F.replace(F.coalesce(e["boxes"], F.lit("")), F.lit(" "), F.lit("")) != C.ZERO_BOX)
    state = joined.withColumn("_entries", F.when(F.col("edits").isNotNull(), real))
    texts = {}
    for c in columns:
        # A column may be shorter than others: what it lacks stays lacking, and added entries follow its last one.
        values = F.filter(F.transform("_entries", C.field(c)), lambda v: v.isNotNull())
        texts[c] = F.when(F.col("edits").isNotNull(), C.aligned_text(c, values)).otherwise(F.col(c))
    return state.withColumns(texts).drop("_entries", "edits")


def refused_corrections(df: DataFrame, corrections: DataFrame) -> DataFrame:
    """Corrections that ``corrected_rows`` refuses whatever comes before them, with the reason."""
    known = df.select(F.col("row_id").alias("row_index")).distinct().withColumn("_known", F.lit(True))
    marked = groups.join_on(corrections, known, ["row_index"], "left")
    needed = F.col("action").isin("remove", "replace", "replace_multi")
    reason = (
        F.when(F.col("_known").isNull(), "unknown row")
        .when(needed & F.col("concept_index").isNull(), "no index")
        .when((F.col("action") == "replace") & (F.col("concept_index") < 0), "negative index")
    )
    return marked.withColumn("reason", reason).filter(F.col("reason").isNotNull()).drop("_known")


def _apply(columns: list[str], entries: Column, edit: Column) -> Column:
    action = edit["action"]
    given = edit["concept_index"]
    # Removing beyond the end removes nothing; a replacement needs an entry to replace.
    usable = given.isNotNull() & ((action != "replace") | ((given >= 0) & (given < F.size(entries))))
    refused = F.raise_error(
        F.concat(F.lit("correction without a usable index: "), action, F.lit(" "), F.coalesce(given.cast("string"), F.lit("NULL")))
    )
    at = F.when(usable, given).otherwise(refused.cast("int"))
    without = F.filter(entries, lambda e, i: i != at)
    new_concept = F.coalesce(edit["new_concept"], F.lit(""))

    def replaced(e: Column) -> Column:
        values = {c: e[c] for c in columns}
        values["concepts"] = F.when(new_concept != "", new_concept).otherwise(e["concepts"])
        values["boxes"] = F.when(F.coalesce(F.size(edit["new_box"]), F.lit(0)) > 0, _int_box(edit["new_box"])).otherwise(e["boxes"])
        values.update({k: F.lit(v) for k, v in REPLACED.items()})
        return _same_entry(columns, values)

    def filled(e: Column) -> Column:
        """Blanks where a column that the replacement marks was too short before it."""
        return _same_entry(columns, {c: F.coalesce(e[c], F.lit("")) if c in REPLACED else e[c] for c in columns})

    several = F.transform(
        F.coalesce(edit["new_boxes"], F.array().cast("array<struct<concept:string,box:array<int>>>")),
        lambda n: _added(columns, n["concept"], n["box"]),
    )
    swapped = F.transform(entries, lambda e, i: F.when(i == at, replaced(e)).when(i < at, filled(e)).otherwise(e))
    return (
        F.when(action == "add", F.concat(entries, F.array(_added(columns, edit["concept"], edit["box"]))))
        .when(action == "remove", without)
        .when(action == "replace", swapped)
        .when(action == "replace_multi", F.concat(without, several))
        .otherwise(entries)
    )


def _same_entry(columns: list[str], values: dict[str, Column]) -> Column:
    return F.struct(*[values[c].cast("string").alias(c) for c in columns])


def exported_corrections(removed: DataFrame, drawn: DataFrame) -> DataFrame:
    """Edits as a correction list: removals from the highest index down, then additions.

    ``removed``: row_index, concept_index; ``drawn``: row_index, draw_no,
    concept, box.  Boxes under five pixels on a side are slips and ignored.
    """
    schema = ["row_index", "action", "concept", "box", "concept_index", "position"]
    gone = removed.select(
        "row_index",
        F.lit("remove").alias("action"),
        F.lit(None).cast("string").alias("concept"),
        F.lit(None).cast("array<int>").alias("box"),
        "concept_index",
        (-F.col("concept_index")).cast("long").alias("position"),
    )
    b = [F.get("box", F.lit(i)) for i in range(4)]
    large = (b[2] - b[0] >= SMALLEST_DRAWN) & (b[3] - b[1] >= SMALLEST_DRAWN)
    added = drawn.filter(large).select(
        "row_index",
        F.lit("add").alias("action"),
        "concept",
        "box",
        F.lit(None).cast("int").alias("concept_index"),
        (F.col("draw_no").cast("long") + 1).alias("position"),
    )
    return gone.select(*schema).unionByName(added.select(*schema))
