"""Publish step: compact, clean, verify, measure and split image rows.

A row already holds its boxes, so compacting, cleaning and verifying are
row-local array expressions: no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from boxloom.functions import codecs as C
from boxloom.functions.codecs import let
from boxloom.operators import groups
from boxloom.session import checkpointed

# Classes of a published dataset, in report order.
CLASSES = [
    "shoe", "top", "product_item", "bottom", "outerwear", "bag", "dress", "eyewear",
    "ethnic_wear", "headwear", "bracelet", "watch", "skirt", "earring", "jewelry_product",
    "scarf", "necklace", "belt", "gloves", "tie", "underwear_bottom", "swimwear",
    "underwear_top", "ring", "onepiece", "hair_accessories", "head_jewelry", "anklet",
    "innertop",
]
# Columns of a published dataset.
DATASET = ["im_url", "im_name", "im_description", "labels", "boxes", "concepts"]
# Issue types whose boxes are taken out.
PRECISION_ISSUES = ["precision", "fp_high_conf_incorrect"]
# Split shares.
SPLITS = {"train": 0.8, "val": 0.1, "test": 0.1}


def _aligned_in(df: DataFrame) -> list[str]:
    return [c for c in C.ALIGNED if c in df.columns]


def _with_texts(df: DataFrame, texts: dict[str, Column], when: Column | None = None) -> DataFrame:
    return df.withColumns(
        {c: (t if when is None else F.when(when, t).otherwise(F.col(c))) for c, t in texts.items()}
    )


def compacted(df: DataFrame) -> DataFrame:
    """Drop entries without a concept from all aligned columns; counts them in ``compacted``."""
    columns = _aligned_in(df)
    names = C.comma_list(F.col("concepts"))
    blank = F.size(F.filter(names, lambda c: F.trim(c) == ""))
    entries = F.filter(C.aligned_entries(columns, F.size(names)), lambda e: F.trim(e["concepts"]) != "")
    staged = df.withColumn("compacted", blank).withColumn("_entries", entries)
    texts = C.entries_text(columns, F.col("_entries"))
    return _with_texts(staged, texts, F.col("compacted") > 0).drop("_entries")


def first_entries(entries: Column) -> Column:
    """First entry of every ``key``, in the order of the array.

    Places are sorted by key, so a row of very many entries costs little more than sorting it.
    """

    def places(by_key: Column) -> Column:
        firsts = F.filter(by_key, lambda x, j: (j == 0) | (F.get(by_key, j - 1)["key"] != x["key"]))
        return F.array_sort(F.transform(firsts, lambda x: x["at"]))

    def picked(whole: Column) -> Column:
        by_key = F.array_sort(F.transform(whole, lambda x, i: F.struct(x["key"].alias("key"), i.alias("at"))))
        return let(let(by_key, places), lambda at: F.transform(at, lambda i: F.get(whole, i)))

    return let(entries, picked)


def cleaned(df: DataFrame) -> DataFrame:
    """Compact rows, then drop placeholder and repeated boxes; every row gets a ``status``.

    Status is kept, empty (no box left) or single_other (only one box, of
    class ``other``).  Counters: compacted, zero_boxes, duplicate_boxes.
    """
    base = compacted(df)
    columns = _aligned_in(base)
    found = C.box_texts(F.col("boxes"))
    entries = F.transform(
        C.aligned_entries(columns, F.size(found)),
        lambda e: F.struct(
            e.alias("e"),
            F.struct(F.replace(e["boxes"], F.lit(" "), F.lit("")).alias("b"), F.coalesce(e["concepts"], F.lit("")).alias("c")).alias("key"),
        ),
    )
    base = base.withColumn("_all", entries)
    real = F.filter("_all", lambda x: x["key"]["b"] != C.ZERO_BOX)
    base = base.withColumn("zero_boxes", F.size("_all") - F.size(real)).withColumn("_all", real)
    base = base.withColumn("_kept", first_entries(F.col("_all")))
    base = base.withColumn("duplicate_boxes", F.size("_all") - F.size("_kept"))
    lone = (F.size("_kept") == 1) & (F.get("_kept", F.lit(0))["key"]["c"] == "other")
    base = base.withColumn(
        "status", F.when(F.size("_kept") == 0, "empty").when(lone, "single_other").otherwise("kept")
    )
    texts = C.entries_text(columns, F.transform("_kept", lambda x: x["e"]), missing="")
    out = _with_texts(base, texts).drop("_all", "_kept")
    # Out of a generator, so a filter on the result does not copy the parsing into itself.
    return out.select(F.inline(F.array(F.struct(*out.columns))))


def cleaning_stats(clean: DataFrame) -> DataFrame:
    """Totals over the rows of ``cleaned``."""

    def rows(status: str) -> Column:
        return F.coalesce(F.sum((F.col("status") == status).cast("long")), F.lit(0))

    return clean.agg(
        F.count(F.lit(1)).alias("input_rows"),
        *[F.coalesce(F.sum(F.col(c).cast("long")), F.lit(0)).alias(c) for c in ("compacted", "zero_boxes", "duplicate_boxes")],
        rows("empty").alias("empty_rows"),
        rows("single_other").alias("single_other_rows"),
        rows("kept").alias("kept_rows"),
    )


def published_rows(clean: DataFrame) -> DataFrame:
    """Dataset columns of the kept rows; coordinates clipped at zero, description blank."""
    kept = clean.filter(F.col("status") == "kept")
    for c in DATASET:
        if c not in kept.columns:
            kept = kept.withColumn(c, F.lit(""))
    kept = kept.withColumn("im_description", F.lit("")).withColumn("boxes", C.clipped_boxes(F.col("boxes")))
    extra = [c for c in ("row_id",) if c in clean.columns]
    return kept.select(*extra, *DATASET)


def violations(df: DataFrame, row_id: str = "row_id") -> DataFrame:
    """(row_id, rule, count) of every broken dataset rule."""
    boxes = C.box_texts(F.col("boxes"))
    numbers = F.transform(
        boxes,
        lambda b: F.transform(F.regexp_extract_all(b, F.lit(r"-?\d+"), F.lit(0)), lambda v: v.cast("long")),
    )
    raw = F.transform(F.split(F.coalesce("concepts", F.lit("")), ","), lambda c: F.trim(c))
    staged = df.select(row_id, boxes.alias("b"), numbers.alias("n"), raw.alias("raw"))
    staged = staged.withColumn("c", F.filter("raw", lambda c: c != ""))
    # The i-th box goes with the i-th non-blank concept; one text each, as distinct texts are found by their hash.
    def key(box: Column, concept: Column) -> Column:
        plain = F.replace(box, F.lit(" "), F.lit(""))
        return F.concat(F.length(plain).cast("string"), F.lit(":"), plain, F.coalesce(concept, F.lit("")))

    keys = let(F.col("c"), lambda c: F.transform("b", lambda b, i: key(b, F.get(c, i))))
    zero = F.array(*[F.lit(0).cast("long") for _ in range(4)])
    staged = staged.withColumn("k", keys)
    rules = {
        "negative_coordinate": F.size(F.filter("n", lambda v: F.exists(v, lambda x: x < 0))),
        "zero_box": F.size(F.filter("n", lambda v: v == zero)),
        "duplicate_box": F.size("k") - F.size(F.array_distinct("k")),
        "no_box": (F.size("b") == 0).cast("int"),
        "single_other": (
            (F.size("b") == 1) & (F.size("c") == 1) & (F.coalesce(F.get("c", F.lit(0)), F.lit("")) == "other")
        ).cast("int"),
        "blank_concept": F.size(F.filter("raw", lambda c: c == "")),
        "count_mismatch": (F.size("b") != F.size("c")).cast("int"),
    }
    listed = F.array(*[F.struct(F.lit(k).alias("rule"), v.cast("long").alias("count")) for k, v in rules.items()])
    return (
        staged.select(row_id, F.explode(listed).alias("v"))
        .select(row_id, "v.rule", "v.count")
        .filter(F.col("count") > 0)
    )


def verified(df: DataFrame, row_id: str = "row_id") -> DataFrame:
    """``df`` itself; raises when any dataset rule is broken."""
    broken = violations(df, row_id).groupBy("rule").agg(F.count(F.lit(1)).alias("rows")).collect()
    if broken:
        raise ValueError("dataset rules broken: " + ", ".join(f"{r['rule']} in {r['rows']} rows" for r in broken))
    return df


def box_counts(df: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Boxes and images per concept, any class.

    A row lists its own concepts, so its contribution to the image count is
    one per distinct concept; both sums combine before the shuffle.
    """
    names = C.tag_list(F.col("concepts"))
    per_row = F.transform(
        F.array_distinct(names),
        lambda c: F.struct(c.alias("concept"), F.size(F.filter(names, lambda x: x == c)).alias("n")),
    )
    return (
        df.select(F.explode(per_row).alias("c"))
        .groupBy(F.col("c.concept").alias("concept"))
        .agg(F.sum(F.col("c.n").cast("long")).alias("boxes"), F.count(F.lit(1)).alias("images"))
    )


def distribution(df: DataFrame, classes: list[str] | None = None) -> DataFrame:
    """Boxes and images of every listed class, zero where there are none."""
    classes = classes or CLASSES
    spark = df.sparkSession
    listed = spark.createDataFrame([(i, c) for i, c in enumerate(classes)], "place int, concept string")
    return listed.join(box_counts(df), "concept", "left").select(
        "place", "concept", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("boxes", "images")]
    )


def unlisted_classes(df: DataFrame, classes: list[str] | None = None) -> DataFrame:
    """Concepts that are not in the class list."""
    return box_counts(df).filter(~F.col("concept").isin(classes or CLASSES))


def prevalence(df: DataFrame, by: str | None = None) -> DataFrame:
    """Share of rows that carry each concept, overall or per value of ``by``.

    With ``by`` a concept missing from a part has no row there.
    """
    keys = [by] if by else []
    # Every row also emits a NULL concept; its count is the number of rows.
    marked = F.concat(F.array(F.lit(None).cast("string")), C.distinct_concepts(F.col("concepts")))
    exploded = df.select(*keys, F.explode(marked).alias("concept"))
    support = exploded.groupBy(*keys, "concept").agg(F.count(F.lit(1)).alias("support"))
    part = W.partitionBy(by) if by else W.partitionBy(F.lit(0))
    rows = F.max(F.when(F.col("concept").isNull(), F.col("support"))).over(part)
    shared = support.withColumn("share", F.col("support") / rows).filter(F.col("concept").isNotNull())
    return shared.select(*keys, "concept", "support", "share")


def rare_concepts(df: DataFrame, below: int = 3) -> DataFrame:
    return prevalence(df).filter(F.col("support") < below)


def split_rows(df: DataFrame, row_id: str = "row_id", seed: int = 42) -> DataFrame:
    """Assign ``split`` so that every concept is spread 80/10/10.

    Each row belongs to the stratum of its rarest concept.  Strata are ranked
    by seeded hash and dealt out in blocks of ten: eight rows train, one
    validation, one test.  One concept may cover most rows, so ranks are
    computed in hash buckets, not in one sort per concept.  A per-stratum
    offset keeps small strata from all starting with the same split.
    """
    exploded = df.select(row_id, F.explode_outer(C.distinct_concepts(F.col("concepts"))).alias("concept"))
    # One row per concept.  Written first, so the join knows its size.
    support = checkpointed(exploded.groupBy("concept").agg(F.count(F.lit(1)).alias("s")))
    weighed = groups.join_on(exploded, support, ["concept"], "left")
    strata = weighed.groupBy(row_id).agg(
        F.min(F.struct(F.coalesce("s", F.lit(0)).alias("s"), F.coalesce("concept", F.lit("")).alias("c"))).alias("m")
    )
    hashed = strata.select(row_id, F.col("m.c").alias("stratum"), groups.seeded_hash(F.col(row_id), seed).alias("_h"))
    ranked = groups.hashed_rank(checkpointed(hashed), ["stratum"], "_h", row_id, "_n")
    offset = F.conv(F.substring(F.md5(F.col("stratum").cast("binary")), 1, 4), 16, 10).cast("int")
    slot = F.pmod(F.col("_n") - 1 + offset, F.lit(10))
    split = F.when(slot < 8, "train").when(slot == 8, "val").otherwise("test")
    return groups.join_on(df, ranked.select(row_id, split.alias("split")), [row_id])


def split_shares(df: DataFrame) -> DataFrame:
    counts = df.groupBy("split").agg(F.count(F.lit(1)).alias("rows"))
    total = F.sum("rows").over(W.partitionBy(F.lit(0)))
    return counts.select("split", "rows", (F.col("rows") / total * 100).alias("percent"))


def split_drift(df: DataFrame) -> DataFrame:
    """Prevalence per concept overall and per split, with absolute drifts and their maximum."""
    full = prevalence(df).select("concept", F.col("share").alias("full"))
    parts = (
        prevalence(df, "split").groupBy("concept").pivot("split", list(SPLITS)).agg(F.first("share"))
    )
    joined = full.join(parts, "concept")
    joined = joined.select("concept", "full", *[F.coalesce(s, F.lit(0.0)).alias(s) for s in SPLITS])
    drifts = [F.abs(F.col(s) - F.col("full")).alias(f"{s}_drift") for s in SPLITS]
    return joined.select("*", *drifts).withColumn(
        "max_drift", F.greatest(*[F.col(f"{s}_drift") for s in SPLITS])
    )


def without_precision_issues(df: DataFrame) -> DataFrame:
    """Remove boxes flagged as precision issues from all aligned columns.

    Short columns are padded with blanks first.  Rows without concepts or
    issue types stay as they are.
    """
    columns = _aligned_in(df)
    plain = [F.transform(C.box_texts(F.col(c)) if c == "boxes" else C.comma_list(F.col(c)), lambda v: F.trim(v)).alias(c) for c in columns]
    staged = df.withColumn("_p", F.struct(*plain))
    n = F.size(F.col("_p.concepts"))
    entries = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.struct(*[F.coalesce(F.get(F.col("_p")[c], i), F.lit("")).alias(c) for c in columns]),
    )
    usable = (n > 0) & (F.size(F.col("_p.issue_types")) > 0)
    kept = F.filter(entries, lambda e: ~e["issue_types"].isin(PRECISION_ISSUES))
    staged = staged.withColumn("_k", F.when(usable, kept))
    texts = {c: F.array_join(F.transform("_k", C.field(c)), ",") for c in columns}
    return _with_texts(staged, texts, usable).drop("_p", "_k")


def box_editor_rows(df: DataFrame) -> DataFrame:
    """Input of the box editor: real boxes with concepts, and the classes still missing a box."""
    zipped = let(
        F.struct(
            F.transform(C.comma_list(F.col("concepts")), lambda c: F.trim(c)).alias("c"),
            F.transform(C.box_texts(F.col("boxes")), C.box_numbers).alias("b"),
            F.transform(C.comma_list(F.col("issue_types")), lambda c: F.trim(c)).alias("t"),
        ),
        lambda p: F.slice(
            F.arrays_zip(p["c"], p["b"], p["t"]), 1, F.least(F.size(p["c"]), F.size(p["b"]), F.size(p["t"]))
        ),
    )
    staged = df.withColumn("_z", zipped)
    pairs = let(
        F.struct(
            F.transform(C.comma_list(F.col("concepts")), lambda c: F.trim(c)).alias("c"),
            F.transform(C.comma_list(F.col("issue_types")), lambda c: F.trim(c)).alias("t"),
        ),
        lambda p: F.filter(p["c"], lambda c, i: F.get(p["t"], i) == "recall"),
    )
    zero = F.array(*[F.lit(0.0) for _ in range(4)])
    real = F.filter("_z", lambda z: F.coalesce(z["b"] != zero, F.lit(True)))
    return staged.select(
        "row_id",
        "im_name",
        "im_url",
        F.transform(real, lambda z: z["c"]).alias("concepts"),
        F.transform(real, lambda z: z["b"].cast("array<int>")).alias("boxes"),
        F.array_distinct(pairs).alias("missing_concepts"),
    ).withColumn("filter_reasons", F.when(F.size("missing_concepts") > 0, C.strings("recall")).otherwise(C.strings()))


def viewer_rows(df: DataFrame) -> DataFrame:
    """Concept and box pairs per row; pairs without a real box are left out."""
    zero = F.array(*[F.lit(0.0) for _ in range(4)])
    pairs = let(
        F.struct(C.tag_list(F.col("concepts")).alias("c"), F.transform(C.box_texts(F.col("boxes")), C.box_numbers).alias("b")),
        lambda p: F.filter(
            F.transform(p["c"], lambda c, i: F.struct(c.alias("concept"), F.get(p["b"], i).alias("box"))),
            lambda x: x["box"].isNotNull() & (x["box"] != zero),
        ),
    )
    return df.select(
        "row_id", "im_id", "im_url", "im_name",
        F.transform(pairs, lambda x: x.withField("box", x["box"].cast("array<int>"))).alias("annotations"),
    )


# --- ground truth -----------------------------------------------------------


def ground_truth(df: DataFrame, order: str = "row_id", bare_boxes_only: bool = False) -> DataFrame:
    """Long ground truth: one row per distinct (product, image, box, concept).

    The product key is im_name, else im_id, else ``unknown_<n>`` counted in
    input order.  Boxes and concepts are cut to the shorter list.  The
    bracketed form is read too; ``bare_boxes_only`` limits it to one bare box.
    """
    usable = df.filter(~F.trim(F.coalesce("im_url", F.lit(""))).isin("", "nan"))

    def filled(c: str) -> Column:
        text = F.trim(F.coalesce(F.col(c), F.lit("")))
        return F.when(~text.isin("", "nan"), text)

    keyed = usable.withColumn("product", F.coalesce(filled("im_name"), filled("im_id")))
    nameless = keyed.filter(F.col("product").isNull())
    nameless = checkpointed(nameless.withColumn("_all", F.lit(0)))
    counted = groups.ordered_rank(nameless, ["_all"], order, "_n").drop("_all")
    counted = counted.withColumn("product", F.concat(F.lit("unknown_"), (F.col("_n") - 1).cast("string"))).drop("_n")
    named = keyed.filter(F.col("product").isNotNull()).unionByName(counted)
    if bare_boxes_only:
        named = named.filter(~F.col("boxes").contains("["))
    pairs = C.existing_detections(F.col("boxes"), F.col("concepts"))
    long = named.select(
        "product", F.trim("im_url").alias("im_url"), F.col(order).alias("row"), F.posexplode(pairs).alias("at", "d")
    )
    first = F.min(F.struct("row", "at")).alias("first")
    return (
        long.groupBy("product", "im_url", F.col("d.box").alias("box"), F.col("d.name").alias("concept"))
        .agg(first)
        .select("product", "im_url", "box", "concept", F.col("first.row").alias("row"), F.col("first.at").alias("at"))
    )


def nested_ground_truth(df: DataFrame, cell: str = "search_gt_outfits", renamed: dict[str, str] | None = None) -> DataFrame:
    """Ground truth from a cell that lists items with im_url, ``x1,y1,x2,y2`` text and class.

    Items without image or readable box are dropped; old class names are renamed.
    """
    items = F.from_json(F.col(cell), "array<struct<im_url:string,box:string,box_concept:string>>")
    long = df.select("product", F.explode(items).alias("i")).select(
        "product",
        F.col("i.im_url").alias("im_url"),
        C.box_numbers(F.col("i.box")).alias("box"),
        current_class(F.coalesce("i.box_concept", F.lit("")), renamed or {}).alias("concept"),
    )
    return long.filter((F.coalesce("im_url", F.lit("")) != "") & F.col("box").isNotNull())


def current_class(name: Column, renamed: dict[str, str]) -> Column:
    out = name
    for old, new in renamed.items():
        out = F.when(name == old, new).otherwise(out)
    return out


def only_products(df: DataFrame, products: DataFrame) -> DataFrame:
    """Rows of the listed products."""
    return groups.join_on(df, products.select("product").distinct(), ["product"], "left_semi")


def product_json(df: DataFrame) -> DataFrame:
    """One JSON item list per product, in input order."""
    from boxloom.operators.rollup import gathered

    placed = df.withColumn("_order", F.shiftleft(F.col("row").cast("long"), 20) + F.col("at"))
    element = F.struct("im_url", F.col("concept").alias("box_concept"), "box")
    listed = gathered(placed, ["product"], "_order", element)
    return listed.select("product", F.to_json("items").alias("items"))


def product_images(df: DataFrame, image: str = "main_image_url", additional: str = "additional_image_url") -> DataFrame:
    """Distinct (product, image) from the main image and a comma list of further ones."""
    urls = F.concat(F.array(F.coalesce(F.trim(image), F.lit(""))), C.tag_list(F.col(additional)))
    exploded = df.select("product", F.posexplode(F.filter(urls, lambda u: (u != "") & (u != "nan"))).alias("at", "image"))
    return exploded.groupBy("product", "image").agg(F.min("at").alias("at"))
