"""Product catalogs: column choice, image expansion, rules, content hashes."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from boxloom.functions import codecs as C
from boxloom.functions import text as T
from boxloom.operators import groups

# Accepted names of the image column, in order of preference.
IMAGE_COLUMNS = ["im_url", "image_url", "url", "image", "original_url"]
EXCLUSION_URL_COLUMNS = ["im_url", "original_url", "image_url", "url"]
# Accepted names of product name and description, in order of preference.
NAME_COLUMNS = ["title", "im_name", "name", "product_name", "product_title"]
DESCRIPTION_COLUMNS = ["description", "im_description", "product_description", "short_description"]
HUMAN_TAG = "image_human:model"
DETAIL_TAG = "image_detail:detail"
REPEATED = "deduplicated"


def image_column(df: DataFrame, candidates: Iterable[str] = IMAGE_COLUMNS) -> str:
    for name in candidates:
        if name in df.columns:
            return name
    raise ValueError(f"no image column among {df.columns}")


def with_image_key(df: DataFrame) -> DataFrame:
    """Add ``im_url`` from the image column and, unless present, ``im_id``."""
    out = df.withColumn("im_url", F.trim(F.col(image_column(df)).cast("string")))
    return out if "im_id" in out.columns else out.withColumn("im_id", T.image_id(F.col("im_url")))


def first_filled_columns(df: DataFrame, wanted: dict[str, list[str]]) -> DataFrame:
    """For each output name take the first candidate column that is filled anywhere in the table.

    The choice is per column, not per row; one aggregate answers it for all
    candidates.  Without any filled candidate the column is blank.
    """
    present = sorted({c for names in wanted.values() for c in names if c in df.columns})
    filled: dict[str, bool] = {}
    if present:
        # `name` may be an output as well, so answers are read by place.
        row = df.agg(*[F.max(F.trim(F.col(c).cast("string")) != "") for c in present]).first()
        filled = {c: bool(row[i]) for i, c in enumerate(present)}
    chosen = {out: next((c for c in names if filled.get(c)), None) for out, names in wanted.items()}
    return df.withColumns(
        {out: F.coalesce(F.col(c).cast("string"), F.lit("")) if c else F.lit("") for out, c in chosen.items()}
    )


def text_or_blank(df: DataFrame, column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("")) if column in df.columns else F.lit("")


def expanded_images(
    df: DataFrame,
    image: str,
    additional: str | None = None,
    per_product: int = 0,
    main_must_be_http: bool = False,
) -> DataFrame:
    """One row per product and distinct http(s) image, main image first.

    The list lives in the product row, so no shuffle is needed.
    """
    main = F.filter(F.array(F.trim(F.coalesce(F.col(image).cast("string"), F.lit("")))), C.is_http)
    urls = main
    if additional and additional in df.columns:
        further = F.filter(F.transform(C.list_cell(F.col(additional)), lambda u: F.trim(u)), C.is_http)
        urls = F.concat(main, further)
    urls = F.array_distinct(urls)
    if per_product > 0:
        urls = F.slice(urls, 1, per_product)
    out = df.filter(F.size(main) > 0) if main_must_be_http else df
    return out.drop("im_url").select("*", F.posexplode(urls).alias("image_no", "im_url"))


def catalog_pool(
    df: DataFrame,
    catalog: str,
    image: str,
    additional: str | None = None,
    category: str = "category",
    terms: list[str] | None = None,
    per_product: int = 0,
    order: str = "pos",
) -> DataFrame:
    """Image pool of one catalog: category filter, expansion, one row per URL, stable ids.

    ``order`` is a unique numeric row number of the input.
    """
    wanted = with_any_term(df, category, terms or []) if category in df.columns else df
    expanded = expanded_images(wanted, image, additional, per_product, main_must_be_http=True)
    placed = expanded.withColumn("_at", F.struct(order, "image_no"))
    unique = groups.first_per_key(placed, ["im_url"], ["_at"])
    out = unique.select(
        F.lit(catalog).alias("catalog_name"),
        text_or_blank(unique, "product_id").alias("product_id"),
        text_or_blank(unique, category).alias("category"),
        "im_url",
        text_or_blank(unique, "title").alias("im_name"),
        text_or_blank(unique, "description").alias("im_description"),
    )
    return out.withColumn(
        "im_id", T.catalog_image_id(F.col("catalog_name"), F.col("product_id"), F.col("im_url"))
    )


def combined_catalogs(df: DataFrame, columns: list[str], order: str) -> DataFrame:
    """Chosen columns of several catalogs, first row per image id."""
    return groups.first_per_key(df.select(*columns, order), ["im_id"], [order])


# --- filters ----------------------------------------------------------------


def contains_any(value: Column, terms: list[str]) -> Column:
    """Case-insensitive substring test against any term."""
    lowered = F.lower(F.coalesce(value.cast("string"), F.lit("")))
    tests = [lowered.contains(t.strip().lower()) for t in terms if t.strip()]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def with_any_term(df: DataFrame, column: str, terms: list[str]) -> DataFrame:
    """Keep rows whose column contains a term; no terms or no such column: keep all."""
    if not [t for t in terms if t.strip()] or column not in df.columns:
        return df
    return df.filter(contains_any(F.col(column), terms))


def without_terms(df: DataFrame, column: str, terms: list[str]) -> DataFrame:
    return df.filter(~contains_any(F.col(column), terms))


def has_tag(tags: Column, tag: str) -> Column:
    return F.array_contains(C.tag_list(tags), tag)


def has_relevant_class(classes: Column, relevant: list[str]) -> Column:
    parsed = F.from_json(classes, "array<string>")
    return F.coalesce(F.arrays_overlap(parsed, C.strings(*relevant)), F.lit(False))


def detail_view_flags(df: DataFrame, terms: list[str], enabled: bool = True) -> DataFrame:
    """Add is_detail_view, detail_allowed_category and passes_detail_filter.

    Detail images pass only in the listed categories.
    """
    if not enabled:
        flags = (F.lit(False), F.lit(True))
    else:
        if not [t for t in terms if t.strip()]:
            raise ValueError("the detail view filter needs category terms")
        flags = (has_tag(F.col("tags"), DETAIL_TAG), contains_any(F.col("category"), terms))
    out = df.withColumn("is_detail_view", flags[0]).withColumn("detail_allowed_category", flags[1])
    return out.withColumn("passes_detail_filter", ~F.col("is_detail_view") | F.col("detail_allowed_category"))


@dataclass(frozen=True)
class Rule:
    name: str
    category_in: list[str] = field(default_factory=list)
    gender_equals: str = ""


def matched_rules(df: DataFrame, rules: list[Rule], category: str, gender: str | None = None) -> DataFrame:
    """Rows that match a rule; per image only rows of the earliest matching rule stay.

    Adds ``matched_rule`` and ``category_clean``.  The rules come from a
    configuration file, so testing them is a projection.  The winner per image
    is a minimum combined before the shuffle; the join back carries the rule
    number in its key.
    """
    norm = F.lower(F.trim(T.primary_category(F.col(category))))
    sex = F.trim(F.col(gender)) if gender and gender in df.columns else F.lit("")
    matches = []
    for i, rule in enumerate(rules):
        terms = [c.strip().lower() for c in rule.category_in]
        if not terms:
            continue
        test = norm.isin(terms)
        if rule.gender_equals.strip():
            test = test & (sex == rule.gender_equals.strip())
        matches.append(F.when(test, F.lit(i)))
    if not matches:
        return df.limit(0).withColumn("matched_rule", F.lit("")).withColumn("category_clean", F.lit(""))
    numbered = df.withColumn("_rule", F.least(*matches) if len(matches) > 1 else matches[0])
    numbered = numbered.withColumn("_norm", norm).filter("_rule is not null")
    winner = numbered.groupBy("im_url").agg(F.min("_rule").alias("_rule"))
    names = F.element_at(C.strings(*[r.name for r in rules]), F.col("_rule") + 1)
    return (
        groups.join_on(numbered, winner, ["im_url", "_rule"], "left_semi")
        .withColumn("matched_rule", names)
        .withColumn("category_clean", T.title_case(F.col("_norm")))
        .drop("_rule", "_norm")
    )


def pool_size(df: DataFrame, category: str = "category_clean") -> DataFrame:
    return df.groupBy(F.col(category).alias("category")).agg(F.count("im_url").alias("pool_size"))


# Words of an object filter that mean "no filter".
NO_FILTER = ["all", "other", "wholeimage"]
# Classes that a single requested class brings along.
EXPANSIONS = {
    "bottom": ["ethnic_wear", "skirt"],
    "dress": ["ethnic_wear", "outerwear", "skirt", "top"],
    "ethnic_wear": ["dress", "skirt", "top"],
    "outerwear": ["dress", "top"],
    "skirt": ["bottom", "dress", "ethnic_wear"],
    "top": ["dress", "ethnic_wear", "outerwear"],
}


def wanted_classes(expression: Column, known: list[str], expand: bool = True) -> Column:
    """Classes an object filter like ``top;dress`` lets through; NULL means all.

    Unknown words are ignored.  ``all``/``wholeimage`` or nothing known means
    no filter.  A single known class brings its expansions along.
    """
    words = F.filter(
        F.transform(F.split(F.coalesce(expression, F.lit("")), ";"), lambda w: F.trim(w)), lambda w: w != ""
    )
    # A stop word ends the expression only if it comes before the end; everything is then allowed.
    stop = F.exists(words, lambda w: w.isin("all", "wholeimage"))
    valid = F.filter(words, lambda w: w.isin([*known, "other"]))
    table = F.create_map(
        *[x for k, v in EXPANSIONS.items() for x in (F.lit(k), C.strings(*[n for n in v if n in known]))]
    )
    named = F.filter(valid, lambda w: w.isin(known))
    widened = named
    if expand:
        single = F.get(valid, F.lit(0))
        widened = F.when(
            F.size(valid) == 1, F.concat(named, F.coalesce(F.try_element_at(table, single), C.strings()))
        ).otherwise(named)
    open_filter = stop | (F.size(named) == 0)
    return F.when(~open_filter, F.array_distinct(widened))


def output_label(expression: Column) -> Column:
    """Label for unnamed boxes: the part after ``/``, else the only requested class, else ''."""
    text = F.coalesce(expression, F.lit(""))
    words = F.filter(F.split(F.regexp_extract(text, "^[^/]*", 0), ";"), lambda w: F.trim(w) != "")
    after = F.regexp_extract(text, "/(.*)$", 1)
    label = F.when(after != "", after).when(F.size(words) == 1, F.trim(F.get(words, F.lit(0)))).otherwise("")
    return F.when(label.isin(NO_FILTER), "").otherwise(label)


def class_thresholds(df: DataFrame, thresholds: DataFrame, default: float) -> DataFrame:
    """Detections at or above the threshold of their class (``default`` when not listed)."""
    listed = thresholds.select("name", F.col("threshold").cast("double").alias("_t"))
    kept = groups.join_on(df, listed, ["name"], "left").filter(F.col("score") >= F.coalesce("_t", F.lit(default)))
    return kept.drop("_t")


def canonical_classes(df: DataFrame, canonical: dict[str, str], requested: list[str]) -> DataFrame:
    """Map labels and aliases (any case, blank or underscore) to class names; keep requested ones."""
    plain = {k.strip().lower().replace("_", " "): v for k, v in canonical.items()}
    plain.update({c.strip().lower().replace("_", " "): c for c in requested})
    key = T.class_key(F.col("name"))
    mapped = F.coalesce(
        F.try_element_at(F.create_map(*[F.lit(x) for kv in plain.items() for x in kv]), key), F.lower(F.trim("name"))
    )
    return df.withColumn("name", mapped).filter(F.col("name").isin(requested))


# --- content hashes ---------------------------------------------------------


def content_deduplicated(df: DataFrame, hashes: DataFrame, order: str = "pos", url: str = "im_url") -> DataFrame:
    """First row per image content; rows whose content could not be read are dropped.

    ``hashes`` maps each distinct URL to ``image_content_hash``.
    """
    joined = groups.join_on(df, hashes.select(url, "image_content_hash"), [url])
    readable = joined.filter(F.coalesce("image_content_hash", F.lit("")) != "")
    return groups.first_per_key(readable, ["image_content_hash"], [order])


def exclusion_hashes(table: DataFrame, column: str, hashes: DataFrame | None = None) -> DataFrame:
    """Distinct content hashes of an exclusion table.

    Uses the hash column when it holds any md5; otherwise the hashes of the
    table's URL column are looked up in ``hashes`` (url, image_content_hash).
    """
    if column in table.columns:
        valid = table.filter(T.is_md5(F.col(column))).select(F.col(column).alias("image_content_hash")).distinct()
        if hashes is None or not valid.isEmpty():
            return valid
    url = next((c for c in EXCLUSION_URL_COLUMNS if c in table.columns), None)
    if url is None or hashes is None:
        return table.select(F.lit("").alias("image_content_hash")).limit(0)
    wanted = table.select(F.trim(url).alias("im_url")).filter(C.is_http(F.col("im_url"))).distinct()
    found = groups.join_on(wanted, hashes.select("im_url", "image_content_hash"), ["im_url"])
    return found.filter(F.col("image_content_hash") != "").select("image_content_hash").distinct()


def with_hash_column(table: DataFrame, column: str, hashes: DataFrame) -> DataFrame:
    """Exclusion table with the hash column filled from its URLs where they are known."""
    url = image_column(table, EXCLUSION_URL_COLUMNS)
    found = hashes.select(F.col("im_url").alias(url), F.col("image_content_hash").alias("_h"))
    old = F.col(column) if column in table.columns else F.lit("")
    return groups.join_on(table, found, [url], "left").withColumn(column, F.coalesce("_h", old)).drop("_h")


def repeated_content(
    df: DataFrame, exclusions: DataFrame | None, order: str = "pos", content: str = "image_content_hash"
) -> DataFrame:
    """Add ``repeated``: content is excluded or appeared earlier in ``order``.

    The first position per content is a combining aggregate.  It is joined
    back on (content, position), which is unique, so popular content does not
    pile up in one task; exclusions only need the first row of each content.
    """
    firsts = df.filter(F.coalesce(content, F.lit("")) != "").groupBy(content).agg(F.min(order).alias(order))
    if exclusions is not None:
        listed = exclusions.select(F.col("image_content_hash").alias(content))
        firsts = groups.join_on(firsts, listed, [content], "left_anti")
    firsts = firsts.withColumn("_new", F.lit(True))
    out = groups.join_on(df, firsts, [content, order], "left")
    unreadable = F.coalesce(content, F.lit("")) == ""
    return out.withColumn("repeated", ~unreadable & F.col("_new").isNull()).drop("_new")


def with_exclusion_tag(df: DataFrame, exclusions: DataFrame, content: str = "image_content_hash") -> DataFrame:
    """Replace the tags of excluded content by the marker ``deduplicated``.

    Exclusions are distinct; which side is broadcast is left to the runtime
    sizes, and a popular content key is split by the adaptive skew join.
    """
    listed = exclusions.select(F.col("image_content_hash").alias(content)).distinct().withColumn("_x", F.lit(True))
    joined = groups.join_on(df, listed, [content], "left")
    return joined.withColumn("tags", F.when(F.col("_x"), F.lit(REPEATED)).otherwise(F.col("tags"))).drop("_x")


def name_matches_content(df: DataFrame) -> DataFrame:
    """Audit: is the stored image name the md5 of the content?"""
    return df.withColumn("name_matches", F.md5("content") == F.col("im_name"))


# --- lookups ----------------------------------------------------------------


def with_catalog_tags(df: DataFrame, catalog: DataFrame, order: str = "pos") -> DataFrame:
    """Tags of the first catalog row of each product as ``product_tags``, and the audience."""
    firsts = groups.first_per_key(catalog.select("product_id", "tags", order), ["product_id"], [order])
    tags = firsts.select("product_id", F.col("tags").alias("product_tags"))
    return groups.join_on(df, tags, ["product_id"], "left").withColumn("gender", T.audience(F.col("product_tags")))


def distinct_urls(frames: list[DataFrame], url: str = "im_url") -> DataFrame:
    """Distinct image URLs over several tables, for one upload."""
    return reduce(lambda a, b: a.unionByName(b), [f.select(url) for f in frames]).distinct()


def with_uploaded_urls(
    df: DataFrame, mapping: DataFrame, url: str = "im_url", remove_failures: bool = True
) -> DataFrame:
    """Replace URLs by their hosted form; keeps the old URL in ``original_url``.

    ``mapping``: original_url, vis_uri, im_url.
    """
    known = mapping.select(
        F.col("original_url").alias(url), F.col("vis_uri").alias("_uri"), F.col("im_url").alias("_new")
    )
    joined = groups.join_on(df, known, [url], "left")
    out = joined.select(
        *[c for c in df.columns if c not in (url, "vis_uri", "original_url")],
        F.coalesce("_new", url).alias(url),
        F.coalesce("_uri", F.lit("")).alias("vis_uri"),
        F.col(url).alias("original_url"),
    )
    return out.filter(F.col("vis_uri") != "") if remove_failures else out


def with_signed_urls(df: DataFrame, signed: DataFrame, host: str, url: str = "im_url") -> DataFrame:
    """Signed form of foreign URLs; URLs of the host itself pass, failures and blanks keep the old URL."""
    known = signed.select(F.col("url").alias("_key"), F.col("signed_url").alias("_signed"))
    keyed = df.withColumn("_key", F.trim(url))
    joined = groups.join_on(keyed, known, ["_key"], "left")
    own = F.coalesce(F.col(url).contains(host), F.lit(False))
    new = F.when(own, F.col(url)).otherwise(F.coalesce(F.nullif(F.col("_signed"), F.lit("")), F.col(url)))
    return joined.withColumn(url, new).drop("_signed", "_key")


def with_pool_details(sample: DataFrame, pool: DataFrame, columns: list[str], order: str = "pos") -> DataFrame:
    """Further columns of a pool row with the same image URL."""
    firsts = groups.first_per_key(pool.select("im_url", *columns, order), ["im_url"], [order]).drop(order)
    return groups.join_on(sample, firsts, ["im_url"], "left")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Count per value and its share of the largest count."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    top = F.max("rows").over(W.partitionBy(F.lit(0)))
    return counts.select(column, "rows", (F.col("rows") / top).alias("share_of_top"))
