"""The data queries behind the review galleries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxloom.functions import codecs as C


def _contains(value: Column, text: str) -> Column:
    return F.lower(F.coalesce(value, F.lit(""))).contains(text)


def matching_images(
    df: DataFrame,
    class_name: str = "",
    verdict: str = "",
    search: str = "",
    hide_invalid: bool = False,
    detections: str = "detections",
) -> DataFrame:
    """Images by class, verdict (``valid_only``/``invalid_only``) and free text.

    The text is looked for in id, URL, class names and reasons.
    """
    everything = F.col(detections)
    shown = F.filter(everything, lambda d: F.coalesce(d["is_valid"], F.lit(True))) if hide_invalid else everything
    tests = []
    if class_name:
        tests.append(F.exists(shown, lambda d: F.lower(d["name"]) == class_name.lower()))
    if verdict == "valid_only":
        tests.append(F.exists(shown, lambda d: d["is_valid"]))
    elif verdict == "invalid_only":
        tests.append(F.exists(everything, lambda d: ~d["is_valid"]))
    text = search.strip().lower()
    if text:
        tests.append(
            _contains(F.col("im_id").cast("string"), text)
            | _contains(F.col("im_url"), text)
            | F.exists(everything, lambda d: _contains(d["name"], text) | _contains(d["reason"], text))
        )
    return df.filter(reduce(lambda a, b: a & b, tests, F.lit(True)))


def matching_cards(
    df: DataFrame, tags: list[str], categories: list[str], search: str, text_columns: list[str]
) -> DataFrame:
    """Cards that carry all tags, any of the categories and all search words."""
    own = C.tag_list(F.col("tags"))
    tests = [F.array_contains(own, t) for t in tags]
    if categories:
        tests.append(F.coalesce("category", F.lit("")).isin(categories))
    haystack = F.concat_ws(" ", *text_columns)
    tests += [_contains(haystack, word) for word in search.strip().lower().split()]
    return df.filter(reduce(lambda a, b: a & b, tests, F.lit(True)))


def matching_catalog_rows(df: DataFrame, catalog: str = "", search: str = "") -> DataFrame:
    """Rows of one catalog whose title, brand or category contains the text."""
    out = df.filter(F.col("catalog_name") == catalog) if catalog else df
    text = search.lower()
    if not text:
        return out
    return out.filter(reduce(lambda a, b: a | b, [_contains(F.col(c), text) for c in ("title", "brand", "category")]))


def matching_crops(df: DataFrame, classes: list[str], valid: bool = True, invalid: bool = True) -> DataFrame:
    """Verified crops of the chosen classes and verdicts."""
    verdict = F.when(F.col("is_valid"), F.lit(valid)).otherwise(F.lit(invalid))
    return df.filter(F.col("name").isin(classes) & verdict)


def crop_counts(df: DataFrame) -> DataFrame:
    """Crops, images, valid and invalid crops."""
    return df.agg(
        F.count(F.lit(1)).alias("crops"),
        F.count_distinct("im_id").alias("images"),
        F.coalesce(F.sum(F.col("is_valid").cast("long")), F.lit(0)).alias("valid"),
        F.coalesce(F.sum((~F.col("is_valid")).cast("long")), F.lit(0)).alias("invalid"),
    )


def items_with_issue(df: DataFrame, reason: str = "all") -> DataFrame:
    """Editor items, all or those with the given filter reason."""
    return df if reason == "all" else df.filter(F.array_contains("filter_reasons", reason))
