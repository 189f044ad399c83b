"""Small text rules: ids, names, tags, status labels."""

from __future__ import annotations

import datetime as _dt
import hashlib
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from boxloom.functions.codecs import let, list_cell, strings, tag_list

# Words that mark a product's audience.
WOMEN_WORDS = ["woman", "women", "female", "ladies", "lady"]
MEN_WORDS = ["man", "men", "male", "gents"]
KIDS_WORDS = ["kids", "boys", "boy"]
# Wording by which a verdict is recognised as a blur complaint.
BLUR_PHRASES = ["blurry", "blurred", "lacks clear detail", "blurry and lacks", "out of focus"]
BLUR_FLAG = "[FLAGGED BLURRY] "
# Run modes.
RUN_MODES = ["full", "detection_only"]
# Short names of models.
MODEL_ALIASES = {"nano": "gpt-4.1-nano", "mini": "gpt-4.1-mini", "5.4-mini": "gpt-5.4-mini"}


def image_id(url: Column) -> Column:
    return F.substring(F.md5(F.coalesce(url, F.lit("")).cast("binary")), 1, 16)


def catalog_image_id(catalog: Column, product: Column, url: Column) -> Column:
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in (catalog, product, url)]
    return F.substring(F.md5(F.concat(parts[0], F.lit("|"), parts[1], F.lit("|"), parts[2])), 1, 16)


def title_case(text: Column) -> Column:
    """Upper case after every non-letter, lower case elsewhere."""
    words = F.split(F.lower(text), r"(?<=[^\p{L}])(?=\p{L})")
    return F.array_join(
        F.transform(
            words,
            lambda w: F.concat(F.upper(F.substring(w, F.lit(1), F.lit(1))), F.substring(w, F.lit(2), F.length(w))),
        ),
        "",
    )


def primary_category(cell: Column) -> Column:
    return F.coalesce(F.get(list_cell(cell), F.lit(0)), F.lit(""))


def category_text(cell: Column) -> Column:
    """List cell as ``a, b``; plain text unchanged; NULL -> ''."""
    raw = F.when(F.coalesce(cell, F.lit("nan")) == "nan", F.lit("")).otherwise(F.trim(cell))
    parsed = F.when(raw.startswith("["), F.from_json(raw, "array<string>"))
    joined = F.array_join(F.transform(parsed, lambda x: F.regexp_replace(x, "^[' ]+|[' ]+$", "")), ", ")
    return F.coalesce(joined, raw)


def safe_text(cell: Column) -> Column:
    return F.when(cell.isin("nan", "None"), "").otherwise(F.coalesce(F.trim(cell), F.lit("")))


def merged_tags(tags: Column, classes: Column) -> Column:
    """Tags followed by the classes that are not tags yet; existing order kept."""
    return let(
        tag_list(tags),
        lambda own: F.array_join(
            F.concat(own, F.filter(classes, lambda c: ~F.array_contains(own, c))), ","
        ),
    )


def with_tag(tags: Column, marker: str) -> Column:
    return F.array_join(F.array_append(tag_list(tags), F.lit(marker)), ",")


def audience(tags: Column) -> Column:
    """women / men / kids / unisex / unknown from a stringified tag list."""
    words = F.transform(
        F.coalesce(F.when(F.trim(tags).startswith("["), F.from_json(F.trim(tags), "array<string>")), strings()),
        lambda t: F.lower(t),
    )
    women = F.arrays_overlap(words, strings(*WOMEN_WORDS))
    men = F.arrays_overlap(words, strings(*MEN_WORDS))
    kids = F.arrays_overlap(words, strings(*KIDS_WORDS))
    return (
        F.when(women & men, "unisex")
        .when(women, "women")
        .when(men, "men")
        .when(kids, "kids")
        .otherwise("unknown")
    )


def product_text(title, description, gender, colors, colours, category, brand) -> Column:
    """``Title: .., Description: ..`` of the fields that are filled."""
    colour = F.when(F.coalesce(colors, F.lit("")) != "", colors).otherwise(colours)
    fields = [
        ("Title", title),
        ("Description", description),
        ("Gender", gender),
        ("Colour", colour),
        ("Category", category),
        ("Brand", brand),
    ]
    return F.concat_ws(", ", *[F.when(c != "", F.concat(F.lit(f"{k}: "), c)) for k, c in fields])


def flagged_reason(is_valid: Column, reason: Column) -> Column:
    """Prefix the blur flag to a rejection that complains about blur."""
    blurry = F.lit(False)
    for phrase in BLUR_PHRASES:
        blurry = blurry | F.lower(reason).contains(phrase)
    return F.when(~is_valid & blurry, F.concat(F.lit(BLUR_FLAG), reason)).otherwise(reason)


def flag_of(reason: Column) -> Column:
    """Flag words of a reason in any case, '' when it carries none."""
    return F.trim(F.regexp_extract(F.coalesce(reason, F.lit("")), r"(?i)^\[FLAGGED\s+([^\]]+)\]", 1))


def without_flag(reason: Column) -> Column:
    return F.regexp_replace(F.coalesce(reason, F.lit("")), r"(?i)^\[FLAGGED\s+[^\]]+\]\s*", "")


def is_md5(text: Column) -> Column:
    return text.rlike("^[0-9a-fA-F]{32}$")


def url_slug(url: Column) -> Column:
    """Stem of the URL path, at most 80 characters, ``image`` when there is none."""
    path = F.try_parse_url(url, F.lit("PATH"))
    name = F.regexp_extract(F.coalesce(path, F.lit("")), r"([^/]*)/*$", 1)
    stem = F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")
    return F.when(stem == "", "image").otherwise(F.substring(stem, 1, 80))


def class_key(name: Column) -> Column:
    """Comparison form of a class name: lower case, blanks for underscores."""
    return F.replace(F.lower(F.trim(name)), F.lit("_"), F.lit(" "))


def filled_template(template: str, values: dict[str, Column]) -> Column:
    """Replace ``{key}`` marks; other braces stay."""
    out = F.lit(template)
    for key, value in values.items():
        out = F.replace(out, F.lit("{" + key + "}"), value)
    return out


def hosted_image_key(reference: Column, host_pattern: str = r"^https?://[^/]+/([0-9a-f]{32})") -> Column:
    """md5 key of a hosted image given as URL or as bare 32-character id; anything else is an error."""
    key = F.coalesce(
        F.nullif(F.regexp_extract(reference, host_pattern, 1), F.lit("")),
        F.when(F.length(reference) == 32, reference),
    )
    return F.coalesce(key, F.raise_error(F.concat(F.lit("not a hosted image: "), reference)))


def settings_hash(settings: dict, length: int = 12) -> str:
    """Short digest of a settings dict; part of cache keys."""
    return hashlib.md5(json.dumps(settings, sort_keys=True, default=str).encode()).hexdigest()[:length]


def run_mode(mode: str | None) -> str:
    value = (mode or "").strip().lower()
    if value not in RUN_MODES:
        raise ValueError(f"mode must be one of {RUN_MODES}, not {mode!r}")
    return value


def full_model_name(name: Column) -> Column:
    out = name
    for short, full in MODEL_ALIASES.items():
        out = F.when(F.lower(name) == short, full).otherwise(out)
    return out


def class_groups(
    classes: list[str],
    size: int | None = None,
    aliases: dict[str, list[str]] | None = None,
    given: list[list[str]] | None = None,
) -> list[list[str]]:
    """Request groups: the given ones, else ``size`` classes each, else one; then aliases take the place of their class."""
    cut = given or ([classes[i : i + size] for i in range(0, len(classes), size)] if size else [classes])
    return [[n for c in group for n in (aliases or {}).get(c, [c])] for group in cut]


def class_of_alias(aliases: dict[str, list[str]]) -> dict[str, str]:
    """Class of each alias, also as written with underscores; blank aliases name nothing."""
    named = [(str(a).strip(), c) for c, own in aliases.items() for a in own or [] if a is not None and str(a).strip()]
    return {spelled: c for a, c in named for spelled in (a, a.replace(" ", "_"))}


def run_stamp(now: _dt.datetime | None = None) -> str:
    return (now or _dt.datetime.now()).strftime("%H%M_%d%m%y")


def dataset_label(path: str) -> str:
    """Readable name from the last two parts of an output path."""
    parts = [p for p in path.rstrip("/").split("/") if p][-2:]
    words = [p.replace("_", " ").replace("-", " ").strip() for p in parts]
    if words and words[-1].endswith(" sample"):
        words[-1] = words[-1][: -len(" sample")].strip()
    return " ".join(w for w in words if w) or "Curated Dataset"
