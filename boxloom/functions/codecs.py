"""Text encodings of the curation tables, as Column expressions.

Seven columns of an image row are *aligned*: entry i of each describes box i.
They are stored as delimited strings and handled here as one
``ARRAY<STRUCT<...>>`` so that every edit is a single ``filter``/``transform``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The aligned columns of an image row, in file order.
ALIGNED = ["concepts", "boxes", "optional", "box_statuses", "box_sources", "box_reasons", "issue_types"]

BRACKETED = r"\[[^\]]+\]"
MANUAL_REASON = "manual_bbox_added"
ZERO_BOX = "[0,0,0,0]"


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it many times inside ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def field(name: str):
    """Accessor for ``transform`` (a lambda in a loop would bind the last name)."""
    return lambda struct: struct[name]


def strings(*values: str) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def list_cell(cell: Column) -> Column:
    """List-valued cell: JSON or Python list literal, else the text itself; blank -> []."""
    text = F.trim(cell)
    parsed = F.when(text.startswith("["), F.from_json(text, "array<string>"))
    return (
        F.when(F.coalesce(text, F.lit("")) == "", strings())
        .when(parsed.isNotNull(), F.transform(parsed, lambda x: F.trim(F.coalesce(x, F.lit("None")))))
        .otherwise(F.array(text))
    )


def url_list_cell(cell: Column) -> Column:
    """List-valued URL cell; entries that are not http(s) and non-list cells are dropped."""
    parsed = F.when(F.trim(cell).startswith("["), F.from_json(F.trim(cell), "array<string>"))
    urls = F.transform(F.coalesce(parsed, strings()), lambda u: F.trim(u))
    return F.filter(urls, is_http)


def is_http(url: Column) -> Column:
    return url.startswith("http://") | url.startswith("https://")


def class_list_cell(cell: Column) -> Column:
    """Class names from a JSON / literal / comma list: lower case, trimmed, no blanks."""
    text = F.trim(cell)
    parsed = F.when(text.startswith("["), F.from_json(text, "array<string>"))
    raw = F.coalesce(parsed, F.split(text, ","), strings())
    return F.filter(F.transform(raw, lambda x: F.lower(F.trim(x))), lambda x: x != "")


def class_multiplicity(cell: Column) -> Column:
    """ARRAY<STRUCT<class, multiplicity>>, one entry per class; the last mention decides."""
    names = class_list_cell(cell)
    items = F.transform(
        names,
        lambda n: F.struct(
            F.trim(F.replace(n, F.lit("(multiple)"), F.lit(""))).alias("class_name"),
            F.when(n.contains("(multiple)"), "multiple").otherwise("singular").alias("multiplicity"),
        ),
    )
    return let(
        items,
        lambda a: F.transform(
            F.array_distinct(F.transform(a, lambda s: s["class_name"])),
            lambda c: F.element_at(F.filter(a, lambda s: s["class_name"] == c), -1),
        ),
    )


def comma_list(cell: Column) -> Column:
    """Plain comma split; an empty or NULL cell has no entries."""
    return F.when(F.coalesce(cell, F.lit("")) == "", strings()).otherwise(F.split(cell, ","))


def tag_list(cell: Column) -> Column:
    """Trimmed, non-blank comma entries."""
    return F.filter(F.transform(comma_list(cell), lambda t: F.trim(t)), lambda t: t != "")


def distinct_concepts(cell: Column) -> Column:
    return F.array_distinct(tag_list(cell))


def truthy(cell: Column, default: bool = False) -> Column:
    """Text flag: 1/true/yes/y/on."""
    return F.coalesce(
        F.lower(F.trim(cell.cast("string"))).isin("1", "true", "yes", "y", "on"), F.lit(default)
    )


def box_texts(cell: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(cell, F.lit("")), F.lit(BRACKETED), F.lit(0))


def box_numbers(text: Column) -> Column:
    """ARRAY<DOUBLE> of one box text, NULL unless it holds exactly four numbers."""
    numbers = F.transform(
        F.split(F.translate(text, "[]", ""), ","), lambda v: F.trim(v).try_cast("double")
    )
    return F.when((F.size(numbers) == 4) & ~F.exists(numbers, lambda v: v.isNull()), numbers)


def box_text(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    # Joined from casts, as a formatter parses its pattern for each row; a missing corner is written "null" as by a formatter.
    corners = [F.coalesce(F.rint(v).cast("long").cast("string"), F.lit("null")) for v in (x1, y1, x2, y2)]
    return F.concat(F.lit("["), F.concat_ws(",", *corners), F.lit("]"))


def existing_detections(boxes: Column, concepts: Column) -> Column:
    """Detections already stored in a row: ARRAY<STRUCT<name, box, score, source>>.

    Boxes are bracketed, or a single bare ``x1,y1,x2,y2``; the longer of the
    two lists is cut to the shorter.
    """
    text = F.trim(boxes)
    found = F.when(text.contains("["), box_texts(text)).otherwise(F.array(text))
    parsed = F.filter(F.transform(found, box_numbers), lambda b: b.isNotNull())
    names = tag_list(F.trim(concepts))
    paired = let(
        F.struct(parsed.alias("b"), names.alias("n")),
        lambda p: F.transform(
            F.slice(F.arrays_zip(p["b"], p["n"]), 1, F.least(F.size(p["b"]), F.size(p["n"]))),
            lambda z: F.struct(
                z["n"].alias("name"),
                z["b"].alias("box"),
                F.lit(1.0).alias("score"),
                F.lit("original").alias("source"),
            ),
        ),
    )
    empty = F.array().cast("array<struct<name:string,box:array<double>,score:double,source:string>>")
    return F.when(boxes.isNull() | concepts.isNull(), empty).otherwise(paired)


def clipped_boxes(cell: Column) -> Column:
    """Box list with negative coordinates raised to 0; entries without four integers go."""
    clipped = F.transform(
        box_texts(cell),
        lambda b: F.transform(
            F.regexp_extract_all(b, F.lit(r"-?\d+"), F.lit(0)),
            lambda v: F.greatest(F.lit(0), v.cast("long")),
        ),
    )
    whole = F.filter(clipped, lambda v: F.size(v) == 4)
    return F.array_join(
        F.transform(whole, lambda v: F.concat(F.lit("["), F.array_join(v.cast("array<string>"), ","), F.lit("]"))),
        ",",
    )


def box_reasons(cell: Column) -> Column:
    """Reasons list: quoted strings, the bare manual marker, or loose text in between."""
    body = F.regexp_replace(F.regexp_replace(F.trim(F.coalesce(cell, F.lit(""))), r"^\[", ""), r"\]$", "")
    tokens = F.regexp_extract_all(
        body, F.lit(r'"[^"]*"|manual_bbox_added|(?:(?!manual_bbox_added)[^"])+'), F.lit(0)
    )
    cleaned = F.transform(
        tokens,
        lambda t: F.when(
            t.startswith('"') & t.endswith('"') & (F.length(t) > 1), F.substring(t, F.lit(2), F.length(t) - 2)
        ).otherwise(F.regexp_replace(t, r'^[ ,"]+|[ ,"]+$', "")),
    )
    return F.filter(cleaned, lambda t: t != "")


def reasons_text(reasons: Column) -> Column:
    quoted = F.transform(
        reasons,
        lambda r: F.when(r == MANUAL_REASON, r).otherwise(
            F.concat(F.lit('"'), F.replace(r, F.lit('"'), F.lit('""')), F.lit('"'))
        ),
    )
    return F.concat(F.lit("["), F.array_join(quoted, ","), F.lit("]"))


def aligned_parts(column: str, cell: Column) -> Column:
    """Entries of one aligned column."""
    if column == "boxes":
        return box_texts(cell)
    if column == "box_reasons":
        return box_reasons(cell)
    return comma_list(cell)


def aligned_text(column: str, parts: Column) -> Column:
    return reasons_text(parts) if column == "box_reasons" else F.array_join(parts, ",")


def aligned_entries(columns: list[str], length: Column) -> Column:
    """Zip the aligned columns to ARRAY<STRUCT>, padded with NULL or cut to ``length``."""
    parts = F.struct(*[aligned_parts(c, F.col(c)).alias(c) for c in columns], length.alias("_n"))
    return let(
        parts,
        lambda p: F.when(
            p["_n"] > 0,
            F.transform(
                F.sequence(F.lit(0), F.greatest(p["_n"] - 1, F.lit(0))),
                lambda i: F.struct(*[F.get(p[c], i).alias(c) for c in columns]),
            ),
        ).otherwise(F.array().cast("array<struct<" + ",".join(f"{c}:string" for c in columns) + ">>")),
    )


def entries_text(columns: list[str], entries: Column, missing: str | None = None) -> dict[str, Column]:
    """Aligned column texts of an entry array; NULL entries vanish or become ``missing``."""
    out = {}
    for c in columns:
        values = F.transform(entries, field(c))
        if missing is None:
            values = F.filter(values, lambda v: v.isNotNull())
        else:
            values = F.transform(values, lambda v: F.coalesce(v, F.lit(missing)))
        out[c] = aligned_text(c, values)
    return out
