"""Readers for catalogs, image rows, reviews, corrections, lists and images."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxloom.operators import groups
from boxloom.operators.catalog import Rule
from boxloom.operators.review import CORRECTION, REVIEW

# Columns kept when sampled catalogs are combined.
COMBINED = ["catalog_name", "product_id", "category", "im_url", "im_id", "im_name", "im_description", "tags"]


def csv_header(spark: SparkSession, path: str) -> list[str]:
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path).columns


def read_csv(spark: SparkSession, path, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with header and quoted multi-line cells; without schema all columns are text."""
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    return (reader.schema(schema) if schema else reader).csv(path)


def with_row_number(df: DataFrame, name: str = "row_id") -> DataFrame:
    """0-based input row number: partition order, then place inside the partition."""
    placed = df.withColumn("_place", F.monotonically_increasing_id())
    placed = placed.withColumn("_part", F.shiftright("_place", 33))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    # One row per input partition, so the broadcast is bounded by their number.
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = groups.join_on(placed, F.broadcast(offsets), ["_part"])
    return numbered.withColumn(name, (F.col("_before") + inside).cast("long")).drop("_place", "_part", "_before")


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Product catalog; everything, product ids included, is text."""
    return with_row_number(read_csv(spark, path), "pos")


def read_combined(spark: SparkSession, pattern: str, columns: list[str] | None = None) -> DataFrame:
    """Sampled catalogs of many folders, first row per image id."""
    columns = columns or COMBINED
    rows = read_csv(spark, pattern).withColumn("_file", F.input_file_name())
    placed = rows.withColumn("_at", F.struct("_file", F.monotonically_increasing_id()))
    return groups.first_per_key(placed.select(*columns, "_at"), ["im_id"], ["_at"]).drop("_at")


def catalog_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("catalog_name").agg(F.count(F.lit(1)).alias("images"))


def read_column(spark: SparkSession, path: str, column: str) -> DataFrame:
    """Distinct non-empty values of one column."""
    return read_csv(spark, path).select(column).filter(F.col(column).isNotNull()).distinct()


def read_corrections(spark: SparkSession, path: str) -> DataFrame:
    """Corrections file; ``position`` keeps the file order."""
    rows = spark.read.schema(CORRECTION).json(path, multiLine=True)
    return rows.withColumn("position", F.monotonically_increasing_id())


def read_review(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REVIEW).json(path, multiLine=True)


def read_thresholds(spark: SparkSession, path: str, default: float) -> DataFrame:
    """``name,threshold`` lines, or class names that take the default."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    cells = F.split("value", ",")
    return lines.select(
        F.trim(F.get(cells, F.lit(0))).alias("name"),
        F.coalesce(F.trim(F.get(cells, F.lit(1))).try_cast("double"), F.lit(default)).alias("threshold"),
    )


def read_rules(spark: SparkSession, path: str) -> list[Rule]:
    """Filter rules from a JSON configuration file."""
    rows = spark.read.schema("name string, category_in array<string>, gender_equals string").json(path, multiLine=True)
    return [Rule(r["name"], r["category_in"] or [], r["gender_equals"] or "") for r in rows.collect()]


def read_image_bytes(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """File name stem, bytes and content md5 of image files."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    )
    stem = F.regexp_extract("path", r"([^/]+?)(\.[^./]*)?$", 1)
    return files.select("path", stem.alias("im_name"), "content", F.md5("content").alias("image_content_hash"))


def read_pixels(spark: SparkSession, path: str) -> DataFrame:
    """Decoded images; unreadable files are dropped.  Pixels are BGR rows."""
    images = spark.read.format("image").option("dropInvalid", True).load(path)
    return images.select(
        F.col("image.origin").alias("origin"),
        F.regexp_extract("image.origin", r"([^/]+?)(\.[^./]*)?$", 1).alias("im_name"),
        F.col("image.height").alias("image_h"),
        F.col("image.width").alias("image_w"),
        F.col("image.nChannels").alias("channels"),
        F.col("image.data").alias("pixels"),
    )


def job_configs(spark: SparkSession, targets: dict[str, int], classes: list[str]) -> DataFrame:
    """One sampling job per catalog: target size and relevant classes."""
    rows = [(name, int(n), classes) for name, n in sorted(targets.items())]
    return spark.createDataFrame(rows, "catalog_name string, target_size int, relevant_classes array<string>")
