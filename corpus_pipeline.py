"""From raw documents to tokens: five stages, each over all that the one before kept.

Rows keep their columns (doc_id, text, lang, source, n_chars) up to the last stage. Further columns of the input are
left out. Row-wise stages treat each row by itself, so NULL and repeated ids are kept as they are; the stage of near
copies keeps one row of each id and all rows without an id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxloom.llm.decontamination import held_out_hits
from boxloom.llm.frames import sha256_hex
from boxloom.llm.near_copies import near_copy_groups
from boxloom.llm.quality import learned_quality, scored
from boxloom.llm.queries import learned_labels
from boxloom.llm.registry import images, table, tokenizer_file
from boxloom.llm.secrets import learned_tagger, spans_of, without_secrets
from boxloom.llm.tokens import token_ids
from boxloom.session import checkpointed

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: The last stage is a tokenizer's exact output and the first learns a model, which SQL doesn't express.
ORACLE_SQL = None


def carried(docs: DataFrame) -> DataFrame:
    """Image rows whose id carries all other columns, for stages that look at one row at a time."""
    return docs.select(F.struct("doc_id", "lang", "source", "n_chars").alias("im_id"), F.col("text").alias("im_description"))


def returned(rows: DataFrame) -> DataFrame:
    return rows.select("im_id.doc_id", F.col("im_description").alias("text"), "im_id.lang", "im_id.source", "im_id.n_chars")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learned quality score doesn't reject."""
    model = learned_quality(images(docs), learned_labels(spark, sf_dir, "quality"))
    return returned(scored(carried(docs), model, keep_text=True).filter(F.col("predicted") == 1))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id."""
    groups = near_copy_groups(images(docs))
    gone = groups.filter(F.col("im_id") != F.col("component")).select(F.col("im_id").alias("doc_id")).distinct()
    kept = docs.select(*COLUMNS).join(gone, "doc_id", "left_anti")
    named = kept.filter(F.col("doc_id").isNotNull())
    # Ids only; texts meet just where an id repeats, in an aggregate that combines before the shuffle.
    repeated = checkpointed(named.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select("doc_id"))
    first = named.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*COLUMNS[1:])).alias("r"))
    once = named.join(repeated, "doc_id", "left_anti").unionByName(first.select("doc_id", "r.*"))
    return once.unionByName(docs.select(*COLUMNS).filter(F.col("doc_id").isNull()))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark passages."""
    held_out = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("im_id"), F.col("text").alias("im_description"))
    return returned(held_out_hits(carried(docs), held_out, keep_text=True).filter(~F.col("contaminated")))


def secrets_masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret replaced by a mark; ``n_chars`` follows."""
    tagger = learned_tagger(images(docs))
    rows = returned(without_secrets(spans_of(carried(docs), tagger)))
    return rows.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("bigint")))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of the text they decode to."""
    rows = token_ids(images(docs), tokenizer_file("word_bpe_49k.json"))
    return rows.select(
        F.col("im_id").alias("doc_id"),
        "n_tokens",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        sha256_hex(F.col("decoded")).alias("decoded_sha256"),
        "token_ids",
    )


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("secret scans", secrets_masked),
    ("BPE encoding", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what one returns is a written table for the next."""
    rows = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        rows = stage(spark, rows, sf_dir)
        if number < len(STAGES):
            rows = checkpointed(rows)
    return rows
