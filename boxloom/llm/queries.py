"""Queries over the given tables; each maps them to an operator's records and its results back."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxloom.llm.conversation_trie import conversation_nodes
from boxloom.llm.decontamination import held_out_hits
from boxloom.llm.edited_counts import edited_trees, token_trees
from boxloom.llm.frames import sha256_hex
from boxloom.llm.near_copies import near_copy_groups
from boxloom.llm.quality import quality_scores
from boxloom.llm.registry import ORACLES, QUERIES, images, query, table, tokenizer_file  # noqa: F401
from boxloom.llm.secrets import secret_spans
from boxloom.llm.substrings import without_repeats
from boxloom.llm.tokens import token_ids
from boxloom.llm.top_search import best_matches
from boxloom.llm.toxicity import toxicity_severity
from boxloom.llm.url_filter import url_verdicts
from boxloom.llm.warc import capture_histories, read_archives, write_archives
from boxloom.llm.whitening import whitened
from boxloom.operators.groups import placed
from boxloom.session import checkpoint_dir


@query("op1_substring_dedup")
def substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    rows = without_repeats(images(table(spark, sf, "documents")), n_words=13)
    return rows.select(
        F.col("im_id").alias("doc_id"), "n_words", "n_removed", sha256_hex(F.col("kept_description")).alias("kept_sha256")
    )


def edited_texts(rows: DataFrame, ranks: str) -> DataFrame:
    """Each text gets five code points replaced at a third of it and a line added at its end.

    The edits of a row depend on its length alone, so rows are named by id and length and distinct names are edited.
    """
    length = F.length("im_description")
    rows = rows.select(F.struct(F.col("im_id").alias("id"), F.coalesce(length, F.lit(0)).alias("length")).alias("im_id"), "im_description")
    length, place = F.col("im_id.length"), F.floor(F.col("im_id.length") / 3).cast("int")
    inner = F.struct(place.alias("start"), F.least(place + 5, length).alias("end"), F.lit(" edited ").alias("replacement"))
    added = F.struct(length.alias("start"), length.alias("end"), F.lit("\nLine 1 added.").alias("replacement"))
    names = rows.select("im_id").filter(length > 0).distinct()
    edits = names.select("im_id", F.explode(F.array(inner, added)).alias("edit")).select("im_id", "edit.*")
    return edited_trees(token_trees(rows, ranks), edits, ranks).withColumn("im_id", F.col("im_id.id"))


@query("op2_token_counts")
def token_counts(spark: SparkSession, sf: str) -> DataFrame:
    counted = edited_texts(images(table(spark, sf, "documents")), tokenizer_file("byte_bpe_50k.tiktoken"))
    return counted.select(
        F.col("im_id").alias("doc_id"), "n_tokens_before", "n_tokens", "n_runs", "n_recounted", sha256_hex(F.coalesce("im_description", F.lit(""))).alias("edited_sha256")
    )


URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


@query(
    "op3_url_filter",
    """
    WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES
        ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
        ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
    cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
    parts AS (
        SELECT page_id, regexp_extract(rest, '^([^/?#]*)([^?#]*)', 1) AS raw_host, regexp_extract(rest, '^([^/?#]*)([^?#]*)', 2) AS path
        FROM cut),
    urls AS (
        SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM parts)
    SELECT page_id, host, path,
        (SELECT arg_max(rule_host || rule_path, length(rule_host || rule_path)) FROM rules
         WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS rule,
        coalesce((SELECT arg_max(rule_verdict, length(rule_host || rule_path)) FROM rules
         WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)), 'allow') AS verdict
    FROM urls
    """,
)
def url_filter(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select(F.col("page_id").alias("im_id"), F.col("url").alias("im_url"))
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_verdicts(pages, rules).withColumnRenamed("im_id", "page_id")


def held_out() -> Column:
    """Whether the remainder of the id's checksum is 0; such labels are never learned from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def learned_labels(spark: SparkSession, sf: str, mark: str) -> DataFrame:
    return table(spark, sf, "labels").filter(~held_out()).select(F.col("doc_id").alias("im_id"), mark)


@query("op4_quality")
def quality(spark: SparkSession, sf: str) -> DataFrame:
    rows = quality_scores(images(table(spark, sf, "documents")), learned_labels(spark, sf, "quality"))
    return rows.withColumnRenamed("im_id", "doc_id").select("doc_id", held_out().alias("held_out"), "score", "predicted")


@query(
    "op5_top_search",
    """
    WITH vectors AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS w
        FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
    scores AS (
        SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.w, c.w) AS BIGINT) AS score
        FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
    ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scores)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
    """,
)
def top_search(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings").select(F.col("vec_id").alias("im_id"), "embedding")
    rows = best_matches(vectors, vectors.filter(F.col("im_id") % 20 == 0), k=20, scale=64)
    return rows.select("query_id", "rank", F.col("im_id").alias("vec_id"), "score")


@query("op6_toxicity")
def toxicity(spark: SparkSession, sf: str) -> DataFrame:
    rows = toxicity_severity(images(table(spark, sf, "documents")), learned_labels(spark, sf, "toxic"))
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return rows.withColumnRenamed("im_id", "doc_id").select(
        "doc_id", held_out().alias("held_out"), "score", "severity", "grade", predicted
    )


@query("op7_bpe")
def bpe(spark: SparkSession, sf: str) -> DataFrame:
    rows = token_ids(images(table(spark, sf, "documents")), tokenizer_file("word_bpe_49k.json"))
    return rows.select(
        F.col("im_id").alias("doc_id"),
        "n_tokens",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        sha256_hex(F.col("decoded")).alias("decoded_sha256"),
    )


@query("op8_ngram_jaccard")
def ngram_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    rows = near_copy_groups(images(table(spark, sf, "documents")), n_words=5, percent=80)
    return rows.select(F.col("im_id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


@query("op9_secrets")
def secrets(spark: SparkSession, sf: str) -> DataFrame:
    rows = secret_spans(images(table(spark, sf, "documents")))

    def said(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "tagged")
    return rows.select(
        F.col("im_id").alias("doc_id"),
        count("assign"),
        count("access"),
        count("hex"),
        sha256_hex(said(base)).alias("base_sha256"),
        said(F.col("spans")).alias("spans"),
    )


@query("op10_decontamination")
def decontamination(spark: SparkSession, sf: str) -> DataFrame:
    held_out = table(spark, sf, "benchmark").select(F.col("item_id").alias("im_id"), F.col("text").alias("im_description"))
    rows = held_out_hits(images(table(spark, sf, "documents")), held_out, n_words=13, least_share=0.05)
    return rows.select(
        F.col("im_id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("found").cast("bigint").alias("n_items"),
        sha256_hex(F.array_join("found", ",")).alias("items_sha256"),
        "contaminated",
    )


def continued_turns(turns: DataFrame) -> DataFrame:
    """Every conversation begins with first turns of the one whose id is the next multiple of five towards zero."""
    filled = [F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")]
    turns = turns.filter(F.col("conv_id").isNotNull()).select("conv_id", "turn", *filled)
    turns = placed(turns, ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")])
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    forks = turns.select("conv_id").distinct().select("conv_id", (F.col("conv_id") - F.col("conv_id") % 5).alias("start_id"), taken.alias("taken"))
    heads = turns.filter((F.col("conv_id") % 5 == 0) & (F.col("place") <= 8)).withColumnRenamed("conv_id", "start_id")
    heads = heads.join(forks, "start_id").filter(F.col("place") <= F.col("taken"))
    columns = ["conv_id", F.col("place").alias("turn"), "role", "text"]
    return heads.select(*columns).unionByName(turns.filter(F.col("place") > taken).select(*columns))


@query(
    "op11_conversation_trie",
    """
    WITH ranked AS (
        SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
            row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
        FROM conversations WHERE conv_id IS NOT NULL),
    forks AS (
        SELECT DISTINCT c, c - c % 5 AS base, xor(4294967295, list_reduce(
            list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
            lambda a, b: list_reduce([0, 0, 0, 0, 0, 0, 0, 0],
                lambda r, i: xor(r >> 1, CASE WHEN r & 1 = 1 THEN 3988292384 ELSE 0 END), xor(a, b)),
            4294967295)) % 9 AS h
        FROM ranked),
    rebuilt AS (
        SELECT f.c, r.place, r.role, r.text FROM forks f JOIN ranked r ON r.c = f.base AND r.place <= f.h
        UNION ALL
        SELECT f.c, r.place, r.role, r.text FROM forks f JOIN ranked r ON r.c = f.c AND r.place > f.h),
    lists AS (
        SELECT f.c, coalesce(list({'role': r.role, 'text': r.text} ORDER BY r.place) FILTER (WHERE r.place IS NOT NULL), []) AS seq
        FROM forks f LEFT JOIN rebuilt r ON r.c = f.c GROUP BY f.c),
    members AS (
        SELECT c, d, seq[:d] AS k, len(seq) = d AS ends, CASE WHEN d = 0 THEN 0 ELSE octet_length(encode(seq[d].text)) END AS bytes
        FROM (SELECT c, seq, unnest(range(len(seq) + 1)) AS d FROM lists)),
    named AS (SELECT *, min(c) OVER (PARTITION BY d, k) AS o FROM members),
    nodes AS (
        SELECT o, d, count(*) AS n, any_value(bytes) AS bytes, bool_and(ends) AS leaf,
            sha256(coalesce(string_agg(CASE WHEN ends THEN CAST(c AS VARCHAR) END, ',' ORDER BY c), '')) AS ends
        FROM named GROUP BY o, d),
    sums AS (
        SELECT a.o, a.d, sum(CASE WHEN b.leaf THEN 1 ELSE 0 END) AS leaves, sum((b.n - 1) * b.bytes) AS saved
        FROM nodes b JOIN named a ON a.c = b.o AND a.d <= b.d GROUP BY a.o, a.d),
    above AS (SELECT b.o, b.d, a.o AS po FROM nodes b JOIN named a ON a.c = b.o AND a.d = b.d - 1),
    kids AS (SELECT po AS o, d - 1 AS d, count(*) AS children FROM above GROUP BY ALL)
    SELECT n.o AS conv_id, CAST(n.d AS BIGINT) AS depth, above.po AS parent_conv_id, n.n AS n_convs, coalesce(kids.children, 0) AS n_children,
        CAST(sums.leaves AS BIGINT) AS n_leaves, CAST(sums.saved AS BIGINT) AS saved_tokens, n.ends AS ends_sha256
    FROM nodes n JOIN sums USING (o, d) LEFT JOIN above USING (o, d) LEFT JOIN kids USING (o, d)
    """,
)
def conversation_trie(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations")
    return conversation_nodes(continued_turns(turns), turns.select("conv_id"))


@query("op12_whitening")
def whitening(spark: SparkSession, sf: str) -> DataFrame:
    rows = whitened(table(spark, sf, "embeddings").select(F.col("vec_id").alias("im_id"), "embedding"), n_components=16, scale=64, shift=1_000_000)
    return rows.withColumnRenamed("im_id", "vec_id").withColumn("deviation", F.col("deviation").try_cast("bigint"))


@query(
    "op13_warc",
    """
    WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload, octet_length(encode(coalesce(html, ''))) AS payload_bytes FROM pages),
    hashed AS (
        SELECT page_id, payload_bytes, max(page_id) OVER (PARTITION BY payload) AS keeper,
            array_to_string(list_transform(string_split(sha1(payload), ''), lambda c: lpad(bin(strpos('0123456789abcdef', c) - 1), 4, '0')), '') AS bits
        FROM payloads)
    SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
        array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 +
            list_reduce(list_transform(string_split(substr(bits, CAST(5 * i + 1 AS INTEGER), 5), ''), lambda b: CAST(b AS INTEGER)), lambda a, b: 2 * a + b), 1)), '') AS payload_digest,
        CASE WHEN page_id = keeper OR keeper IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
        CASE WHEN page_id IS DISTINCT FROM keeper THEN keeper END AS refers_to
    FROM hashed
    """,
)
def warc(spark: SparkSession, sf: str) -> DataFrame:
    second = F.timestamp_seconds(F.lit(946_684_800) + F.pmod("page_id", F.lit(1_000_000_000)))
    captures = table(spark, sf, "pages").select(
        F.col("page_id").alias("im_id"), F.col("url").alias("im_url"), F.col("html").alias("content"), F.coalesce(second, F.timestamp_seconds(F.lit(0))).alias("captured")
    )
    folder = f"{checkpoint_dir(spark)}/archives/{uuid4().hex}"
    write_archives(captures, folder)
    return capture_histories(read_archives(spark, folder)).select(
        F.col("im_id").cast("bigint").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("bigint").alias("refers_to")
    )
