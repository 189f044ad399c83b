"""The registered queries and the pipeline on the small tables."""

import hashlib
import struct

import corpus_pipeline
import pytest
from checks.compare import check, connect
from tests.llm import plain

from boxloom.llm.queries import ORACLES, QUERIES
from boxloom.llm.registry import tokenizer_file


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.fixture(scope="module")
def documents(con):
    return con.execute("SELECT doc_id, text FROM documents").fetchall()


@pytest.fixture(scope="module")
def benchmark(con):
    return con.execute("SELECT item_id, text FROM benchmark").fetchall()


def rows(spark, sf, name):
    got = QUERIES[name](spark, sf)
    return got.columns, sorted(map(tuple, got.collect()))


def digest(ids):
    return hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()


def encoded(documents):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    for i, text in documents:
        ids = own.encode(text or "", add_special_tokens=False).ids
        yield i, len(ids), digest(ids), plain.sha(own.decode(ids, skip_special_tokens=False))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, sf, con, name):
    ok, note = check(spark, sf, name, QUERIES[name], ORACLES[name], con)
    assert ok, note


def test_op1(spark, sf, documents):
    columns, got = rows(spark, sf, "op1_substring_dedup")
    assert columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert got == sorted((i, n, r, plain.sha(t)) for i, n, r, t in plain.repeats(documents))


def test_op2(spark, sf, documents):
    import base64

    import tiktoken

    from boxloom.llm.edited_counts import LEAF_RUNS, PATTERN

    with open(tokenizer_file("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    own = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for i, text in documents:
        n = len(text or "")
        after = text[: n // 3] + " edited " + text[min(n // 3 + 5, n) :] + "\nLine 1 added." if n else ""
        want.append((i, len(own.encode_ordinary(text or "")), len(own.encode_ordinary(after)), plain.sha(after)))
    columns, got = rows(spark, sf, "op2_token_counts")
    assert [(r[0], r[1], r[2], r[5]) for r in got] == sorted(want)
    assert all(r[4] <= 2 * 5 * LEAF_RUNS for r in got)


def test_op4(spark, sf, con):
    columns, got = rows(spark, sf, "op4_quality")
    assert columns == ["doc_id", "held_out", "score", "predicted"]
    assert [r[0] for r in got] == sorted(r[0] for r in con.execute("SELECT doc_id FROM documents").fetchall())
    import zlib

    assert all(r[1] == (zlib.crc32(str(r[0]).encode()) % 5 == 0) and 0 <= r[2] <= 1 and r[3] == (r[2] >= 0.3) for r in got)
    quality = dict(con.execute("SELECT doc_id, quality FROM labels").fetchall())
    right = [r[3] == quality[r[0]] for r in got if r[0] in quality and r[1]]
    assert sum(right) / len(right) >= 0.9


def test_op6(spark, sf, con):
    columns, got = rows(spark, sf, "op6_toxicity")
    assert columns == ["doc_id", "held_out", "score", "severity", "grade", "predicted"]
    toxic = dict(con.execute("SELECT doc_id, toxic FROM labels").fetchall())
    right = [r[5] == toxic[r[0]] for r in got if r[0] in toxic]
    # Fewer than a hundred labels here: most abusive words are in too few rows to be known.
    assert sum(right) / len(right) >= 0.8


def test_op7(spark, sf, documents):
    columns, got = rows(spark, sf, "op7_bpe")
    assert columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert got == sorted(encoded(documents))


def test_op8(spark, sf, documents):
    columns, got = rows(spark, sf, "op8_ngram_jaccard")
    assert columns == ["doc_id", "n_shingles", "component_id"]
    assert got == sorted(plain.groups(documents))


def test_op9(spark, sf, documents):
    columns, got = rows(spark, sf, "op9_secrets")
    assert columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    want = []
    for i, text in documents:
        spans = plain.secrets(text)
        want.append((i, *(sum(s.startswith(k) for s in spans) for k in ("assign", "access", "hex")), plain.sha(",".join(spans))))
    assert [r[:5] for r in got] == sorted(want)
    assert all(set(plain.secrets(t)) <= set(r[5].split(",")) for (i, t), r in zip(sorted(documents), got, strict=True) if plain.secrets(t))


def test_op10(spark, sf, documents, benchmark):
    columns, got = rows(spark, sf, "op10_decontamination")
    assert columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    want = plain.contamination(documents, benchmark)
    assert got == sorted((i, n, h, len(f), plain.sha(",".join(f)), c) for i, n, h, f, c in want)


def test_pipeline(spark, sf, tmp_path, benchmark):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    kept = {}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.select("doc_id", "text").collect()
        stage(spark, docs, sf).write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        kept[name] = ([tuple(r) for r in before], docs)
        assert docs.count() > 0
        if number < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns

    def pairs(df):
        return sorted(map(tuple, df.select("doc_id", "text").collect()))

    before, after = kept["quality classifier"]
    scores = {r[0]: r[3] for r in rows(spark, sf, "op4_quality")[1]}
    assert pairs(after) == sorted(r for r in before if scores[r[0]])
    before, after = kept["n-gram Jaccard join"]
    component = {i: c for i, _, c in plain.groups(before)}
    assert pairs(after) == sorted(r for r in before if component[r[0]] == r[0])
    before, after = kept["benchmark decontamination"]
    dirty = {i for i, *_, c in plain.contamination(before, benchmark) if c}
    assert pairs(after) == sorted(r for r in before if r[0] not in dirty)
    before, after = kept["secret scans"]
    texts = dict(pairs(after))
    assert sorted(texts) == sorted(i for i, _ in before)
    for i, text in before:
        assert not plain.secrets(texts[i])
        if not plain.secrets(text):
            assert texts[i] == text or "[SECRET]" in texts[i]
    before, after = kept["BPE encoding"]
    got = sorted(map(tuple, after.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()))
    assert got == sorted(encoded(before))
    assert corpus_pipeline.run(spark, sf).count() == len(got)


def test_stages_on_odd_rows(spark, sf, odd_rows, tmp_path):
    from pyspark.sql import functions as F

    def table(rows):
        df = spark.createDataFrame([(i, t, None, "s" if i else None, None) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
        return df.select("*", F.lit(1).alias("im_id"), F.lit("x").alias("component"))

    counts = {}
    for name, stage in corpus_pipeline.STAGES:
        for label, rows_ in (("odd", odd_rows), ("none", [])):
            path = f"{tmp_path}/{name}-{label}"
            table(rows_).write.parquet(path)
            counts[name, label] = stage(spark, spark.read.parquet(path), sf).count()
    assert all(counts[name, "none"] == 0 for name, _ in corpus_pipeline.STAGES)
    assert counts["secret scans", "odd"] == counts["BPE encoding", "odd"] == counts["benchmark decontamination", "odd"] == len(odd_rows)
    groups = plain.groups(odd_rows)
    ids = {i for i, _, c in groups if i is not None and c == i}
    assert counts["n-gram Jaccard join", "odd"] == len(ids) + sum(i is None for i, _ in odd_rows)
