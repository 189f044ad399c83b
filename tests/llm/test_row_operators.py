import base64
import random

import pytest
from tests.llm import plain

from boxloom.llm.edited_counts import PATTERN, edited_trees, token_trees
from boxloom.llm.quality import quality_scores
from boxloom.llm.queries import edited_texts
from boxloom.llm.registry import tokenizer_file
from boxloom.llm.tokens import token_ids
from boxloom.llm.top_search import best_matches
from boxloom.llm.toxicity import toxicity_severity
from boxloom.llm.url_filter import url_verdicts

WORDS = "the ring of silver with stones a band and chain gold small large cut bright for set in old".split()


def prose(chance, n):
    return " ".join(chance.choice(WORDS) for _ in range(n)) + "."


@pytest.fixture(scope="module")
def judged_texts():
    chance = random.Random(11)
    out = []
    for i in range(400):
        good = i % 3 != 0
        text = prose(chance, chance.randrange(20, 120))
        out.append((i, text if good else " ".join(w.upper() + "!!" for w in text.split()), int(good)))
    return out


def test_quality(spark, image_rows, odd_rows, judged_texts):
    rows = image_rows([(i, t) for i, t, _ in judged_texts] + [(1000 + n, t) for n, (_, t) in enumerate(odd_rows)])
    judged = spark.createDataFrame([(i, q) for i, _, q in judged_texts if i % 5] + [(3, None), (None, 1), (77777, 1)], "im_id bigint, quality int")
    got = {r.im_id: r for r in quality_scores(rows, judged).collect()}
    assert len(got) == len(judged_texts) + len(odd_rows)
    right = [got[i].predicted == q for i, _, q in judged_texts if i % 5 == 0]
    assert sum(right) / len(right) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    assert got[1001].score == got[1002].score  # NULL and empty


@pytest.mark.parametrize(("labels", "predicted"), [([], 1), ([(1, 1), (2, 1)], 1), ([(1, 0)], 0)])
def test_quality_without_both_labels(spark, image_rows, labels, predicted):
    judged = spark.createDataFrame(labels, "im_id bigint, quality int")
    got = quality_scores(image_rows([(1, "a b"), (2, "c"), (3, None)]), judged).collect()
    assert [r.predicted for r in got] == [predicted] * 3
    assert quality_scores(image_rows([]), judged).count() == 0


def test_toxicity(spark, image_rows, odd_rows):
    chance = random.Random(4)
    rude = ["numbskull", "dimwit", "halfwit", "blockhead"]
    rows = []
    for i in range(600):
        words = prose(chance, 60).split()
        for _ in range(0 if i % 4 else 1 + i % 5):
            words[chance.randrange(len(words))] = chance.choice(rude)
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    judged = spark.createDataFrame([(i, y) for i, _, y in rows if i % 5] + [(1, None)], "im_id bigint, toxic int")
    table = image_rows([(i, t) for i, t, _ in rows] + [(1000 + n, t) for n, (_, t) in enumerate(odd_rows)])
    got = {r.im_id: r for r in toxicity_severity(table, judged).collect()}
    tested = [(i, y) for i, _, y in rows if i % 5 == 0]
    assert sum((got[i].score >= 0.5) == bool(y) for i, y in tested) / len(tested) > 0.97
    assert all(0 <= r.severity <= 2 and 0 <= r.grade <= 2 for r in got.values())
    mild, strong = ([got[i].severity for i, _, y in rows if y and i % 5 == n] for n in (0, 4))
    assert sum(strong) / len(strong) > sum(mild) / len(mild)
    assert len(got) == 600 + len(odd_rows) and got[1001].score == got[1002].score
    nothing = spark.createDataFrame([], "im_id bigint, toxic int")
    assert [r.score for r in toxicity_severity(image_rows([(1, "a")]), nothing).collect()] == [0.5]
    assert toxicity_severity(image_rows([]), nothing).count() == 0


def test_toxicity_of_given_grades(spark, image_rows):
    rows = [(i, f"plain words {'bad ' if i % 3 else ''}{'awful ' if i % 3 == 2 else ''}here") for i in range(90)]
    judged = spark.createDataFrame([(i, i % 3) for i in range(90)], "im_id bigint, toxic int")
    got = {r.im_id: r.grade for r in toxicity_severity(image_rows(rows), judged).collect()}
    assert got == {i: i % 3 for i in range(90)}


RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("b.c", "", "block"),
    ("b.c", "/x", "allow"),
    ("B.c", "/x", "block"),
    (None, "/", "block"),
]


def test_urls(spark):
    urls = [None, "", "no scheme", "http://", "http://Example.COM/en/x?y#z", "https://a.WWW.example.com/en/", "ftp://x.net/es/..", "x://net/es"]
    urls += ["x://net/es/", "http://notexample.com/en/", "http://a.b.c", "http://b.c/x/y", "http://com", "http://com/", "http://com?/", "a://b://c.com/q"]
    urls += ["http://.com/", "http://a..com/x", "http://" + "a." * 300 + "com/" + "p" * 3000, "http://ÉX.com/é"] * 2
    rows = spark.createDataFrame([(n, u, "x", "y") for n, u in enumerate(urls)], "im_id bigint, im_url string, keys string, best string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = {r.im_id: (r.host, r.path, r.rule, r.verdict) for r in url_verdicts(rows, rules).collect()}
    assert got == {n: plain.verdict(u, RULES) for n, u in enumerate(urls)}
    assert {r.verdict for r in url_verdicts(rows, rules.limit(0), "block").collect()} == {"block"}
    assert url_verdicts(rows.limit(0), rules).count() == 0


def test_urls_with_many_rules(spark):
    chance = random.Random(8)
    rules = [(f"h{n}.com", f"/{chance.randrange(9)}", chance.choice(["allow", "block"])) for n in range(5000)]
    urls = [(n, f"http://s.h{chance.randrange(9000)}.com/{chance.randrange(9)}/x") for n in range(3000)]
    got = url_verdicts(spark.createDataFrame(urls, "im_id bigint, im_url string"), spark.createDataFrame(rules, "host string, path string, verdict string"))
    by_host = {h: (h, p, v) for h, p, v in rules}
    want = {n: plain.verdict(u, [r for r in [by_host.get(u.split("/")[2][2:])] if r]) for n, u in urls}
    assert {r.im_id: (r.host, r.path, r.rule, r.verdict) for r in got.collect()} == want


@pytest.mark.parametrize("kind", ["dense", "sparse", "ties"])
def test_best_matches(spark, kind, monkeypatch):
    import math

    import boxloom.llm.top_search as T

    monkeypatch.setattr(T, "SHARD_ROWS", 150)
    monkeypatch.setattr(T, "BLOCK_ROWS", 10)
    chance = random.Random(kind)
    make = {
        "dense": lambda: [chance.gauss(0, 0.2) for _ in range(24)],
        "sparse": lambda: [chance.gauss(0, 1) if chance.random() < 0.1 else 0.0 for _ in range(chance.randrange(20, 40))],
        "ties": lambda: [chance.choice([-0.5, 0.5, 0.0]) for _ in range(3)],
    }[kind]
    rows = [(n, make()) for n in range(700)]
    rows += [(700, None), (701, [0.1, None]), (702, [float("nan"), 1.0]), (703, [float("inf")]), (704, []), (None, [1.0]), (5, rows[5][1])]
    df = spark.createDataFrame(rows, "im_id bigint, embedding array<double>").selectExpr("*", "1 as rank", "2 as mark")
    got = best_matches(df, df.filter("im_id % 35 = 0 or im_id in (701, 704, 5)"), k=7).collect()
    good = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for i, v in {i: v for i, v in good if i % 35 == 0 or i in (5, 704)}.items():
        scores = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), j) for j, w in good if j != i)[:7]
        want += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scores)]
    assert sorted(map(tuple, got)) == sorted(want)
    assert best_matches(df.limit(0), df).count() == 0 and best_matches(df, df.limit(0)).count() == 0


def test_edited_counts(spark, image_rows, odd_rows):
    import tiktoken

    path = tokenizer_file("byte_bpe_50k.tiktoken")
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    plain_count = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    chance = random.Random(6)
    texts = [t for _, t in odd_rows if t is None or len(t) < 5000] + ["  lead", "trail  ", "a\n\n  b", "don't  stop 12 345!?", "\u00a0x\u00a0 y"]
    texts += ["".join(chance.choice("ab c\n'1é日") for _ in range(chance.randrange(600))) for _ in range(60)]
    edits, want = [], {}
    for i, text in enumerate(texts):
        after, own = text, []
        cuts = sorted(chance.sample(range(len(text or "") + 1), min(len(text or "") + 1, 2 * chance.randrange(4))))
        for s, e in zip(cuts[::2], cuts[1::2], strict=False):
            own.append((s, chance.choice([s, e]), chance.choice(["", " ", "x", "'s", " new words\n", "  ", None])))
        for s, e, r in reversed(own):
            after = after[:s] + (r or "") + after[e:]
        edits += [(i, s, e, r) for s, e, r in own]
        want[i] = (after, len(plain_count.encode_ordinary(text or "")), len(plain_count.encode_ordinary(after or "")))
    edits += [(None, 0, 1, "x"), (999, 0, 1, "x"), (0, None, 1, "x")]
    table = spark.createDataFrame(edits, "im_id bigint, start int, end int, replacement string")
    rows = edited_trees(token_trees(image_rows(list(enumerate(texts))), path), table, path).collect()
    assert {r.im_id: (r.im_description, r.n_tokens_before, r.n_tokens) for r in rows} == want
    for r in rows:
        for tree in (r.token_tree, r.length_tree):
            assert all(tree[n] == tree[2 * n] + tree[2 * n + 1] for n in range(1, len(tree) // 2))
    assert edited_trees(token_trees(image_rows([]), path), table, path).count() == 0


WIDE = [0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def test_token_counts_beside_wide_blanks(spark, image_rows):
    """Pre-tokens cross ASCII blanks beside other white space."""
    import base64
    import random

    import tiktoken

    path = tokenizer_file("byte_bpe_50k.tiktoken")
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    whole = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    chance = random.Random(9)
    texts = ["x \u00a0 \u00a0 y"]
    texts += [f"x{c} y {c} z {c}{c} \n {c}w" for c in map(chr, WIDE)]
    pieces = [" ", " ", "\n", "\u00a0", "\u3000", "\x85", "\u2009", "a", "word", "\u4e2d", "\u0120", "\U0001f600", "\x1c", "\u200b", "7", "'s", "!"]
    texts += ["".join(chance.choice(pieces) for _ in range(chance.randrange(1, 300))) for _ in range(300)]
    edits, want = [], {}
    for i, text in enumerate(texts):
        at = chance.randrange(len(text))
        new = chance.choice([" \u00a0", "\u3000 ", "b", ""])
        edits.append((i, at, min(at + 2, len(text)), new))
        after = text[:at] + new + text[at + 2 :]
        want[i] = (after, len(whole.encode_ordinary(text)), len(whole.encode_ordinary(after)))
    table = spark.createDataFrame(edits, "im_id bigint, start int, end int, replacement string")
    rows = edited_trees(token_trees(image_rows(list(enumerate(texts))), path), table, path).collect()
    assert {r.im_id: (r.im_description, r.n_tokens_before, r.n_tokens) for r in rows} == want


def test_repeated_rows_are_edited_once(image_rows):
    """Rows of one id, equal or not, each get their own edits."""
    texts = [(1, "one two three four"), (1, "one two three four"), (1, "another text of this id"), (2, "word"), (None, "no id at all"), (None, "no id at all"), (3, ""), (4, None)]

    def edited(text):
        n = len(text or "")
        return text[: n // 3] + " edited " + text[min(n // 3 + 5, n) :] + "\nLine 1 added." if n else text

    rows = edited_texts(image_rows(texts), tokenizer_file("byte_bpe_50k.tiktoken")).collect()
    assert sorted((r.im_id or 0, r.im_description or "") for r in rows) == sorted((i or 0, edited(t) or "") for i, t in texts)


def test_few_runs_are_counted_again(spark, image_rows):
    path = tokenizer_file("byte_bpe_50k.tiktoken")
    edits = spark.createDataFrame([(1, 50_000, 50_003, "new")], "im_id bigint, start int, end int, replacement string")
    row = edited_trees(token_trees(image_rows([(1, "some word " * 20_000)]), path), edits, path).first()
    assert row.n_runs > 39_000 and row.n_recounted < 200


def test_samples_hold_one_row_of_an_id(spark, image_rows):
    """An id that many rows repeat does not go beyond the bound."""
    from boxloom.llm.sampled import judged_sample

    rows = image_rows([(1, f"text {n}") for n in range(50)] + [(2, None), (2, None), (3, "own"), (None, "x")])
    judged = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (3, 0), (4, 1)], "im_id bigint, quality int")
    got = [tuple(r) for r in judged_sample(rows, judged, "quality", 100).select("im_id", "mark", "im_description").collect()]
    assert sorted(r[:2] for r in got) == [(1, 0), (1, 1), (2, 1), (3, 0)]
    assert {(2, 1, None), (3, 0, "own")} <= set(got) and len({r[2] for r in got if r[0] == 1}) == 1


def test_chunks_of_copies_have_their_own_keys(image_rows):
    """Chunks of one text repeated are not joined in one call."""
    import pyarrow as pa

    from boxloom.llm.tokens import _place_rows, _word_rows

    text = "the same few words again"
    batches = [pa.RecordBatch.from_arrays([pa.array(range(100)), pa.array([text] * 100)], names=["im_id", "im_description"])] * 2
    keys = [k for b in _place_rows(8, 500)(iter(batches)) for k in b.column("chunk").to_pylist()]
    assert len(keys) > 3 and len(set(keys)) == len(keys)
    assert set(keys) == {k for b in _word_rows(8, 500)(iter(batches)) for k in b.column("chunk").to_pylist()}
    got = token_ids(image_rows([(n, text) for n in range(60)]), tokenizer_file("word_bpe_49k.json"), chunk_bytes=500)
    want = token_ids(image_rows([(0, text)]), tokenizer_file("word_bpe_49k.json")).first()
    assert want.n_tokens and sorted(map(tuple, got.collect())) == [(n, *want[1:]) for n in range(60)]


def test_token_ids(image_rows, odd_rows):
    import struct

    from tokenizers import Tokenizer

    path = tokenizer_file("word_bpe_49k.json")
    plain_tokens = Tokenizer.from_file(path)
    extra = ["Hello <|endoftext|> don't I'LL", "<|startoftext|>x<|endoftext|>y", "İstanbul ΣΑΣ ﬁ ǅ", "x\u0301 \u0301y e\u0301", "\u00a0", "a\u00a0b\u3000c\x1cd\x85e", "l" * 5000]
    rows = odd_rows + [(100 + n, t) for n, t in enumerate(extra)]
    got = token_ids(image_rows(rows), path).collect()
    want = []
    for i, text in rows:
        ids = plain_tokens.encode(text or "", add_special_tokens=False).ids
        want.append((i, len(ids), struct.pack(f"<{len(ids)}I", *ids), plain_tokens.decode(ids, skip_special_tokens=False)))
    assert sorted(((r.im_id, r.n_tokens, bytes(r.token_ids), r.decoded) for r in got), key=str) == sorted(want, key=str)
    small = token_ids(image_rows(rows), path, chunk_bytes=300).collect()
    assert sorted(map(str, small)) == sorted(map(str, got))
    assert token_ids(image_rows([]), path).count() == 0
    names = token_ids(image_rows([("a", "one"), (None, None)], "string"), path).select("im_id", "n_tokens").collect()
    assert sorted(map(tuple, names), key=str) == [("a", 1), (None, 0)]


def test_very_long_hosts_are_judged_at_once(spark):
    """A host of 1 MB in half a million labels; a rule's path of thousands of lengths."""
    import time

    urls = [(1, "http://" + "a." * 500_000 + "Example.com/en/x"), (2, "http://" + "." * 1_000_000), (3, "http://" + "a" * 1_000_000 + ".net/" + "y" * 3000)]
    rules = [("example.com", "/en/", "block"), ("a.b.c.example.com", "/", "allow"), *[("net", "/" + "y" * n, "block") for n in range(1, 2000)]]
    rows = spark.createDataFrame(urls, "im_id bigint, im_url string")
    listed = spark.createDataFrame(rules, "host string, path string, verdict string")
    url_verdicts(rows.limit(1), listed).collect()
    begin = time.time()
    got = {r["im_id"]: (r["rule"], r["verdict"]) for r in url_verdicts(rows, listed).select("im_id", "rule", "verdict").collect()}
    assert got == {1: ("example.com/en/", "block"), 2: (None, "allow"), 3: ("net/" + "y" * 1999, "block")}
    assert time.time() - begin < 30
