"""Archives written and read back, revisits, and merged histories."""

import base64
import gzip
import hashlib
import random
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from boxloom.llm import warc
from boxloom.llm.loser_tree import LoserTree
from boxloom.llm.warc import capture_histories, marked_revisits, read_archives, write_archives

CAPTURES = "im_id bigint, im_url string, content binary, captured timestamp"
NASTY = [
    b"", b"\r\n", b"\r\n\r\n", b"\r\n\r\n\r\n", b"\r\r\n\r\n", b"a\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\nb", b"\xff\xd8\xff\x00\n\r\x00", b"tail\r", b"tail\r\n",
    b"\n\r\n\r\n\r", b"x" * 300_000, "é日本".encode(),
]


def when(second):
    return datetime.fromtimestamp(second, timezone.utc)


def made(spark, rows):
    df = spark.createDataFrame(rows, CAPTURES).repartition(3)
    return df.select("*", *[F.lit("x").alias(c) for c in ("key", "keeper", "one", "record_type", "archive")])


def digest(content):
    return base64.b32encode(hashlib.sha1(content or b"").digest()).decode()


def plain(rows, least=0):
    keeper = {}
    for i, _, content, _ in rows:
        c = content or b""
        if len(c) >= least and i is not None:
            keeper[c] = max(i, keeper.get(c, i))
    out = []
    for i, url, content, at in rows:
        c = content or b""
        first = len(c) < least or keeper.get(c) is None or i == keeper[c]
        out.append((i, url, at or when(0), "response" if first else "revisit", None if first else keeper[c], len(c), digest(c)))
    return out


def by_text(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, str(v)) for v in r))


def read_back(spark, folder):
    got = read_archives(spark, folder).collect()
    assert all(r["intact"] for r in got)
    num = lambda v: None if v is None else int(v)
    return [(num(r["im_id"]), r["im_url"], r["captured"].astimezone(timezone.utc), r["record_type"], num(r["refers_to"]), r["payload_bytes"], r["payload_digest"]) for r in got]


def captures():
    rows = [(n, f"https://a.example.com/{n}", content, when(1000 + n)) for n, content in enumerate(NASTY)]
    rows += [(100 + n, "http://b.example.com/x?y=1", content, when(50 - n)) for n, content in enumerate(NASTY)]
    rows += [(100, "http://b.example.com/x?y=1", b"", when(50)), (None, None, None, None), (None, "no protocol", b"only unknown", when(5)), (300, "ü\r\nX: y", None, None)]
    return rows


@pytest.mark.parametrize("least,many", [(0, 1 << 16), (0, 1), (6, 1 << 16)])
def test_round_trip(spark, tmp_path, monkeypatch, least, many):
    monkeypatch.setattr(warc, "MANY", many)
    rows = captures()
    write_archives(made(spark, rows), f"{tmp_path}/w", least, most_records=4)
    got = read_back(spark, f"{tmp_path}/w")
    expected = [(i, u.replace("\r", "%0D").replace("\n", "%0A") if u else u, *rest) for i, u, *rest in plain(rows, least)]
    assert by_text(got) == by_text(expected)


def test_text_ids(spark, tmp_path):
    rows = [("a/b <c>%", "u", "text", None), ("", "u", "text", None), ("ü", "v", "other", None)]
    write_archives(spark.createDataFrame(rows, "im_id string, im_url string, content string, captured timestamp"), f"{tmp_path}/w")
    got = {(r["im_id"], r["record_type"], r["refers_to"]) for r in read_archives(spark, f"{tmp_path}/w").collect()}
    assert got == {("a/b <c>%", "response", None), ("", "revisit", "a/b <c>%"), ("ü", "response", None)}


def test_no_rows(spark, tmp_path):
    write_archives(spark.createDataFrame([], CAPTURES), f"{tmp_path}/w")
    assert capture_histories(read_archives(spark, f"{tmp_path}/w")).collect() == []


def test_other_archives(spark, tmp_path):
    """A gzip member per record, other record types, resources, a changed payload."""
    def record(kind, block, *more):
        head = "\r\n".join(["WARC/1.0", f"WARC-Type: {kind}", "WARC-Record-ID: <urn:uuid:1>", *more, f"Content-Length: {len(block)}"])
        return gzip.compress(head.encode() + b"\r\n\r\n" + block + b"\r\n\r\n")

    parts = [
        record("warcinfo", b"software: x\r\n"), record("resource", b"\r\nraw\r\n", f"WARC-Payload-Digest: sha1:{digest(b'raw')}", "WARC-Date: 2020-01-02T03:04:05Z"),
        record("response", b"HTTP/1.1 200 OK\r\n\r\nbody", "Content-Type: application/http; msgtype=response", f"warc-payload-digest: sha1:{digest(b'body')}"),
        record("revisit", b"", "WARC-Refers-To: <urn:uuid:0>", "WARC-Payload-Digest: sha1:ABC"),
    ]
    (Path(tmp_path) / "a.warc.gz").write_bytes(b"".join(parts))
    got = read_archives(spark, str(tmp_path)).orderBy("offset").collect()
    assert [(r["record_type"], r["payload_bytes"], r["intact"], r["refers_to"]) for r in got] == [
        ("resource", 7, False, None), ("response", 4, True, None), ("revisit", None, True, "urn:uuid:0")
    ]
    assert got[2]["payload_digest"] == "ABC" and got[0]["captured"].astimezone(timezone.utc) == datetime(2020, 1, 2, 3, 4, 5, tzinfo=timezone.utc)
    plain_bytes = gzip.decompress(b"".join(parts))
    assert all(plain_bytes[r["offset"] :].startswith(b"WARC/1.0\r\nWARC-Type: " + r["record_type"].encode()) for r in got)


@pytest.mark.parametrize("range_rows", [1 << 18, 7])
def test_histories(spark, tmp_path, monkeypatch, range_rows):
    monkeypatch.setattr(warc, "RANGE_ROWS", range_rows)
    chance = random.Random(range_rows)
    rows = [(n, chance.choice([None, "http://www.a.org/p", "https://a.org/P#f", "http://b.a.org/"]), b"%d" % n, when(chance.randrange(5))) for n in range(60)]
    write_archives(made(spark, rows), f"{tmp_path}/w", most_records=9)
    got = capture_histories(read_archives(spark, f"{tmp_path}/w")).orderBy("place").collect()
    keys = {None: None, "http://www.a.org/p": "org,a,www)/p", "https://a.org/P#f": "org,a)/p", "http://b.a.org/": "org,a,b)/"}
    assert [r["place"] for r in got] == list(range(1, 61)) and all(r["url_key"] == keys[r["im_url"]] for r in got)
    order = [(r["url_key"] is not None, r["url_key"] or "", r["captured"], r["im_id"]) for r in got]
    assert order == sorted(order)
    assert by_text([(int(r["im_id"]), r["im_url"]) for r in got]) == by_text([r[:2] for r in rows])


def test_types_of_revisits(spark):
    got = marked_revisits(made(spark, captures()))
    assert got.columns == ["im_id", "im_url", "content", "captured", "record_type", "refers_to"]


def test_loser_tree():
    chance = random.Random(1)
    for k in (0, 1, 2, 3, 5, 8, 13):
        runs = [sorted(chance.randrange(20) for _ in range(chance.randrange(9))) for _ in range(k)]
        got = list(LoserTree(runs))
        assert got == sorted(((r, at) for r, run in enumerate(runs) for at in range(len(run))), key=lambda e: (runs[e[0]][e[1]], e[0], e[1]))
