"""Web archives of image files: WARC records with revisits, and capture histories merged from the archives' indexes.

Records are written by Spark's text writer: two line breaks end a record, so they are the writer's line separator, and
commits, retries and the file system are Spark's.  An archive is one gzip file, which one task reads back.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from boxloom.llm.frames import Batches, in_tasks
from boxloom.llm.loser_tree import LoserTree
from boxloom.operators.groups import attach_one_per_key
from boxloom.session import checkpointed

BREAK = "\r\n"
END = BREAK * 2
URN = "urn:boxloom:image"
# Captures of one payload beyond which its rows are dealt out instead of meeting by the payload's digest.
MANY = 1 << 16
# Index rows that one task merges.
RANGE_ROWS = 1 << 18
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_RECORD = (
    "im_id string, im_url string, captured timestamp, record_type string, refers_to string, payload_bytes bigint, payload_digest string, "
    "intact boolean, archive string, offset bigint"
)


def base32(hexadecimal: Column) -> Column:
    """Upper-case base32 of a hexadecimal text of a multiple of five digits, built from groups of 20 bits."""

    def letters(at: Column) -> Column:
        bits = F.conv(F.substr(hexadecimal, at * 5 + 1, F.lit(5)), 16, 10).cast("int")
        fives = [F.substr(F.lit(_BASE32), F.shiftright(bits, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
        return F.concat(*fives)

    return F.array_join(F.transform(F.sequence(F.lit(0), (F.length(hexadecimal) / 5).cast("int") - 1), letters), "")


def url_key(url: Column) -> Column:
    """Sort key of a URL: reversed host labels, a bracket, path and query in lower case; equal for both protocols."""
    rest = F.lower(F.regexp_replace(url, r"^[^:/?#]*://|#.*$", ""))
    host = F.regexp_extract(rest, r"^[^/?]*", 0)
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.substr(rest, F.length(host) + 1))


def _named(im_id: Column) -> Column:
    return F.concat(F.lit(f"<{URN}"), F.coalesce(F.concat(F.lit(":"), F.url_encode(im_id.cast("string"))), F.lit("")), F.lit(">"))


def marked_revisits(captures: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``captures`` (``im_id``, ``im_url``, ``content``, ``captured``) with ``record_type`` and ``refers_to``.

    Of captures with equal content the one with the largest id is the response, the others are its revisits.
    """
    rows = captures.select(
        "im_id", F.col("im_url").cast("string").alias("im_url"), F.coalesce(F.col("content").cast("binary"), F.lit(b"")).alias("content"),
        F.col("captured").cast("timestamp").alias("captured"),
    )
    key = F.unhex(F.sha2("content", 256))
    long = F.octet_length("content") >= least_bytes
    counts = rows.filter(long).groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n"), F.max("im_id").alias("keeper"))
    repeated = checkpointed(counts.filter(F.col("n") > 1))
    # Contents of very many captures, at most one in MANY rows, don't meet by their digest; the rest are joined by it.
    many = repeated.filter(F.col("n") > MANY).select("key", F.col("keeper").alias("much"))
    rows = attach_one_per_key(rows.withColumn("key", F.when(long, key).otherwise(F.lit(b""))), many, ["key"], "left")
    spread = F.coalesce(F.when(F.col("much").isNull() & long, F.col("key")), F.unhex(F.sha2(F.concat("key", F.coalesce(F.col("im_id").cast("string").cast("binary"), F.lit(b""))), 256)))
    few = repeated.filter(F.col("n") <= MANY).select(F.col("key").alias("one"), F.col("keeper").alias("little"))
    rows = rows.withColumn("one", spread).join(few, "one", "left")
    keeper = F.coalesce("much", "little")
    first = keeper.isNull() | F.coalesce(F.col("im_id") == keeper, F.lit(False))
    return rows.select(
        "im_id", "im_url", "content", "captured", F.when(first, "response").otherwise("revisit").alias("record_type"), F.when(~first, keeper).alias("refers_to")
    )


def write_archives(captures: DataFrame, folder: str, least_bytes: int = 0, most_records: int = 100_000) -> None:
    """Write one WARC record per capture into gzip archives in ``folder``, in at most ``most_records`` to an archive.

    ``captures`` are downloaded image files: ``im_id``, ``im_url``, ``content`` (bytes or text, NULL: empty) and ``captured`` (a
    timestamp, NULL: 1970).  Of equal contents of at least ``least_bytes`` bytes the one with the largest ``im_id`` is a response, the others
    are revisits without content that refer to it; rows that repeat the largest id are responses too, and so are all
    where no id is known.  Further columns take no part.  An empty table gives an empty folder.
    """
    rows = marked_revisits(captures, least_bytes)
    size = F.octet_length("content").cast("string")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{BREAK}Content-Type: application/octet-stream{BREAK}Content-Length: "), size, F.lit(END))
    block = F.when(F.col("record_type") == "response", F.concat(http.cast("binary"), "content")).otherwise(http.cast("binary"))
    when = F.to_utc_timestamp(F.coalesce("captured", F.timestamp_seconds(F.lit(0))), F.current_timezone())
    uri = F.col("im_url")
    for sign, code in (("\r", "%0D"), ("\n", "%0A")):
        uri = F.replace(uri, F.lit(sign), F.lit(code))

    def field(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(BREAK)), F.lit(""))

    head = F.concat(
        F.lit(f"WARC/1.1{BREAK}"),
        field("WARC-Type", F.col("record_type")),
        field("WARC-Record-ID", _named(F.col("im_id"))),
        field("WARC-Date", F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")),
        field("WARC-Target-URI", uri),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.sha1("content")))),
        field("X-Payload-Bytes", size),
        field("WARC-Refers-To", F.when(F.col("refers_to").isNotNull(), _named(F.col("refers_to")))),
        field("WARC-Profile", F.when(F.col("record_type") == "revisit", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        field("Content-Type", F.lit("application/http;msgtype=response")),
        field("Content-Length", F.octet_length(block).cast("string")),
        F.lit(BREAK),
    )
    record = F.concat(head.cast("binary"), block).cast("string")
    rows.select(record.alias("record")).write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", most_records).text(folder)


class _Stream:
    """Records of one archive out of the pieces between its double line breaks."""

    def __init__(self, archive: str):
        self.archive, self.buffer, self.start = archive, bytearray(), 0

    def records(self, piece: bytes) -> Iterator[tuple]:
        self.buffer += piece
        self.buffer += b"\r\n\r\n"
        while True:
            blank = 0
            while self.buffer[blank : blank + 2] == b"\r\n":
                blank += 2
            stop = self.buffer.find(b"\r\n\r\n", blank)
            if stop < 0:
                return
            fields = {}
            for line in bytes(self.buffer[blank:stop]).split(b"\r\n")[1:]:
                name, _, value = line.partition(b":")
                fields[name.strip().lower()] = value.strip()
            begin = stop + 4
            end = begin + int(fields.get(b"content-length", b"0"))
            if len(self.buffer) < end + 4:
                return
            block, at = bytes(self.buffer[begin:end]), self.start + blank
            del self.buffer[: end + 4]
            self.start += end + 4
            yield at, fields, block


def _id(value: bytes | None) -> str | None:
    from urllib.parse import unquote_plus

    text = (value or b"").decode().strip("<>")
    if text.startswith(URN):
        return unquote_plus(text[len(URN) + 1 :]) if len(text) > len(URN) else None
    return text or None


def _parsed(archive: str, at: int, fields: dict[bytes, bytes], block: bytes) -> tuple | None:
    from datetime import datetime, timezone

    kind = fields.get(b"warc-type", b"").decode()
    if kind not in ("response", "revisit", "resource"):
        return None
    payload = block
    if fields.get(b"content-type", b"").startswith(b"application/http"):
        payload = block.partition(b"\r\n\r\n")[2]
    stated = fields.get(b"warc-payload-digest", b"").decode().removeprefix("sha1:") or None
    size, digest, intact = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), True
    if kind == "revisit":
        length = fields.get(b"x-payload-bytes")
        size, digest = int(length) if length else None, stated
    elif stated:
        intact = stated == digest
    date = fields.get(b"warc-date", b"1970-01-01T00:00:00Z").decode().replace("Z", "+00:00")
    captured = datetime.fromisoformat(date).astimezone(timezone.utc)
    url = fields[b"warc-target-uri"].decode(errors="replace") if b"warc-target-uri" in fields else None
    refers = _id(fields[b"warc-refers-to"]) if b"warc-refers-to" in fields else None
    return _id(fields.get(b"warc-record-id")), url, captured, kind, refers, size, digest, intact, archive, at


def _read(batches: Batches) -> Batches:
    types = [pa.string(), pa.string(), pa.timestamp("us", "UTC"), pa.string(), pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.string(), pa.int64()]
    names = [c.split()[0] for c in _RECORD.split(", ")]
    stream = _Stream("")
    for batch in batches:
        rows = []
        for piece, archive in zip(batch.column("value"), batch.column("archive").to_pylist()):
            if archive != stream.archive:
                stream = _Stream(archive)
            for at, fields, block in stream.records(piece.as_py() or b""):
                row = _parsed(archive, at, fields, block)
                if row is not None:
                    rows.append(row)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Index of the records in the gzip archives of ``folder``, each archive's in its order.

    ``im_id`` (text), ``im_url``, ``captured``, ``record_type``, ``refers_to``, ``payload_bytes`` and ``payload_digest`` (SHA-1 in base32) of the full payload,
    ``intact`` (the digest fits what was read), ``archive``, and ``offset`` in it before compression.  A revisit has size and digest from its
    header.  Responses, revisits and resources are read, other records are skipped.
    """
    pieces = spark.read.option("lineSep", END).option("recursiveFileLookup", True).text(folder)
    pieces = pieces.select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("archive"))
    return in_tasks(pieces, _read, _RECORD)


_MERGED = _RECORD + ", url_key string, stretch int, place bigint"


def _merge(batches: Batches) -> Batches:
    """One range of the keys: the slices of all runs are merged by a loser tree."""
    from pyspark import TaskContext

    held = list(batches)
    if not held:
        return
    rows = pa.Table.from_batches(held).combine_chunks()
    runs = rows["archive"].combine_chunks().dictionary_encode()
    code = runs.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(code, kind="stable")
    columns = [rows[c].to_pylist() for c in ("url_key", "im_id")] + [rows["captured"].cast(pa.int64()).to_pylist(), rows["offset"].to_pylist()]
    keys = [(k is not None, k or "", t, i is not None, i or "", o) for k, i, t, o in zip(*columns)]
    places = np.split(order, np.flatnonzero(np.diff(code[order])) + 1)
    slices = []
    for some in places:
        run = [keys[i] for i in some]
        # A run comes in its own order, as one task reads an archive; a shuffle that was fetched otherwise is put in order.
        if any(b < a for a, b in zip(run, run[1:])):
            some = np.array(sorted(some, key=keys.__getitem__))
            run = [keys[i] for i in some]
        slices.append((some, run))
    tree = LoserTree([run for _, run in slices])
    merged = np.fromiter((slices[r][0][at] for r, at in tree), np.int64, len(keys))
    out = rows.take(pa.array(merged))
    out = out.append_column("stretch", pa.array(np.full(len(keys), TaskContext.get().partitionId()), pa.int32()))
    out = out.append_column("place", pa.array(np.arange(1, len(keys) + 1)))
    yield from out.to_batches()


def capture_histories(records: DataFrame) -> DataFrame:
    """Records of ``read_archives`` in the order of URL key, time and id, with ``url_key`` and ``place`` (from 1, over all archives).

    The index of each archive is a run, sorted where it is read.  Runs are cut at common borders, and each range of keys is
    merged from its slices by a loser tree; the totals of the ranges before give the place.  The ranges are cut by
    time and id as well, so one URL may have most captures.  Unknown URLs come first.
    """
    order = [F.col(c).asc_nulls_first() for c in ("url_key", "captured", "im_id", "offset")]
    runs = checkpointed(records.withColumn("url_key", url_key(F.col("im_url"))).sortWithinPartitions("archive", *order))
    ranges = max(1, -(-runs.count() // RANGE_ROWS))
    dealt = runs.repartitionByRange(ranges, *order)
    merged = checkpointed(in_tasks(dealt.select(*[c.split()[0] for c in _RECORD.split(", ")], "url_key"), _merge, _MERGED))
    totals = merged.groupBy("stretch").agg(F.count(F.lit(1)).alias("n"))
    before = totals.select("stretch", F.coalesce(F.sum("n").over(W.orderBy("stretch").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    # One row per range of RANGE_ROWS rows.
    return merged.join(before, "stretch").withColumn("place", F.col("place") + F.col("before")).drop("stretch", "before")
