"""Verdicts on image URLs by listed hosts and paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of 64 bits of the filter; more rules only let more false hits through to the join.
MOST_WORDS = 1 << 17
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def _mask(hashed: Column) -> Column:
    """Four bits of one word, from the upper parts of a hash."""
    one = F.lit(1).cast("bigint")
    mask = F.lit(0).cast("bigint")
    for shift in (58, 52, 46, 40):
        place = F.shiftrightunsigned(hashed, shift).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", one, place))
    return mask


def _filter_words(listed: DataFrame, n_words: int, *key: str) -> list[int]:
    """Words of the blocked Bloom filter of the listed keys."""
    hashed = F.xxhash64(*key)
    block = F.pmod(hashed, F.lit(n_words)).cast("int")
    words = [0] * n_words
    for row in listed.select(block.alias("block"), _mask(hashed).alias("mask")).groupBy("block").agg(F.bit_or("mask").alias("word")).collect():
        words[row["block"]] = row["word"]
    return words


def _fitting(filter_words: list[int], keys: Column, *fields: str) -> Column:
    """Keys (structs of ``fields``, or plain values) that a word of the filter has all bits of."""
    words = F.from_json(F.lit("[" + ",".join(map(str, filter_words)) + "]"), "array<bigint>")
    n = len(filter_words)

    def fits(key: Column) -> Column:
        hashed = F.xxhash64(*([key[f] for f in fields] or [key]))
        word = F.get(words, F.pmod(hashed, F.lit(n)).cast("int"))
        return word.bitwiseAND(_mask(hashed)) == _mask(hashed)

    return F.filter(keys, fits)


def url_verdicts(images: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """Judge the ``im_url`` of image rows by listed URLs.

    ``images`` has ``im_id`` and ``im_url``; ``rules`` has ``host``, ``path`` and ``verdict`` (``allow`` or ``block``).
    A rule fits its host and all subdomains if the URL's path starts with the rule's; the longest fitting rule wins
    (host and path together; of equal ones the longer host, then ``block``).

    The canonical forms of a URL (each parent domain of as many labels as some rule's host, with each start of the path as long as some
    rule's path) are tested with blocked Bloom filters, first the domains alone, then whole forms: one 64-bit word per rule, four bits in it.  URLs without a hit get ``default`` where they
    are; the others go to an exact hash join with the rules, once per distinct host and path.  The filter is bounded
    (1 MB): a longer list raises false hits, not errors.

    One row per input row: ``im_id``, ``host``, ``path``, ``rule`` (host and path; NULL if none fits), ``verdict``.  NULL
    URLs and those without ``://`` have empty host and path.  Rules with a NULL are ignored; no rules give ``default``.
    Repeated rows are judged each; further columns are left out.
    """
    listed = rules.select(F.translate("host", _UPPER, _LOWER).alias("host"), "path", "verdict").dropna()
    listed = listed.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    totals = listed.agg(F.count(F.lit(1)).alias("n"), F.collect_set(F.length("path")).alias("lengths"), F.collect_set(F.size(F.split("host", r"\.", -1))).alias("labels")).first()
    n_words = min(MOST_WORDS, max(1024, totals["n"]))
    host_words = _filter_words(listed, n_words, "host")
    filter_words = _filter_words(listed, n_words, "host", "path")

    lengths = F.array(*[F.lit(n) for n in sorted(totals["lengths"])]).cast("array<int>")
    counts = F.array(*[F.lit(n) for n in sorted(totals["labels"])]).cast("array<int>")

    def keyed_url(url: Column) -> Column:
        labels, path = url["labels"], url["path"]
        # A host may have any number of labels; only domains of as many labels as some rule's host are built.
        some = F.filter(counts, lambda n: n <= url["n_labels"])
        domains = F.transform(some, lambda n: F.array_join(F.slice(labels, url["n_labels"] - n + 1, n), "."))
        starts = F.transform(F.filter(lengths, lambda n: n <= url["length"]), lambda n: F.substring(path, F.lit(1), n))
        known = _fitting(host_words, domains)
        keys = F.flatten(F.transform(known, lambda host: F.transform(starts, lambda start: F.struct(host.alias("host"), start.alias("path")))))
        return F.struct(url["host"].alias("host"), path.alias("path"), _fitting(filter_words, keys, "host", "path").alias("keys"))

    host, path = F.coalesce(url_host(F.col("im_url")), F.lit("")), F.coalesce(url_path(F.col("im_url")), F.lit(""))
    labels = F.split(host, r"\.", -1)
    parts = F.struct(host.alias("host"), path.alias("path"), labels.alias("labels"), F.size(labels).alias("n_labels"), F.length(path).alias("length"))
    # As an array of one, so that the parts are cut once and not again for every length.
    tested = images.select("im_id", F.get(F.transform(F.array(parts), keyed_url), F.lit(0)).alias("url")).select("im_id", "url.*")

    hits = tested.filter(F.size("keys") > 0)
    distinct = hits.select("host", "path", "keys").distinct()
    keyed = distinct.select("host", "path", F.explode("keys").alias("key"))
    keyed = keyed.select("host", "path", F.col("key.host").alias("rule_host"), F.col("key.path").alias("rule_path"))
    exact = listed.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "verdict")
    order = F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("length"),
        F.length("rule_host").alias("host_length"),
        F.col("verdict").alias("verdict"),
        F.concat("rule_host", "rule_path").alias("rule"),
    )
    best = keyed.join(exact, ["rule_host", "rule_path"]).groupBy("host", "path").agg(F.max(order).alias("best"))
    judged = hits.drop("keys").join(best, ["host", "path"], "left").select(
        "im_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )
    rest = tested.filter(F.size("keys") == 0)
    return judged.unionByName(
        rest.select("im_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    )
