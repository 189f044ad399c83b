"""Samples by paid models: rows are asked round by round in the seeded order, and the rounds end at the target.

The order, the batches and repeated content need no model, so they are one plan, written once.  Then a driver loop
asks the models for one round at a time.  Answers go to result stores: a run that failed asks only what is missing when it
is started again, and takes the same course.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxloom.functions import text as T
from boxloom.operators import annotate, catalog
from boxloom.operators import sampling as S
from boxloom.operators.store import ResultStore
from boxloom.session import checkpoint_dir, checkpointed, forget


@dataclass(frozen=True)
class Asked:
    """A model, the store of its answers and the options of its calls."""

    model: annotate.RowAnnotator
    store: ResultStore
    options: dict = field(default_factory=dict)

    def answers(self, rows: DataFrame, columns: list[str], defaults: dict[str, str]) -> DataFrame:
        """``rows`` with the model's fields, defaults where there is no answer; only keys that are not stored are asked."""
        keys = self.store.keys
        request = rows.select(*keys, *[c for c in columns if c in rows.columns and c not in keys])
        found = annotate.annotated(request, keys, self.model, self.store, **self.options)
        return annotate.with_annotations(rows, found, defaults, keys)


class _Rounds:
    """Rows of finished rounds, appended to one table."""

    def __init__(self, spark: SparkSession):
        self.spark, self.path = spark, f"{checkpoint_dir(spark)}/tables/{uuid.uuid4().hex}"
        self.schema = None

    def add(self, rows: DataFrame) -> DataFrame:
        """Append a round and read it back."""
        written = checkpointed(rows)
        self.schema = written.schema
        written.write.mode("append").parquet(self.path)
        return written

    def all(self, like: DataFrame) -> DataFrame:
        if self.schema is None:
            return like.filter(F.lit(False))
        return self.spark.read.schema(self.schema).parquet(self.path)


def _in_order(table: DataFrame) -> DataFrame:
    """Written in ranges of the rank, so that a round reads only the part of the table that holds it."""
    return checkpointed(table.repartitionByRange("rank").sortWithinPartitions("rank"))


def staged_class_sample(
    pool: DataFrame,
    target: int,
    batch_size: int,
    relevant: list[str],
    classifier: Asked,
    tagger: Asked | None = None,
    must_terms: list[str] | None = None,
    exclusions: DataFrame | None = None,
    seed: int = 42,
) -> S.ClassSample:
    """As ``sampling.class_sample``, for a pool whose visible classes, and with ``tagger`` also tags, are yet to be asked for.

    The pool carries im_id, im_url, category, image_content_hash and, without ``tagger``, tags.  Rows of must-include
    categories are asked first, then one batch after the other until ``target`` rows are accepted; no later batch is asked.
    Content that is excluded or came before is not asked at all, and the classifier sees images of people only.
    A row whose call fails has no visible class and is asked again by a later run.
    """
    spark = pool.sparkSession
    forced, loop = S.class_candidates(pool, target, batch_size, must_terms, exclusions, seed)
    loop = _in_order(loop)
    size = loop.count()
    available = F.lit(", ".join(sorted(relevant)))

    def tagged(rows: DataFrame) -> DataFrame:
        if tagger is None:
            return rows
        return tagger.answers(rows.drop("tags"), ["im_id", "im_url"], {"tags": ""})

    def classified(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("available_classes", available)
        rows = classifier.answers(rows, ["im_id", "im_url", "available_classes", "tags"], {"visible_classes": "[]", "gpt_reason": "llm_failed"})
        return rows.drop("available_classes")

    columns = [c for c in pool.columns if c not in ("tags", "visible_classes", "gpt_reason")] + ["tags", "visible_classes", "gpt_reason"]
    must_rows = checkpointed(classified(tagged(forced.filter(~F.col("repeated")))))
    must_count = must_rows.count()
    classes = F.coalesce(F.from_json("visible_classes", "array<string>"), F.array().cast("array<string>"))
    must_rows = must_rows.withColumn("tags", T.merged_tags(F.col("tags"), classes))

    def blank(rows: DataFrame) -> DataFrame:
        return rows.withColumns({"visible_classes": F.lit("[]"), "gpt_reason": F.lit("")})

    rounds, accepted, positives, used = _Rounds(spark), 0, 0, 0
    while accepted < target and used * batch_size < size:
        batch = loop.filter((F.col("rank") > used * batch_size) & (F.col("rank") <= (used + 1) * batch_size))
        repeated = batch.filter("repeated")
        if tagger is not None:
            repeated = repeated.withColumn("tags", F.lit(""))
        fresh = checkpointed(tagged(batch.filter(~F.col("repeated"))))
        human = catalog.has_tag(F.col("tags"), catalog.HUMAN_TAG)
        seen = classified(fresh.filter(human))
        rest = blank(fresh.filter(~F.coalesce(human, F.lit(False)))).unionByName(blank(repeated).select(*seen.columns))
        looked = rounds.add(S.class_marks(seen.unionByName(rest.select(*seen.columns)), relevant))
        positives += looked.filter("_good").count()
        accepted = must_count + positives if positives else 0
        used += 1
        forget(fresh, looked)
    none = S.class_marks(blank(loop.withColumn("tags", F.lit("")) if tagger is not None else loop), relevant)
    return S.class_outcome(columns, must_rows, must_count, rounds.all(none), target, size, used)


def staged_presence_sample(
    pool: DataFrame,
    target: int,
    oversample: int,
    max_rounds: int,
    tagger: Asked,
    exclusions: DataFrame | None = None,
    detail_terms: list[str] | None = None,
    seed: int = 42,
) -> S.PresenceSample:
    """As ``sampling.presence_sample``, for a pool whose tags are yet to be asked for; the rows of a round are asked when it begins.

    Content that is excluded or came in an earlier round is not asked.
    """
    spark = pool.sparkSession
    table = _in_order(S.ranked_content(pool.drop("tags"), exclusions, seed))
    size, rounds = table.count(), _Rounds(spark)

    def flagged(rows: DataFrame) -> DataFrame:
        return S.with_presence(catalog.detail_view_flags(rows, detail_terms or [], enabled=bool(detail_terms)))

    start, accepted, ends = 0, 0, []
    while accepted < target and start < size and len(ends) < max_rounds:
        end = S.round_end(start, size, target - accepted, oversample)
        window = table.filter((F.col("rank") > start) & (F.col("rank") <= end))
        known = F.col("excluded") | (F.col("first_rank") <= start)
        asked = tagger.answers(window.filter(~known), ["im_url"], {"tags": ""})
        silent = window.filter(known).withColumn("tags", F.lit(""))
        looked = rounds.add(flagged(asked.unionByName(silent.select(*asked.columns))))
        accepted += looked.filter(F.col("_ok") & (F.col("first_rank") > start)).count()
        ends.append(end)
        start = end
        forget(looked)
    return S.presence_outcome(rounds.all(flagged(table.withColumn("tags", F.lit("")))), ends, size, accepted, target)


class SeenContent:
    """Content hashes that later samples leave out; a bucketed store, so it may outgrow memory and outlive a run."""

    def __init__(self, spark: SparkSession, path: str):
        self.store = ResultStore(spark, path, ["image_content_hash"])

    def add(self, rows: DataFrame) -> None:
        """Add the known hashes of ``rows`` that are not there yet."""
        known = rows.select("image_content_hash").filter(F.coalesce("image_content_hash", F.lit("")) != "").distinct()
        fresh = checkpointed(self.store.pending(known))
        if not fresh.isEmpty():
            self.store.append(fresh, self.store.next_run())
        forget(fresh)

    def among(self, rows: DataFrame) -> DataFrame | None:
        """Those of the hashes that ``rows`` has; reads only the buckets that its hashes fall into."""
        if not self.store.exists():
            return None
        return self.store.stored(rows.select("image_content_hash")).select("image_content_hash")


@dataclass
class CatalogSamples:
    """Samples of several catalogs: all rows with ``catalog_name``, and one row of counters per catalog."""

    accepted: DataFrame
    rejected: DataFrame
    evaluated: DataFrame
    stats: DataFrame


STATS = "catalog_name string, pool_size long, evaluated long, accepted long, target long, rounds long, exhausted boolean"


def catalog_presence_samples(
    pools: dict[str, DataFrame],
    target: int,
    oversample: int,
    max_rounds: int,
    seen: SeenContent,
    tagger: Asked | None = None,
    detail_terms: dict[str, list[str]] | None = None,
    seed: int = 42,
) -> CatalogSamples:
    """Presence samples of one catalog after the other; content that was looked at in an earlier one does not count again.

    ``seen`` starts with the excluded content and holds all content that was looked at in the end.  ``detail_terms`` are given per
    catalog.  Catalogs are few, so the loop and the counters are the driver's; an empty catalog counts as exhausted.
    """
    if not pools:
        raise ValueError("no catalogs")
    parts, rows = [], []
    for name, pool in pools.items():
        pool = checkpointed(pool)
        excluded, terms = seen.among(pool), (detail_terms or {}).get(name)
        excluded = None if excluded is None else checkpointed(excluded)
        if tagger is None:
            out = S.presence_sample(pool, target, oversample, max_rounds, excluded, terms, seed)
        else:
            out = staged_presence_sample(pool, target, oversample, max_rounds, tagger, excluded, terms, seed)
        seen.add(out.evaluated)
        rows.append((name, *[out.stats[c] for c in ("pool_size", "evaluated", "accepted", "target", "rounds", "exhausted")]))
        parts.append([df.withColumn("catalog_name", F.lit(name)) for df in (out.accepted, out.rejected, out.evaluated)])
    joined = []
    for some in zip(*parts):
        whole = some[0]
        for df in some[1:]:
            whole = whole.unionByName(df, allowMissingColumns=True)
        joined.append(whole)
    return CatalogSamples(*joined, next(iter(pools.values())).sparkSession.createDataFrame(rows, STATS))
