"""Reproducible sampling: shuffles, budgets, strata, ratios and rounds.

Random order is the md5 of (id, seed): the same rows on every cluster size.
Categories may be very uneven, so ranks inside a category are computed in hash
buckets (``groups.hashed_rank``), never by sorting a whole category.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from boxloom.functions import text as T
from boxloom.operators import catalog, groups

# Shares, smallest size and category words of the audience sample.
WOMEN_SHARE = 0.70
MEN_SHARE = 0.30
SMALLEST_SAMPLE = 3000
ALWAYS_INCLUDED = ["rings", "earrings", "bracelets", "formal trousers", "formal shirts"]
NEVER_INCLUDED = ["flip-flops", "co-ordinate sets"]
FALLBACK_TAG = "fallback_sample:true"


def shuffled(df: DataFrame, id_column: str, seed: int = 42, rank: str = "rank") -> DataFrame:
    """Add the 1-based place of every row in the seeded random order."""
    hashed = df.withColumn("_h", groups.seeded_hash(F.col(id_column), seed))
    return groups.hashed_rank(hashed, [], "_h", id_column, rank).drop("_h")


def batches(ranked: DataFrame, size: int, rank: str = "rank") -> DataFrame:
    return ranked.withColumn("batch", F.floor((F.col(rank) - 1) / F.lit(size)).cast("long"))


def random_rows(df: DataFrame, id_column: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows by seeded order."""
    hashed = df.withColumn("_h", groups.seeded_hash(F.col(id_column), seed))
    return groups.hashed_head(hashed, [], "_h", id_column, n, "_n").drop("_h", "_n")


# --- budgets ----------------------------------------------------------------


def allocated_budget(
    pools: DataFrame, total: int | Column, smallest: int, largest: int, rounds: int = 10
) -> DataFrame:
    """Budget per category from (category, pool_size), weighted by the root of the pool.

    The first share is rounded half-even and held between ``smallest`` and
    min(``largest``, pool).  What is left is handed out in rounds to
    categories with headroom, larger pools first.  Running sums decide how far
    a round reaches; the input has one row per category.
    """
    total = F.lit(total).cast("long") if isinstance(total, int) else total
    everything = W.partitionBy(F.lit(0))
    by_pool = everything.orderBy(F.col("pool_size").desc(), "category")
    before = by_pool.rowsBetween(W.unboundedPreceding, -1)
    cap = F.least(F.lit(largest).cast("long"), F.col("pool_size"))
    weight = F.sqrt(F.greatest(F.col("pool_size"), F.lit(1)).cast("double"))
    out = pools.withColumn("_w", weight).withColumn("_total", total)
    raw = F.bround(F.col("_total") * F.col("_w") / F.sum("_w").over(everything)).cast("long")
    out = out.withColumn("budget", F.greatest(F.lit(smallest).cast("long"), F.least(cap, raw)))
    for _ in range(rounds):
        open_row = F.col("budget") < cap
        out = out.withColumn("_left", F.col("_total") - F.sum("budget").over(everything)).withColumn(
            "_open", F.sum(open_row.cast("long")).over(everything)
        )
        give = F.greatest(F.lit(1).cast("long"), F.expr("_left div greatest(_open, 1L)"))
        out = out.withColumn("_add", F.when(open_row & (F.col("_left") > 0), F.least(give, cap - F.col("budget"))).otherwise(F.lit(0)))
        reached = F.coalesce(F.sum("_add").over(before), F.lit(0)) < F.col("_left")
        out = out.withColumn("_take", F.when(reached, F.col("_add")).otherwise(F.lit(0)))
        out = out.withColumn("budget", F.col("budget") + F.col("_take"))
    return out.select("category", "pool_size", "budget")


def category_budget(
    pools: DataFrame, total: int, smallest: int, largest: int, fixed: dict[str, object] | None = None, strict: bool = True
) -> DataFrame:
    """As ``allocated_budget``, with fixed targets for some categories (any case).

    Fixed targets are held to the pool; targets that name no category, are
    negative or no number are ignored.  The rest is shared without a floor.
    Fixed targets beyond ``total`` are an error; without ``strict`` they are kept whole and nothing is left to share.
    """
    wanted = {}
    for name, value in (fixed or {}).items():
        try:
            number = int(value)
        except (TypeError, ValueError):
            continue
        if number >= 0:
            wanted[str(name).strip().lower()] = number
    if not wanted:
        return allocated_budget(pools, total, smallest, largest)
    table = F.create_map(*[F.lit(x) for kv in wanted.items() for x in kv])
    marked = pools.withColumn("_fixed", F.try_element_at(table, F.lower(F.trim("category"))).cast("long"))
    # `least` skips NULL, so rows without a target are kept out of it.
    marked = marked.withColumn("_fixed", F.when(F.col("_fixed").isNotNull(), F.least("_fixed", "pool_size")))
    matched = marked.agg(F.count("_fixed"), F.coalesce(F.sum("_fixed"), F.lit(0))).first()
    if matched[0] == 0:
        return allocated_budget(pools, total, smallest, largest)
    if matched[1] > total and strict:
        raise ValueError(f"fixed targets ({matched[1]}) exceed the total ({total})")
    left = total - matched[1]
    held = marked.filter("_fixed is not null").select("category", "pool_size", F.col("_fixed").alias("budget"))
    rest = marked.filter("_fixed is null").select("category", "pool_size")
    if left > 0:
        return held.unionByName(allocated_budget(rest, left, 0, largest))
    return held.unionByName(rest.withColumn("budget", F.lit(0).cast("long")))


def stratified_sample(
    pool: DataFrame, budgets: DataFrame, id_column: str = "im_id", category: str = "category", seed: int = 42
) -> DataFrame:
    """Per category the first ``budget`` rows in seeded order.

    ``budgets`` has one row per category.
    """
    hashed = pool.withColumn("_h", groups.seeded_hash(F.col(id_column), seed))
    limits = budgets.select(F.col("category").alias(category), F.col("budget").alias("limit"))
    return groups.hashed_head(hashed, [category], "_h", id_column, limits, "rank").drop("_h")


def budget_report(budgets: DataFrame) -> DataFrame:
    return budgets.select(
        "category",
        "pool_size",
        F.col("budget").alias("allocated"),
        F.least("budget", "pool_size").alias("sampled"),
    )


# --- audience ratio ---------------------------------------------------------


def ratio_targets(counts: dict[str, int], smallest: int = SMALLEST_SAMPLE) -> dict[str, int]:
    """Rows still needed per audience so that the forced rows fit a 70/30 sample."""
    women, men = counts.get("women", 0), counts.get("men", 0)
    total = max(smallest, int(men / MEN_SHARE), int(women / WOMEN_SHARE))
    return {
        "women": max(0, int(total * WOMEN_SHARE) - women),
        "men": max(0, int(total * MEN_SHARE) - men),
    }


def ratio_sample(
    df: DataFrame,
    id_column: str = "im_id",
    smallest: int = SMALLEST_SAMPLE,
    always: list[str] | None = None,
    never: list[str] | None = None,
    seed: int = 42,
) -> DataFrame:
    """All rows of the always-included categories, filled with women and men to 70/30.

    Adds ``must_include`` and the final random place ``rank``.
    """
    wanted = catalog.without_terms(df, "category", NEVER_INCLUDED if never is None else never)
    must = catalog.contains_any(F.col("category"), ALWAYS_INCLUDED if always is None else always)
    marked = wanted.withColumn("must_include", must)
    forced = marked.filter(F.col("must_include") & F.col("gender").isin("women", "men")).groupBy("gender").agg(F.count(F.lit(1)).alias("n")).collect()
    need = ratio_targets({r["gender"]: r["n"] for r in forced}, smallest)
    rest = marked.filter(~F.col("must_include") & F.col("gender").isin("women", "men"))
    hashed = rest.withColumn("_h", groups.seeded_hash(F.col(id_column), seed))
    limits = df.sparkSession.createDataFrame(list(need.items()), "gender string, limit long")
    filled = groups.hashed_head(hashed, ["gender"], "_h", id_column, limits, "_n").drop("_n", "_h")
    return shuffled(marked.filter("must_include").unionByName(filled), id_column, seed + 1)


# --- rounds by human presence -----------------------------------------------


class PresenceSample:
    """Outcome of ``presence_sample``: all evaluated rows, the sample, the counters."""

    def __init__(self, evaluated: DataFrame, accepted: DataFrame, stats: dict):
        self.evaluated = evaluated
        self.accepted = accepted
        self.rejected = evaluated.filter(~F.col("accepted"))
        self.stats = stats


def presence_sample(
    pool: DataFrame,
    target: int,
    oversample: int,
    max_rounds: int,
    exclusions: DataFrame | None = None,
    detail_terms: list[str] | None = None,
    seed: int = 42,
) -> PresenceSample:
    """Rounds over one catalog until ``target`` images with a person are found.

    Each round takes the next rows of the seeded order, ``oversample`` times
    what is missing.  Content that is excluded or came in an earlier round
    does not count.  The pool carries one row per im_url with tags, category
    and image_content_hash.  A round is one count over a narrow table; only
    that count reaches the driver.
    """
    table = ranked_content(catalog.detail_view_flags(pool, detail_terms or [], enabled=bool(detail_terms)), exclusions, seed)
    table = groups.checkpointed(with_presence(table))
    size = table.count()
    start, accepted, ends = 0, 0, []
    while accepted < target and start < size and len(ends) < max_rounds:
        missing = target - accepted
        end = round_end(start, size, missing, oversample)
        window = table.filter((F.col("rank") > start) & (F.col("rank") <= end))
        accepted += window.filter(F.col("_ok") & (F.col("first_rank") > start)).count()
        ends.append(end)
        start = end
    return presence_outcome(table.filter(F.col("rank") <= start), ends, size, accepted, target)


def ranked_content(pool: DataFrame, exclusions: DataFrame | None, seed: int) -> DataFrame:
    """Rows in seeded order with the first ``rank`` of their content (``first_rank``) and whether it is ``excluded``."""
    ranked = shuffled(pool, "im_url", seed)
    known = F.coalesce("image_content_hash", F.lit(""))
    firsts = ranked.filter(known != "").groupBy("image_content_hash").agg(F.min("rank").alias("first_rank"))
    if exclusions is not None:
        listed = exclusions.select("image_content_hash").distinct().withColumn("excluded", F.lit(True))
        firsts = groups.join_on(firsts, listed, ["image_content_hash"], "left")
    else:
        firsts = firsts.withColumn("excluded", F.lit(False))
    # AQE splits the join where one image content is very frequent.
    table = groups.join_on(ranked, firsts, ["image_content_hash"], "left")
    return table.withColumns({"first_rank": F.coalesce("first_rank", "rank"), "excluded": F.coalesce("excluded", F.lit(False))})


def with_presence(table: DataFrame) -> DataFrame:
    """Add ``_ok``: shows a person, passes the filter for detail views, is not excluded."""
    human = catalog.has_tag(F.col("tags"), catalog.HUMAN_TAG)
    return table.withColumn("_ok", human & F.col("passes_detail_filter") & ~F.col("excluded"))


def round_end(start: int, size: int, missing: int, oversample: int) -> int:
    """Last rank of the round that begins after ``start``."""
    return start + min(size - start, max(missing, missing * oversample))


def presence_outcome(looked: DataFrame, ends: list[int], size: int, accepted: int, target: int) -> PresenceSample:
    """Outcome of the rounds that end at ``ends``, over the rows that they looked at."""
    evaluated = _with_rounds(looked, ends)
    sample = evaluated.filter("accepted").orderBy("rank").limit(target)
    start = ends[-1] if ends else 0
    stats = {
        "pool_size": size,
        "evaluated": start,
        "accepted": min(accepted, target),
        "target": target,
        "rounds": len(ends),
        "exhausted": start >= size,
    }
    return PresenceSample(evaluated, sample, stats)


def _with_rounds(table: DataFrame, ends: list[int]) -> DataFrame:
    round_no, begin = F.lit(0), F.lit(0)
    for i, end in reversed(list(enumerate(ends))):
        round_no = F.when(F.col("rank") <= end, i + 1).otherwise(round_no)
        begin = F.when(F.col("rank") <= end, ends[i - 1] if i else 0).otherwise(begin)
    out = table.withColumn("round", round_no).withColumn("_begin", begin)
    again = F.col("excluded") | (F.col("first_rank") <= F.col("_begin"))
    out = out.withColumn("accepted", F.col("_ok") & (F.col("first_rank") > F.col("_begin")))
    out = out.withColumn("has_human_evidence", ~again & catalog.has_tag(F.col("tags"), catalog.HUMAN_TAG))
    out = out.withColumn("tags", F.when(again, F.lit(catalog.REPEATED)).otherwise(F.col("tags")))
    return out.drop("_ok", "_begin", "first_rank", "excluded")


# --- rounds by visible class ------------------------------------------------


class ClassSample:
    """Outcome of ``class_sample``: accepted and rejected rows and the counters."""

    def __init__(self, accepted: DataFrame, rejected: DataFrame, stats: dict):
        self.accepted, self.rejected, self.stats = accepted, rejected, stats


def batch_progress(rows: DataFrame, good: Column, offset: int = 0) -> DataFrame:
    """Per batch: good rows in it and the running total (``offset`` counts once any row was good).

    One row per batch; the running sum is the only ordered step.
    """
    per_batch = rows.groupBy("batch").agg(
        F.sum(good.cast("long")).alias("good"), F.count(F.lit(1)).alias("rows")
    )
    running = F.sum("good").over(W.partitionBy(F.lit(0)).orderBy("batch").rowsBetween(W.unboundedPreceding, 0))
    return per_batch.withColumn("running", running).withColumn(
        "accepted_so_far", F.when(F.col("running") > 0, F.col("running") + offset).otherwise(F.lit(0).cast("long"))
    )


def batches_evaluated(progress: DataFrame, target: int) -> int:
    """Number of batches that are looked at before the target is met; whole batches count."""
    done = progress.filter(F.col("accepted_so_far") >= target).agg(F.min("batch")).first()[0]
    return int(done) + 1 if done is not None else progress.count()


def mark_seen_content(
    rows: DataFrame, exclusions: DataFrame | None, content: str = "image_content_hash"
) -> DataFrame:
    """Add ``repeated``: excluded, or the content came in an earlier batch, or from another URL of this one."""
    known = F.coalesce(content, F.lit("")) != ""
    firsts = (
        rows.filter(known)
        .groupBy(content)
        .agg(F.min(F.struct("rank", "batch", "im_url")).alias("_first"))
    )
    if exclusions is not None:
        listed = exclusions.select(F.col("image_content_hash").alias(content)).distinct()
        firsts = groups.join_on(firsts, listed.withColumn("_x", F.lit(True)), [content], "left")
    else:
        firsts = firsts.withColumn("_x", F.lit(False))
    out = groups.join_on(rows, firsts, [content], "left")
    again = F.coalesce("_x", F.lit(False)) | (
        F.col("_first").isNotNull()
        & ((F.col("batch") > F.col("_first.batch")) | (F.col("im_url") != F.col("_first.im_url")))
    )
    return out.withColumn("repeated", again).drop("_first", "_x")


def class_sample(
    pool: DataFrame,
    target: int,
    batch_size: int,
    relevant: list[str],
    must_terms: list[str] | None = None,
    exclusions: DataFrame | None = None,
    seed: int = 42,
) -> ClassSample:
    """Images of people that show a relevant class, taken batch by batch in seeded order.

    The pool carries tags, image_content_hash and visible_classes.  Which
    batches would have been looked at follows from a running sum, so all of
    them are one plan.  Short samples are filled from images of people without
    a relevant class.
    """
    classes = F.coalesce(F.from_json("visible_classes", "array<string>"), F.array().cast("array<string>"))
    tagged = T.merged_tags(F.col("tags"), classes)
    forced, loop = class_candidates(pool, target, batch_size, must_terms, exclusions, seed)
    must_rows = forced.filter(~F.col("repeated")).withColumn("tags", tagged)
    must_count = must_rows.count()
    loop = groups.checkpointed(class_marks(loop, relevant))
    used = batches_evaluated(batch_progress(loop, F.col("_good"), must_count), target) if target > 0 else 0
    looked = loop.filter(F.col("batch") < used)
    return class_outcome(pool.columns, must_rows, must_count, looked, target, loop.count(), used)


def class_candidates(
    pool: DataFrame, target: int, batch_size: int, must_terms: list[str] | None, exclusions: DataFrame | None, seed: int
) -> tuple[DataFrame, DataFrame]:
    """(rows of must-include categories, the first ``target`` of them; all other rows in batches), with ``repeated``."""
    ranked = shuffled(pool, "im_id", seed)
    must = catalog.contains_any(F.col("category"), must_terms or []) if must_terms else F.lit(False)
    marked = groups.checkpointed(ranked.withColumn("_must", must))
    forced = marked.filter("_must").orderBy("rank").limit(target).withColumn("batch", F.lit(-1).cast("long"))
    forced = groups.checkpointed(mark_seen_content(forced, exclusions))
    seen = forced.select("image_content_hash").filter(F.col("image_content_hash") != "")
    if exclusions is not None:
        seen = seen.unionByName(exclusions.select("image_content_hash"))
    loop = marked.filter(~F.col("_must")).drop("rank")
    loop = batches(shuffled(loop, "im_id", seed), batch_size)
    return forced, mark_seen_content(loop, seen)


def class_marks(rows: DataFrame, relevant: list[str]) -> DataFrame:
    """Add ``_human`` and ``_good`` (a person with a relevant class); repeated content is neither."""
    rows = rows.withColumn("tags", F.when(F.col("repeated"), catalog.REPEATED).otherwise(F.col("tags")))
    rows = rows.withColumn("_human", catalog.has_tag(F.col("tags"), catalog.HUMAN_TAG))
    return rows.withColumn("_good", F.col("_human") & catalog.has_relevant_class(F.col("visible_classes"), relevant))


def class_outcome(
    columns: list[str], must_rows: DataFrame, must_count: int, looked: DataFrame, target: int, candidates: int, used: int
) -> ClassSample:
    """Outcome over the rows of the batches that were looked at: must-include rows, positives, then the fallback."""
    classes = F.coalesce(F.from_json("visible_classes", "array<string>"), F.array().cast("array<string>"))
    positives = looked.filter("_good").withColumn("tags", T.merged_tags(F.col("tags"), classes))
    found = must_count + positives.count()
    spare = looked.filter("_human and not _good").withColumn("reject_reason", F.lit("no_visible_accessories"))
    missing = max(0, target - found)
    filler = spare.orderBy("rank").limit(missing).withColumn("tags", T.with_tag(F.col("tags"), FALLBACK_TAG))

    phase = 1 << 50
    parts = [
        must_rows.withColumn("_seq", F.col("rank")),
        positives.withColumn("_seq", F.col("rank") + phase),
        filler.withColumn("_seq", F.col("rank") + 2 * phase),
    ]
    kept = [*columns, "_seq"]
    union = parts[0].select(*kept).unionByName(parts[1].select(*kept)).unionByName(parts[2].select(*kept))
    accepted = groups.first_per_key(union, ["im_url"], ["_seq"]).orderBy("_seq").limit(target)
    last_used = filler.agg(F.max("rank")).first()[0] if missing else None
    left_over = spare.filter(F.col("rank") > last_used) if last_used is not None else spare
    rejected = (
        looked.filter("not _human")
        .withColumn("reject_reason", F.lit("not_human_model"))
        .unionByName(left_over)
        .select(*columns, "reject_reason")
    )
    stats = {
        "total_candidates": candidates,
        "checked": looked.count(),
        "accepted": accepted.count(),
        "target": target,
        "rounds": used,
    }
    stats["exhausted"] = stats["checked"] >= stats["total_candidates"]
    return ClassSample(accepted.drop("_seq"), rejected, stats)


def acceptance_percent(stats: DataFrame) -> DataFrame:
    """Accepted share of the evaluated rows, in percent."""
    rate = F.when(F.col("evaluated") > 0, F.col("accepted") / F.col("evaluated") * 100).otherwise(0.0)
    return stats.withColumn("acceptance_percent", F.round(rate, 1))


def facet_order(df: DataFrame, values: Column, priority: list[str], order: str = "pos") -> DataFrame:
    """Distinct facet values: the priority list first, then by first appearance."""
    exploded = df.select(F.col(order).alias("_at"), F.posexplode(values).alias("_i", "value"))
    firsts = exploded.groupBy("value").agg(F.min(F.struct("_at", "_i")).alias("first"))
    rank = F.lit(len(priority))
    for i, name in enumerate(priority):
        rank = F.when(F.col("value") == name, i).otherwise(rank)
    return firsts.select("value", rank.alias("priority"), F.col("first._at").alias("first_row"), F.col("first._i").alias("first_item"))
