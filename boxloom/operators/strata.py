"""Iterative stratification: a split in which every concept has its share of each part."""

from __future__ import annotations

from fractions import Fraction
from math import floor

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from boxloom.functions import codecs as C
from boxloom.operators import groups
from boxloom.operators.dataset import SPLITS
from boxloom.session import checkpointed

#: Concepts that get a round of their own; the rarer ones beyond share the first round.
MOST_ROUNDS = 256
_STEPS = 1000


def filled(wanted: list[Fraction], n: int, order: list[int]) -> list[int]:
    """``n`` rows one after the other to the part that wants most, ties by ``order``; without walking them.

    All parts that get rows end at one level; what rounding leaves, fewer rows than parts, is walked.
    """
    tops = sorted(wanted, reverse=True)
    level = max((sum(tops[:k]) - n) / Fraction(k) for k in range(1, len(tops) + 1))
    got = [max(0, floor(w - level)) for w in wanted]
    for _ in range(n - sum(got)):
        best = min(range(len(wanted)), key=lambda s: (got[s] - wanted[s], order[s]))
        got[best] += 1
    return got


def label_sets(df: DataFrame, concepts: str = "concepts"):
    """Text of a row's distinct concepts in order; equal sets are equal texts, no concepts the empty text."""
    return F.coalesce(F.array_join(F.array_sort(C.distinct_concepts(F.col(concepts))), ","), F.lit(""))


def _labels():
    return F.when(F.col("labels") == "", F.array().cast("array<string>")).otherwise(F.split("labels", ","))


def _strata(sets: DataFrame, most_rounds: int) -> tuple[DataFrame, list[tuple[str, int]]]:
    """Sets with the number of their round, and the concepts with own rounds, rarest first.

    A set belongs to its rarest concept.  ``start`` is the number of rows of the sets before it in its stratum, by digest;
    sums of digest buckets give it, so a concept that most sets have is no single group.
    """
    spark = sets.sparkSession
    exploded = sets.select("labels", "n", F.explode(_labels()).alias("concept"))
    support = checkpointed(exploded.groupBy("concept").agg(F.sum("n").alias("support")))
    listed = support.orderBy(F.desc("support"), F.desc("concept")).limit(most_rounds).collect()
    main = [(r["concept"], r["support"]) for r in reversed(listed)]
    weighed = groups.join_on(exploded, support, ["concept"])
    rarest = weighed.groupBy("labels").agg(F.min(F.struct("support", "concept"))["concept"].alias("stratum"))
    turns = spark.createDataFrame([(c, i) for i, (c, _) in enumerate(main)], "stratum string, turn int")
    staged = groups.join_on(sets, rarest, ["labels"], "left")
    staged = groups.join_on(staged, F.broadcast(turns), ["stratum"], "left")
    # Sets without concepts come last, those of the rarer concepts first.
    turn = F.when(F.col("labels") == "", len(main)).otherwise(F.coalesce("turn", F.lit(-1)))
    staged = staged.withColumn("turn", turn).withColumn("stratum", F.coalesce("stratum", F.lit("")))
    staged = staged.withColumn("_bucket", F.substring("set", 1, 3))
    sizes = staged.groupBy("stratum", "_bucket").agg(F.sum("n").alias("_n"))
    before = W.partitionBy("stratum").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    key = F.struct("stratum", "_bucket").alias("_key")
    offsets = sizes.select(
        key, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(W.partitionBy("stratum")).alias("rows")
    )
    joined = groups.join_on(staged.select("*", key), offsets, ["_key"])
    inside = W.partitionBy("_key").orderBy("set").rowsBetween(W.unboundedPreceding, -1)
    start = F.col("_before") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    placed = joined.withColumn("start", start).select("set", "labels", "n", "stratum", "turn", "start", "rows")
    # By round, so a round reads the files and row groups of its own sets.
    return checkpointed(placed.repartitionByRange("turn", "set").sortWithinPartitions("turn")), main


def _dealt(sets: DataFrame, parts: int) -> DataFrame:
    """Rows of each set for every part but the first: quota ``q_k`` of a stratum, spread evenly over its rows."""
    out = sets.withColumn("_low", F.col("start")).withColumn("_high", F.col("start") + F.col("n")).withColumn("_left", F.col("rows"))
    for k in range(1, parts):
        for end in ("low", "high"):
            share = F.expr(f"(CAST(q_{k} AS DECIMAL(19, 0)) * CAST(_{end} AS DECIMAL(19, 0))) div CAST(_left AS DECIMAL(19, 0))")
            out = out.withColumn(f"_{end}_{k}", F.when(F.col("_left") > 0, share).otherwise(0))
        out = out.withColumn(f"n_{k}", F.col(f"_high_{k}") - F.col(f"_low_{k}"))
        out = out.withColumn("_low", F.col("_low") - F.col(f"_low_{k}")).withColumn("_high", F.col("_high") - F.col(f"_high_{k}"))
        out = out.withColumn("_left", F.col("_left") - F.col(f"q_{k}"))
    return out.select(*sets.columns, *[f"n_{k}" for k in range(1, parts)])


def _plain_quotas(shares: list[Fraction]) -> list:
    """Quotas of a stratum by shares alone; the digest of its name says which part a rest goes to."""
    rest = F.conv(F.substring(F.md5(F.col("stratum").cast("binary")), 1, 4), 16, 10).cast("bigint") % _STEPS
    ends, total = [F.lit(0).cast("bigint")], Fraction(0)
    for share in shares[1:]:
        total += share
        whole = total.denominator * _STEPS
        ends.append(F.floor((F.col("rows") * (total.numerator * _STEPS) + rest * total.denominator) / F.lit(whole).cast("decimal(19,0)")).cast("bigint"))
    return [b - a for a, b in zip(ends, ends[1:], strict=False)]


def stratified_split(
    df: DataFrame, row_id: str = "row_id", seed: int = 42, shares: dict[str, float] | None = None, most_rounds: int = MOST_ROUNDS
) -> DataFrame:
    """``df`` with ``split``: iterative stratification over the comma lists of ``concepts``.

    Concepts are taken from the rarest to the most frequent.  The rows whose rarest concept it is go, one after the other, to the part that
    still wants most rows with the concept: its share of all such rows minus what earlier rounds gave it.  Ties go to the
    part that wants more rows at all.  Rows without concepts come last and level the sizes.  Order and support are those of the whole table.

    Rows are never walked: equal sets of concepts are one row with a count, a round is a sum over the sets of its stratum, and its
    quotas are spread evenly over them.  Inside a set the seeded hash of ``row_id`` decides, ranked in hash buckets.  The driver holds one line for
    each of at most ``most_rounds`` concepts; rarer ones beyond share a first round, dealt by the plain shares.
    NULL and blank concepts are none; repeated ids are rows of their own; an empty table stays empty.
    """
    given = {name: Fraction(str(share)) for name, share in (shares or SPLITS).items()}
    names, parts = list(given), list(given.values())
    if sum(parts) != 1:
        raise ValueError("shares must add up to one")
    spark = df.sparkSession
    counted = df.groupBy(label_sets(df).alias("labels")).agg(F.count(F.lit(1)).alias("n"))
    sets = checkpointed(counted.withColumn("set", F.md5(F.col("labels").cast("binary"))))
    sets, main = _strata(sets, most_rounds)
    own = [c for c, _ in main]
    sizes = {r["turn"]: r["n"] for r in sets.groupBy("turn").agg(F.sum("n").alias("n")).collect()}
    total = sum(sizes.values())
    given_rows = {c: [0] * len(parts) for c in [None, *own]}

    def add(dealt: DataFrame) -> None:
        # One line per concept with a round, and one for all rows.
        marked = dealt.withColumn("concept", F.explode(F.concat(F.array(F.lit(None).cast("string")), _labels())))
        marked = marked.filter(F.col("concept").isNull() | F.col("concept").isin(own)) if own else marked.filter(F.col("concept").isNull())
        sums = [F.sum(f"n_{k}").alias(f"n_{k}") for k in range(1, len(parts))]
        for r in marked.groupBy("concept").agg(F.sum("n").alias("n"), *sums).collect():
            later = [r[f"n_{k}"] for k in range(1, len(parts))]
            line = given_rows[r["concept"]]
            for k, n in enumerate([r["n"] - sum(later), *later]):
                line[k] += n

    plain = [q.alias(f"q_{k}") for k, q in enumerate(_plain_quotas(parts), 1)]
    if -1 in sizes:
        add(_dealt(sets.filter(F.col("turn") == -1).select("*", *plain), len(parts)))
    quotas = []
    for turn, (concept, support) in enumerate([*main, (None, total)]):
        if turn not in sizes:
            continue
        wanted = [share * support - n for share, n in zip(parts, given_rows[concept], strict=True)]
        rows = [share * total - n for share, n in zip(parts, given_rows[None], strict=True)]
        order = sorted(range(len(parts)), key=lambda s: (-rows[s], s))
        got = filled(wanted, sizes[turn], [order.index(s) for s in range(len(parts))])
        quotas.append((turn, *got[1:]))
        if concept is not None:
            fixed = [F.lit(n).cast("bigint").alias(f"q_{k}") for k, n in enumerate(got[1:], 1)]
            add(_dealt(sets.filter(F.col("turn") == turn).select("*", *fixed), len(parts)))
    known = ", ".join(f"g_{k} bigint" for k in range(1, len(parts)))
    table = spark.createDataFrame(quotas, "turn int" + (f", {known}" if known else ""))
    final = groups.join_on(sets.select("*", *plain), F.broadcast(table), ["turn"], "left")
    for k in range(1, len(parts)):
        final = final.withColumn(f"q_{k}", F.coalesce(f"g_{k}", f"q_{k}"))
    final = checkpointed(_dealt(final, len(parts)).select(F.col("set").alias("_set"), *[F.col(f"n_{k}").alias(f"_n_{k}") for k in range(1, len(parts))]))
    marked = df.withColumn("_set", F.md5(label_sets(df).cast("binary"))).withColumn("_h", groups.seeded_hash(F.col(row_id), seed))
    ranked = groups.hashed_rank(marked, ["_set"], "_h", row_id, "_n")
    joined = groups.attach_one_per_key(ranked, final, ["_set"])
    split, end = F.lit(names[0]), F.lit(0)
    cases = []
    for k in range(1, len(parts)):
        end = end + F.col(f"_n_{k}")
        cases.append((F.col("_n") <= end, names[k]))
    for condition, name in reversed(cases):
        split = F.when(condition, name).otherwise(split)
    return joined.select(*df.columns, split.alias("split"))
