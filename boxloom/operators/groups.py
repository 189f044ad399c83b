"""Building blocks for per-key work that stays safe when one key is huge.

Three rules are kept throughout the library:

* first/last per key and counts use aggregates that combine before the shuffle;
* a key is gathered into one array only when its row count is known to be
  small (``large_groups`` finds the others);
* ranks over a large key are computed in buckets: bucket totals give the
  offset, and only one bucket at a time is sorted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from boxloom.session import checkpointed

# Rows of one key that may be gathered and compared with each other in one array.
GROUP_LIMIT = 1024
# Bytes a side may have to be broadcast; beyond it the join is salted instead.
BROADCAST_BYTES = 16 << 20
SALTS = 64


def first_per_key(df: DataFrame, keys: list[str], order: list[str], last: bool = False) -> DataFrame:
    """One row per key, the first (or last) in ``order``.

    Written as an aggregate, so each map task forwards one row per key however
    often the key repeats.  NULL is a key like any other.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    row = F.struct(*[F.col(c) for c in rest])
    by = F.struct(*[F.col(c) for c in order]) if len(order) > 1 else F.col(order[0])
    pick = F.max_by(row, by) if last else F.min_by(row, by)
    return (
        df.groupBy(*keys)
        .agg(pick.alias("_row"))
        .select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])
    )


def join_on(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys``; the keys of ``right`` are not repeated.  NULL matches nothing."""
    return _joined(left, right, keys, how, lambda a, b: a == b)


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """As ``join_on``, but NULL matches NULL.

    Such a join cannot reuse an existing partitioning by the keys, so it is
    kept for keys that name groups and may be NULL.
    """
    return _joined(left, right, keys, how, lambda a, b: a.eqNullSafe(b))


def _joined(left: DataFrame, right: DataFrame, keys: list[str], how: str, same) -> DataFrame:
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    condition = reduce(lambda a, b: a & b, [same(F.col(k), F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def large_groups(df: DataFrame, keys: list[str], limit: int = GROUP_LIMIT) -> DataFrame | None:
    """Keys with more than ``limit`` rows, or None when there are none.

    Reads only the key columns and counts before shuffling.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("group_rows")).filter(F.col("group_rows") > limit)
    if counts.isEmpty():
        return None
    return checkpointed(counts)


def split_by_size(df: DataFrame, keys: list[str], limit: int | None = GROUP_LIMIT):
    """(rows of small groups, rows of large groups or None).

    ``limit=None``: the caller has already seen that no group is large.
    """
    large = large_groups(df, keys, limit) if limit is not None else None
    if large is None:
        return df, None
    heads = large.select(*keys)
    return join_null_safe(df, heads, keys, "left_anti"), join_null_safe(df, heads, keys, "left_semi")


def attach_one_per_key(
    rows: DataFrame, side: DataFrame, keys: list[str], how: str = "inner", row_bytes: int = 128
) -> DataFrame:
    """Join ``side`` (one row per key, of about ``row_bytes``) to rows of few, possibly huge keys.

    ``side`` is counted: small enough, it is broadcast; otherwise both sides
    are salted so that one key spreads over many tasks.
    """
    if side.count() * row_bytes <= BROADCAST_BYTES:
        return join_null_safe(rows, F.broadcast(side), keys, how)
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns if c not in keys]), F.lit(SALTS))
    left = rows.withColumn("_salt", spread)
    right = side.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return join_null_safe(left, right, [*keys, "_salt"], how).drop("_salt")


def seeded_hash(column: Column, seed: int) -> Column:
    """Reproducible random order: md5 text of id and seed."""
    return F.md5(F.concat(F.coalesce(column.cast("string"), F.lit("")), F.lit(f"|{seed}")).cast("binary"))


def _rank_in_buckets(df: DataFrame, keys: list[str], bucket: str, order: list[Column], rank: str) -> DataFrame:
    """Rank by bucket totals plus place in the bucket.

    The struct key is never NULL as a whole, so join and window share one
    shuffle of the rows.
    """
    sizes = df.groupBy(*keys, bucket).agg(F.count(F.lit(1)).alias("_size"))
    before = W.partitionBy(*keys).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    key = F.struct(*keys, bucket).alias("_key")
    offsets = sizes.select(key, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    joined = join_on(df.select("*", key).drop(bucket), offsets, ["_key"])
    inside = F.row_number().over(W.partitionBy("_key").orderBy(*order))
    return joined.withColumn(rank, (F.col("_before") + inside).cast("long")).drop("_before", "_key")


def hashed_rank(
    df: DataFrame, keys: list[str], hash_column: str, tie: str, rank: str = "rank", prefix: int = 4
) -> DataFrame:
    """1-based position of every row of its key in the order of a hash text.

    The hash prefix is the bucket, so a key that holds a third of all rows is
    sorted in 16^prefix pieces instead of in one task.
    """
    bucketed = df.withColumn("_bucket", F.substring(F.col(hash_column), 1, prefix))
    return _rank_in_buckets(bucketed, keys, "_bucket", [F.col(hash_column), F.col(tie)], rank)


def hashed_head(
    df: DataFrame, keys: list[str], hash_column: str, tie: str, limits: DataFrame | int, rank: str = "rank", prefix: int = 4
) -> DataFrame:
    """Rows whose place in the order of a hash text is within their key's limit, with that place.

    ``limits`` is one number or a table of ``keys`` and ``limit``; keys without a limit have no rows.
    The totals of the hash buckets, one narrow count, say which buckets can hold such
    rows; only their rows are shuffled and sorted, not the whole pool.
    """
    bucketed = df.withColumn("_bucket", F.substring(F.col(hash_column), 1, prefix))
    sizes = bucketed.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    before = W.partitionBy(*keys).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0)))
    if isinstance(limits, int):
        offsets = offsets.withColumn("limit", F.lit(limits))
    else:
        offsets = join_on(offsets, limits, keys)
    key = F.struct(*keys, "_bucket").alias("_key")
    # Written, so the join knows how few buckets there are.
    heads = checkpointed(offsets.filter(F.col("_before") < F.col("limit")).select(key, "_before", F.col("limit").alias("_limit")))
    joined = join_on(bucketed.select("*", key).drop("_bucket"), heads, ["_key"])
    inside = F.row_number().over(W.partitionBy("_key").orderBy(hash_column, tie))
    ranked = joined.withColumn(rank, (F.col("_before") + inside).cast("long"))
    return ranked.filter(F.col(rank) <= F.col("_limit")).drop("_before", "_key", "_limit")


FAN = 64


def ordered_rank(
    df: DataFrame, keys: list[str], order: str, rank: str = "rank", pieces: int = FAN * FAN
) -> DataFrame:
    """1-based position of every row of its key in the order of a unique numeric column.

    Approximate quantiles only place the bucket borders; the rank is exact.
    """
    steps = [i / pieces for i in range(1, pieces)]
    borders = df.groupBy(*keys).agg(
        F.array_distinct(F.percentile_approx(F.col(order), steps, pieces * 4)).alias("_borders")
    )
    # Every FAN-th border first, so a row is compared with about 2 * FAN of them.
    coarse = F.filter("_borders", lambda b, i: i % FAN == FAN - 1)
    width = 16 * (pieces + pieces // FAN)
    placed = attach_one_per_key(df, borders.withColumn("_coarse", coarse), keys, row_bytes=width)
    placed = placed.withColumn("_skip", F.size(F.filter("_coarse", lambda b: b < F.col(order))) * FAN)
    fine = F.filter(F.slice("_borders", F.col("_skip") + 1, F.lit(FAN)), lambda b: b < F.col(order))
    placed = placed.withColumn("_bucket", F.col("_skip") + F.size(fine))
    return _rank_in_buckets(placed.drop("_borders", "_coarse", "_skip"), keys, "_bucket", [F.col(order)], rank)


# Rows of one key that one task may sort to number them.
SORT_LIMIT = 1 << 17


def placed(df: DataFrame, keys: list[str], order: list[Column], place: str = "place", limit: int = SORT_LIMIT) -> DataFrame:
    """1-based place of every row of its key in ``order``, exact at any size of a key; equal rows in any order.

    Keys of more than ``limit`` rows are sorted in ranges: all rows of a range are numbered in its task, and the
    totals of the ranges before, one row per key and range, give the offset.  Without keys, the whole table is one group.
    """
    if keys:
        small, large = split_by_size(df, keys, limit)
        if large is None:
            return small.withColumn(place, F.row_number().over(W.partitionBy(*keys).orderBy(*order)).cast("long"))
        small = small.withColumn(place, F.row_number().over(W.partitionBy(*keys).orderBy(*order)).cast("long"))
        return small.unionByName(_placed_in_ranges(large, keys, order, place))
    return _placed_in_ranges(df, keys, order, place)


def _placed_in_ranges(df: DataFrame, keys: list[str], order: list[Column], place: str) -> DataFrame:
    by = [*[F.col(k) for k in keys], *order]
    # Written once: the number of a row names its task and its place there.
    rows = checkpointed(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_row", F.monotonically_increasing_id()))
    rows = rows.withColumn("_range", F.shiftright("_row", 33))
    ranges = rows.groupBy(*keys, "_range").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = W.partitionBy(*keys).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    ranges = ranges.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    at = join_null_safe(rows, ranges.drop("_rows"), [*keys, "_range"])
    return at.withColumn(place, F.col("_before") + F.col("_row") - F.col("_first") + 1).select(*df.columns, place)
