"""CSV with quoted multi-line cells, read by many tasks a file."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxloom.session import checkpointed, forget
from boxloom.sources.readers import csv_header

_OPTIONS = {"quote": '"', "escape": '"'}
_SUMS = ["quotes", "full0", "full1", "lone0", "lone1"]


def _lines(spark: SparkSession, path) -> DataFrame:
    """Lines with their file, the byte at which their range starts and their order; ranges are cut at line ends by the text source."""
    value = F.col("value")
    return spark.read.option("lineSep", "\n").text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_range"),
        F.monotonically_increasing_id().alias("_place"),
        (F.length("value") - F.length(F.replace(value, F.lit('"'), F.lit("")))).cast("bigint").alias("_quotes"),
        value.endswith("\r").alias("_cr"),
        F.length("value").alias("_length"),
    )


def _summed(lines: DataFrame) -> DataFrame:
    """Add what comes before a line in its task: quotes, and non-empty lines and lone CRs after an even or odd number of quotes.

    The lines stream through in order, a batch at a time, so a long range is neither sorted nor held.
    """

    def sums(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        seen = dict.fromkeys(_SUMS, 0)
        for quotes, cr, length in batches:
            steps = {"quotes": quotes.to_numpy()}
            odd = (seen["quotes"] + np.cumsum(steps["quotes"]) - steps["quotes"]) % 2 == 1
            for name, lines in (("full", length.to_numpy() > 0), ("lone", cr.to_numpy() & (length.to_numpy() == 1))):
                steps[f"{name}0"], steps[f"{name}1"] = (lines & ~odd).astype("int64"), (lines & odd).astype("int64")
            ends = {name: seen[name] + np.cumsum(steps[name]) for name in _SUMS}
            yield pd.DataFrame({name: ends[name] - steps[name] for name in _SUMS})
            if len(odd):
                seen = {name: int(ends[name][-1]) for name in _SUMS}

    running = F.pandas_udf(sums, ", ".join(f"{name} bigint" for name in _SUMS)).asNondeterministic()
    return lines.withColumn("_sums", running("_quotes", "_cr", "_length"))


def _blank() -> Column:
    return (F.col("_length") == 0) | (F.col("_crlf") & F.col("_cr") & (F.col("_length") == 1))


def _outside() -> Column:
    """Whether a line begins outside of quotes: as many before it, up to an even number, as where its range is outside."""
    return F.col("_sums.quotes") % 2 == F.col("_base")


def _begun(sums: Column, base: Column, crlf: Column) -> Column:
    """Records begun in the task up to a place with these sums, were all of the task like the range with this base."""
    even, odd = (sums[f"full{p}"] - F.when(crlf, sums[f"lone{p}"]).otherwise(0) for p in (0, 1))
    return F.when(base == 0, even).otherwise(odd)


def _ranges(lines: DataFrame) -> DataFrame:
    """One row per range: is it outside after an even (0) or odd number of the task's quotes, do lines of its file end by CR LF,
    how many records the task begins before it, and the file and the files before it."""
    full, lone = F.col("_length") > 0, F.col("_cr") & (F.col("_length") == 1)
    odd = F.col("_sums.quotes") % 2 == 1
    own = {"quotes": F.col("_quotes"), "full0": full & ~odd, "full1": full & odd, "lone0": lone & ~odd, "lone1": lone & odd}
    ends = [F.max(F.col(f"_sums.{name}") + own[name].cast("bigint")).alias(name) for name in _SUMS]
    starts = [F.min(f"_sums.{name}").alias(f"s_{name}") for name in _SUMS]
    sums = lines.groupBy("_file", "_range").agg(F.min_by("_cr", "_place").alias("_first"), *starts, *ends)
    sums = sums.select("_file", "_range", "_first", F.struct(*[F.col(f"s_{n}").alias(n) for n in _SUMS]).alias("_start"), F.struct(*_SUMS).alias("_end"))
    by_file = W.partitionBy("_file").orderBy("_range")
    earlier, whole = by_file.rowsBetween(W.unboundedPreceding, -1), by_file.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    quotes = F.coalesce(F.sum(F.col("_end.quotes") - F.col("_start.quotes")).over(earlier), F.lit(0))
    sided = sums.withColumn("_base", (quotes + F.col("_start.quotes")) % 2).withColumn("_crlf", F.first("_first").over(whole))
    start, end = (_begun(F.col(c), F.col("_base"), F.col("_crlf")) for c in ("_start", "_end"))
    counted = sided.select("_file", "_range", "_base", "_crlf", start.alias("_skipped"), (end - start).alias("_records"))
    return counted.withColumn("_before", F.coalesce(F.sum("_records").over(earlier), F.lit(0)))


def _records(lines: DataFrame) -> DataFrame:
    """Lines of one record that follow each other become one row; it is whole when it begins one and its quotes are closed."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, after, texts = None, None, []

        def rows(columns: list, values: pa.Array) -> pa.RecordBatch:
            at, start, place, begins, quotes = columns
            whole = np.asarray(begins, dtype=bool) & (np.asarray(quotes) % 2 == 0)
            return pa.RecordBatch.from_arrays([pa.array(at), pa.array(start), pa.array(place), pa.array(whole), values], names=["_at", "_range", "_place", "_whole", "value"])

        def last(kind: pa.DataType) -> pa.RecordBatch:
            return rows([np.array([v]) for v in held], pa.array(["\n".join(texts)], kind))

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("_at", "_range", "_place", "_begins", "_quotes")]
            at, start, place, _, quotes = columns
            value = batch.column("value")
            apart = (at[1:] != at[:-1]) | (start[1:] != start[:-1]) | (place[1:] != place[:-1] + 1)
            heads = np.concatenate([[0], np.flatnonzero(apart) + 1])
            bounds = pa.array(np.append(heads, len(at)), pa.int32())
            values = pc.binary_join(pa.ListArray.from_arrays(bounds, value), "\n")
            columns = [c[heads] for c in columns[:4]] + [np.add.reduceat(quotes, heads)]
            if held is not None and after == (at[0], start[0], place[0]):
                held[4] += columns[4][0]
                texts.append(values[0].as_py())
                columns, values = [c[1:] for c in columns], values[1:]
            if len(values):
                if held is not None:
                    yield last(value.type)
                # The last one may go on in the next batch.
                held, texts = [c[-1] for c in columns], [values[-1].as_py()]
                yield rows([c[:-1] for c in columns], values[:-1])
            after = (at[-1], start[-1], place[-1] + 1)
        if held is not None:
            yield last(value.type)

    return lines.mapInArrow(joined, "_at bigint, _range bigint, _place bigint, _whole boolean, value string")


def _text(value: Column) -> Column:
    return F.when(F.col("_crlf") & F.col("_cr"), value.substr(F.lit(1), F.col("_length") - 1)).otherwise(value)


def read_large_csv(spark: SparkSession, path, schema: T.StructType | None = None, position: str | None = None) -> DataFrame:
    """As ``read_csv``, with many tasks for one file: header, quoted cells that may hold line ends, doubled quotes.

    The files are cut into byte ranges.  The quotes before a range, a running sum over one number per range, say whether it
    begins inside a cell; a line begins a record where the quotes before it are even in number.  Lines are numbered and joined as
    they stream through a task, so its memory does not grow with the range; only records that are cut between tasks are shuffled.
    ``position`` names a column for the 0-based place of the row, files in order of their paths.

    Quotes stand around cells or, doubled, inside quoted ones, as writers of the format put them; a single quote inside an
    unquoted cell would shift all that follows, so such files are for ``read_csv``.  Blank lines are no records.  Line ends are LF or CR LF by the
    first line of each file.  Files without rows give none; short records are filled with NULL.
    """
    if schema is None:
        schema = T.StructType([T.StructField(name, T.StringType()) for name in csv_header(spark, path)])
    # Written once: ranges are the same for every later step, and counting reads the narrow columns only.
    lines = checkpointed(_summed(_lines(spark, path)))
    counted = checkpointed(_ranges(lines.drop("value")))
    # One row per file and per range, the header's record taken off.
    sizes = counted.groupBy("_file").agg((F.greatest(F.sum("_records"), F.lit(1)) - 1).alias("_rows"))
    before = W.partitionBy(F.lit(0)).orderBy("_file").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.select("_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_earlier"))
    counted = checkpointed(counted.join(sizes, "_file").drop("_records"))

    # One row per range, so the broadcast is bounded by their number, and the lines keep their order.
    placed = lines.join(F.broadcast(counted), ["_file", "_range"]).withColumn("_begins", _outside() & ~_blank())
    number = _begun(F.col("_sums"), F.col("_base"), F.col("_crlf")) - F.col("_skipped") + F.col("_begins").cast("bigint")
    placed = placed.withColumn("_record", F.col("_before") + number).filter((F.col("_begins") | ~_outside()) & (F.col("_record") > 1))
    at = F.col("_earlier") + F.col("_record") - 2
    records = checkpointed(_records(placed.select(at.alias("_at"), "_range", "_place", "_begins", "_quotes", _text(F.col("value")).alias("value"))))
    forget(lines)
    # Only records that go on in another range, or where the table of lines was cut, meet in a group of their own.
    part = F.struct("_range", "_place", "value")
    parts = records.filter(~F.col("_whole")).groupBy("_at").agg(F.sort_array(F.collect_list(part)).alias("_l"))
    parts = parts.select("_at", F.array_join(F.transform("_l", lambda x: x["value"]), "\n").alias("value"))
    rows = records.filter("_whole").select("_at", "value").unionByName(parts)
    parsed = rows.select(F.from_csv("value", _ddl(schema), _OPTIONS).alias("r"), "_at")
    out = [F.col("r")[f.name].alias(f.name) for f in schema.fields]
    return parsed.select(*out, *([F.col("_at").alias(position)] if position else []))


def read_large_catalog(spark: SparkSession, path) -> DataFrame:
    """``read_catalog`` for a catalog too large for one task: everything is text, ``pos`` is the input row."""
    return read_large_csv(spark, path, position="pos")


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
