"""User-supplied models over tables, incrementally.

Results live in a ``ResultStore`` keyed by separate columns.  A run anti-joins
its input with the store, calls the model only for what is missing, appends,
and reads the answer back from the store.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from threading import Thread
from time import monotonic

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxloom.functions import codecs as C
from boxloom.functions import geometry as G
from boxloom.functions.text import flagged_reason
from boxloom.operators import groups
from boxloom.operators.store import RUN, ResultStore
from boxloom.session import checkpointed, forget

ERROR = "_error"
CALL_FAILED = "verification call failed"
MISSING = object()

DETECTION = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("box", T.ArrayType(T.DoubleType())),
        T.StructField("source", T.StringType()),
    ]
)
# Fixed value: reply of the image tagging service, as far as it is used.
TAG_REPLY = "status string, result array<struct<objects:array<struct<tags:array<struct<tag:string>>>>>>"


class RowAnnotator:
    """Base class of row models: set ``fields`` and implement ``process``."""

    fields: T.StructType

    def setup(self) -> None:
        """Called once per task, before the first row."""

    def process(self, row: dict) -> dict:
        raise NotImplementedError


def records(frame: pd.DataFrame) -> list[dict]:
    """``frame.to_dict("records")``, a column at a time."""
    names = list(frame.columns)
    return [dict(zip(names, values)) for values in zip(*[frame[c].tolist() for c in names])]


class _Caller(Thread):
    """Takes rows from a shared iterator until it ends, or until it is given up in a call."""

    def __init__(self, process, rows: list[dict], turns: Iterator[int], found: list):
        super().__init__(daemon=True)
        self.work, self.now, self.given_up = (process, rows, turns, found), None, False

    def run(self) -> None:
        process, rows, turns, found = self.work
        for at in turns:
            self.now = (at, monotonic())
            try:
                result = process(rows[at])
            except BaseException as error:
                result = error
            if found[at] is MISSING:
                found[at] = result
            if self.given_up:
                return


def call_each(process: Callable[[dict], dict], rows: list[dict], threads: int, timeout: float | None) -> list:
    """``process`` of every row, or the exception that it raised; ``threads`` calls at a time.

    Neither a pool's task object nor a lock is spent on a row.  A call that takes longer than ``timeout`` counts as
    failed; its thread is left to itself, and another takes its place.
    """
    found: list = [MISSING] * len(rows)
    # Again only for a row that a thread took in the moment in which it was given up.
    while waiting := [i for i, result in enumerate(found) if result is MISSING]:
        turns = iter(waiting)
        callers = [_Caller(process, rows, turns, found) for _ in range(min(threads, len(waiting)))]
        for caller in callers:
            caller.start()
        while callers := [c for c in callers if c.is_alive()]:
            if timeout is None:
                callers[0].join()
                continue
            for c in list(callers):
                if (now := c.now) is not None and monotonic() - now[1] >= timeout:
                    c.given_up = True
                    found[now[0]] = TimeoutError()
                    callers.remove(c)
                    callers.append(_Caller(process, rows, turns, found))
                    callers[-1].start()
            first = min(callers, key=lambda c: c.now[1] if c.now else monotonic())
            first.join(max(0.0, (first.now[1] if first.now else monotonic()) + timeout - monotonic()))
    for result in found:
        if isinstance(result, BaseException) and not isinstance(result, Exception):
            raise result
    return found


def run_annotator(
    df: DataFrame, keys: list[str], annotator: RowAnnotator, threads: int = 4, timeout: float | None = 120.0, errors: bool = False
) -> DataFrame:
    """Keys and model fields of every row; rows whose call fails or times out are left out.

    With ``errors`` they stay, with empty fields and the reason in the column ``_error``.
    ``threads`` calls of one task wait at the same time (the work is remote).
    """
    schema = T.StructType([df.schema[k] for k in keys] + list(annotator.fields))
    if errors:
        schema = schema.add(ERROR, T.StringType())
    names = [f.name for f in schema]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        annotator.setup()
        for batch in batches:
            rows = records(batch)
            out: dict[str, list] = {name: [] for name in names}
            for row, result in zip(rows, call_each(annotator.process, rows, threads, timeout)):
                failed = isinstance(result, Exception)
                if failed and not errors:
                    continue
                for k in keys:
                    out[k].append(row[k])
                for f in annotator.fields:
                    out[f.name].append(None if failed else result.get(f.name))
                if errors:
                    out[ERROR].append(f"{type(result).__name__}: {result}"[:1000] if failed else None)
            yield pd.DataFrame(out, columns=names, dtype=object)

    return df.mapInPandas(run, schema)


def annotated(
    df: DataFrame,
    keys: list[str],
    annotator: RowAnnotator,
    store: ResultStore,
    tasks: int | None = None,
    rounds: int = 1,
    threads: int = 4,
    timeout: float | None = 120.0,
) -> DataFrame:
    """Model results for the keys of ``df``; only missing keys are computed.

    A key that occurs several times is computed once.  ``rounds`` > 1 appends
    in that many commits, so a failed run keeps its finished rounds.  Calls that failed
    are listed by ``store.failed()`` and tried again next time.  New
    results with an empty field are not returned.
    """
    spark = df.sparkSession
    # One row per key with all its columns: the first by content, so retries agree.  Written, as all that follows reads it.
    rest = [c for c in df.columns if c not in keys]
    if rest:
        asked = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_r")).select(*keys, "_r.*").select(*df.columns)
    else:
        asked = df.distinct()
    asked = checkpointed(asked)
    # Without earlier results every key waits, and the answers are the rows of this run.
    first = not store.exists()
    buckets = None if first else store.touched(asked)
    waiting = asked if first else checkpointed(store.pending(asked, buckets))
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    run = store.next_run()
    for i in range(rounds):
        part = waiting
        if rounds > 1:
            part = waiting.filter(F.pmod(F.xxhash64(*keys), F.lit(rounds)) == i)
        if part.isEmpty():
            continue
        # Written once: both tables come from the same calls.
        calls = checkpointed(run_annotator(part.repartition(tasks, *keys), keys, annotator, threads, timeout, errors=True))
        store.append(calls.filter(F.col(ERROR).isNull()).drop(ERROR), run)
        failed = calls.filter(F.col(ERROR).isNotNull()).select(*keys, ERROR)
        if not failed.isEmpty():
            store.append_failed(failed, run)
        forget(calls)
    if not first:
        forget(waiting)
    fields = [f.name for f in annotator.fields]
    if not store.exists():
        return spark.createDataFrame([], T.StructType([df.schema[k] for k in keys] + list(annotator.fields)))
    usable = F.lit(True)
    for f in fields:
        usable = usable & F.col(f).isNotNull()
    if first:
        return store.read().filter((F.col(RUN) == run) & usable).drop(RUN)
    found = store.stored(asked, buckets)
    complete = F.col(RUN) < run
    return groups.first_per_key(found.filter(complete | usable), keys, [RUN], last=True).drop(RUN)


def with_annotations(
    df: DataFrame, annotations: DataFrame, fields: dict[str, str], keys: list[str] | None = None
) -> DataFrame:
    """Left join of annotations; ``fields`` gives each field's value where there is none."""
    keys = keys or ["im_id"]
    joined = groups.join_on(df.drop(*fields), annotations.select(*keys, *fields), keys, "left")
    return joined.withColumns({f: F.coalesce(f, F.lit(v)) for f, v in fields.items()})


# --- detectors --------------------------------------------------------------

Detect = Callable[[list[dict]], list[list[dict]]]


def detected(
    df: DataFrame, load: Callable[[], Detect], batch: int = 8, output: str = "detections"
) -> DataFrame:
    """Add the model's detections per image row.

    ``load`` runs once per task and returns a function from a list of rows to
    a list of detection lists.  A failing request is repeated row by row; a
    row that fails again, or gets no answer, has no detections.
    """
    schema = T.StructType([*df.drop(output).schema, T.StructField(output, T.ArrayType(DETECTION))])

    def call(model: Detect, rows: list[dict]) -> list[list[dict]]:
        try:
            replies = list(model(rows))
        except Exception:
            if len(rows) == 1:
                return [[]]
            return [call(model, [row])[0] for row in rows]
        return [r or [] for r in replies] + [[] for _ in range(len(rows) - len(replies))]

    def plain(det: dict) -> dict:
        return {
            "name": det.get("name"),
            "score": float(det.get("score", 1.0)),
            "box": [float(v) for v in det.get("box") or []],
            "source": det.get("source", ""),
        }

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for frame in batches:
            rows = records(frame)
            found: list[list[dict]] = []
            for start in range(0, len(rows), batch):
                found.extend(call(model, rows[start : start + batch]))
            out = frame.copy()
            out[output] = [[plain(d) for d in dets] for dets in found]
            yield out

    return df.drop(output).mapInPandas(run, schema)


# --- verification of single boxes -------------------------------------------


def class_setting(settings: dict[str, dict], name: str, default=None, class_name: Column | None = None) -> Column:
    """Setting of the box's class, else the general one, else ``default``."""
    class_name = F.col("name") if class_name is None else class_name
    general = settings.get("general", {}).get(name, default)
    expr = F.lit(general)
    for cls, values in settings.items():
        if cls != "general" and name in values:
            expr = F.when(class_name == cls, F.lit(values[name])).otherwise(expr)
    return expr


def crop_rectangles(df: DataFrame, settings: dict[str, dict]) -> DataFrame:
    """Add the crop rectangle cx1..cy2 of every box; needs image_w and image_h."""
    rect = G.crop_rectangle(
        G.box(),
        F.col("image_w"),
        F.col("image_h"),
        class_setting(settings, "padding", 0.0).cast("double"),
        class_setting(settings, "flat_padding_px").cast("int"),
        class_setting(settings, "min_box_padding").cast("int"),
    )
    return df.withColumns({f"c{c}": v for c, v in zip(G.Box._fields, rect)})


def to_verify(df: DataFrame, classes: Iterable[str]) -> Column:
    """Is the box's class verified?  An empty list means every class."""
    listed = [c.lower() for c in classes]
    return F.lower("name").isin(listed) if listed else F.lit(True)


def verified_boxes(
    df: DataFrame,
    judge: RowAnnotator,
    store: ResultStore,
    settings: dict[str, dict],
    settings_hash: str,
    classes: Iterable[str] = (),
    **run_options,
) -> DataFrame:
    """Add llm_validated, is_valid and reason to every box.

    Verdicts are stored by (image, class, rounded box, settings).  Boxes of
    other classes, and boxes whose crop is empty, count as valid.  A failed
    call counts as invalid and is tried again next time.
    """
    # Written, as questions and answers both read it: a filter on the rectangles would take them apart into their formulas again.
    cropped = crop_rectangles(df, settings).withColumn("box_text", C.box_text(*[F.col(c) for c in G.Box._fields]))
    cropped = checkpointed(cropped).withColumn("settings", F.lit(settings_hash))
    asked = to_verify(df, classes)
    empty = (F.col("cx2") <= F.col("cx1")) | (F.col("cy2") <= F.col("cy1"))
    keys = ["im_id", "name", "box_text", "settings"]
    wanted = cropped.filter(asked & ~empty)
    request = [*keys, "image_w", "image_h", "cx1", "cy1", "cx2", "cy2"]
    answers = annotated(wanted.select(*request), keys, judge, store, **run_options)
    found = answers.select(*keys, F.col("is_valid").alias("_v"), F.col("reason").alias("_r"))
    joined = groups.join_on(cropped, found, keys, "left")
    valid = F.when(asked & ~empty, F.coalesce("_v", F.lit(False))).otherwise(True)
    reason = F.when(asked & ~empty, F.coalesce("_r", F.when(F.col("_v").isNull(), CALL_FAILED))).otherwise("")
    return joined.select(
        *[c for c in df.columns if c not in ("llm_validated", "is_valid", "reason")],
        asked.alias("llm_validated"),
        valid.alias("is_valid"),
        flagged_reason(valid, F.coalesce(reason, F.lit(""))).alias("reason"),
    )


def reply_tags(reply: Column) -> Column:
    """Sorted tags of a tagging reply; not OK or unreadable -> none."""
    parsed = F.from_json(reply, TAG_REPLY)
    nested = F.flatten(
        F.flatten(
            F.transform(
                parsed["result"],
                lambda r: F.transform(
                    F.coalesce(r["objects"], F.array().cast("array<struct<tags:array<struct<tag:string>>>>")),
                    lambda o: F.transform(
                        F.coalesce(o["tags"], F.array().cast("array<struct<tag:string>>")), lambda t: t["tag"]
                    ),
                ),
            )
        )
    )
    tags = F.array_sort(F.filter(nested, lambda t: F.coalesce(t, F.lit("")) != ""))
    return F.when(parsed["status"] == "OK", F.coalesce(tags, C.strings())).otherwise(C.strings())
