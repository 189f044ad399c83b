"""Detection models: packed requests, answers cached per image, model and settings."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxloom.functions.text import settings_hash
from boxloom.operators import groups
from boxloom.operators.annotate import DETECTION, ERROR, records
from boxloom.operators.store import RUN, ResultStore
from boxloom.session import checkpointed, forget

KEYS = ["im_id", "model", "settings"]
WANTED = "wanted_classes"
#: A request: image rows and the prompts of one class group; the answer is a list of detections per image.
Request = Callable[[list[dict], list[str]], list[list[dict]]]


@dataclass(frozen=True)
class Detector:
    """A prompted detection model.

    ``classes`` are asked in ``class_groups``, or in groups of ``per_prompt``.  A class with ``class_aliases`` is asked by these
    names, and what is found counts as the class.  ``batch`` images share a request.  ``load`` runs once per task.
    """

    model: str
    load: Callable[[], Request]
    classes: tuple[str, ...] = ()
    class_groups: tuple[tuple[str, ...], ...] = ()
    class_aliases: dict[str, list[str]] = field(default_factory=dict)
    per_prompt: int | None = 15
    batch: int = 8
    settings: dict = field(default_factory=dict)

    def settings_hash(self) -> str:
        """Digest of all that an answer depends on; the size of requests is no part of it."""
        parts = {"classes": self.classes, "groups": self.class_groups, "aliases": self.class_aliases, "per_prompt": self.per_prompt}
        return settings_hash({**parts, **self.settings}, 8)

    def prompts(self, classes: list[str] | None = None) -> list[list[str]]:
        """Prompts of each class group: aliases instead of their class, blanks instead of underlines.

        ``classes`` asks for these only, in groups of ``per_prompt``.
        """
        asked = self.classes if classes is None else classes
        size = self.per_prompt or max(1, len(asked))
        groups_of = self.class_groups if classes is None else ()
        found = groups_of or [asked[i : i + size] for i in range(0, len(asked), size)]
        named = [[name for c in group for name in (self._aliases(c) if c in self.class_aliases else [c])] for group in found]
        return [[name.replace("_", " ") for name in group] for group in named if group]

    def _aliases(self, name: str) -> list[str]:
        return [a.strip() for a in self.class_aliases[name] or [] if a and a.strip()]

    def class_names(self) -> dict[str, str]:
        """Class of every name that an answer may use."""
        plain = [c for group in (self.class_groups or [self.classes]) for c in group]
        out = {c.replace("_", " "): c for c in plain}
        for name in self.class_aliases:
            for alias in self._aliases(name):
                out |= {alias: name, alias.replace(" ", "_"): name, alias.replace("_", " "): name}
        return out


def _asked(detector: Detector):
    names = detector.class_names()

    def plain(det: dict) -> dict:
        name = det.get("name")
        return {
            "name": names.get(name, name),
            "score": float(det.get("score", 1.0)),
            "box": [float(v) for v in det.get("box") or []],
            "source": det.get("source") or detector.model,
        }

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        request = detector.load()
        for frame in batches:
            rows = records(frame.drop(columns=[WANTED, *KEYS[1:]], errors="ignore"))
            found: list[list[dict]] = [[] for _ in rows]
            failed: list[str | None] = [None] * len(rows)

            def take(at: list[int], group: list[str]) -> None:
                # No answer for an image of the request means nothing was found.
                for i, dets in zip(at, request([rows[i] for i in at], group)):
                    found[i].extend(plain(d) for d in dets or [])

            def ask(at: list[int], group: list[str]) -> None:
                before = [len(found[i]) for i in at]
                try:
                    return take(at, group)
                except Exception as error:
                    reason = f"{type(error).__name__}: {error}"[:1000]
                for i, n in zip(at, before):
                    del found[i][n:]
                    if len(at) == 1:
                        failed[i] = reason
                    else:
                        ask([i], group)

            # Images that are asked for the same classes share requests.
            alike: dict[tuple | None, list[int]] = {}
            if WANTED in frame:
                for i, classes in enumerate(frame[WANTED]):
                    alike.setdefault(tuple(classes), []).append(i)
            elif rows:
                alike[None] = list(range(len(rows)))
            for classes, members in alike.items():
                prompts = detector.prompts(None if classes is None else list(classes))
                for start in range(0, len(members), detector.batch):
                    for group in prompts:
                        at = [i for i in members[start : start + detector.batch] if failed[i] is None]
                        if at:
                            ask(at, group)
            out = frame[KEYS].copy()
            out["detections"] = [None if bad else dets for dets, bad in zip(found, failed)]
            out[ERROR] = failed
            yield out

    return run


def packed_detections(images: DataFrame, detector: Detector, store: ResultStore, tasks: int | None = None, repeated: bool = True) -> DataFrame:
    """``im_id`` and ``detections`` of every image; only images without a stored answer of this model and settings are asked.

    Rows of ``images`` go to the model with all their columns; an image that repeats is asked once.  Requests hold ``batch``
    images and one class group.  A request that fails is repeated image by image; an image that fails again has no
    detections, is listed by ``store.failed()`` and asked again next time.  Empty answers are stored like others.
    A column ``wanted_classes`` (array of names) asks each image for these classes only; such answers are stored apart for each list.
    ``repeated=False``: the caller knows that every image is there once.
    """
    spark = images.sparkSession
    rest = [c for c in images.columns if c != "im_id"]
    one = images
    if repeated:
        one = images.groupBy("im_id").agg(F.min(F.struct(*rest)).alias("_r")).select("im_id", "_r.*") if rest else images.distinct()
    settings = F.lit(detector.settings_hash())
    if WANTED in rest:
        settings = F.concat(settings, F.lit(":"), F.md5(F.to_json(F.col(WANTED)).cast("binary")))
    named = {"model": F.lit(detector.model), "settings": settings}
    clashing = [c for c in rest if c in named]
    if clashing:
        raise ValueError(f"columns {clashing} name the cache's keys")
    asked = checkpointed(one.withColumns(named))
    buckets = store.touched(asked)
    waiting = checkpointed(store.pending(asked, buckets))
    if not waiting.isEmpty():
        schema = T.StructType([*[asked.schema[k] for k in KEYS], T.StructField("detections", T.ArrayType(DETECTION)), T.StructField(ERROR, T.StringType())])
        # Dealt by image, and inside a task in the order of the classes that are asked for.
        dealt = waiting.repartition(tasks or int(spark.conf.get("spark.sql.shuffle.partitions")), "im_id")
        if WANTED in rest:
            dealt = dealt.sortWithinPartitions(WANTED, "im_id")
        calls = checkpointed(dealt.mapInPandas(_asked(detector), schema))
        run = store.next_run()
        store.append(calls.filter(F.col(ERROR).isNull()).select(*KEYS, "detections"), run)
        failed = calls.filter(F.col(ERROR).isNotNull()).select(*KEYS, ERROR)
        if not failed.isEmpty():
            store.append_failed(failed, run)
        forget(calls)
    forget(waiting)
    none = F.array().cast(T.ArrayType(DETECTION))
    if not store.exists():
        return asked.select("im_id", none.alias("detections"))
    found = groups.first_per_key(store.stored(asked, buckets), KEYS, [RUN], last=True)
    joined = groups.join_on(asked.select("im_id"), found.select("im_id", "detections"), ["im_id"], "left")
    return joined.withColumn("detections", F.coalesce("detections", none))
