"""Session settings shared by jobs, tests and the benchmark."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "boxloom", **extra: str) -> SparkSession:
    """Session for tests and benchmarks on one machine; clusters bring their own."""
    n = 8 if cpus == "*" else int(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", extra.pop("driver_memory", "8g"))
        .config("spark.ui.enabled", "false")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint folder of the session.

    The cluster names a shared folder in ``spark.checkpoint.dir``.  Only a
    local session without that setting gets a temporary folder.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="boxloom-checkpoint-")
    context.setCheckpointDir(configured)
    return configured


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back.

    Cuts the lineage and survives lost executors.  Unlike a checkpointed plan,
    the table brings fresh columns and its true size, so joins with small
    results can be broadcast.  ``forget`` deletes it when nothing reads it any more,
    ``tables_of_a_job`` all tables of a job at its end.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    for written in _JOBS:
        written.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_table = path
    return out


_JOBS: list[list[str]] = []


def _delete(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def forget(*tables: DataFrame) -> None:
    """Delete tables of ``checkpointed``; other frames, and what was selected from a table, are left alone."""
    for df in tables:
        path = df.__dict__.get("written_table")
        if path:
            _delete(df.sparkSession, path)


@contextmanager
def tables_of_a_job(spark: SparkSession) -> Iterator[None]:
    """Delete at the end all tables that ``checkpointed`` wrote inside; write the result to its place inside, too."""
    written: list[str] = []
    _JOBS.append(written)
    try:
        yield
    finally:
        _JOBS.remove(written)
        for path in written:
            _delete(spark, path)


def ship_packages(spark: SparkSession, *folders: str) -> None:
    """Send Python packages to the workers, for clusters where they are not installed."""
    context = spark.sparkContext
    done = context.__dict__.setdefault("_shipped_packages", set())
    for folder in [str(Path(__file__).parent), *folders]:
        if folder in done:
            continue
        root = Path(folder)
        archive = Path(tempfile.mkdtemp(prefix="boxloom-ship-")) / f"{root.name}.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(root.rglob("*.py")):
                out.write(source, source.relative_to(root.parent))
        context.addPyFile(str(archive))
        done.add(folder)
