"""Path lookups through the Hadoop file system, so they work on any store."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession


def _fs_path(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop = _fs_path(spark, path)
    return fs.exists(hadoop)


def listed(spark: SparkSession, path: str) -> list[str]:
    """Full paths directly under ``path``, sorted; none if it does not exist."""
    fs, hadoop = _fs_path(spark, path)
    if not fs.exists(hadoop):
        return []
    return sorted(s.getPath().toString() for s in fs.listStatus(hadoop))


def first_existing(spark: SparkSession, candidates: list[str]) -> str:
    for path in candidates:
        if path and path_exists(spark, path):
            return path
    raise FileNotFoundError(f"none of {candidates} exists")


def dataset_path(spark: SparkSession, prepared: str | None, root: str, path: str, prefer_prepared: bool = True) -> str:
    """Prepared copy first (if preferred), then under the root, then as given, then the prepared copy."""
    order = [prepared] if prefer_prepared else []
    order += [f"{root.rstrip('/')}/{path}", path, prepared]
    return first_existing(spark, [p for p in order if p])


def catalog_path(spark: SparkSession, csv: str | None, folder: str | None) -> str:
    """Explicit CSV, else ``catalog.csv`` of the folder, else its first CSV by name."""
    if csv:
        return first_existing(spark, [csv])
    usual = f"{folder}/catalog.csv"
    if path_exists(spark, usual):
        return usual
    found = [p for p in listed(spark, folder) if p.endswith(".csv")]
    if not found:
        raise FileNotFoundError(f"no CSV in {folder}")
    return found[0]


def input_path(spark: SparkSession, name: str, folders: list[str]) -> str:
    """A given path, else the same name in the listed folders or their ``corrections`` folder."""
    tries = [name]
    for folder in folders:
        tries += [f"{folder.rstrip('/')}/{name}", f"{folder.rstrip('/')}/corrections/{name}"]
    return first_existing(spark, tries)


def next_version(spark: SparkSession, folder: str) -> int:
    """One above the highest ``v<N>`` in the folder; 1 in an empty one."""
    found = [re.search(r"/v(\d+)/?$", p) for p in listed(spark, folder)]
    return max([int(m.group(1)) for m in found if m], default=0) + 1


def stored_image_path(root: str, key: str, flat: bool = False) -> str:
    """Content-addressed location: ``<key>`` or ``<first two>/<key>``."""
    root = root.rstrip("/")
    return f"{root}/{key}" if flat else f"{root}/{key[:2]}/{key}"


def claimed(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it exists, also when another job creates it at the same time."""
    fs, hadoop = _fs_path(spark, path)
    fs.mkdirs(hadoop.getParent())
    if fs.getScheme() == "file":
        return spark._jvm.java.io.File(hadoop.toUri().getPath()).createNewFile()
    try:
        return fs.createNewFile(hadoop)
    except Exception as error:
        if fs.exists(hadoop):
            return False
        raise error


def claimed_number(spark: SparkSession, folder: str, prefix: str, first: int = 0) -> int:
    """Smallest number above all files ``<prefix><N>`` of the folder, claimed by a file of that name."""
    found = [re.search(rf"/{re.escape(prefix)}(\d+)$", p) for p in listed(spark, folder)]
    number = max([int(m.group(1)) + 1 for m in found if m], default=first)
    number = max(number, first)
    while not claimed(spark, f"{folder}/{prefix}{number}"):
        number += 1
    return number


def deleted(spark: SparkSession, path: str) -> None:
    fs, hadoop = _fs_path(spark, path)
    fs.delete(hadoop, True)
