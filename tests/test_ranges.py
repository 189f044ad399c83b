"""Splittable CSV against the whole-file reader."""

import random

import pytest
from pyspark.sql import types as T

from boxloom.session import checkpointed
from boxloom.sources import ranges
from boxloom.sources.ranges import _lines, read_large_csv
from boxloom.sources.readers import read_csv


@pytest.fixture()
def small_ranges(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def quoted(chance):
    parts = ["ring", "é日", " ", ",", '""', "\n", "\n\n", "x" * 90, "end"]
    return '"' + "".join(chance.choice(parts) for _ in range(chance.randrange(6))) + '"'


def written(folder, name, n, seed, end="\n"):
    chance = random.Random(seed)
    lines = ["id,im_name,im_description"]
    for i in range(n):
        lines.append(f"{seed * 1000 + i},{chance.choice(['plain', '', quoted(chance)])},{quoted(chance)}")
        lines += [""] * (chance.random() < 0.1)
    (folder / name).write_bytes(end.join(x.replace("\n", end) for x in lines).encode() + (end.encode() if seed % 2 else b""))


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_equal_to_whole_files(spark, tmp_path, small_ranges):
    written(tmp_path, "a.csv", 300, 1)
    written(tmp_path, "b.csv", 120, 2)
    written(tmp_path, "c.csv", 150, 3, end="\r\n")
    (tmp_path / "d.csv").write_text("id,im_name,im_description\n")
    (tmp_path / "e.csv").write_text('id,im_name,im_description\n1,"' + "long\n" * 2000 + '",z\n2,short\n')
    path = str(tmp_path)
    got = read_large_csv(spark, path, position="pos")
    assert rows(got.drop("pos")) == rows(read_csv(spark, path)) and got.count() == 572
    assert _lines(spark, f"{path}/a.csv").rdd.getNumPartitions() > 5
    ordered = [r["id"] for r in got.orderBy("pos").collect()]
    assert ordered == [str(s * 1000 + i) for s, n in ((1, 300), (2, 120), (3, 150)) for i in range(n)] + ["1", "2"]
    assert sorted(r["pos"] for r in got.collect()) == list(range(572))


def test_types_and_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,score,"odd ""name"""\n1,0.5,"a\nb"\n2,,\n')
    typed = read_csv(spark, str(tmp_path)).schema
    typed["id"].dataType = T.LongType()
    assert rows(read_large_csv(spark, str(tmp_path), typed)) == rows(read_csv(spark, str(tmp_path), typed)) == [(1, "0.5", "a\nb"), (2, None, None)]
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "x.csv").write_text("id,name\n")
    assert read_large_csv(spark, str(tmp_path / "b"), position="pos").collect() == []


def test_lines_are_numbered_and_joined_without_a_sort(spark, tmp_path, small_ranges, monkeypatch):
    plans = []

    def kept(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return checkpointed(df)

    monkeypatch.setattr(ranges, "checkpointed", kept)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    # Records and the state of quotes go over from batch to batch.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        for name, end, seed in (("lf", "\n", 5), ("crlf", "\r\n", 6)):
            (tmp_path / name).mkdir()
            written(tmp_path / name, "a.csv", 60, seed, end)
            path = str(tmp_path / name)
            got = read_large_csv(spark, path, position="pos")
            assert rows(got.drop("pos")) == rows(read_csv(spark, path))
            assert [r["id"] for r in got.orderBy("pos").collect()] == [str(seed * 1000 + i) for i in range(60)]
            plans.append(got._jdf.queryExecution().executedPlan().toString())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    # Ranges are sorted, one row each; lines never are, and neither are they shuffled.
    texts = [p for p in plans if "value" in p and "_at" in p]
    assert len(texts) == 4 and not any("Window" in p for p in texts)
    assert not any("Sort [" in p or "hashpartitioning" in p for p in texts if "MapInArrow" in p)
    assert sum("MapInArrow" in p for p in texts) == 2
