"""Records cut in parallel against Spark's own reader, which reads a file with quoted line ends in one task."""

import random

import pytest
from pyspark.sql import functions as F

from riskloom.sources import csv_files as C
from riskloom.sources import csv_records as R

KEYS = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")


@pytest.fixture
def splits(spark):
    old = {k: spark.conf.get(k) for k in KEYS}

    def of(size):
        spark.conf.set(KEYS[0], str(size))
        spark.conf.set(KEYS[1], "0")
    yield of
    for k, v in old.items():
        spark.conf.set(k, v)


def value(rng):
    body = "".join(rng.choice(["a", "b c", '"', ",", "\n", "é", "\n\n"]) for _ in range(rng.randint(0, 14)))
    if rng.random() < 0.5:
        return '"' + body.replace('"', '""') + '"'
    bare = body.replace('"', "").replace(",", "").replace("\n", "")
    return bare + ('"q' if bare and rng.random() < 0.2 else "")   # a quote inside a bare value is a letter


def write(path, rng, rows, nl="\n", last=True):
    lines = ["id,t,u"] + [f"{i},{value(rng)},{value(rng)}" for i in range(rows)]
    path.write_text(nl.join(x.replace("\n", nl) for x in lines) + (nl if last else ""), encoding="utf-8", newline="")
    return f"file:{path}"


def single_task(spark, files):
    rows = spark.read.schema("id string, t string, u string").options(**C.CSV_OPTIONS).csv(files)
    return sorted(map(repr, rows.select(F.col("_metadata.file_path").alias("f"), "id", "t", "u").collect()))


@pytest.mark.parametrize("size", [90, 4000])
def test_equal_to_the_reader_of_one_task(spark, tmp_path, splits, size):
    rng = random.Random(size)
    files = [write(tmp_path / "a 1.csv", rng, 150), write(tmp_path / "b.csv", rng, 90, "\r\n"), write(tmp_path / "c.csv", rng, 1, last=False),
             write(tmp_path / "d.csv", rng, 0)]
    want = single_task(spark, files)
    splits(size)
    rows = C._rows(spark, files, 3)
    got = rows.select(F.col("stored_path").alias("f"), F.col("_0").alias("id"), F.col("_1").alias("t"), F.col("_2").alias("u"), "_place").collect()
    assert all(str(r._place) == r.id for r in got)      # numbered in order, whatever the splits
    assert sorted(repr(r).rsplit(", _place", 1)[0] + ")" for r in got) == want


def test_a_value_over_many_splits_and_one_that_never_ends(spark, tmp_path, splits):
    long = "line, \"\"x\"\"\n\n" * 400
    (tmp_path / "a.csv").write_text(f'id,t,u\n1,"{long}",z\n\n2,b,c\n3,"open\nto the,end\n', encoding="utf-8")
    splits(64)
    file = [f"file:{tmp_path}/a.csv"]
    assert R._lines(spark, file).rdd.getNumPartitions() > 20
    got = {r.place: r.record for r in R.csv_records(spark, file).collect()}
    assert got == {0: "id,t,u", 1: f'1,"{long}",z', 2: "2,b,c", 3: '3,"open\nto the,end'}


def test_headers(spark, tmp_path):
    for name, text, want in [("a", "", []), ("b", "\n\n", []), ("c", "﻿id, t\r\n1,2", ["id", "t"]), ("d", '"a\nb",c\n', ["a\nb", "c"]), ("e", "one", ["one"])]:
        (tmp_path / name).write_text(text, encoding="utf-8", newline="")
        assert R.header(spark, f"file:{tmp_path}/{name}") == want


def test_files_may_order_columns_freely(spark, tmp_path):
    (tmp_path / "a.csv").write_text("t,u,u\n1,2,3\n")
    (tmp_path / "b.csv").write_text("x,t\n4,5\n")
    (tmp_path / "c.csv").write_text("")
    rows = C.read_news_csv(spark, str(tmp_path))
    assert rows.columns == ["t", "u1", "u2", "x"]
    assert sorted(map(tuple, rows.collect()), key=str) == [("1", "2", "3", None), ("5", None, None, "4")]
