"""CSV records of large files, cut in parallel although quoted values may hold line ends.

A file is read as lines, in splits. A line's effect depends on whether it begins inside a quoted value, so each split is
read once under both assumptions; it tells how it ends and how many records begin in it. Running over a file's splits in
order, one small row each, gives every split its true start and the number of its first record. The splits are then cut
independently; records that cross a split's edge are put together from their parts, and only those parts are shuffled.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.session import materialize

T = TypeVar("T")
_CLOSE = re.compile(r'[^"]*(?:""[^"]*)*"(?!")')
HEAD_BYTES = 1 << 20  # a header is looked for in the first bytes of a file


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted value is open after the line. Quotes count at the start of a value, or doubled in a quoted one."""
    if '"' not in line:
        return inside
    at = 0
    while True:
        if not inside and line[at:at + 1] == '"':
            inside, at = True, at + 1
        if inside:
            closed = _CLOSE.match(line, at)
            if closed is None:
                return True
            inside, at = False, closed.end()
        at = line.find(",", at) + 1
        if at == 0:
            return False


def _bare(line: str) -> str:
    return line[:-1] if line.endswith("\r") else line


def _lines(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """Lines in the order of their split; `f` the file, `b` the split's place in it."""
    return spark.read.option("lineSep", "\n").text(list(files)).select(
        F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), "value")


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per split: is a value open at its end, and how many records begin in it, if it began outside or inside one."""
    def row(f, b, state, n):
        return pa.RecordBatch.from_pydict({"f": [f], "b": [b], "end_out": [state[0]], "end_in": [state[1]], "n_out": [n[0]], "n_in": [n[1]]})

    now, state, n = None, [False, True], [0, 0]
    for batch in batches:
        for f, b, line in zip(*(c.to_pylist() for c in batch.columns)):
            if (f, b) != now:
                if now is not None:
                    yield row(*now, state, n)
                now, state, n = (f, b), [False, True], [0, 0]
            line = _bare(line)
            for k in (0, 1):
                n[k] += bool(line) and not state[k]
                if '"' in line:
                    state[k] = ends_inside(line, state[k])
    if now is not None:
        yield row(*now, state, n)


def _starts(surveyed: DataFrame) -> DataFrame:
    """(f, b, inside, first, open): how each split begins, the number of the first record in it, and whether it ends in a value."""
    before = Window.partitionBy("f").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    settled = F.col("end_out") == F.col("end_in")     # the split ends alike however it began
    swaps = (F.col("end_out") & ~F.col("end_in")).cast("int")
    known = surveyed.withColumn("_swaps", F.coalesce(F.sum(swaps).over(before), F.lit(0)))
    last = F.last(F.when(settled, F.struct(F.col("end_out").cast("int").alias("end"), "_swaps")), ignorenulls=True).over(before)
    known = known.withColumn("_last", last)
    since = F.col("_swaps") - F.coalesce(F.col("_last._swaps"), F.lit(0))
    inside = (F.coalesce(F.col("_last.end"), F.lit(0)) + since) % 2 == 1
    known = known.withColumn("inside", inside).withColumn("_n", F.when(F.col("inside"), F.col("n_in")).otherwise(F.col("n_out")))
    ends = F.when(F.col("inside"), F.col("end_in")).otherwise(F.col("end_out"))
    return known.select("f", "b", "inside", ends.alias("open"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("first"))


def _cut(edges: bool, alone: bool = False):
    """Records that lie in one split, or the parts of those that cross its edges. A split may be a file of its own."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, inside, place, part, crossing = None, False, 0, [], False
        out: list[tuple] = []

        def put(whole: bool):
            nonlocal part
            if part and whole != edges:
                out.append((*now, place, "\n".join(part)))
            part = []

        def flush():
            rows = list(zip(*out)) or [(), (), (), ()]
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(rows[0], pa.string()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.int64()), pa.array(rows[3], pa.string())],
                names=["f", "b", "place", "record"])

        for batch in batches:
            for f, b, line, starts, first in zip(*(c.to_pylist() for c in batch.columns)):
                if (f, b) != now:
                    put(whole=alone)   # what is open at a split's end
                    now, inside, place, crossing = (f, b), starts, first - 1, starts
                line = _bare(line)
                if not inside:
                    if not line:
                        continue
                    place += 1
                part.append(line)
                inside = ends_inside(line, inside)
                if not inside:
                    put(whole=not crossing)
                    crossing = False
            yield flush()
        put(whole=alone)
        yield flush()
    return cut


def _never_split(spark: SparkSession, files: Sequence[str]) -> tuple[list[str], list[str]]:
    """Files so small that Spark reads each in one split, and the others."""
    conf = spark._jsparkSession.sessionState().conf()
    limit = min(conf.filesMaxPartitionBytes(), conf.filesOpenCostInBytes())

    def size(path: str) -> int:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where).getLen()

    small = [n <= limit for n in _each(size, files)]
    return [f for f, s in zip(files, small) if s], [f for f, s in zip(files, small) if not s]


def _each(work: Callable[[str], T], files: Sequence[str]) -> list[T]:
    with ThreadPoolExecutor(16) as pool:
        return list(pool.map(work, files))


def csv_records(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """(f, place, record): the text of every record, numbered from 0 in its file; the header is record 0.

    Empty lines between records are left out, line ends inside values become one line feed. A value that is never closed
    takes the rest of its file. The starts of the splits are broadcast: one row of about 100 bytes per split of a file.
    Files that are never split need none. A split that was not surveyed, because the cluster's size changed the splits in
    between, stops the job.
    """
    small, large = _never_split(spark, files)
    schema = "f string, b long, place long, record string"
    out = None
    if small:
        lines = _lines(spark, small).select("*", F.lit(False).alias("inside"), F.lit(0).cast("long").alias("first"))
        out = lines.mapInArrow(_cut(edges=False, alone=True), schema).select("f", "place", "record")
    if large:
        cut = _records_over_splits(spark, large, schema)
        out = cut if out is None else out.unionByName(cut)
    return out


def _records_over_splits(spark: SparkSession, files: Sequence[str], schema: str) -> DataFrame:
    starts = materialize(_starts(_lines(spark, files).mapInArrow(
        _survey, "f string, b long, end_out boolean, end_in boolean, n_out long, n_in long")), "starts")
    near = F.broadcast(starts.select(F.col("f").alias("_f"), F.col("b").alias("_b"), "inside", "first"))
    lines = _lines(spark, files)
    placed = lines.join(near, (F.col("f") == F.col("_f")) & (F.col("b") == F.col("_b")), "left").select(
        "f", "b", "value", F.when(F.col("first").isNull(), F.raise_error(F.lit("splits have changed"))).otherwise(F.col("inside")).alias("inside"), "first")
    whole = placed.mapInArrow(_cut(edges=False), schema).select("f", "place", "record")
    if starts.where("open").isEmpty():
        return whole
    parts = placed.mapInArrow(_cut(edges=True), schema).groupBy("f", "place").agg(
        F.array_sort(F.collect_list(F.struct("b", "record"))).alias("parts"))
    joined = F.array_join(F.transform("parts", lambda p: p["record"]), "\n")
    return whole.unionByName(parts.select("f", "place", joined.alias("record")))


def headers(spark: SparkSession, files: Sequence[str]) -> list[list[str]]:
    """The column names of each file; none for an empty one."""
    return _each(lambda f: header(spark, f), files)


def header(spark: SparkSession, path: str) -> list[str]:
    """The column names of a file; none for an empty one. Only the first bytes are read, on the driver."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = where.getFileSystem(spark._jsc.hadoopConfiguration()).open(where)
    try:
        wrapped = spark._jvm.org.apache.commons.io.input.BoundedInputStream(stream, HEAD_BYTES)
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(wrapped, "UTF-8")
    finally:
        stream.close()
    part: list[str] = []
    inside = False
    for line in text.lstrip("\ufeff").split("\n"):
        line = _bare(line)
        if part or line.strip():
            part.append(line)
            inside = ends_inside(line, inside)
            if not inside:
                return [n.strip() for n in next(csv.reader(["\n".join(part)]))]
    return []
