"""Tables that are replaced at one stroke.

Data is written beside what is stored; then a small manifest, numbered one higher than the last, makes it current. Every
part of a store (a batch of uploads, or a table kept by key) has manifests of its own. A reader takes the last manifest
that is whole, so before the switch it finds the old rows and after it the new ones, in all tables of the part alike.
Two writers of one part cannot both make the same number; the second one fails and leaves nothing behind that is read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from urllib.parse import quote, unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskloom.schemas import TABLES


class Conflict(RuntimeError):
    """Another writer has switched the part in the meantime."""


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, where = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def _folder(root: str, part: str) -> str:
    return f"{root}/_manifests/{quote(part, safe='')}"


def manifest(spark: SparkSession, root: str, part: str) -> tuple[int, dict]:
    """(number, content) of the part's current manifest; 0 and nothing before the first."""
    folder = _folder(root, part)
    for name in reversed([n for n in _names(spark, folder) if n.isdigit()]):
        fs, where = _fs(spark, f"{folder}/{name}")
        stream = fs.open(where)
        try:
            body = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return int(name), json.loads(body)
        except ValueError:  # still being written, or its writer was lost
            continue
    return 0, {}


def switch(spark: SparkSession, root: str, part: str, after: int, content: dict) -> None:
    """Make ``content`` the part's manifest, if the one it was made from (number ``after``) is still the last."""
    folder = _folder(root, part)
    taken = [int(n) for n in _names(spark, folder) if n.isdigit()]
    number, _ = manifest(spark, root, part)
    if number != after:
        raise Conflict(f"{part} was switched to {number} while {after} was being replaced")
    fs, where = _fs(spark, f"{folder}/{max([after, *taken]) + 1:012d}")
    try:
        out = fs.create(where, False)
    except Py4JJavaError as exc:
        raise Conflict(f"{part} is being switched by another writer") from exc
    try:
        out.write(bytearray(json.dumps(content).encode()))
    finally:
        out.close()


def parts(spark: SparkSession, root: str) -> list[str]:
    return [unquote(n) for n in _names(spark, f"{root}/_manifests")]


def new_version() -> str:
    return uuid.uuid4().hex


def version_path(root: str, version: str, table: str) -> str:
    return f"{root}/data/v={version}/t={table}"


# --- batches made of files --------------------------------------------------------


def write_files(tables: dict[str, DataFrame], root: str) -> dict[tuple[str, str], dict[str, list]]:
    """Write rows of several tables (with batch_id and file_id) as one new version, which nobody reads yet.

    Returns, per batch and file, the number of rows in each table that has some, and the folder they lie in.
    """
    version, counts = new_version(), {}
    for name, df in tables.items():
        path = version_path(root, version, name)
        df.write.partitionBy("batch_id", "file_id").parquet(path)
        written = df.sparkSession.read.schema(df.schema).parquet(path)
        folder = F.regexp_extract(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), "^(.*)/[^/]+$", 1)
        for r in written.groupBy("batch_id", "file_id").agg(F.count(F.lit(1)).alias("n"), F.min(folder).alias("folder")).collect():  # a step's files
            counts.setdefault((r.batch_id, r.file_id), {})[name] = [r.n, r.folder]
    return counts


def record_files(spark: SparkSession, root: str, batch: str, files: dict[str, dict]) -> dict:
    """Switch a batch to a manifest in which the given files have new entries; other files stay. Returns all entries."""
    number, content = manifest(spark, root, batch)
    now = {**content.get("files", {}), **files}
    switch(spark, root, batch, number, {"files": now})
    return now


def file_ledger(spark: SparkSession, root: str, batches: Iterable[str] | None = None) -> DataFrame:
    """(batch_id, file_id, stored_path, epoch, items, rejected, processed_at, error_message): every file of the batches, once."""
    rows = []
    for batch in parts(spark, root) if batches is None else batches:
        for file_id, e in manifest(spark, root, batch)[1].get("files", {}).items():
            items, rejected = (e.get("rows", {}).get(t, [0])[0] for t in ("news_items", "rejected_rows"))
            rows.append((batch, file_id, e["path"], e["epoch"], items, rejected, e["at"], e.get("error")))
    ledger = spark.createDataFrame(rows, "batch_id string, file_id string, stored_path string, epoch long, items long, rejected long, at string, "
                                         "error_message string")
    return ledger.withColumn("processed_at", F.to_timestamp("at")).drop("at")


def read_files(spark: SparkSession, root: str, table: str, schema: StructType | str, batches: Iterable[str] | None = None) -> DataFrame:
    """Current rows of a table of batches; only the folders that the manifests name are listed and read."""
    folders = []
    for batch in parts(spark, root) if batches is None else batches:
        for file_id, e in manifest(spark, root, batch)[1].get("files", {}).items():
            if table in e.get("rows", {}):
                folders.append(e["rows"][table][1])
    if not folders:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", f"{root}/data")
    return reader.parquet(*folders).select(*spark.createDataFrame([], schema).columns)


# --- tables kept by key -----------------------------------------------------------


def _declared(df: DataFrame, name: str) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in TABLES[name].fields])


def keyed_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Current rows of a declared table; none before the first merge."""
    version = manifest(spark, root, f"table:{name}")[1].get("version")
    reader = spark.read.schema(TABLES[name])
    return reader.parquet(version_path(root, version, name)) if version else spark.createDataFrame([], TABLES[name])


def merge_by_key(updates: DataFrame, root: str, name: str, key: Sequence[str] = ("id",)) -> None:
    """Rows of known keys are replaced, others are added, all at one stroke.

    Keys of the updates must differ: of two rows for one key neither could be said to be the last.
    """
    spark = updates.sparkSession
    rows = _declared(updates, name)
    twice = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not twice.isEmpty():
        raise ValueError(f"updates of {name} repeat a key")
    part = f"table:{name}"
    number, _ = manifest(spark, root, part)
    kept = keyed_table(spark, root, name).join(rows.select(*key), list(key), "left_anti")
    version = new_version()
    _declared(kept, name).unionByName(rows).write.parquet(version_path(root, version, name))
    switch(spark, root, part, number, {"version": version})
