"""CSV sources and sinks of the upload path."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.constants import NULL_TOKENS, OPTIONAL_COLUMNS, REQUIRED_COLUMNS, RESULT_COLUMNS
from riskloom.functions.text import is_blank
from riskloom.sources.csv_records import csv_records, headers

CSV_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"'}


RECORD_OPTIONS = {"quote": '"', "escape": '"', "mode": "PERMISSIVE"}


def _named(names: Sequence[str]) -> list[str]:
    """Column names that differ: a missing name is the column's place, a repeated one gets its place added."""
    return [f"_c{i}" if not n else f"{n}{i}" if list(names).count(n) > 1 else n for i, n in enumerate(names)]


def _rows(spark: SparkSession, files: Sequence[str], width: int) -> DataFrame:
    """`stored_path`, `_place` and the values `_0` … of every record after the header, all files having one header."""
    declared = ", ".join(f"`_{i}` string" for i in range(width))
    records = csv_records(spark, files).where("place > 0")
    return records.select(
        F.col("f").alias("stored_path"), (F.col("place") - 1).alias("_place"), F.from_csv("record", declared, RECORD_OPTIONS).alias("r")).select(
        "stored_path", "_place", "r.*")


def read_news_csv(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Read CSV files by header; every column is text, quoted newlines are kept.

    Columns are found by name in the header of each file, so files may order them freely. A large file is cut into
    many tasks, see `csv_records`. Use `null_tokens` for default missing-value handling.
    """
    listed = spark.read.option("pathGlobFilter", "*.csv").text([path] if isinstance(path, str) else list(path)).inputFiles()
    groups: dict[tuple[str, ...], list[str]] = {}
    files = sorted(unquote(f) for f in listed)
    for f, names in zip(files, headers(spark, files)):
        if names:
            groups.setdefault(tuple(_named(names)), []).append(f)
    if not groups:
        raise ValueError("the file is empty")
    parts = [_rows(spark, group, len(names)).select(*[F.col(f"_{i}").alias(n) for i, n in enumerate(names)])
             for names, group in groups.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def null_tokens(df: DataFrame, cols: Iterable[str] | None = None, tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Turn the usual spellings of a missing value into null."""
    names = list(cols) if cols is not None else [n for n, t in df.dtypes if t == "string"]
    return df.withColumns({c: F.when(~F.col(c).isin(list(tokens)), F.col(c)) for c in names})


def require_columns(df: DataFrame, cols: Iterable[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Raise before any job runs when columns are missing."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError("missing required columns: " + ", ".join(missing))
    return df


def missing_columns(df: DataFrame, cols: Iterable[str]) -> list[str]:
    return [c for c in cols if c not in df.columns]


def align_optional_columns(
    df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS, optional: Sequence[str] = OPTIONAL_COLUMNS,
) -> DataFrame:
    """Exactly the required and optional columns; absent optional ones are null."""
    require_columns(df, required)
    have = set(df.columns)
    return df.select(
        *required,
        *[F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in optional],
    )


def reject_reason(required: Sequence[str] = REQUIRED_COLUMNS):
    """Names of the blank required columns, joined by `;`; null for a valid row."""
    blank = F.concat_ws(";", *[F.when(is_blank(c), F.lit(c)) for c in required])
    return F.nullif(blank, F.lit(""))


def split_valid_rejected(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> tuple[DataFrame, DataFrame]:
    """Rows with all required texts, and the others with a `reject_reason`."""
    require_columns(df, required)
    marked = df.withColumn("reject_reason", reject_reason(required))
    return (
        marked.filter(F.col("reject_reason").isNull()).drop("reject_reason"),
        marked.filter(F.col("reject_reason").isNotNull()),
    )


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Raise when a frame is empty; reads at most one row."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def read_upload(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """The whole intake check of one upload: rows, columns, blank texts."""
    raw = require_rows(read_news_csv(spark, path), "the file holds no news rows")
    valid, _ = split_valid_rejected(null_tokens(raw))
    return require_rows(align_optional_columns(valid), "the file holds no valid rows")


def batch_of_file(path_col="_metadata.file_path"):
    """Batch name of a landing file: the `batch_id=…` part of its path, else the file name.

    A path is escaped as a whole; a folder's name was escaped before that by the writer.
    """
    path = F.col(path_col)
    named = F.regexp_extract(path, r"batch_id=([^/]+)/", 1)
    plain = F.regexp_extract(path, r"([^/]+?)(?:\.csv)?$", 1)
    return F.when(named != "", _unescaped(_unescaped(named))).otherwise(_unescaped(plain))


def _unescaped(name):
    return F.url_decode(F.regexp_replace(name, r"\+", "%2B"))


def read_by_header(spark: SparkSession, files: Sequence[str], schema) -> tuple[DataFrame | None, list[str], dict[str, str]]:
    """Rows of CSV files, each file's columns found by its own header: (rows, absent optional columns, errors by file).

    Files of equal header are read together. Unknown columns are left out, absent optional ones are null. A file
    without a header or without a required column gives no rows and an error that names it. Ids that the files leave out
    are given from the file, the row's place in it and its content, so equal rows are different items.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    errors: dict[str, str] = {}
    for f, found in zip(files, headers(spark, files)):
        names = tuple(found)
        if not names:
            errors[f] = "the file is empty"
            continue
        missing = [c for c in REQUIRED_COLUMNS if c not in names]
        if missing:
            errors[f] = "missing required columns: " + ", ".join(missing)
            continue
        groups.setdefault(names, []).append(f)
    absent: set[str] = set()
    parts = []
    for names, group in groups.items():
        absent |= {c for c in OPTIONAL_COLUMNS if c not in names}
        place = {n: F.col(f"_{i}") for i, n in reversed(list(enumerate(names)))}
        columns = [place[f.name].try_cast(f.dataType).alias(f.name) if f.name in place else F.lit(None).cast(f.dataType).alias(f.name)
                   for f in schema.fields]
        part = _rows(spark, group, len(names)).select(*columns, "stored_path", "_place")
        if "id" not in names:
            content = [c for c in part.columns if c not in ("id", "_place")]
            part = part.withColumn("id", F.xxhash64("_place", *content).bitwiseAND(F.lit((1 << 62) - 1)))
        part = part.drop("_place")
        parts.append(part)
    out = None
    for part in parts:
        out = part if out is None else out.unionByName(part)
    return (None if out is None else out.withColumn("batch_id", batch_of_file("stored_path"))), sorted(absent), errors


def land_batch_files(spark: SparkSession, folder: str, schema=None) -> DataFrame:
    """All `.csv` files below a landing folder with the batch each belongs to."""
    reader = spark.read.options(**CSV_OPTIONS, pathGlobFilter="*.csv", recursiveFileLookup="true")
    if schema is not None:
        reader = reader.schema(schema)
    raw = reader.csv(folder)
    return raw.select("*", batch_of_file().alias("batch_id"), F.col("_metadata.file_path").alias("stored_path"))


def results_table(df: DataFrame) -> DataFrame:
    """The result contract: seven columns in fixed order, highest risk first."""
    order = [F.desc("risk_score")] + ([F.col("news_item_id")] if "news_item_id" in df.columns else [])
    return df.orderBy(*order).select(*RESULT_COLUMNS)


def write_results_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Export results as CSV.

    The rows are range-partitioned by score, so the part files in name order
    are the sorted result. ``single_file`` is for one batch shown to a person.
    """
    out = results_table(df)
    if single_file:
        out = out.coalesce(1)
    out.write.mode("overwrite").options(header="true", quote='"', escape='"').csv(path)
