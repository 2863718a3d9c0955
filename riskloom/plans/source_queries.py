"""Files written and read back: uploads, reports and teacher labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.plans.adapters import Views
from riskloom.plans.oracle import with_views
from riskloom.plans.registry import query
from riskloom.session import scratch_path
from riskloom.sources import csv_files, tables

# values go to the file as they are: quoted, with their line ends and outer spaces
AS_IS = {"header": "true", "quote": '"', "escape": '"', "quoteAll": "true", "ignoreLeadingWhiteSpace": "false",
         "ignoreTrailingWhiteSpace": "false", "emptyValue": ""}


@query("IO1", r"""
SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, length(t) AS n_chars, md5(t) AS text_md5, len(t) - len(replace(t, chr(10), '')) AS line_ends
FROM (SELECT doc_id, lang, regexp_replace(text, '\r\n', chr(10), 'g') AS t FROM documents)""")
def read_csv_texts(v: Views):
    """All documents as CSV uploads with line ends inside values, read back by their headers in as many tasks as there are splits."""
    path = scratch_path(v.spark, "uploads")
    v.table("documents").select("lang", F.regexp_replace("text", "\r\n", "\n").alias("text"), "doc_id").write.options(**AS_IS).csv(path)
    rows = csv_files.read_news_csv(v.spark, path)
    return rows.select(
        "doc_id", "lang", F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("text_md5"),
        (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))).cast("long").alias("line_ends"))


@query("IO8", "SELECT lang, source, count(*) AS documents, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY lang, source")
def written_report(v: Views):
    """A report written as CSV and as Parquet; rows that both hold alike are returned."""
    report = v.table("documents").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("documents"), F.sum("n_chars").cast("long").alias("chars"))
    as_csv, as_parquet = scratch_path(v.spark, "report"), scratch_path(v.spark, "report")
    tables.write_report(report, as_parquet)
    stored = v.spark.read.parquet(as_parquet)
    tables.write_report(stored, as_csv, "csv")
    text = csv_files.read_news_csv(v.spark, as_csv)
    return text.select("lang", "source", F.col("documents").cast("long").alias("documents"), F.col("chars").cast("long").alias("chars")).intersectAll(
        stored.select("lang", "source", "documents", "chars"))


@query("IO9", with_views("""
SELECT CAST(sample_id AS BIGINT) AS sample_id, teacher_label, teacher_confidence, 'v2' AS teacher_prompt_version FROM v_teacher""", "v_teacher"))
def stored_teacher_labels(v: Views):
    """Teacher labels from the first usable of three places: one is missing, one has no labels, one is a CSV with other names."""
    empty, csv = scratch_path(v.spark, "labels"), scratch_path(v.spark, "labels") + ".csv"
    v.teacher.select("sample_id").write.parquet(empty)
    v.teacher.withColumnsRenamed({"teacher_label": "label", "teacher_confidence": "confidence"}).write.options(header="true").csv(csv)
    found = tables.load_teacher_labels(v.spark, [scratch_path(v.spark, "none"), empty, csv], "v2")
    return found.select(F.col("sample_id").cast("long").alias("sample_id"), "teacher_label", "teacher_confidence", "teacher_prompt_version")
