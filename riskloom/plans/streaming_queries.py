"""Streaming queries over files that Spark writes from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions.text import is_blank
from riskloom.operators.scoring import score_items
from riskloom.plans.adapters import ALIASES, WEIGHTS, Views
from riskloom.plans.oracle import NOT_SPACE, with_views
from riskloom.plans.registry import query
from riskloom.schemas import LANDING_ITEM
from riskloom.session import scratch_path
from riskloom.sources import csv_files, store
from riskloom.streaming import score_stream as SS


def _run(v: Views, landing: str, out: str, **options) -> None:
    q = SS.score_stream(v.spark, landing, out, scratch_path(v.spark, "stream-state"), ALIASES, WEIGHTS, **options)
    q.awaitTermination()


@query("SR1 SR3 IO6 IO11", with_views(
    "SELECT news_item_id, batch_id, user_id, risk_score, alert_flag, model_name, threshold FROM v_predictions", "v_predictions"))
def score_stream(v: Views):
    """All items land as CSV, the stream scores them, the stored results come back."""
    landing, out = scratch_path(v.spark, "landing"), scratch_path(v.spark, "results")
    SS.land_items(v.items, landing)
    _run(v, landing, out)
    return SS.stored_rows(v.spark, out, "prediction_results")


@query("SR2", with_views("SELECT batch_id, count(*) AS rows, 'completed' AS status FROM v_predictions GROUP BY batch_id", "v_predictions"))
def idempotent_reprocess(v: Views):
    """The same files scored twice by fresh streams: every batch has its rows once."""
    landing, out = scratch_path(v.spark, "landing"), scratch_path(v.spark, "results")
    SS.land_items(v.items, landing)
    _run(v, landing, out)
    _run(v, landing, out)
    stored = SS.stored_rows(v.spark, out, "prediction_results").groupBy("batch_id").agg(F.count(F.lit(1)).alias("rows"))
    return stored.join(SS.batch_states(v.spark, out).select("batch_id", "status"), "batch_id")


_TWICE = "SELECT CAST(source AS VARCHAR) AS batch_id, text FROM documents UNION ALL SELECT source, text FROM documents"


@query("SR3 IO6 AG29", f"""
SELECT batch_id, count(*) AS total_items, count(*) AS item_ids, count(*) AS results, 0 AS rejected, 'completed' AS status
FROM ({_TWICE}) WHERE regexp_matches(coalesce(text, ''), '{NOT_SPACE}') AND regexp_matches(split_part(text, chr(10), 1), '{NOT_SPACE}') GROUP BY batch_id""")
def repeated_upload_rows(v: Views):
    """Uploads without ids in which every row stands twice: each is an item of its own, in the ledger, the items and the results."""
    landing, out = scratch_path(v.spark, "landing"), scratch_path(v.spark, "results")
    rows = v.items.where(~is_blank("title")).select("title", "text_fragment", "batch_id")
    # both rows in one task, so that they come to lie in one file
    twice = rows.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("_n")).drop("_n")
    SS.write_landing(twice, landing)
    _run(v, landing, out, files_per_step=40)
    items = SS.stored_rows(v.spark, out, "news_items").select("id", "batch_id")
    found = SS.stored_rows(v.spark, out, "prediction_results").select(F.col("news_item_id").alias("id"), F.col("batch_id").alias("_b"))
    joined = items.join(found, "id").groupBy("batch_id").agg(F.countDistinct("id").alias("item_ids"), F.count(F.lit(1)).alias("results"))
    totals = SS.batch_totals(v.spark, out).select("batch_id", "total_items", F.col("rejected").cast("int").alias("rejected"), "status")
    return totals.join(joined, "batch_id")


@query("SR5 SR2", """
SELECT source AS batch_id, CASE WHEN source = (SELECT min(source) FROM documents) THEN 'failed' ELSE 'completed' END AS status,
  CASE WHEN source = (SELECT min(source) FROM documents) THEN 0 ELSE count(*) END AS rows FROM documents GROUP BY source""")
def poison_batch(v: Views):
    """One batch breaks the scorer: it alone is failed, the others are scored."""
    landing, out = scratch_path(v.spark, "landing"), scratch_path(v.spark, "results")
    bad = v.items.agg(F.min("batch_id")).first()[0]
    SS.land_items(v.items, landing)
    broken = F.raise_error(F.lit("scorer broke")).cast("string")

    def scorer(rows):
        return score_items(rows.withColumn("title", F.when(F.col("batch_id") == bad, broken).otherwise(F.col("title"))), ALIASES, WEIGHTS)

    q = SS.score_stream(v.spark, landing, out, scratch_path(v.spark, "stream-state"), scorer=scorer)
    q.awaitTermination()
    stored = SS.stored_rows(v.spark, out, "prediction_results").groupBy("batch_id").agg(F.count(F.lit(1)).alias("rows"))
    return SS.batch_totals(v.spark, out).select("batch_id", "status").join(stored, "batch_id", "left").select(
        "batch_id", "status", F.coalesce("rows", F.lit(0)).alias("rows"))


@query("IO11 AG29", """
SELECT event_id AS id, user_id, CASE WHEN event_id % 6 = 0 THEN 'completed' ELSE CASE event_id % 3 WHEN 0 THEN 'queued' WHEN 1 THEN 'completed' ELSE 'failed' END END AS status,
  event_id % 50 + 1 AS total_items, CASE WHEN event_id % 6 = 0 OR event_id % 3 = 1 THEN event_id % 50 + 1 ELSE 0 END AS processed_items,
  event_id % 6 = 0 OR event_id % 3 <> 0 AS processed
FROM events WHERE event_type = 'click'""")
def merge_batches(v: Views):
    """Batches are stored without the latest ones; an update then finishes some and brings the others; the table is read again."""
    root = scratch_path(v.spark, "tables")
    rows = v.batches.withColumn("stored_path", F.col("original_filename"))
    store.merge_by_key(rows.where("id % 4 <> 0 OR id % 6 = 0"), root, "news_batches")
    finished = rows.where("id % 6 = 0").withColumns({
        "status": F.lit("completed"), "processed_items": F.col("total_items"), "processed_at": F.col("created_at"),
        "error_message": F.lit(None).cast("string")})
    store.merge_by_key(finished.unionByName(rows.where("id % 4 = 0 AND id % 6 <> 0")), root, "news_batches")
    return store.keyed_table(v.spark, root, "news_batches").select(
        "id", "user_id", "status", "total_items", "processed_items", F.col("processed_at").isNotNull().alias("processed"))


@query("IO6", "SELECT source AS batch_id, count(*) AS rows FROM documents GROUP BY source")
def land_batch_files(v: Views):
    """Landing files read back with the batch each belongs to."""
    landing = scratch_path(v.spark, "landing")
    SS.land_items(v.items, landing)
    return csv_files.land_batch_files(v.spark, landing, LANDING_ITEM).groupBy("batch_id").agg(F.count(F.lit(1)).alias("rows"))


@query("SP6 SP8", "SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, count(*) AS alerts FROM events WHERE event_type = 'error' GROUP BY 1")
def alerts_per_day_stream(v: Views):
    """Risk events replayed as a stream with event time, counted per day."""
    source = scratch_path(v.spark, "alerts")
    v.table("events").filter("event_type = 'error'").select("event_id", F.col("ts").cast("timestamp").alias("ts")).write.parquet(source)
    stream = v.spark.readStream.schema("event_id long, ts timestamp").parquet(source)
    out = scratch_path(v.spark, "alerts-per-day")

    def keep(rows, _epoch):
        rows.write.mode("overwrite").parquet(out)

    # Complete output: one row per day, so the last step holds the whole table.
    q = (
        SS.alert_counts_by_day(stream).writeStream.outputMode("complete").foreachBatch(keep)
        .option("checkpointLocation", scratch_path(v.spark, "stream-state")).trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return v.spark.read.parquet(out).select(F.date_format("day", "yyyy-MM-dd").alias("day"), "alerts")


@query("SP6 SP8", """
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, count(*) AS alerts FROM events WHERE event_type = 'error' GROUP BY date_trunc('day', ts)
HAVING date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events WHERE event_type = 'error')""")
def final_alert_days_stream(v: Views):
    """Days that are final when the replayed stream ends, in append mode: the last ones are still open."""
    source, out = scratch_path(v.spark, "alerts"), scratch_path(v.spark, "final-days")
    v.table("events").filter("event_type = 'error'").select("event_id", F.col("ts").cast("timestamp").alias("ts")).write.parquet(source)
    stream = v.spark.readStream.schema("event_id long, ts timestamp").parquet(source)
    SS.final_alert_counts(v.spark, stream, out, scratch_path(v.spark, "stream-state")).awaitTermination()
    days = v.spark.read.schema("day timestamp, alerts long, step long").parquet(out)
    return days.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "alerts")
