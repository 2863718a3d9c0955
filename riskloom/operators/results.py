"""Result, job and ownership queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.constants import RESULT_COLUMNS
from riskloom.operators.scoring import rank_by_risk, recent_first


def results(items: DataFrame, predictions: DataFrame, batch_id=None, user_id=None) -> DataFrame:
    """Items with their predictions, highest risk first.

    The batch filter goes to both sides, so that only the partition of the
    batch is read from either table.
    """
    if batch_id is not None:
        items = items.filter(F.col("batch_id") == batch_id)
        predictions = predictions.filter(F.col("batch_id") == batch_id)
    if user_id is not None:
        items = items.filter(F.col("user_id") == user_id)
    left = items.select("id", "batch_id", "user_id", "title", "entity_norm", "text_fragment")
    right = predictions.select("news_item_id", "risk_score", "alert_flag", "model_name", "threshold")
    joined = left.join(right, left["id"] == right["news_item_id"], "inner").drop("id")
    return rank_by_risk(joined).select("news_item_id", "batch_id", "user_id", *RESULT_COLUMNS)


def owned(df: DataFrame, user_id, key: str = "id", value=None) -> DataFrame:
    """Rows of one owner (or one row of one owner); nothing for anybody else."""
    out = df.filter(F.col("user_id") == user_id)
    return out if value is None else out.filter(F.col(key) == value)


def require_owned(df: DataFrame, user_id, value, key: str = "id") -> DataFrame:
    found = owned(df, user_id, key, value)
    if found.isEmpty():
        raise LookupError(f"{key}={value!r} not found")
    return found


def job_view(batches: DataFrame) -> DataFrame:
    """Job history rows as shown: ids twice, dates as text, `-` for nothing."""
    fmt = "yyyy-MM-dd HH:mm"
    shown = batches.select(
        "id", F.col("id").alias("batch_id"), "user_id", "original_filename", F.col("original_filename").alias("filename"),
        "status", "total_items", "processed_items",
        F.date_format("created_at", fmt).alias("created_at"),
        F.coalesce(F.date_format("processed_at", fmt), F.lit("-")).alias("processed_at"),
        F.coalesce("error_message", F.lit("-")).alias("error_message"),
    )
    return recent_first(shown)


def latest_n(df: DataFrame, n: int = 5, by: str = "user_id", at: str = "created_at", key: str = "id") -> DataFrame:
    """The ``n`` newest rows per owner; each task passes on at most ``n`` of them."""
    w = Window.partitionBy(by).orderBy(F.desc(at), F.desc(key))
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def batch_progress(batches: DataFrame, items: DataFrame, predictions: DataFrame) -> DataFrame:
    """Total and processed items of each batch, and whether it is complete.

    Both sides are counted per batch before they meet.
    """
    total = items.groupBy("batch_id").agg(F.count(F.lit(1)).alias("total_items"))
    done = predictions.groupBy("batch_id").agg(F.count(F.lit(1)).alias("processed_items"))
    out = batches.select("batch_id").join(total, "batch_id", "left").join(done, "batch_id", "left")
    t, d = (F.coalesce(c, F.lit(0)) for c in ("total_items", "processed_items"))
    return out.select(
        "batch_id", t.alias("total_items"), d.alias("processed_items"),
        F.when(d == 0, "queued").when(d < t, "processing").otherwise("completed").alias("status"))


STATUSES = ("uploaded", "queued", "processing", "completed", "failed")


def job_lifecycle(events: DataFrame, key: str = "batch_id", at: str = "ts", tie: Sequence[str] = ("event_id",)) -> DataFrame:
    """Current state per batch from its status events (one aggregate, no sort)."""
    when = F.struct(F.col(at), *[F.col(t) for t in tie])
    last = F.max_by(F.struct("status", at, "error_message"), when)
    closed = F.max(F.when(F.col("status").isin("completed", "failed"), F.col(at)))
    out = events.groupBy(key).agg(last.alias("_l"), closed.alias("_closed"), F.count(F.lit(1)).alias("n_events"))
    final = F.col("_l.status").isin("completed", "failed")
    return out.select(
        key, F.col("_l.status").alias("status"), F.col(f"_l.{at}").alias("changed_at"),
        F.when(final, F.col("_closed")).alias("processed_at"),
        F.when(F.col("_l.status") == "failed", F.col("_l.error_message")).alias("error_message"), "n_events")


def parse_control_message(df: DataFrame, body: str = "body") -> DataFrame:
    """Batch id of a queue message; anything but a whole JSON number is an error.

    `true`, `"5"` and `5.0` are refused, as is text that is no JSON object.
    """
    # The parser overlooks what follows a value; inside brackets it would have to be a second one.
    message = F.try_parse_json(F.concat(F.lit("["), body, F.lit("]")))
    kind = F.schema_of_variant(F.try_variant_get(message, "$[0].batch_id", "variant"))
    alone = F.try_variant_get(message, "$[1]", "variant").isNull()
    parsed = F.when(alone & (kind == "BIGINT"), F.try_variant_get(message, "$[0].batch_id", "long"))
    return df.withColumn("batch_id", parsed).withColumn(
        "error", F.when(parsed.isNull(), "message must contain integer batch_id"))


def digest_of_day(
    df: DataFrame, at: str, k: int, by: Sequence[str] = ("entity_norm",), since=None, until=None, key: str = "news_item_id",
) -> DataFrame:
    """The ``k`` highest alerts per day and bank within a period."""
    rows = df.filter(F.col("alert_flag") == 1)
    if since is not None:
        rows = rows.filter(F.col(at) >= since)
    if until is not None:
        rows = rows.filter(F.col(at) < until)
    w = Window.partitionBy("day", *by).orderBy(F.desc("risk_score"), key)
    ranked = rows.withColumn("day", F.to_date(F.col(at))).withColumn("rank", F.row_number().over(w))
    return ranked.filter(F.col("rank") <= k)
