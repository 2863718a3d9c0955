"""Balances, subscriptions and the dashboard of a user."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.constants import PLAN_NAME, PURCHASE, SUBSCRIPTION_DAYS, TOP_UP
from riskloom.operators.results import latest_n
from riskloom.operators.running import BUCKET_ROWS, running_in_order

MONEY = "decimal(20,2)"


def subscription_period(purchases: DataFrame, days: int = SUBSCRIPTION_DAYS, plan: str = PLAN_NAME, at: str = "created_at") -> DataFrame:
    return purchases.withColumns({
        "plan_name": F.lit(plan), "starts_at": F.col(at), "ends_at": F.col(at) + F.make_dt_interval(days=F.lit(days)),
    })


def ledger_rows(events: DataFrame) -> DataFrame:
    """Signed transactions: a purchase always lowers the balance, and a top-up
    of zero or less is refused."""
    amount = F.col("amount").cast(MONEY)
    signed = F.when(F.col("transaction_type") == PURCHASE, -F.abs(amount)).otherwise(amount)
    refused = (F.col("transaction_type") == TOP_UP) & (amount <= 0)
    return events.withColumn("amount", signed).filter(~refused)


def ledger_balance(ledger: DataFrame) -> DataFrame:
    """Balance per user: exact decimal sum."""
    return ledger.groupBy("user_id").agg(
        F.sum(F.col("amount").cast(MONEY)).cast("double").alias("balance"),
        F.count(F.lit(1)).alias("transactions"),
        F.count_if(F.col("transaction_type") == PURCHASE).alias("purchases"))


def running_balance(ledger: DataFrame, at: str = "created_at", key: str = "id", rows: int = BUCKET_ROWS) -> DataFrame:
    """Balance after each transaction, in time order, ties by key.

    A user's transactions run in slices of about ``rows`` rows, however many fall on one day or instant.
    """
    return running_in_order(
        ledger, "user_id", [at, key], {"balance_after": ("sum", F.col("amount").cast("decimal(28,2)"))}, rows)


def overdrawn_purchases(ledger: DataFrame, at: str = "created_at", key: str = "id") -> DataFrame:
    """Purchases the balance before did not cover; they had to be refused."""
    rows = running_balance(ledger, at, key)
    before = F.col("balance_after") - F.col("amount")
    return rows.filter((F.col("transaction_type") == PURCHASE) & (before < -F.col("amount"))).withColumn(
        "balance_before", before)


def _coverage(points: DataFrame, subs: DataFrame, at: str, key: str, rows: int) -> DataFrame:
    """Every point with the subscription that started by then and ends last.

    Instead of a range join (all points of a user times all its
    subscriptions), both tables run in time order and carry the latest end
    seen so far; at equal times a start comes before a point. Nobody's
    subscriptions (null user) cover nothing.
    """
    sub_row = F.struct(F.col("ends_at"), F.col("starts_at"), F.col("id").alias("subscription_id"))
    starts = subs.where(F.col("user_id").isNotNull()).select(
        "user_id", F.col("starts_at").alias("_at"), F.lit(0).alias("_kind"),
        F.lit(None).cast(points.schema[key].dataType).alias(key), sub_row.alias("_sub"), F.xxhash64(sub_row).alias("_tie"))
    asked = points.select(
        "user_id", F.col(at).alias("_at"), F.lit(1).alias("_kind"), F.col(key),
        F.lit(None).cast(starts.schema["_sub"].dataType).alias("_sub"), F.xxhash64(key).alias("_tie"))
    ran = running_in_order(
        starts.unionByName(asked), "user_id", ["_at", "_kind", "_tie"], {"_best_row": ("max", F.col("_sub"))}, rows)
    # Only a subscription that has not ended covers the point.
    covers = F.col("_best_row.ends_at") >= F.col("_at")
    return ran.filter("_kind = 1").select(
        "user_id", key, F.col("_at").alias(at),
        F.coalesce(covers, F.lit(False)).alias("entitled"),
        *[F.when(covers, F.col(f"_best_row.{c}")).alias(c) for c in ("subscription_id", "starts_at", "ends_at")])


def entitled_uploads(
    uploads: DataFrame, subs: DataFrame, at: str = "created_at", key: str = "id", rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Uploads marked as allowed or not by a subscription at that time."""
    return _coverage(uploads, subs, at, key, rows).select("user_id", key, at, "entitled")


def active_subscription_asof(
    points: DataFrame, subs: DataFrame, at: str = "at", key: str = "id", rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Latest-ending subscription that covers each asked instant, null if none."""
    return _coverage(points, subs, at, key, rows)


def active_subscription_at(subs: DataFrame, instant: Column) -> DataFrame:
    """The same for one instant and all users: a filter and one aggregate."""
    alive = subs.filter((F.col("starts_at") <= instant) & (F.col("ends_at") >= instant))
    best = F.max_by(F.struct("id", "starts_at", "ends_at"), F.struct("ends_at", "starts_at", "id"))
    return alive.groupBy("user_id").agg(best.alias("s")).select(
        "user_id", F.col("s.id").alias("subscription_id"), "s.starts_at", "s.ends_at")


def user_dashboard(batches: DataFrame, predictions: DataFrame, subs: DataFrame, instant: Column, latest: int = 5) -> DataFrame:
    """Per user: batches, processed items, newest batches, active subscription.

    Each part is reduced to one row per user before the parts are joined.
    """
    n_batches = batches.groupBy("user_id").agg(F.count(F.lit(1)).alias("batch_count"))
    done = predictions.groupBy("user_id").agg(F.count(F.lit(1)).alias("processed_news"))
    newest = latest_n(batches, latest).groupBy("user_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "id"))), lambda x: x["id"].cast("string")).alias("_ids"))
    active = active_subscription_at(subs, instant).select("user_id", "ends_at")
    return (
        n_batches.join(done, "user_id", "left").join(newest, "user_id", "left").join(active, "user_id", "left")
        .select(
            "user_id", "batch_count", F.coalesce("processed_news", F.lit(0)).alias("processed_news"),
            F.array_join("_ids", ",").alias("latest_batches"), F.col("ends_at").alias("active_until"))
    )
