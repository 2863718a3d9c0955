"""Declared schemas of the stored tables and of the analytical datasets."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampType,
)


def _struct(*fields: tuple) -> StructType:
    return StructType([StructField(name, kind(), nullable) for name, kind, nullable in fields])


USERS = _struct(
    ("id", LongType, False), ("email", StringType, False), ("hashed_password", StringType, False),
    ("balance", DoubleType, False), ("created_at", TimestampType, False),
)
SUBSCRIPTIONS = _struct(
    ("id", LongType, False), ("user_id", LongType, False), ("plan_name", StringType, False),
    ("starts_at", TimestampType, False), ("ends_at", TimestampType, False),
    ("created_at", TimestampType, False),
)
BALANCE_TRANSACTIONS = _struct(
    ("id", LongType, False), ("user_id", LongType, False), ("amount", DoubleType, False),
    ("transaction_type", StringType, False), ("created_at", TimestampType, False),
)
NEWS_BATCHES = _struct(
    ("id", LongType, False), ("user_id", LongType, False), ("original_filename", StringType, False),
    ("stored_path", StringType, False), ("status", StringType, False), ("total_items", LongType, False),
    ("processed_items", LongType, False), ("created_at", TimestampType, False),
    ("processed_at", TimestampType, True), ("error_message", StringType, True),
)
NEWS_ITEMS = _struct(
    ("id", LongType, False), ("batch_id", StringType, False), ("user_id", LongType, False),
    ("source", StringType, True), ("url", StringType, True), ("published_at", StringType, True),
    ("title", StringType, False), ("text_fragment", StringType, False),
    ("entity_norm", StringType, False), ("created_at", TimestampType, False),
)
PREDICTION_RESULTS = _struct(
    ("id", LongType, False), ("news_item_id", LongType, False), ("batch_id", StringType, False),
    ("user_id", LongType, False), ("risk_score", DoubleType, False), ("alert_flag", IntegerType, False),
    ("model_name", StringType, False), ("threshold", DoubleType, False),
    ("created_at", TimestampType, False),
)
LABELLED = _struct(
    ("sample_id", LongType, False), ("event_group_id", StringType, True), ("split", StringType, True),
    ("text_fragment", StringType, True), ("title", StringType, True), ("entity_norm", StringType, True),
    ("found_risk_keywords", StringType, True), ("source", StringType, True),
    ("published_year", IntegerType, True), ("published_month", IntegerType, True),
    ("alert_flag", IntegerType, True), ("risk_type_4cls", StringType, True),
)
TEACHER_LABELS = _struct(
    ("sample_id", LongType, False), ("teacher_label", IntegerType, True),
    ("teacher_confidence", DoubleType, True), ("teacher_reason", StringType, True),
    ("teacher_response_raw", StringType, True), ("teacher_prompt_version", StringType, True),
)

# Landing files: every column is read as text, publication dates stay text.
LANDING_ITEM = _struct(
    ("id", LongType, True), ("user_id", LongType, True), ("source", StringType, True),
    ("url", StringType, True), ("published_at", StringType, True), ("title", StringType, True),
    ("text_fragment", StringType, True), ("entity_norm", StringType, True),
)

# Partition column of the stored tables that have one.
PARTITION_COLUMNS = {"news_items": "batch_id", "prediction_results": "batch_id"}
TABLES = {
    "users": USERS,
    "subscriptions": SUBSCRIPTIONS,
    "balance_transactions": BALANCE_TRANSACTIONS,
    "news_batches": NEWS_BATCHES,
    "news_items": NEWS_ITEMS,
    "prediction_results": PREDICTION_RESULTS,
}
