"""The driver's tables seen as news data.

Each view exists twice: as a DataFrame here and as SQL in `oracle.py`, so that
results can be checked by an independent engine. All of them use whole tables
and whole texts.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.constants import UNKNOWN_ENTITY
from riskloom.functions.text import hash_bucket, title_and_fragment
from riskloom.operators.items import resolve_entity
from riskloom.operators.scoring import find_risk_keywords, predictions, score_items
from riskloom.session import spread

# Dictionaries that fit the generated texts.
ALIASES = {
    "Northbank": ["tion", "ther"],
    "Eastbank": ["ouon", "ment"],
    "Southbank": ["ando", "sch"],
    "Westbank": ["ung", "eaux"],
}
WEIGHTS = {
    "scum": 0.28, "moron": 0.24, "pathetic": 0.20, "clown": 0.17,
    "worthless": 0.25, "idiot": 0.26, "trash": 0.22, "stupid": 0.18,
}
FAMILIES = {
    "cyber_risk": ["scum", "moron", "idiot"],
    "operational_risk": ["pathetic", "clown", "trash"],
    "regulatory_risk": ["worthless", "stupid"],
}
TEAMS = {"cyber_risk": "security", "operational_risk": "operations"}
STATUS_OF = {"view": "uploaded", "click": "queued", "signup": "processing", "purchase": "completed", "error": "failed"}


class Views:
    """Lazy views over one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def items(self) -> DataFrame:
        day = F.date_add(F.lit("2002-01-01").cast("date"), (F.col("doc_id") % 6800).cast("int"))
        return spread(self.table("documents"), "doc_id").select(
            F.col("doc_id").alias("id"), F.col("source").alias("batch_id"), (F.col("doc_id") % 10).alias("user_id"),
            "source", F.lit(None).cast("string").alias("url"), F.date_format(day, "yyyy-MM-dd").alias("published_at"),
            F.substring_index("text", "\n", 1).alias("title"), F.col("text").alias("text_fragment"),
            F.lit(None).cast("string").alias("entity_norm"))

    @cached_property
    def resolved(self) -> DataFrame:
        return resolve_entity(self.items, ALIASES)

    @cached_property
    def scored_items(self) -> DataFrame:
        return score_items(self.items, ALIASES, WEIGHTS)

    @cached_property
    def predictions(self) -> DataFrame:
        return predictions(self.scored_items)

    @cached_property
    def texts(self) -> DataFrame:
        """All documents, split by story."""
        spot = hash_bucket(F.md5("title"), 20)
        return self.resolved.select(
            F.col("id").alias("sample_id"), "title", "entity_norm", "text_fragment",
            F.when(spot < 14, "train").when(spot < 17, "valid").otherwise("test").alias("split"))

    def _labelled(self, split_key: str) -> DataFrame:
        docs = find_risk_keywords(self.resolved, list(WEIGHTS), title_and_fragment())
        day = F.to_date("published_at")
        risk = F.when(F.col("toxic") == 0, "no_risk").when(F.col("quality") == 0, "cyber_risk").otherwise("operational_risk")
        rows = docs.join(self.table("labels"), docs["id"] == F.col("doc_id"), "inner")
        group = F.md5("title")
        spot = hash_bucket(group if split_key == "group" else F.col("id"), 20)
        return rows.select(
            F.col("id").alias("sample_id"), group.alias("event_group_id"),
            F.when(spot < 14, "train").when(spot < 17, "valid").otherwise("test").alias("split"),
            "text_fragment", "title", "entity_norm", "found_risk_keywords", "source",
            F.year(day).alias("published_year"), F.month(day).alias("published_month"),
            F.col("toxic").alias("alert_flag"), risk.alias("risk_type_4cls"))

    @cached_property
    def labelled(self) -> DataFrame:
        """Split by story: nothing leaks."""
        return self._labelled("group")

    @cached_property
    def labelled_leaky(self) -> DataFrame:
        """Split by row: copies of a story land in several splits."""
        return self._labelled("row")

    @cached_property
    def teacher(self) -> DataFrame:
        i = F.col("doc_id")
        label = F.when(i % 37 == 0, -1).when(i % 10 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic"))
        return self.table("labels").select(
            i.alias("sample_id"), label.alias("teacher_label"),
            F.when(i % 37 != 0, (55 + (i % 9) * 5) / F.lit(100.0)).alias("teacher_confidence"))

    @cached_property
    def teacher_raw(self) -> DataFrame:
        """Answers as text: some with words around the JSON, some broken, some with quoted, broken or unknown numbers."""
        i = F.col("doc_id")
        conf = F.concat(F.lit("0."), (55 + (i % 9) * 5).cast("string"))
        label = F.when(i % 10 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")).cast("string")
        quoted = F.when(i % 43 == 0, "2").when(i % 41 == 0, F.concat(label, F.lit(".7"))).when(
            i % 7 == 0, F.concat(F.lit('"'), label, F.lit('"'))).otherwise(label)
        sure = F.when(i % 47 == 0, '"high"').otherwise(conf)
        body = F.concat(F.lit('{"label": '), quoted, F.lit(', "confidence": '), sure, F.lit("}"))
        raw = (
            F.when(i % 37 == 0, F.lit("no answer {label"))
            .when(i % 5 == 0, F.concat(F.lit("Answer:\n"), body, F.lit("\nDone."))).otherwise(body))
        return self.table("labels").select(i.alias("sample_id"), raw.alias("raw"))

    @cached_property
    def scored(self) -> DataFrame:
        """Labelled rows with the keyword model's score (many ties) and a second, finer score."""
        rows = self.labelled.join(
            self.predictions.select(F.col("news_item_id").alias("sample_id"), F.col("risk_score").alias("student_score"),
                                    F.col("alert_flag").alias("student_pred")), "sample_id")
        length = F.length("text_fragment")
        return rows.withColumns({
            "text_length": length,
            "second_score": F.round((F.col("alert_flag") * 20 + length % 97) / F.lit(120.0), 6),
        })

    @cached_property
    def ledger(self) -> DataFrame:
        e = self.table("events").filter(F.col("event_type").isin("signup", "purchase"))
        buy = F.col("event_type") == "purchase"
        amount = F.col("value").cast("decimal(20,2)")
        return e.select(
            F.col("event_id").alias("id"), "user_id", F.when(buy, -amount).otherwise(amount).alias("amount"),
            F.when(buy, "subscription_purchase").otherwise("top_up").alias("transaction_type"), F.col("ts").alias("created_at"))

    @cached_property
    def subscriptions(self) -> DataFrame:
        e = self.table("events").filter(F.col("event_type") == "purchase")
        return e.select(
            F.col("event_id").alias("id"), "user_id", F.col("ts").alias("starts_at"),
            (F.col("ts") + F.make_dt_interval(days=F.lit(1))).alias("ends_at"))

    @cached_property
    def uploads(self) -> DataFrame:
        e = self.table("events").filter(F.col("event_type") == "click")
        return e.select(F.col("event_id").alias("id"), "user_id", F.col("ts").alias("created_at"))

    @cached_property
    def job_events(self) -> DataFrame:
        names = F.create_map(*[F.lit(x) for kv in STATUS_OF.items() for x in kv])
        status = F.element_at(names, F.col("event_type"))
        return self.table("events").select(
            F.col("user_id").alias("batch_id"), "event_id", "ts", status.alias("status"),
            F.when(status == "failed", F.concat(F.lit("error "), F.col("event_id").cast("string"))).alias("error_message"))

    @cached_property
    def batches(self) -> DataFrame:
        """One news batch per upload event."""
        i = F.col("event_id")
        done = i % 3 != 0
        return self.table("events").filter(F.col("event_type") == "click").select(
            i.alias("id"), "user_id", F.concat(F.lit("news_"), i.cast("string"), F.lit(".csv")).alias("original_filename"),
            F.when(i % 3 == 0, "queued").when(i % 3 == 1, "completed").otherwise("failed").alias("status"),
            (i % 50 + 1).alias("total_items"), F.when(i % 3 == 1, i % 50 + 1).otherwise(0).alias("processed_items"),
            F.col("ts").alias("created_at"),
            F.when(done, F.col("ts") + F.make_dt_interval(mins=(i % 30).cast("int"))).alias("processed_at"),
            F.when(i % 3 == 2, "scoring failed").alias("error_message"))

    @cached_property
    def answers(self) -> DataFrame:
        """Two labellers' free-text answers over all labelled rows."""
        i, y = F.col("doc_id"), F.col("toxic")
        zero = F.when(i % 11 == 0, F.lit("cannot say")).otherwise(F.concat(F.lit("Answer: "), F.when(i % 8 == 0, 1 - y).otherwise(y).cast("string"), F.lit(".")))
        few = F.when(i % 13 == 0, F.lit("10 out of 10")).otherwise(F.when(i % 6 == 0, 1 - y).otherwise(y).cast("string"))
        return self.table("labels").select(
            i.alias("sample_id"), y.alias("alert_flag"), zero.alias("zero_shot_answer"), few.alias("few_shot_answer"))

UNKNOWN = UNKNOWN_ENTITY
