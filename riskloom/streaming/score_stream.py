"""Scoring of landing files as a stream.

Files of a batch lie in `batch_id=<name>/` below the landing folder. A step reads the files that it brings and no others,
validates, scores and writes them, and then records them in the manifests of their batches (`sources/store.py`). A batch's
manifest is its ledger: every file with the step that read it, its rows and its error. A file that comes again, in a
retried step or a new stream, takes the place of its earlier rows, so nothing is stored twice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from riskloom.constants import ALERT_THRESHOLD, ENTITY_ALIASES, RISK_TERM_WEIGHTS
from riskloom.operators.items import normalise_items
from riskloom.operators.scoring import predictions, score_items
from riskloom.schemas import LANDING_ITEM
from riskloom.session import materialize
from riskloom.sources import store
from riskloom.sources.csv_files import _unescaped, batch_of_file, null_tokens, read_by_header, reject_reason
from riskloom.sources.tables import load_model

ALONE = 4  # batches of a failed step that are tried at the same time

STATUS = StructType([
    StructField("batch_id", StringType()), StructField("status", StringType()),
    StructField("changed_at", TimestampType()), StructField("error_message", StringType()),
])


def landing_stream(spark: SparkSession, landing: str, files_per_step: int | None = None) -> DataFrame:
    """Names and batches of new landing files.

    The stream itself only lists files; a step reads them by their own headers.
    """
    reader = spark.readStream.option("pathGlobFilter", "*.csv").option("recursiveFileLookup", "true")
    if files_per_step is not None:
        reader = reader.option("maxFilesPerTrigger", str(files_per_step))
    path = F.col("_metadata.file_path")
    # one row per file, whatever it holds; without the content column the file is not opened
    reader = reader.schema("path string, modificationTime timestamp, length long, content binary")
    return reader.format("binaryFile").load(landing).select(path.alias("stored_path")).withColumn(
        "batch_id", batch_of_file("stored_path"))


def _append_status(spark: SparkSession, out: str, states: list[tuple[str, str, str | None]]) -> None:
    """One small file for all batches of a step: (batch, status, error)."""
    rows = spark.createDataFrame(states, "batch_id string, status string, error_message string").select(
        "batch_id", "status", F.current_timestamp().alias("changed_at"), "error_message")
    rows.coalesce(1).write.mode("append").parquet(f"{out}/batch_status")


def _file_id(path) -> Column:
    return F.md5(path)


def _tables(rows: DataFrame, scorer: Callable[[DataFrame], DataFrame]) -> dict[str, DataFrame]:
    """Items, predictions and rejected rows of checked rows; scored once for both tables.

    While rows are scored, those to be rejected are counted, so the files are read again only if there are some.
    """
    texts = [c for c, t in rows.dtypes if t == "string" and c not in ("batch_id", "file_id")]
    marked = null_tokens(rows, texts).withColumn("reject_reason", reject_reason())
    seen = Observation()
    counted = marked.observe(seen, F.count(F.lit(1)).alias("rows"), F.count("reject_reason").alias("rejected"))
    valid = counted.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    rejected = marked.filter(F.col("reject_reason").isNotNull())
    scored = materialize(scorer(valid), "scored")
    items = normalise_items(scored, ("id", "batch_id", "user_id", "file_id"))
    tables = {"news_items": items, "prediction_results": predictions(scored, ["file_id"])}
    found = seen.get
    # only if the counted rows are those scored: a scorer may drop rows, or read some of them by itself before
    none = found.get("rows") and not found["rejected"] and found["rows"] == scored.count()
    return tables if none else {**tables, "rejected_rows": rejected}


def score_stream(
    spark: SparkSession, landing: str, out: str, checkpoint: str, aliases=ENTITY_ALIASES,
    weights: Mapping[str, float] = RISK_TERM_WEIGHTS, threshold: float = ALERT_THRESHOLD,
    scorer: Callable[[DataFrame], DataFrame] | None = None, files_per_step: int = 1000, model_path: str | None = None,
    uploaders: Callable[[], DataFrame] | None = None,
) -> StreamingQuery:
    """Start the scoring stream over everything that has landed so far.

    Files are read by their headers: columns in any order, unknown ones left out, absent optional ones null. A model
    stored at ``model_path`` scores; as long as there is none, keywords do. Each step looks again, so a new model takes
    over without a restart. ``uploaders`` gives (batch_id, user_id) for rows that name no user.

    An unusable file marks its batch `failed` with the reason, the batch's other files are scored. A step that cannot be
    scored does not stop the stream: its batches are tried by themselves, and only those that fail themselves are marked
    `failed` with the message; their files stay where they are for a later try.
    """

    def scored(rows: DataFrame) -> DataFrame:
        if scorer is not None:
            return scorer(rows)
        model = load_model(rows.sparkSession, model_path) if model_path else None
        return score_items(rows, aliases, weights, threshold, model)

    def score(session: SparkSession, files: dict[str, list[str]], epoch: int) -> list[tuple]:
        rows, _, errors = read_by_header(session, [f for group in files.values() for f in group], LANDING_ITEM)
        counts = {}
        if rows is not None:
            rows = rows.withColumn("file_id", _file_id(_unescaped(F.col("stored_path")))).drop("stored_path")
            if uploaders is not None:
                named = uploaders().select(F.col("batch_id").alias("_b"), F.col("user_id").alias("_u"))
                rows = rows.join(named, F.col("batch_id") == F.col("_b"), "left").withColumn("user_id", F.coalesce("user_id", "_u")).drop("_b", "_u")
            counts = store.write_files(_tables(rows, scored), out)
        states = []
        for batch, group in files.items():
            ids = dict(zip(group, _ids_of(group)))
            states.append(_record(session, batch, {ids[f]: {
                "path": f, "epoch": epoch, "at": _now(), "rows": counts.get((batch, ids[f]), {}), "error": errors.get(f)}
                for f in group}))
        return states

    def alone(session: SparkSession, batch: str, group: list[str], epoch: int) -> list[tuple]:
        try:
            return score(session, {batch: group}, epoch)
        except Exception as exc:  # a poison batch is recorded, the stream goes on; rows stored earlier stay
            old = store.manifest(session, out, batch)[1].get("files", {})
            return [_record(session, batch, {
                i: {**old.get(i, {}), "path": f, "epoch": epoch, "at": _now(), "error": str(exc)} for f, i in zip(group, _ids_of(group))})]

    def _record(session: SparkSession, batch: str, entries: dict[str, dict]) -> tuple[str, str, str | None]:
        everything = store.record_files(session, out, batch, entries)
        why = "; ".join(e["error"] for e in everything.values() if e.get("error"))
        return batch, "failed" if why else "completed", why or None

    def step(rows: DataFrame, epoch: int) -> None:
        session = rows.sparkSession
        files: dict[str, list[str]] = {}
        listed = rows.select("batch_id", _unescaped(F.col("stored_path")).alias("f")).orderBy("f")
        for r in listed.collect():  # bounded by files_per_step
            files.setdefault(r.batch_id, []).append(r.f)
        if not files:
            return
        _append_status(session, out, [(b, "processing", None) for b in files])
        try:
            states = score(session, files, epoch)
        except Exception:
            # every batch writes folders and a manifest of its own; their states are one file again, as two jobs must not append at once
            with ThreadPoolExecutor(ALONE) as pool:
                tries = [pool.submit(inheritable_thread_target(session)(alone), session, batch, group, epoch) for batch, group in files.items()]
                states = [state for one in tries for state in one.result()]
        _append_status(session, out, states)

    return (
        landing_stream(spark, landing, files_per_step).writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def _ids_of(files: list[str]) -> list[str]:
    return [hashlib.md5(f.encode()).hexdigest() for f in files]


def _now() -> str:
    return datetime.now(timezone.utc).isoformat()


STORED = {
    "news_items": "id long, batch_id string, user_id long, source string, url string, published_at string, title string, text_fragment string, "
                  "entity_norm string",
    "prediction_results": "news_item_id long, batch_id string, user_id long, risk_score double, alert_flag int, model_name string, threshold double",
    "rejected_rows": "id long, batch_id string, user_id long, title string, text_fragment string, reject_reason string",
}


def stored_rows(spark: SparkSession, out: str, table: str, batches=None) -> DataFrame:
    """What the stream has stored, of some batches or of all."""
    return store.read_files(spark, out, table, STORED[table], batches)


def batch_totals(spark: SparkSession, out: str) -> DataFrame:
    """(batch_id, files, total_items, rejected, processed_at, status, error_message) from the ledger."""
    return store.file_ledger(spark, out).groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("files"), F.sum("items").alias("total_items"), F.sum("rejected").alias("rejected"),
        F.max("processed_at").alias("processed_at"),
        F.when(F.count("error_message") > 0, "failed").otherwise("completed").alias("status"),
        F.nullif(F.concat_ws("; ", F.sort_array(F.collect_set("error_message"))), F.lit("")).alias("error_message"))


def batch_states(spark: SparkSession, out: str) -> DataFrame:
    """Latest status of every batch."""
    log = spark.read.schema(STATUS).parquet(f"{out}/batch_status")
    last = F.max_by(F.struct("status", "changed_at", "error_message"), "changed_at")
    return log.groupBy("batch_id").agg(last.alias("s")).select("batch_id", "s.*")


def alert_counts_by_day(alerts: DataFrame, at: str = "ts", late: str = "1 hour") -> DataFrame:
    """Alerts per day on a stream of alerts with an event time; a day is final
    once events are more than ``late`` past its end."""
    return (
        alerts.withWatermark(at, late).groupBy(F.window(at, "1 day"))
        .agg(F.count(F.lit(1)).alias("alerts"))
        .select(F.col("window.start").alias("day"), "alerts")
    )


def final_alert_counts(spark: SparkSession, alerts: DataFrame, out: str, checkpoint: str, at: str = "ts", late: str = "1 hour") -> StreamingQuery:
    """Write each day's count once, when the day is final; alerts that come after that are dropped.

    A step writes a folder of its own, so a retried step does not write its days twice.
    """
    def keep(rows: DataFrame, epoch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/step={epoch}")

    return (
        alert_counts_by_day(alerts, at, late).writeStream.outputMode("append").foreachBatch(keep)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def land_items(items: DataFrame, landing: str) -> None:
    """Write items as landing CSV files, one folder per batch."""
    write_landing(items.select(*[f.name for f in LANDING_ITEM.fields], "batch_id"), landing)


def write_landing(rows: DataFrame, landing: str) -> None:
    rows.write.mode("append").partitionBy("batch_id").options(
        header="true", quote='"', escape='"', emptyValue="", nullValue="").csv(landing)
