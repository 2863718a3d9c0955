"""Atomic replacement, the ledger of the stream, ids of uploads, stored models."""

import csv
import os

import pytest
from pyspark.sql import functions as F

from riskloom.operators import features as X
from riskloom.operators import linear as L
from riskloom.operators.results import results
from riskloom.sources import store
from riskloom.sources.csv_files import read_by_header
from riskloom.sources.tables import LinearModel, load_model, save_model
from riskloom.schemas import LANDING_ITEM
from riskloom.streaming import score_stream as SS

BATCHES = "id long, user_id long, original_filename string, stored_path string, status string, total_items long, processed_items long, created_at timestamp"


def batches(spark, rows):
    return spark.createDataFrame([(i, 1, "f", "p", s, 1, 0, None) for i, s in rows], BATCHES).withColumns(
        {"processed_at": F.lit(None).cast("timestamp"), "error_message": F.lit(None).cast("string")})


def stored(spark, root):
    return sorted((r.id, r.status) for r in store.keyed_table(spark, root, "news_batches").collect())


def land(folder, batch, name, rows, header=("title", "text_fragment")):
    where = folder / f"batch_id={batch}"
    where.mkdir(parents=True, exist_ok=True)
    with open(where / name, "w", newline="") as f:
        csv.writer(f).writerows([header, *rows])


def run(spark, tmp_path, **options):
    SS.score_stream(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / f"state{len(os.listdir(tmp_path))}"), **options).awaitTermination()


def test_merge_by_key(spark, tmp_path):
    root = str(tmp_path)
    assert stored(spark, root) == []
    store.merge_by_key(batches(spark, [(1, "queued"), (2, "queued")]), root, "news_batches")
    store.merge_by_key(batches(spark, [(2, "completed"), (3, "queued")]), root, "news_batches")
    assert stored(spark, root) == [(1, "queued"), (2, "completed"), (3, "queued")]
    store.merge_by_key(batches(spark, []), root, "news_batches")
    assert len(stored(spark, root)) == 3
    with pytest.raises(ValueError):
        store.merge_by_key(batches(spark, [(4, "a"), (4, "b")]), root, "news_batches")


def test_a_writer_lost_before_the_switch_leaves_the_old_rows(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    store.merge_by_key(batches(spark, [(1, "queued")]), root, "news_batches")
    before = store.keyed_table(spark, root, "news_batches")

    def lost(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(store, "switch", lost)
    with pytest.raises(RuntimeError):
        store.merge_by_key(batches(spark, [(1, "completed")]), root, "news_batches")
    monkeypatch.undo()
    assert stored(spark, root) == [(1, "queued")]
    folder = store._folder(root, "table:news_batches")
    open(f"{folder}/{2:012d}", "w").close()  # lost while it wrote the manifest
    assert stored(spark, root) == [(1, "queued")]
    store.merge_by_key(batches(spark, [(1, "completed")]), root, "news_batches")
    assert stored(spark, root) == [(1, "completed")]
    assert [r.status for r in before.collect()] == ["queued"]  # a reader that had begun goes on with what it found


def test_the_second_of_two_writers_fails(spark, tmp_path):
    root = str(tmp_path)
    store.switch(spark, root, "p", 0, {"x": 1})
    with pytest.raises(store.Conflict):
        store.switch(spark, root, "p", 0, {"x": 2})
    assert store.manifest(spark, root, "p") == (1, {"x": 1})


def test_a_batch_over_ten_steps_reads_each_file_once(spark, tmp_path, monkeypatch):
    for i in range(10):
        land(tmp_path / "in", "a:b/c", f"{i}.csv", [(f"title {i}", "text"), (" ", "text")])
    read = []

    def counting(session, files, schema):
        read.extend(files)
        return read_by_header(session, files, schema)

    monkeypatch.setattr(SS, "read_by_header", counting)
    run(spark, tmp_path, files_per_step=1)
    out = str(tmp_path / "out")
    assert len(read) == len(set(read)) == 10
    ledger = store.file_ledger(spark, out).collect()
    assert sorted(r.epoch for r in ledger) == list(range(10)) and {(r.items, r.rejected) for r in ledger} == {(1, 1)}
    total = SS.batch_totals(spark, out).first()
    assert (total.batch_id, total.files, total.total_items, total.rejected, total.status) == ("a:b/c".split("/")[0], 10, 10, 10, "completed")
    assert total.processed_at == max(r.processed_at for r in ledger)
    assert SS.stored_rows(spark, out, "prediction_results").count() == 10


def test_a_broken_step_keeps_earlier_rows_and_the_next_try_heals(spark, tmp_path):
    land(tmp_path / "in", "a", "1.csv", [("t", "x")])
    run(spark, tmp_path)
    out = str(tmp_path / "out")

    def broken(rows):
        raise RuntimeError("no scorer")

    run(spark, tmp_path, scorer=broken)
    assert SS.stored_rows(spark, out, "prediction_results").count() == 1
    state = SS.batch_states(spark, out).first()
    assert state.status == "failed" and "no scorer" in state.error_message
    run(spark, tmp_path)
    assert SS.batch_states(spark, out).first().status == "completed" and SS.stored_rows(spark, out, "prediction_results").count() == 1


def test_equal_upload_rows_are_different_items(spark, tmp_path):
    rows = [("A", "same text"), ("B", "other"), ("A", "same text")]
    land(tmp_path / "in", "a", "1.csv", rows)
    land(tmp_path / "in", "a", "2.csv", rows)
    run(spark, tmp_path, uploaders=lambda: spark.createDataFrame([("a", 7)], "batch_id string, user_id long"))
    out = str(tmp_path / "out")
    items, found = SS.stored_rows(spark, out, "news_items"), SS.stored_rows(spark, out, "prediction_results")
    first = {r.id for r in items.collect()}
    assert len(first) == 6 and {r.user_id for r in items.collect()} == {7}
    assert results(items, found, "a", 7).count() == 6
    run(spark, tmp_path)  # the same files again: the same ids
    assert {r.id for r in SS.stored_rows(spark, out, "news_items").collect()} == first


def test_ids_of_the_file_win(spark, tmp_path):
    land(tmp_path / "in", "a", "1.csv", [("5", "T", "x")], ("id", "title", "text_fragment"))
    rows, _, _ = read_by_header(spark, [f"file:{tmp_path}/in/batch_id=a/1.csv"], LANDING_ITEM)
    assert [r.id for r in rows.collect()] == [5]


# stored models

def linear(spark):
    texts = spark.createDataFrame([(1, "fine court breach"), (2, "court day"), (3, "breach of rules, court")], "id long, x string")
    parts = [X.fit_vocabulary(X.doc_terms(texts, f, "id", "x"), X.document_count(texts), X.Family(f.name, f.kind, f.low, f.high, 1, None)).select(
        F.lit(f.name).alias("family"), "term", "idf", ((F.length("term") % 5) - 1.5).alias("coef")) for f in (X.WORD, X.CHAR)]
    return LinearModel(parts[0].unionByName(parts[1]), -0.5, 0.6, "linear", {"families": "word,char"})


def test_scoring_in_the_row_equals_the_join_and_shuffles_nothing(spark, tmp_path):
    save_model(linear(spark), str(tmp_path / "m"))
    model = load_model(spark, str(tmp_path / "m"))
    texts = [(1, "court breach"), (2, None), (3, ""), (4, "zz"), (5, "Court, COURT day " * 4000), (5, "rules of the day"), (None, "fine")]
    spark.createDataFrame(texts, "id long, x string").withColumn("row", F.monotonically_increasing_id()).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    scored = L.score_linear(df, model, "row", "x")
    assert "Exchange" not in scored._jdf.queryExecution().executedPlan().toString()
    got = {r.row: r.score for r in scored.collect()}
    for other in (X.score_linear_joined(df, model, "row", "x"), L.score_linear(df, model, "row", "x", most_terms=5)):
        want = {r.row: r.score for r in other.collect()}
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-12) for k in want)
    assert len(got) == 7 and L.score_linear(df.limit(0), model, "row", "x").count() == 0


def test_the_stream_takes_a_stored_model_and_falls_back_to_keywords(spark, tmp_path):
    land(tmp_path / "in", "a", "1.csv", [("court", "breach of rules")])
    path, out = str(tmp_path / "m"), str(tmp_path / "out")
    run(spark, tmp_path, model_path=path)
    assert SS.stored_rows(spark, out, "prediction_results").first().model_name != "linear"
    save_model(linear(spark), path)
    run(spark, tmp_path, model_path=path)
    got = SS.stored_rows(spark, out, "prediction_results").collect()
    assert [(r.model_name, r.threshold) for r in got] == [("linear", 0.6)]


def test_terms_are_counted_inside_the_row(spark):
    from collections import Counter
    rows = [(1, "a bb bb ccc bb"), (2, ""), (3, None), (4, "bb bb")]
    df = spark.createDataFrame(rows, "id long, x string")
    terms = X.doc_terms(df, X.WORD, "id", "x")
    assert "Exchange" not in terms._jdf.queryExecution().executedPlan().toString()
    want = {1: Counter(["bb", "bb", "ccc", "bb", "bb bb", "bb ccc", "ccc bb"]), 4: Counter(["bb", "bb", "bb bb"])}
    assert {(r.id, r.term): r.tf for r in terms.collect()} == {(i, t): n for i, c in want.items() for t, n in c.items()}
    chars = {(r.id, r.term): r.tf for r in X.doc_terms(df.where("id = 4"), X.CHAR, "id", "x").collect()}
    assert chars == {(4, " bb"): 2, (4, "bb "): 2, (4, " bb "): 2}


def test_late_alerts_are_dropped_once_their_day_is_final(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def step(*times):
        rows = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "event_id long, ts string")
        rows.select("event_id", F.col("ts").cast("timestamp").alias("ts")).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema("event_id long, ts timestamp").parquet(source)
        SS.final_alert_counts(spark, stream, out, state).awaitTermination()
        days = spark.read.schema("day timestamp, alerts long, step long").parquet(out)
        return sorted((str(r.day)[:10], r.alerts) for r in days.collect())

    assert step("2024-01-01 10:00:00", "2024-01-01 23:30:00") == []
    # a little late, within the hour: still counted
    assert step("2024-01-02 00:20:00", "2024-01-01 23:40:00") == []
    assert step("2024-01-02 02:00:00") == [("2024-01-01", 3)]
    # too late: its day is final
    assert step("2024-01-01 12:00:00", "2024-01-03 05:00:00") == [("2024-01-01", 3), ("2024-01-02", 2)]
