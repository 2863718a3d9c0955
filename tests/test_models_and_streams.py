import os
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import features as X
from riskloom.operators import linear as L
from riskloom.operators import training as R
from riskloom.streaming import score_stream as SS

GOOD = ["bank opens new office today", "quarterly report shows growth", "new card for students", "office hours change today"]
BAD = ["regulator fines bank for breach", "court claim against bank", "data breach hits bank clients", "fines for breach of rules"]


def texts(spark):
    rows = [(i, t, int(t in BAD)) for i, t in enumerate((GOOD + BAD) * 3)]
    return spark.createDataFrame(rows, "sample_id long, model_text string, alert_flag int")


def test_weights_table_scores_like_the_fitted_model(spark):
    df = texts(spark)
    vec = R.fit_vectoriser(df)
    feats = vec.transform(df)
    model = R.fit_logreg(feats, C=2.0, balanced=True)
    want = {r.sample_id: r.score for r in R.with_scores(model, feats).collect()}
    linear = R.to_linear_model(spark, model, vec)
    got = {r.sample_id: r.score for r in L.score_linear(df, linear, "sample_id", "model_text").collect()}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)
    unknown = spark.createDataFrame([(1, "zzz"), (2, None)], "sample_id long, model_text string")
    sig = 1 / (1 + np.exp(-linear.intercept))
    assert [r.score for r in L.score_linear(unknown, linear, "sample_id", "model_text").collect()] == [pytest.approx(sig)] * 2


def test_fit_reaches_the_optimum(spark):
    df = texts(spark)
    vec = R.fit_vectoriser(df, families=[X.WORD])
    feats = vec.transform(df).withColumn("soft_y", F.when(F.col("alert_flag") == 1, 0.9).otherwise(0.2))
    model = R.fit_logreg_soft(feats, C=1.0)   # default settings
    x = np.array([r.features.toArray() for r in feats.collect()])
    y = np.array([r.soft_y for r in feats.collect()])
    w = np.zeros(x.shape[1])
    for _ in range(50):   # Newton on |w|²/2 + Σ soft loss
        p = 1 / (1 + np.exp(-x @ w))
        w -= np.linalg.solve(np.eye(len(w)) + (x * (p * (1 - p))[:, None]).T @ x, w + x.T @ (p - y))
    assert np.abs(model.coefficients - w).max() < 1e-5
    again = R.fit_logreg_soft(feats.repartition(7), C=1.0)
    assert np.abs(again.coefficients - w).max() < 1e-5


def items(spark, rows):
    return spark.createDataFrame(rows, "id long, user_id long, batch_id string, title string, text_fragment string").select(
        "*", *[F.lit(None).cast("string").alias(c) for c in ("source", "url", "published_at", "entity_norm")])


def run(spark, tmp_path, **options):
    state = str(tmp_path / f"state-{len(os.listdir(tmp_path))}")
    SS.score_stream(spark, str(tmp_path / "in"), str(tmp_path / "out"), state, **options).awaitTermination()


def test_stream_replaces_whole_batches_and_keeps_rejects(spark, tmp_path):
    SS.land_items(items(spark, [(1, 1, "a", "Суд", "иск, штраф\nи санкции"), (2, 1, "a", "Спокойно", "день"), (3, 2, "b", " ", "x")]), str(tmp_path / "in"))
    run(spark, tmp_path, files_per_step=1)
    SS.land_items(items(spark, [(4, 1, "a", "ВТБ", "ещё новость")]), str(tmp_path / "in"))   # late file of batch a
    run(spark, tmp_path)
    got = SS.stored_rows(spark, str(tmp_path / "out"), "prediction_results")
    assert sorted((r.batch_id, r.news_item_id, r.alert_flag) for r in got.collect()) == [("a", 1, 1), ("a", 2, 0), ("a", 4, 0)]
    rejected = SS.stored_rows(spark, str(tmp_path / "out"), "rejected_rows").collect()
    assert [(r.id, r.reject_reason) for r in rejected] == [(3, "title")]


def test_poison_batch_is_marked_and_the_rest_goes_on(spark, tmp_path):
    SS.land_items(items(spark, [(1, 1, "good", "t", "x"), (2, 1, "bad", "t", "poison")]), str(tmp_path / "in"))

    def scorer(df):
        from riskloom.operators.scoring import score_items
        bad = F.raise_error(F.lit("scorer broke")).cast("string")
        return score_items(df.withColumn("title", F.when(F.col("text_fragment") == "poison", bad).otherwise(F.col("title"))))

    run(spark, tmp_path, scorer=scorer)
    states = {r.batch_id: (r.status, r.error_message) for r in SS.batch_states(spark, str(tmp_path / "out")).collect()}
    assert states["good"][0] == "completed"
    assert states["bad"][0] == "failed" and "scorer broke" in states["bad"][1]


def test_batches_of_a_failed_step_are_tried_side_by_side(spark, tmp_path):
    from riskloom.operators.scoring import score_items
    SS.land_items(items(spark, [(1, 1, "a", "t", "x"), (2, 1, "b", "t", "y")]), str(tmp_path / "in"))
    together, calls = threading.Barrier(2), []

    def scorer(df):
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("scorer broke")
        together.wait(timeout=60)  # before, the second batch waited for the first one, which breaks the barrier
        return score_items(df)

    run(spark, tmp_path, scorer=scorer)
    states = {r.batch_id: r.status for r in SS.batch_states(spark, str(tmp_path / "out")).collect()}
    assert states == {"a": "completed", "b": "completed"} and len(calls) == 3
    assert SS.stored_rows(spark, str(tmp_path / "out"), "prediction_results").count() == 2


def test_files_are_read_again_only_for_rejected_rows(spark, tmp_path):
    out = tmp_path / "out"
    SS.land_items(items(spark, [(1, 1, "a", "t", "x")]), str(tmp_path / "in"))
    run(spark, tmp_path)
    assert not list(out.glob("data/*/t=rejected_rows"))  # before, they were looked for and written each time
    SS.land_items(items(spark, [(2, 1, "b", " ", "x"), (3, 1, "b", "t", "y")]), str(tmp_path / "in"))

    def looks_first(df):
        from riskloom.operators.scoring import score_items
        df.where("id = 3").limit(1).collect()
        return score_items(df)

    run(spark, tmp_path, scorer=looks_first)
    assert [r.id for r in SS.stored_rows(spark, str(out), "rejected_rows").collect()] == [2]
    assert sorted(r.news_item_id for r in SS.stored_rows(spark, str(out), "prediction_results").collect()) == [1, 3]


def test_uploads_are_read_by_their_header(spark, tmp_path):
    land = tmp_path / "in"
    files = {
        "batch_id=7/a.csv": "source,url,published_at,title,text_fragment\nx,u,2024-01-01,Суд,иск\n",
        "batch_id=7/b.csv": "text_fragment,title,extra\n\"two\nlines\",T,1\n",
        "batch_id=007/a.csv": "title,text_fragment\nT,day\n",
        "batch_id=a%3Ab/a.csv": "title,text_fragment\nT,day\n",
        "batch_id=none/a.csv": "text_fragment,url\nT,day\n",
        "flat.csv": "title,text_fragment\nT,day\n",
    }
    for name, body in files.items():
        (land / name).parent.mkdir(parents=True, exist_ok=True)
        (land / name).write_text(body)
    run(spark, tmp_path)
    states = {r.batch_id: (r.status, r.error_message) for r in SS.batch_states(spark, str(tmp_path / "out")).collect()}
    done = ("completed", None)
    assert states == {"7": done, "007": done, "a:b": done, "flat": done, "none": ("failed", "missing required columns: title")}
    items = SS.stored_rows(spark, str(tmp_path / "out"), "news_items")
    got = sorted((r.batch_id, r.title, r.text_fragment, r.source) for r in items.collect())
    assert [g[0] for g in got] == ["007", "7", "7", "a:b", "flat"]
    assert got[1][1:] == ("T", "two\nlines", None) and got[2][1:] == ("Суд", "иск", "x")


def test_nothing_stale_is_left_of_a_replaced_batch(spark, tmp_path):
    land = tmp_path / "in" / "batch_id=a"
    land.mkdir(parents=True)
    (land / "1.csv").write_text("title,text_fragment\nT,day\n")
    run(spark, tmp_path)
    (land / "1.csv").write_text("title,text_fragment\n ,day\n")
    run(spark, tmp_path)
    out = str(tmp_path / "out")
    assert SS.stored_rows(spark, out, "prediction_results").count() == 0
    assert SS.stored_rows(spark, out, "rejected_rows").count() == 1


def test_control_messages(spark):
    from riskloom.operators.results import parse_control_message
    bodies = ['{"batch_id": 5}', '{"x":{"batch_id":5},"batch_id":"7"}', '{"batch_id": 5} trailing', '{"batch_id": 5.0}', '{"batch_id": true}',
              "[]", "x", None, '{"batch_id": -3, "x": 1}']
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    assert [r.batch_id for r in parse_control_message(df).collect()] == [5, None, None, None, None, None, None, None, -3]
