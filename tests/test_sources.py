import pytest
from pyspark.sql import functions as F

from riskloom.constants import RESULT_COLUMNS
from riskloom.sources import csv_files as C
from riskloom.sources import tables as T

HEAD = "source,url,published_at,title,text_fragment\n"


def put(tmp_path, text, name="news.csv"):
    p = tmp_path / name
    p.write_text(text, encoding="utf-8")
    return str(p)


def test_quoted_newlines_and_doubled_quotes(spark, tmp_path):
    path = put(tmp_path, HEAD + 's,u,2026,"Title ""A""","line one\nline two, still"\n')
    row = C.read_upload(spark, path).first()
    assert row.title == 'Title "A"' and row.text_fragment == "line one\nline two, still"
    assert row.published_at == "2026" and row.entity_norm is None


@pytest.mark.parametrize("gone", ["title", "text_fragment"])
def test_missing_required_column_is_named(spark, tmp_path, gone):
    kept = "text_fragment" if gone == "title" else "title"
    with pytest.raises(ValueError, match=gone):
        C.read_upload(spark, put(tmp_path, f"{kept}\nvalue\n"))


def test_empty_file_and_header_only(spark, tmp_path):
    with pytest.raises(ValueError, match="empty|no news rows"):
        C.read_upload(spark, put(tmp_path, "", "a.csv"))
    with pytest.raises(ValueError, match="no news rows"):
        C.read_upload(spark, put(tmp_path, HEAD, "b.csv"))


def test_extra_column_is_ignored_and_optional_ones_added(spark, tmp_path):
    df = C.read_upload(spark, put(tmp_path, "extra,title,text_fragment\nx,T,B\n"))
    assert df.columns == ["title", "text_fragment", "source", "url", "published_at", "entity_norm"]
    assert df.first().title == "T"


def test_blank_rows_are_rejected_and_all_blank_fails(spark, tmp_path):
    rows = spark.createDataFrame([("a", "b"), (" \t", "b"), (None, None), ("a", " "), ("NA", "b")], "title string, text_fragment string")
    valid, rejected = C.split_valid_rejected(C.null_tokens(rows))
    assert valid.count() == 1
    reasons = sorted(r.reject_reason for r in rejected.collect())
    assert reasons == ["text_fragment", "title", "title", "title;text_fragment"]
    with pytest.raises(ValueError, match="no valid rows"):
        C.read_upload(spark, put(tmp_path, 'title,text_fragment\n"  ",x\n'))


def test_landing_reads_csv_only_and_names_the_batch(spark, tmp_path):
    for name in ("b 1", "b2"):
        (tmp_path / f"batch_id={name}").mkdir()
        put(tmp_path / f"batch_id={name}", HEAD + "s,u,d,T,B\n")
    put(tmp_path, "not,a,batch\n", "readme.txt")
    got = sorted(r.batch_id for r in C.land_batch_files(spark, str(tmp_path)).collect())
    assert got == ["b 1", "b2"]


def test_results_export_has_the_seven_columns_sorted(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, "a", "E", 'x "q"\ny', 0.2, 0, "m", 0.5), (2, "b", "E", "y", 0.9, 1, "m", 0.5)],
        "news_item_id long, title string, entity_norm string, text_fragment string, risk_score double, alert_flag int, model_name string, threshold double")
    out = str(tmp_path / "out")
    C.write_results_csv(df, out, single_file=True)
    back = C.read_news_csv(spark, out)
    assert back.columns == RESULT_COLUMNS
    assert [r.title for r in back.collect()] == ["b", "a"] and back.collect()[1].text_fragment == 'x "q"\ny'


def _predictions(spark, rows):
    return spark.createDataFrame(rows, "id long, news_item_id long, batch_id string, risk_score double").select(
        "id", "news_item_id", "batch_id", F.lit(1).alias("user_id"), "risk_score", F.lit(0).alias("alert_flag"),
        F.lit("m").alias("model_name"), F.lit(0.5).alias("threshold"), F.current_timestamp().alias("created_at"))


def test_replacing_a_batch_leaves_the_others(spark, tmp_path):
    root = str(tmp_path)
    T.append_table(_predictions(spark, [(1, 1, "a", 0.1), (2, 2, "b", 0.2)]), root, "prediction_results")
    T.replace_batches(_predictions(spark, [(3, 1, "a", 0.7)]), root, "prediction_results")
    got = {(r.batch_id, r.risk_score) for r in T.read_table(spark, root, "prediction_results").collect()}
    assert got == {("a", 0.7), ("b", 0.2)}


def test_model_round_trip_and_absent_model(spark, tmp_path):
    w = spark.createDataFrame([("word", "x", 1.5, -0.5)], "family string, term string, idf double, coef double")
    T.save_model(T.LinearModel(w, 0.1, 0.4, "m", {"C": 1.0}), str(tmp_path / "m"))
    back = T.load_model(spark, str(tmp_path / "m"))
    assert (back.intercept, back.threshold, back.model_name, back.meta["C"]) == (0.1, 0.4, "m", "1.0")
    assert back.weights.first().coef == -0.5
    assert T.load_model(spark, str(tmp_path / "none")) is None


def test_teacher_labels_from_first_usable_file(spark, tmp_path):
    bad = put(tmp_path, "sample_id,label,confidence\n1,-1,\n", "bad.csv")
    good = put(tmp_path, "sample_id,label,confidence\n1,1,0.9\n2,0,0.6\n", "good.csv")
    got = T.load_teacher_labels(spark, [str(tmp_path / "none.csv"), bad, good], "v2")
    assert [(r.teacher_label, r.teacher_confidence, r.teacher_prompt_version) for r in got.collect()] == [(1, 0.9, "v2"), (0, 0.6, "v2")]
    with pytest.raises(FileNotFoundError):
        T.load_teacher_labels(spark, [bad], "v2")
