import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.operators import evaluation as E
from riskloom.operators import profile as P
from riskloom.operators import leakage as L
from riskloom.operators import sampling as SA
from riskloom.operators.running import running_sums


def scored(spark, n=300, seed=1, digits=2):
    g = np.random.default_rng(seed)
    y = (g.random(n) < 0.3).astype(int)
    s = np.round(np.clip(0.35 + 0.25 * y + 0.2 * g.standard_normal(n), 0, 1), digits)
    pdf = pd.DataFrame({"sample_id": range(n), "alert_flag": y, "student_score": s, "student_pred": (s >= 0.5).astype(int)})
    return spark.createDataFrame(pdf), pdf


def auc(y, s):
    p, n = s[y == 1], s[y == 0]
    return float(((p[:, None] > n[None, :]).sum() + 0.5 * (p[:, None] == n[None, :]).sum()) / (len(p) * len(n)))


def ap(y, s):
    out, last = 0.0, 0.0
    for t in sorted(set(s), reverse=True):
        hit = s >= t
        recall = (y[hit] == 1).sum() / (y == 1).sum()
        out += (recall - last) * (y[hit] == 1).mean()
        last = recall
    return out


def test_ranking_metrics_against_all_pairs(spark):
    df, pdf = scored(spark)
    got = E.ranking_metrics(df).first()
    y, s = pdf.alert_flag.to_numpy(), pdf.student_score.to_numpy()
    assert got.roc_auc == pytest.approx(auc(y, s), abs=1e-12)
    assert got.pr_auc == pytest.approx(ap(y, s), abs=1e-12)


def test_known_average_precision(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.4), (1, 0.35), (1, 0.8)], "alert_flag int, student_score double")
    assert E.average_precision(df).first()[0] == pytest.approx(0.8333333333)


def test_one_class_gives_null_and_zero(spark):
    df = spark.createDataFrame([(0, 0.1, 0), (0, 0.4, 0)], "alert_flag int, student_score double, student_pred int")
    assert E.ranking_metrics(df).first().roc_auc is None
    m = E.binary_metrics(df).first()
    assert (m.precision, m.recall, m.f1, m.accuracy) == (0.0, 0.0, 0.0, 1.0)


def test_sweep_and_review_zone(spark):
    df, pdf = scored(spark)
    y, s = pdf.alert_flag.to_numpy(), pdf.student_score.to_numpy()
    for r in E.threshold_sweep(df).collect():
        t = [x for x in E.grid_points((0.3, 0.05, 13)) if round(x, 2) == r.threshold][0]
        p = s >= t
        assert (r.tp, r.fp, r.fn, r.tn) == ((p & (y == 1)).sum(), (p & (y == 0)).sum(), (~p & (y == 1)).sum(), (~p & (y == 0)).sum())
    conf = np.maximum(s, 1 - s)
    zone = {r.review_threshold: r for r in E.review_zone(df, [0.55, 0.8, 1.01]).collect()}
    for t in (0.55, 0.8):
        auto = conf >= t
        assert zone[t].coverage == pytest.approx(auto.mean())
        assert zone[t].auto_errors == ((pdf.student_pred != y) & auto).sum()
    assert zone[1.01].auto_f1 is None and zone[1.01].auto_errors == 0


def test_quartile_bins(spark):
    df, pdf = scored(spark, 200)
    pdf["text_length"] = [int(x) for x in np.random.default_rng(3).integers(1, 30, len(pdf))]
    df = spark.createDataFrame(pdf)
    cut = pd.qcut(pdf.text_length, 4, duplicates="drop")
    want = pdf.assign(e=(pdf.alert_flag != pdf.student_pred)).groupby(cut, observed=True).e.agg(["size", "sum"])
    got = sorted((r.length_bin, r.n, r.errors) for r in E.error_rate_by_quartile(df).collect())
    assert [(n, e) for _, n, e in got] == [(int(a), int(b)) for a, b in want.to_numpy()]


def test_running_sums_with_many_buckets(spark):
    g = np.random.default_rng(5)
    pdf = pd.DataFrame({"k": g.integers(0, 3, 500), "o": g.permutation(500) / 7.0, "v": g.integers(0, 100, 500)})
    for descending in (False, True):
        got = running_sums(spark.createDataFrame(pdf), ["v"], "o", ["k"], descending, buckets=16).toPandas()
        want = pdf.sort_values("o", ascending=not descending)
        want["w"] = want.groupby("k").v.cumsum()
        both = got.merge(want, on=["k", "o"])
        assert len(both) == 500 and (both.v_upto == both.w).all()


def test_best_rows_and_runs(spark):
    rows = [(1, "m", "valid", "0.5", "0.7"), (2, "m", "test", "0.5", "0.6"), (3, "m", "valid", "0.30000000000000004", "0.8"),
            (4, "m", "test", "0.3", "0.5"), (5, "m", "valid", "0.4", "bad")]
    df = spark.createDataFrame(rows, "row_id int, model string, dataset string, threshold string, f1 string")
    assert sorted(r.row_id for r in E.keep_best_run(df).collect()) == [3, 4]
    grid = spark.createDataFrame([(0.3, 0.7, 0.5, 0.9), (0.4, 0.7, 0.6, 0.8), (0.5, 0.6, 0.9, 0.9)], "threshold double, f1 double, recall double, precision double")
    assert E.best_grid_row(grid).first().threshold == 0.4


def test_profile_against_pandas(spark):
    pdf = pd.DataFrame({"a": [1, 1, 2, 3, 3, 3], "b": ["x", "x", " ", None, "y", "y"], "split": ["t", "v", "t", "t", "v", "v"]})
    df = spark.createDataFrame(pdf)
    prof = {r.column: r for r in P.column_profile(df).collect()}
    assert (prof["b"].missing_or_empty, prof["b"].unique_values, prof["b"].dtype) == (2, 4, "string")
    d = P.describe_numeric(df, ["a"]).first()
    want = pdf.a.describe()
    assert d["mean"] == pytest.approx(want["mean"]) and d["std"] == pytest.approx(want["std"])
    assert (d["p25"], d["median"], d["p75"]) == (want["25%"], want["50%"], want["75%"])
    assert P.duplicate_counts(df, {"a": ["a"]}).first()["count"] == 3
    assert P.duplicate_rows(df, ["a", "b"]).count() == 4
    leaks = L.cross_split_leaks(df, {"ab": ["a", "b"]}).first()
    assert (leaks.leaking_keys, leaks.rows) == (1, 2)
    assert L.rows_for_keys(df, ["a", "b"]).count() == 2


def test_hash_samples(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    first = [r.k for r in SA.smallest_hashes(df, 37, "k").orderBy("k").collect()]
    assert first == sorted(r.k for r in SA.sample_n(df, 37, "k").collect()) and len(first) == 37
    assert SA.smallest_hashes(df, 5000, "k").count() == 1000


def test_hot_key_keeps_all_rows(spark):
    df = spark.range(3000).select(F.col("id").alias("sample_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("t"),
                                  F.when(F.col("id") % 2 == 0, "train").otherwise("test").alias("split"))
    assert P.duplicate_rows(df, ["t"]).count() == 1000
    assert L.drop_exact_duplicates(df, ["t"], "sample_id").count() == 2001
    assert L.rows_for_keys(df, ["t"]).count() == 1000
