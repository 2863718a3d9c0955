"""Fits: few passes over the rows, and still the optimum of the objective."""

import os

import numpy as np
from pyspark.sql import functions as F

from riskloom.operators import solver as S


def _rows(spark, n=3000, width=400, seed=5):
    rng = np.random.default_rng(seed)
    likely = 1 / np.arange(1, width)
    rows = []
    for i in range(n):
        at = np.sort(rng.choice(width - 1, 30, replace=False, p=likely / likely.sum()))
        v = rng.random(30)
        v /= np.linalg.norm(v)
        rows.append((i, i % 2, width, [*at.tolist(), width - 1], [*v.tolist(), 1.0]))
    return spark.createDataFrame(rows, "id int, y int, size int, indices array<int>, values array<double>").repartition(4, "id")


def _counted(monkeypatch):
    passes, summed = [], S._summed
    monkeypatch.setattr(S, "_summed", lambda *a: passes.append(1) or summed(*a))
    return passes


def _dense(df, width):
    found = df.orderBy("id").collect()
    x = np.zeros((len(found), width))
    for i, r in enumerate(found):
        x[i, r["indices"]] = r["values"]
    return x, found


def test_binary_fits_take_few_passes_and_end_at_the_optimum(spark, monkeypatch):
    df, passes = _rows(spark, 900), _counted(monkeypatch)
    fits = S.fit_binary(df, [(F.col("y"), 1 - F.col("y"))] * 2, [1.0, 100.0])
    assert len(passes) <= 20
    _at_optimum(df, fits, (1.0, 100.0))


def test_a_sample_of_the_rows_does_not_change_the_optimum(spark, monkeypatch):
    monkeypatch.setattr(S, "SAMPLE_ROWS", 64)
    df = _rows(spark, 900)
    _at_optimum(df, S.fit_binary(df, [(F.col("y"), 1 - F.col("y"))], [1.0]), (1.0,))


def _at_optimum(df, fits, cs):
    x, found = _dense(df, 400)
    y = np.array([r["y"] for r in found], float)
    for c, fit in zip(cs, fits):
        w = fit.coefficients
        slope = w + c * x.T @ (1 / (1 + np.exp(-x @ w)) - y)
        assert np.linalg.norm(slope) <= 1e-5 * np.linalg.norm(c * x.T @ (0.5 - y))


def test_rows_made_of_counts_take_little_room(spark, monkeypatch):
    rng = np.random.default_rng(3)
    factor, starts, rows = np.append(1 + rng.random(40), 1.0), np.array([0, 15, 40]), []
    for i in range(300):
        at = [np.sort(rng.choice(np.arange(a, b), n, replace=False)) for a, b, n in ((0, 15, i % 7), (15, 40, 9), (40, 41, 1))]
        values = []
        for k, cells in enumerate(at):
            v = rng.choice([2, 4, 300] if i % 5 == 0 else [1, 2, 3, 300], len(cells)) * factor[cells] if k < 2 else np.ones(1)
            values += (v / np.linalg.norm(v) if k < 2 and len(v) else v).tolist()
        rows.append((i, i % 2, 41, np.concatenate(at).tolist(), values))
    df = spark.createDataFrame(rows, "id int, y int, size int, indices array<int>, values array<double>")
    sides, scales = [(F.col("y"), 1 - F.col("y"))], S.Scales(factor, starts)
    with S._packed(df, [F.col("y")], scales) as packed:  # before, an entry took twelve bytes
        cells = packed.blocks.selectExpr("sum(length(column) + length(value))", "min(length(shared))").first()
        assert cells[0] == 4 * sum(len(r[3]) for r in rows) and cells[1] > 0
        folder = packed.blocks.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
        assert os.path.isdir(folder)
    assert not os.path.exists(folder)
    want, got = (S.fit_binary(df, sides, [2.0], s)[0].coefficients for s in (None, scales))
    assert np.abs(want - got).max() < 1e-7
    odd = df.withColumn("values", F.transform("values", lambda v: v * (1 + F.rand(1))))  # no counts: kept as they come
    assert np.abs(np.subtract(*(S.fit_binary(odd, sides, [2.0], s)[0].coefficients for s in (None, scales)))).max() < 1e-7


def test_minima_that_are_found_are_not_evaluated_again():
    seen = []

    def evaluate(w, which):
        seen.append(len(which))
        steep = np.array([1.0, 300.0])[which, None] * np.linspace(1, 9, 30)
        return 0.5 * (steep * w * w).sum(axis=1) - w.sum(axis=1), steep * w - 1

    S.minimise(evaluate, 2, 30)
    assert seen[0] == 2 and seen[-1] == 1


def test_fit_of_a_single_row(spark):
    df = _rows(spark, 1)
    assert np.isfinite(S.fit_binary(df, [(F.col("y"), 1 - F.col("y"))], [1.0])[0].coefficients).all()
