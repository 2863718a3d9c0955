"""Hot keys are split, and columns of as many values as rows are never gathered."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.operators import running
from riskloom.operators.evaluation import quartile_edges
from riskloom.operators.leakage import rows_for_keys
from riskloom.operators.profile import duplicate_rows, grouped_stats

SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def skewed(spark):
    before = {k: spark.conf.get(k) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield spark.range(0, 60_000, 1, 8).select(
        F.col("id").alias("sample_id"), F.when(F.col("id") % 2 == 0, "train").otherwise("test").alias("split"),
        F.when(F.col("id") % 3 < 2, "hot").otherwise(F.col("id").cast("string")).alias("text_fragment"))
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("operator", [duplicate_rows, rows_for_keys])
def test_key_of_two_thirds_is_split(skewed, operator):
    out = operator(skewed, ["text_fragment"])
    assert len(out.collect()) == 40_000
    assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()


def test_statistics_over_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(running, "BUCKET_ROWS", 20)
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 900).astype(str), "x": rng.normal(size=900), "k": rng.integers(0, 9, 900)})
    pdf.loc[::50, "x"] = None
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "g string, x double, k int")
    got = {(r["g"], r["column"]): r for r in grouped_stats(df, ["x", "k"], ["g"]).collect()}
    assert len(got) == 6
    for (g, c), r in got.items():
        v = pdf.loc[pdf.g == g, c].dropna().astype(float)
        want = v.describe()
        have = [r[n] for n in ("count", "mean", "std", "min", "p25", "median", "p75", "max")]
        assert np.allclose(have, want.to_numpy(), rtol=1e-9)
    assert np.allclose(quartile_edges(df, "x"), np.nanquantile(pdf.x, [0, 0.25, 0.5, 0.75, 1]))
    assert quartile_edges(df.filter("false"), "x") == []
