"""The registered fits, on tables built here."""

import pytest

from riskloom.plans.catalog import REGISTRY
from riskloom.plans.registry import as_callable

CALM = ["bank opens new office today", "quarterly report shows growth", "new card for students", "office hours change today"]
RISKY = ["regulator fines bank for breach", "court claim against bank", "data breach hits bank clients", "fines for breach of rules"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    docs = [(i, f"story {i % 40}\n{(CALM + RISKY)[i % 8]} {i % 7}", "en", "wire") for i in range(160)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(f"{folder}/documents.parquet")
    labels = [(i, i % 3 % 2, int(i % 8 >= 4)) for i in range(160) if i % 5]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_word_character_and_combined_models_are_fitted(spark, tables):
    got = {r.model: r for r in as_callable(REGISTRY["fit_logreg"])(spark, tables).collect()}
    assert set(got) == {"word", "char", "word + char"}  # before, the model on characters alone was left out
    assert all(r.f1 > 0.9 for r in got.values())
