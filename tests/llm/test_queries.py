"""Registered queries next to their SQL, and the pipeline against its parts in plain Python."""

import re

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from riskloom.llm.queries import ORACLE, QUERIES
from tests.llm.test_dedup import brute_components, squeeze
from tools.check_oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_oracle(spark, name):
    assert compare(QUERIES[name](spark, SF), connect(SF), ORACLE[name], []).startswith("ok")


def test_registered():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
        out = stage(spark, docs, SF)
        if name == "pack":
            assert {r.doc_id for r in out.collect()} == set(before)
            break
        assert out.columns == docs.columns
        kept = {r.doc_id for r in out.collect()}
        if name == "exact_dedup":
            first = {}
            for i in sorted(before):
                first.setdefault(squeeze(before[i]), i)
            assert kept == set(first.values())
        if name == "near_dedup":
            ids = sorted(before)
            assert kept == {ids[i] for i, (_, _, k) in brute_components([before[i] for i in ids]).items() if k}
        if name == "decontaminate":
            plain = {i: " ".join(re.findall(r"[^\W_]+", t.lower())) for i, t in before.items()}
            items = [" ".join(re.findall(r"[^\W_]+", r.text.lower())) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            assert {i for i, t in plain.items() if not any(x in t for x in items)} == kept
        docs = spark.createDataFrame(out.collect(), docs.schema)
