import pytest

import __spark_entry__ as entry
from riskloom.plans.catalog import REGISTRY
from tools.check_oracle import compare, connect

SF = "/root/testdata/sf0.001"
SAMPLE = ["risk_scoring", "results_join", "cross_split_leaks", "column_profile", "threshold_sweep", "near_duplicate_pairs",
          "tfidf", "score_linear", "entitled_uploads", "user_dashboard", "parse_teacher_json", "extract_mentions", "event_groups"]


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    assert compare(df, con, entry.oracle_sql()[name], []).startswith("ok")


def test_entry_and_names(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(REGISTRY) <= set(entry.queries())
