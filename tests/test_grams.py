"""n-grams counted in tasks, weights in the row, fits on packed blocks."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskloom.functions import grams as G
from riskloom.operators import features as X
from riskloom.operators import solver as S
from riskloom.sources.tables import LinearModel


def _brute(text: str, low: int, high: int) -> Counter:
    return Counter(w[i:i + n] for word in text.split() for w in [f" {word} "] for n in range(low, high + 1) for i in range(len(w) - n + 1))


def _counted(column: pa.Array, found: G.Counts) -> list[Counter]:
    out = [Counter() for _ in range(len(column))]
    for r, g, n in zip(found.row, found.gram, found.tf):
        assert found.names[g].as_py() not in out[r]
        out[r][found.names[g].as_py()] = n
    return out


@pytest.mark.parametrize("widest", [1 << 62, 1 << 12])
def test_char_grams_equal_brute_force(monkeypatch, widest):
    monkeypatch.setattr(G, "_WIDEST", widest)
    rng = random.Random(5)
    words = ["a", "ab", "ёж", "naïve", "日本語", "x\x00y", "🙂🙂", "abcab", "cabca"]
    texts = ["", *[" ".join(rng.choices(words, k=rng.randint(0, 30))) for _ in range(60)], "a"]
    padded = pa.array([f" {t} " if t else " " for t in texts]).slice(1, 60)
    for low, high in ((3, 5), (2, 2), (2, 4), (4, 4)):
        assert _counted(padded, G.counts_of(padded, "char", low, high)) == [_brute(t, low, high) for t in texts[1:61]]


def test_runs_cover_every_row_and_long_rows_stand_alone(monkeypatch):
    monkeypatch.setattr(G, "RUN", 8)
    batch = pa.RecordBatch.from_pydict({"w": pa.array([["a"] * n for n in (3, 20, 0, 5, 5, 9, 0)]), "id": pa.array(range(7))})
    seen = [p.column(1).to_pylist() for p, _ in G.runs(batch, "word", 1, 2)]
    assert sum(seen, []) == list(range(7)) and len(seen) > 3
    assert sum(int(c.tf.sum()) for _, c in G.runs(batch, "word", 1, 1)) == 42


def test_vocabulary_counts_and_weights(spark):
    rows = [(1, "Big bank, big loss"), (2, "big bank"), (3, None), (4, ""), (2, "big bank"), (None, "loss big bank")]
    df = spark.createDataFrame(rows, "id long, x string")
    for family in (X.Family("word", "word", 1, 2, 2, None), X.Family("char", "char", 3, 5, 2, None)):
        terms = X.doc_terms(df, family, "id", "x")
        old = X.fit_vocabulary(terms, X.document_count(df), family)
        new = X.vocabulary_of(df, family, "x")
        weights = X.tfidf_of(df, new, X.Family(family.name, family.kind, family.low, family.high), "id", "x")
        assert sorted(old.collect()) == sorted(new.collect())
        # nothing is shuffled to weigh the terms: before, all of them were, once for the vocabulary and once for the length
        plan = weights._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" not in plan and "Window" not in plan
        joined = {(r.id, r.term, round(r.weight, 9)) for r in X.tfidf(terms, new, "id").collect()}
        limited = X.Family(family.name, family.kind, family.low, family.high, 2, None, 1000)
        # rows that repeat a key are one document
        assert joined == {(r.id, r.term, round(r.weight, 9)) for r in X.fit_transform(df, limited, "id", "x")[1].collect()}
        copies = {r.term: r for r in X.term_counts(df.withColumn("n", F.lit(3)), family, "x", "n").collect()}
        assert all(copies[r.term].df == 3 * r.df and copies[r.term].docs == r.df and copies[r.term].total == r.total for r in old.collect())


def test_a_word_is_cut_into_characters_once_per_run(monkeypatch):
    rng = random.Random(8)
    spaces = [chr(c) for c in (9, 10, 11, 13, 28, 31, 32, 0x85, 0xA0, 0x1680, 0x2000, 0x200A, 0x2028, 0x202F, 0x205F, 0x3000)]
    words = ["ab", "abab", "ёж", "日本語", "、x", "\u200b", "\u180e", "Âà", "🙂🙂"]
    texts = ["", " ", *["".join(rng.choice(words) + rng.choice(spaces) * rng.randint(1, 2) for _ in range(rng.randint(0, 40))) for _ in range(50)]]
    assert all(s.isspace() for s in spaces)
    cut, seen = G._char_grams, []
    monkeypatch.setattr(G, "_char_grams", lambda column, *limits: seen.append(len(column)) or cut(column, *limits))
    brute, copies = [_brute(t, 3, 5) for t in texts], np.array([rng.randint(1, 4) for _ in texts])
    names, *sums = G.totals_of(pa.array(texts), "char", 3, 5, copies)
    want = {g: (sum(int(n) for b, n in zip(brute, copies) if g in b), sum(g in b for b in brute), sum(b[g] for b in brute)) for g in set().union(*brute)}
    assert dict(zip(names.to_pylist(), zip(*map(np.ndarray.tolist, sums)))) == want
    assert _counted(pa.array(texts), G.counts_of(pa.array(texts), "char", 3, 5)) == brute
    # before, every place of every text was cut
    assert seen == [len(words)] * 2


def test_words_are_pieces_of_two_letters_and_more(spark):
    rows = [(1, "a Big-bank, x's  ёЖ_1\u00a0日本 🙂🙂 é"), (2, None), (3, "b"), (4, "\u0301ab 𝒳𝒴 𝒳")]
    df = spark.createDataFrame(rows, "id long, x string")
    want = {(r.id, t) for r in df.select("id", X.terms_of(X.WORD, "x").alias("t")).collect() for t in r.t}
    assert {(r.id, r.term) for r in X.doc_terms(df, X.WORD, "id", "x").collect()} == want and (1, "big bank") in want


def test_a_term_meets_its_weight_once_per_run_of_rows(spark):
    rows = [(i, f"Big bank {i % 3} big") for i in range(40)] + [(7, "bank loss"), (None, "big loss"), (50, None)]
    df = spark.createDataFrame(rows, "id long, x string").coalesce(1)
    for family in (X.WORD, X.CHAR):
        held = X.postings(df, family, "id", "x")
        # before, a row per text and term met the weights
        assert held.count() == held.select("term").distinct().count()
        flat = held.select(F.inline("docs"), "term").select("id", "term", "tf")
        assert sorted(map(repr, flat.collect())) == sorted(map(repr, X.doc_terms(df, family, "id", "x").collect()))


def test_joined_scoring_does_not_shuffle_terms_for_small_models(spark):
    df = spark.createDataFrame([(i, f"big bank {i % 3}") for i in range(30)], "id long, x string")
    weights = X.vocabulary_of(df, X.WORD, "x").select(F.lit("word").alias("family"), "term", "idf", F.lit(0.5).alias("coef"))
    scored = X.score_linear_joined(df, LinearModel(weights, 0.1, 0.5, "m", {"families": "word"}), "id", "x")
    plan = scored._jdf.queryExecution().executedPlan().toString()
    terms = plan[plan.index("MapInArrow") - 600:plan.index("MapInArrow")]
    assert "BroadcastHashJoin" in terms and "hashpartitioning(term" not in plan


@pytest.mark.parametrize("direct", [1 << 25, 0])
def test_fits_on_many_small_blocks(spark, monkeypatch, direct):
    monkeypatch.setattr(S, "BLOCK_ENTRIES", 7)
    monkeypatch.setattr(S, "DIRECT_BYTES", direct)
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(40, 3)), rng.integers(0, 2, 40)
    rows = [(4, [0, 1, 2, 3], [*map(float, r), 1.0], int(t)) for r, t in zip(x, y)]
    df = spark.createDataFrame(rows, "size int, indices array<int>, values array<double>, y int").repartition(3)
    packed = S._blocks(df.select("indices", "values", F.array(F.col("y").cast("double")).alias("about")))
    assert packed.count() > 10
    w = S.fit_binary(df, [(F.col("y"), 1 - F.col("y"))], [1.0])[0].coefficients
    full = np.c_[x, np.ones(40)]
    assert np.abs(w + full.T @ (1 / (1 + np.exp(-full @ w)) - y)).max() < 1e-4
