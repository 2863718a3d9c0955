"""Exact and near duplicates against plain Python."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from riskloom.llm.exact_dedup import drop_exact_copies, exact_groups
from riskloom.llm.near_dup import components, drop_near_copies, near_duplicates

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, ids=None):
    ids = ids or range(len(texts))
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in zip(ids, texts)], SCHEMA)


def squeeze(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


TEXTS = ["a b", "a  b", "a\tb ", "a b ", None, "", " ", "x", "x", "a b", "é\nf", "é f", "q" * 50_000, "q" * 50_000]


@pytest.mark.parametrize("weak", [False, True])
def test_exact_groups(spark, weak):
    # a hash that only sees the length makes unequal texts collide
    extra = {"content_hash": lambda t: F.encode(F.length(t).cast("string"), "utf-8")} if weak else {}
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_groups(docs_of(spark, TEXTS), **extra).collect()}
    norm = [squeeze(t) for t in TEXTS]
    assert got == {i: (norm.index(t), norm.count(t), norm.index(t) == i, hashlib.sha256(t.encode()).hexdigest()) for i, t in enumerate(norm)}


def test_exact_nulls_repeats_and_extra_columns(spark):
    df = docs_of(spark, ["a", "a", "a", "b", "b"], [7, 7, None, None, None])
    df = df.select("*", F.lit(1).alias("keep_id"), F.lit(2).alias("kept"), F.lit("t").alias("t"), F.lit("h").alias("h"))
    rows = exact_groups(df).collect()
    assert sorted((r.doc_id or -1, r.keep_id or -1, r.group_size, r.kept) for r in rows) == [
        (-1, -1, 2, True), (-1, -1, 2, True), (-1, 7, 3, False), (7, 7, 3, True), (7, 7, 3, True)]
    assert drop_exact_copies(df).columns == df.columns
    assert drop_exact_copies(docs_of(spark, TEXTS)).count() == len({squeeze(t) for t in TEXTS})
    assert exact_groups(docs_of(spark, [])).count() == drop_exact_copies(docs_of(spark, [])).count() == 0


def brute_components(texts, size=4, per_cent=80):
    sets = []
    for t in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set())
    up = list(range(len(texts)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= per_cent * len(a | sets[j]):
                x, y = sorted((root(i), root(j)))
                up[y] = x
    return {i: (len(s), root(i), root(i) == i) for i, s in enumerate(sets)}


def near_texts(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choices(vocabulary, k=55))
    out = [None, "", " \n", "one", "ONE", "one two", "one two three four", "É é É É", "é é é é"]
    for _ in range(12):
        base = rng.choices(vocabulary, k=rng.randint(5, 120))
        for _ in range(rng.randint(1, 9)):
            words = list(base)
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            text = " ".join(words)
            if rng.random() < 0.3:
                text = f"{text}\n{passage}"
            out.append(text.upper() if rng.random() < 0.2 else text)
    out += [" ".join(rng.choices(vocabulary, k=8)) + " " + passage for _ in range(25)]  # the passage dominates, links differ
    chain = rng.choices(vocabulary, k=60)
    for i in range(15):  # each is near the next, the ends are not
        out.append(" ".join(chain[i:] + vocabulary[:i]))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates(spark, seed):
    texts = near_texts(seed)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs_of(spark, texts)).collect()}
    assert got == brute_components(texts)


def test_near_duplicates_odd_tables(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    df = docs_of(spark, [long, long + " x", "a b c d", "a b c d", "a b c d"], [5, 3, 9, 9, None]).withColumn("rep", F.lit(0)).withColumn("n", F.lit(0))
    got = sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in near_duplicates(df).collect())
    assert got == [(-1, -1, True), (3, 3, True), (5, 3, False), (9, 9, True), (9, 9, True)]
    assert drop_near_copies(df).columns == df.columns
    assert near_duplicates(docs_of(spark, [])).count() == 0
    assert near_duplicates(docs_of(spark, [None, ""])).count() == 2


def test_near_duplicates_with_an_id_of_hash_zero(spark):
    text = " ".join(f"w{i}" for i in range(60))
    df = docs_of(spark, [text, text + " x", text + " y"], [25317696, 60270852, 7])
    assert {(r.doc_id, r.component_id) for r in near_duplicates(df).collect()} == {(25317696, 7), (60270852, 7), (7, 7)}


def test_components_of_a_chain(spark):
    rng = random.Random(3)
    ends = list(range(200))
    rng.shuffle(ends)
    links = spark.createDataFrame([*zip(ends, ends[1:]), (900, 901)], "a long, b long")
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {**dict.fromkeys(range(200), 0), 900: 900, 901: 900}


def test_frequent_shingles_in_blocks_and_ids_by_join(spark, monkeypatch):
    from riskloom.llm import near_dup

    monkeypatch.setattr(near_dup, "BLOCK", 3)
    rng = random.Random(12)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for i in range(70):  # all share most of a template, some pairs reach the threshold
        words = base[:]
        for _ in range(rng.randrange(1, 5)):
            words[rng.randrange(60)] = f"x{rng.randrange(9)}"
        texts.append(" ".join(words))
    want = {i: (n, c, k) for i, (n, c, k) in brute_components(texts).items()}
    for most in (near_dup.MOST_BITS, 1):
        monkeypatch.setattr(near_dup, "MOST_BITS", most)
        got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs_of(spark, texts)).collect()}
        assert got == want
