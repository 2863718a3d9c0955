"""Periodic runs, tokenizer alignment and language prediction against plain Python."""

import hashlib
import json
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import alignment
from riskloom.llm.alignment import Tokenizers, align_tokenizers, pair_bitmaps, pair_counts
from riskloom.llm.languages import _tree, code_lengths, predict_languages
from riskloom.llm.periods import _numbered, collapse_runs, word_runs
from riskloom.llm.queries import PIECES, QUERIES, vocabulary
from tests.llm.test_dedup import docs_of as table_of

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0D]+")


def docs_of(spark, rows):
    return table_of(spark, [t for _, t in rows], [i for i, _ in rows])


# periodic runs

def brute_runs(words, least=12, times=2):
    found = {}
    n = len(words)
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, times * q):
                found.setdefault((i, j + q), q)
            i = j
    return sorted((s, e - s, q) for (s, e), q in found.items())


def brute_collapse(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def found_runs(texts, least=12):
    words, names, ends = _numbered(texts)
    begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    out = defaultdict(list)
    for s, e, q in word_runs(names, np.repeat(ends, ends - begins), least).tolist():
        i = int(np.searchsorted(ends, s, side="right"))
        out[i].append((s - int(begins[i]), e - s, q))
    return [out[i] for i in range(len(texts))]


@pytest.mark.parametrize("least", [1, 12])
def test_runs_of_small_alphabets_equal_brute_force(least):
    rng = random.Random(7)
    texts = []
    for _ in range(1500):
        kind = rng.randrange(4)
        n = rng.randrange(0, 70)
        if kind == 0:
            words = [rng.choice("ab") for _ in range(n)]
        elif kind == 1:
            words = [rng.choice("abc") for _ in range(n)]
        elif kind == 2:  # squares of words that are nearly periodic themselves
            part = (rng.choice(["ab", "aab", "abaab", "aaab"]) * 20)[:rng.randrange(2, 20)]
            words = list(rng.choice(["", "a", "b", "ba"]) + part * rng.randrange(2, 4) + rng.choice(["", "a", "b", "ab" * 5]))
        else:
            words = list("".join(rng.choice(["ab" * rng.randrange(1, 9), "ba" * rng.randrange(1, 9), "a" * rng.randrange(1, 9)]) for _ in range(5)))
        texts.append(" ".join(words))
    for text, got in zip(texts, found_runs(texts, least)):
        assert got == brute_runs(text.split(), least), text


def test_runs_of_long_periods():
    rng = random.Random(3)
    texts = []
    for p in (1, 2, 3, 17, 64, 65, 127, 128, 129, 300):
        unit = [str(rng.randrange(10 ** 6)) for _ in range(p)]
        texts.append(" ".join(["x"] * 5 + [unit[i % p] for i in range(rng.choice([2 * p, 2 * p - 1, 3 * p + 1, 12]))] + ["y"]))
    for text, got in zip(texts, found_runs(texts)):
        assert got == brute_runs(text.split())


def test_collapse_on_odd_rows(spark):
    text = "head " + "one two three " * 5 + "tail"
    rows = [(1, text), (2, None), (3, ""), (4, " \t\n"), (5, "a " * 11), (6, "a\u00a0b " * 12), (6, "a\u00a0b " * 12), (None, text), (7, "w " * 30000 + "end"),
            (8, " ".join(map(str, range(5000))))]
    df = docs_of(spark, rows).withColumn("runs", F.lit("x")).withColumn("collapsed", F.lit(1)).withColumn("start", F.lit(1))
    got = [(r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in collapse_runs(df).collect()]
    assert (1, [(1, 15, 3)], "head one two three tail") in got and (None, [(1, 15, 3)], "head one two three tail") in got
    assert all((i, [], "") in got for i in (2, 3, 4)) and (5, [], " ".join("a" * 11)) in got
    assert got.count((6, [(0, 12, 1)], "a\u00a0b")) == 2 and (7, [(0, 30000, 1)], "w end") in got
    assert (8, [], " ".join(map(str, range(5000)))) in got and len(got) == len(rows)
    assert collapse_runs(df.limit(0)).count() == 0


def test_op12_equals_brute_force(spark):
    got = {r.doc_id: r for r in QUERIES["op12_periodic_runs"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    some = 0
    for doc in docs:
        words = WORD.findall(doc.text or "")
        h = zlib.crc32(str(doc.doc_id).encode())
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        r = got.pop(doc.doc_id)
        assert r.collapsed_sha256 is not None
        if len(words) > 3000:
            continue
        runs = brute_runs(words)
        some += len(runs)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None, None, None)
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(brute_collapse(words, runs).encode()).hexdigest()
    assert not got and some > 10


# alignment

@pytest.fixture(scope="module")
def files():
    import public_tokenizers

    return Tokenizers(*vocabulary(), public_tokenizers.path(PIECES))


def brute_alignment(rows, files):
    """The contract read literally: whole texts, all overlaps, all counts."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(files.tokenizer)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=files.pieces)
    names = {i: t for t, i in json.load(open(files.tokenizer))["model"]["vocab"].items()}
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves; the others follow from 256 on
    byte = {chr(c): c for c in plain} | {chr(256 + k): c for k, c in enumerate(c for c in range(256) if c not in plain)}
    parts = []
    for _, text in rows:
        x = a.encode(" " + text, add_special_tokens=False).ids if text else []
        y = b.encode(text) if text else []
        bytes_a = [bytes(byte[c] for c in names[i]) for i in x]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in y]
        if not text or not (b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode()):
            parts.append(([], [], [], []))
            continue
        spans = []
        for ids, bs in ((x, bytes_a), (y, bytes_b)):
            at, out = 0, []
            for i, t in zip(ids, bs):
                out.append((i, at, at + len(t)))
                at += len(t)
            spans.append(out)
        links, j = [], 0
        for i, s, e in spans[0]:
            while spans[1][j][2] <= s:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][1] < e:
                links.append((i, spans[1][k][0]))
                k += 1
        both = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups, low = [], 0
        for cut in both:
            groups.append("|".join(",".join(str(i) for i, s, _ in side if low <= s < cut) for side in spans))
            low = cut
        parts.append((x, y, groups, links))
    count = Counter(p for *_, links in parts for p in set(links))
    total = Counter(p for *_, links in parts for p in links)
    most = defaultdict(int)
    for (i, _), n in count.items():
        most[i] = max(most[i], n)
    out = [(key, len(x), len(y), len(groups), len(links), hashlib.sha256(";".join(groups).encode()).hexdigest() if x else "",
            sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links)) for (key, _), (x, y, groups, links) in zip(rows, parts)]
    return out, count, total


def test_alignment_equals_brute_force_on_odd_texts(spark, files, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_ROWS", 5)
    rng = random.Random(5)
    odd = ["", None, " ", "  two  spaces ", "\ttab\n\n line \nend\n", "\nstart", "<|endoftext|> <s> </s> <unk> <0x41>", "low▁line", "a\x00b \x1c c", "日本語 и русский",
           "emoji 😀😀 café naïve", "x" * 3000, "don't can't 12345 1,000.5", " nbsp em\u0085nel", "same text", "same text", "á combining"]
    alphabet = ["the", "a", "risk-based", "naïve", "12.5%", "Über", "\n", " ", "", "\t", "don't", "ﬁ", "▁", "…", "O'Neil"]
    odd += [rng.choice([" ", " ", "  ", "\n"]).join(rng.choices(alphabet, k=rng.randrange(12))) for _ in range(120)]
    rows = [(i if i % 9 else None, t) for i, t in enumerate(odd)]
    df = docs_of(spark, rows).withColumn("pair", F.lit("x")).withColumn("block", F.lit("x")).withColumn("n_a", F.lit(1))
    got = align_tokenizers(df, files, with_groups=True).collect()
    want, _, _ = brute_alignment(rows, files)
    key = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    assert sorted(map(str, [tuple(r[k] for k in key) for r in got])) == sorted(map(str, want))
    assert all(hashlib.sha256(r.groups.encode()).hexdigest() == r.groups_sha256 if r.n_a else r.groups == "" for r in got)
    assert align_tokenizers(df.limit(0), files).count() == 0


def test_pair_counts_equal_brute_force(spark, files):
    text = "the risk of the risk of the bank and the risk of loss " * 9
    rows = [(i, text if i % 3 else f"other words {i} of the bank") for i in range(60)]
    got = {(r.pair >> 16, r.pair & 0xFFFF): (r.documents, r.links) for r in pair_counts(pair_bitmaps(docs_of(spark, rows), files)).collect()}
    _, count, total = brute_alignment(rows, files)
    assert got == {p: (n, total[p]) for p, n in count.items()}


def test_op11_equals_brute_force(spark, files):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want, _, _ = brute_alignment(rows, files)
    got = [(r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.groups_sha256, r.n_best, r.count_sum) for r in QUERIES["op11_tokenizer_alignment"](spark, SF).collect()]
    assert sorted(got) == sorted(want)


# languages

def brute_bits(learned, text, order):
    """Prediction by partial matching with exclusion, symbol by symbol."""
    counts = defaultdict(Counter)
    for t in learned:
        t = bytes(order) + t
        for i in range(order, len(t)):
            for k in range(order + 1):
                counts[t[i - k:i]][t[i]] += 1
    bits, t = 0.0, bytes(order) + text
    for i in range(order, len(t)):
        excluded = set()
        for k in range(order, -1, -1):
            left = {s: n for s, n in counts.get(t[i - k:i], {}).items() if s not in excluded}
            if not left:
                continue
            whole = sum(left.values()) + len(left)
            if t[i] in left:
                bits -= math.log2(left[t[i]] / whole)
                break
            bits -= math.log2(len(left) / whole)
            excluded |= set(left)
        else:
            bits += math.log2(256 - len(excluded))
    return bits


def test_code_lengths_equal_brute_force():
    import pyarrow as pa

    from riskloom.llm.languages import LanguageModel, _grams
    rng = random.Random(1)
    for order in (0, 1, 3, 4):
        learned = ["".join(rng.choices("abcdé ", k=rng.randrange(60))) for _ in range(20)]
        grams = np.concatenate([g for _, g in _grams(pa.array(learned), order)])
        keys, n = np.unique(grams, return_counts=True)
        model = LanguageModel(["x"], [_tree(keys, n, order)], order)
        asked = ["".join(rng.choices("abcdé fz", k=rng.randrange(40))) for _ in range(20)] + [""]
        got = model.bits(pa.array(asked))[:, 0]
        assert np.allclose(got, [brute_bits([t.encode() for t in learned], t.encode(), order) for t in asked])
        assert np.allclose(code_lengths(model.trees[0], keys) > 0, True)


def test_long_texts_in_chunks(monkeypatch):
    import pyarrow as pa

    from riskloom.llm import languages
    texts = pa.array(["abc " * 50, None, "", "é" * 70, "z"])
    whole = [np.concatenate(x) for x in zip(*languages._grams(texts, 3))]
    monkeypatch.setattr(languages, "CHUNK", 7)
    parts = [np.concatenate(x) for x in zip(*languages._grams(texts, 3))]
    assert all((a == b).all() for a, b in zip(whole, parts))


def test_languages_on_odd_rows(spark):
    words = {"en": "the bank has risk and loss of money in the market", "de": "die Bank hat ein Risiko und Verluste am Markt für Geld"}
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices(words[l].split(), k=30)), l) for i in range(200) for l in [("en", "de")[i % 2]]]
    rows += [(1000, None, "en"), (1001, "", "de"), (1002, "12 345 .", "en"), (None, "the bank and the market", None), (1003, "the market", None), (1003, "the market", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit(1)).withColumn("lang_pred", F.lit("x"))
    got = predict_languages(df).collect()
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append((r.lang_pred, r.score))
        assert r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
    assert all(by[i][0][0] == l for i, _, l in rows[:200])
    assert all(by[i] == [("und", 0.0)] for i in (1000, 1001, 1002)) and by[None][0][0] == "en" and len(by[1003]) == 2
    assert predict_languages(df.limit(0)).count() == 0
    nothing = predict_languages(df.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}
    only = predict_languages(df.where("lang = 'en'")).where("lang_pred <> 'und'").collect()
    assert {(r.lang_pred, r.score) for r in only} == {("en", 1.0)}


def test_op13_held_out_accuracy(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    got = [r for r in QUERIES["op13_ppm_language"](spark, "/root/testdata/sf0.01").collect() if r.held_out and r.lang_pred != "und"]
    assert len(got) > 200 and sum(truth[r.doc_id] == r.lang_pred for r in got) >= 0.97 * len(got)
