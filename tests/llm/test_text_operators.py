"""License scan, HTML text, decontamination and classifiers on small tables."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskloom.llm.decontaminate import drop_leaks, leaks
from riskloom.llm.html_text import PageTree, main_texts
from riskloom.llm.licenses import HEADERS, TEMPLATES, blocks_of, full_texts, least_terms, license_scan, telling_terms, template_weights
from riskloom.llm.quality import THRESHOLD, drop_low_quality, pool_adjacent, quality_scores, text_statistics
from riskloom.llm.toxicity import toxicity_scores
from tests.llm.test_dedup import docs_of

MIT = "Released under the MIT License."
GPL = "This work is licensed under the GNU General Public License, version 3."


def scan(spark, rows, **extra):
    df = spark.createDataFrame(rows, "file_id long, path string, text string").withColumn("license", F.lit("x")).withColumn("dir", F.lit(1))
    return {r.file_id: (r.license, r.origin, r.license_dir) for r in license_scan(df, **extra).collect()}


def test_license_headers_and_nearest_directory(spark):
    got = scan(spark, [
        (1, "LICENSE", MIT), (2, "a/COPYING.txt", "x\n" * 5000 + GPL), (3, "a/b/f.py", "code"), (4, "f.py", "code"), (5, "a/g.py", f"# {MIT}\ncode"),
        (6, "ab/f.py", None), (7, "a/b/LICENSE", "all rights reserved"), (8, None, "code"), (9, None, MIT), (10, "a/b/c/d/e.py", ""),
        (11, "a/b/LICENSEE.py", "x")])
    assert got == {
        1: ("MIT", "header", None), 2: ("GPL-3.0", "header", None), 3: ("GPL-3.0", "directory", "a"), 4: ("MIT", "directory", ""),
        5: ("MIT", "header", None), 6: ("MIT", "directory", ""), 7: ("GPL-3.0", "directory", "a"), 8: (None, "none", None),
        9: ("MIT", "header", None), 10: ("GPL-3.0", "directory", "a"), 11: ("GPL-3.0", "directory", "a")}
    assert scan(spark, []) == {}


def test_license_ties_and_repeats(spark):
    got = scan(spark, [(1, "LICENSE", "Licensed under CC0 1.0."), (2, "LICENSE.txt", MIT), (2, "LICENSE.txt", MIT), (3, "x", "mit")])
    assert got[3] == ("CC0-1.0", "directory", "") and got[2] == ("MIT", "header", None)


def test_whole_licence_texts_are_found_and_inherited(spark):
    texts = {name: text[0] for name, text in full_texts().items()}
    rows, want = [], {}
    for i, (name, text) in enumerate(sorted(texts.items())):
        body = "The License\r\n\r\nCopyright (c) 2024 Jane Roe\n\n" + text.replace("\n", "\r\n")
        if name == "GPL-3.0":
            body = text[:text.index("How to Apply These Terms")]  # without the header at its end
        rows += [(2 * i, f"p{i}/LICENSE.md", body), (2 * i + 1, f"p{i}/src/f.py", "code")]
        want |= {2 * i: (name, "header", None), 2 * i + 1: (name, "directory", f"p{i}")}
    rows.append((900, "q/essay.txt", "words " * 50 + texts["GPL-3.0"][:9000]))   # no licence file
    rows.append((901, "q/LICENSE", "All rights reserved. " * 200))
    got = scan(spark, rows)
    assert got.pop(900) == got.pop(901) == (None, "none", None)
    assert got == want


def test_headers_in_comments_and_notices_over_two_lines(spark):
    def comment(text, mark):
        words = text.split()
        lines = [" ".join(words[i:i + 9]) for i in range(0, len(words), 9)]
        return "\n".join(["#!/bin/x", mark, *[f"{mark} {line}" for line in lines], mark, "code = 1", "more code"])

    cases = [(name, text, mark) for name, texts in HEADERS.items() for text in texts for mark in ("#", " *", "//")]
    rows = [(i, f"d/{i}.py", comment(text, mark)) for i, (_, text, mark) in enumerate(cases)]
    rows.append((100, "e.py", "Licensed under the Apache\nLicense, Version 2.0."))
    rows.append((101, "f.py", "// Released under\n// the MIT License.\n\n\ncode"))
    rows.append((102, "g.py", "\n" * 50_000 + "x\n" + " \n" * 50_000 + "the license of software\n"))
    got = scan(spark, rows)
    assert {i: got[i][0] for i in range(len(cases))} == {i: c[0] for i, c in enumerate(cases)}
    assert got[100][0] == "Apache-2.0" and got[101][0] == "MIT" and got[102][0] is None


@pytest.mark.parametrize("templates", [TEMPLATES, blocks_of(TEMPLATES, HEADERS), full_texts()])
def test_units_that_are_not_scored_stay_below_the_threshold(templates):
    rows, _, _ = template_weights(templates)
    telling, least = set(telling_terms(rows, 0.75)), least_terms(rows, 0.75)
    for notice in {r[:2] for r in rows}:
        weights = {r[2]: r[3] for r in rows if r[:2] == notice}
        assert sum(w * w for t, w in weights.items() if t not in telling) < 0.75 ** 2
        assert sum(w * w for w in sorted(weights.values())[::-1][:least - 1]) < 0.75 ** 2


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body><header class="top">Site</header>
<nav><ul><li><a href="/x">Menu</a></ul></nav><div class="cookie-notice">We use cookies</div>
<main><article><header><h1>Title &amp; more</h1></header><p>First <b>bold</b>
 text<p>Second&nbsp;&#233;<br>line<script>var t="</p><p>no";</script><aside>Related</aside>
<div id="comments"><p>Nice post!</p></div><form>Name <input></form></article></main><div>stray</div><footer>(c)</footer></body></html>"""


def extract(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("x")).withColumn("host", F.lit("x"))
    return {r.page_id: (r.text, r.n_chars) for r in main_texts(df).collect()}


def test_main_text(spark):
    want = "Title & more\nFirst bold text\nSecond é line"
    got = extract(spark, [(1, "http://a/", PAGE), (2, None, None), (3, "x", ""), (4, "http://a/", "<p>only</p><p> </p>tail"), (5, "http://a/", "<<a <p>broken <!-- x")])
    assert got[1] == (want, len(want))
    assert got[2] == got[3] == ("", 0)
    assert got[4] == ("only\ntail", 9)
    assert got[5][0].endswith("broken")
    assert extract(spark, []) == {}


def test_branches_that_repeat_on_a_host_go(spark):
    rng = random.Random(1)
    rows = []
    for i in range(60):
        body = "".join(f"<p>{' '.join(rng.choices('abcdefgh', k=12))} {i}</p>" for _ in range(3))
        rows.append((i, "http://a/", f"<body><div class=box><span>Buy this</span></div><div class=content>{body}</div></body>"))
    rows += [(100 + i, f"http://h{i}/", "<body><div class=box>Only here</div></body>") for i in range(5)]
    got = extract(spark, rows)
    assert all("Buy" not in got[i][0] and got[i][0].count("\n") == 2 for i in range(60))
    assert all(got[100 + i][0] == "Only here" for i in range(5))


def test_marked_noise_goes_on_a_host_of_any_size(spark):
    rows = [(i, "http://a/", f"<body><p>{i} text<div id=comments><p>comment {i}</div><div>x{i}</div><div hidden>y{i}</div></body>") for i in range(2500)]
    got = extract(spark, rows)
    assert all(got[i][0] == f"{i} text\nx{i}" for i in range(2500))


def test_marks_and_plain_elements_of_one_path_are_told_apart(spark):
    rows = [(i, "http://a/", f"<body><div>Always</div><p>text {i}</p><div hidden>secret {i}</div></body>") for i in range(100)]
    got = extract(spark, rows)
    assert all(got[i][0] == f"text {i}" for i in range(100))


def test_the_tree_decides_inside_and_beside_main(spark):
    def page(i):
        return (f"<body><div class=story><p>{i} {'story ' * 9}</p></div><main><h1>Title {i}</h1><div class=box>Buy this</div>"
                f"<article><p>{i} {'word ' * 30}</p></article></main><div class=strip>Always</div></body>")

    def small(i):  # the body is a div, what HTML calls an article is a teaser or a comment
        return f"<div class=text>{i} {'word ' * 30}</div><article><p>Teaser {i}</p></article><article class=comment>{i} {'reply ' * 60}</article>"

    copy = "<main><div><p>Same</p></div></main>"
    got = extract(spark, [(i, "http://a/", page(i)) for i in range(100)] + [(100 + i, "http://b/", copy) for i in range(50)]
                  + [(200 + i, f"http://c{i}/", small(i)) for i in range(3)] + [(300, "http://d/", page(0))])
    for i in range(100):
        assert got[i][0].split("\n") == [f"{i} {'story ' * 9}".strip(), f"Title {i}", f"{i} {'word ' * 30}".strip()]
    assert all(got[100 + i][0] == "Same" for i in range(50))
    assert all(got[200 + i][0] == f"{i} {'word ' * 30}Teaser {i}".replace("word T", "word\nT") for i in range(3))
    assert got[300][0] == f"Title 0\nBuy this\n0 {'word ' * 30}".strip()


def test_very_deep_and_long_pages(spark):
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    assert [t for _, t in PageTree().read(deep).blocks] == ["x"]
    long = "<article>" + "<p>word</p>" * 20_000 + "</article>"
    assert extract(spark, [(1, "http://a/", long)])[1][1] == 5 * 20_000 - 1


ITEM = "On Monday Anna bought 12 apples and 7 pears in the old market then Anna walked 3.5 km home along the narrow river path"
OTHER = "a plain question without any slots that asks about the colour of the small bird on the green fence today"


def leaked(spark, texts, items=((1, ITEM), (2, OTHER), (3, "too short"), (4, None), (None, ITEM))):
    bench = spark.createDataFrame(list(items), "item_id long, text string")
    df = docs_of(spark, texts).withColumn("item_id", F.lit("x")).withColumn("plain", F.lit("x"))
    return {(r.doc_id, r.item_id, r.renamed) for r in leaks(df, bench).collect()}


def test_leaks(spark):
    renamed = ITEM.replace("Anna", "Berta").replace("12", "30").replace("3.5", "4").replace(" km", " miles")
    mixed = ITEM.replace("then Anna", "then Carla")  # one name became two
    filler = "some other words stand here before and after the passage itself and go on. "
    got = leaked(spark, [f"{filler}{ITEM}\n{filler}", renamed, mixed, OTHER.upper(), OTHER.replace(" ", "\n\n"), filler, None, "", OTHER[:40],
                         " ".join(OTHER.split()[2:16]), filler * 3000 + OTHER, OTHER])
    assert got == {(0, 1, False), (1, 1, True), (3, 2, False), (4, 2, False), (9, 2, False), (10, 2, False), (11, 2, False)}
    assert leaked(spark, []) == set()
    assert leaked(spark, [ITEM], items=()) == set()


def test_copies_of_items_of_mostly_slots_and_in_other_case(spark):
    sums = "What is 12 + 7 * 3 - 45 / 9 + 16 - 8 * 2 + 31 - 6 + 77 - 5?"
    nouns = "Der Hund und die Katze sahen den Vogel im Garten der Tante bei der Kirche am Markt"
    got = leaked(spark, ["so " * 7 + sums, sums.replace("45", "44"), nouns, nouns.lower(), "x " + nouns.upper()], items=((1, sums), (2, nouns)))
    assert got == {(0, 1, False), (2, 2, False), (3, 2, False), (4, 2, False)}


def test_names_at_sentence_starts_and_of_other_lengths(spark):
    tom = "Tom has 3 red apples. Tom buys 5 more apples at the shop near the old river. How many apples does Tom have in the end?"
    smith = "last week the teacher Robert Smith gave 4 books to the class and then Robert Smith took 2 of them home again"
    ann = tom.replace("Tom", "Ann").replace("3", "7").replace("5", "9")
    got = leaked(spark, [ann, ann.replace(". ", ".\n\n").replace("does ", "does\n"), smith.replace("Robert Smith", "Ann")],
                 items=((1, tom), (2, smith)))
    assert got == {(0, 1, True), (1, 1, True), (2, 2, True)}


def test_drop_leaks_keeps_columns_and_null_ids(spark):
    bench = spark.createDataFrame([(1, OTHER), (1, OTHER)], "item_id long, text string")
    df = docs_of(spark, [OTHER, OTHER, "clean", OTHER], [1, 1, 2, None])
    left = drop_leaks(df, bench)
    assert left.columns == df.columns and sorted((r.doc_id or 0) for r in left.collect()) == [0, 2]


def labelled(spark, make, n=400):
    rng = random.Random(4)
    marks = [rng.random() < 0.4 for _ in range(n)]
    df = docs_of(spark, [make(rng, m) for m in marks])
    return df, spark.createDataFrame([(i, int(m), int(m)) for i, m in enumerate(marks)], "doc_id long, quality int, toxic int"), marks


def plain_text(rng, k=60):
    return " ".join("".join(rng.choices("aeioutnrs", k=rng.randint(2, 8))) for _ in range(k))


def check_scores(rows, marks, threshold):
    assert len(rows) == len(marks)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= threshold)
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == marks[r.doc_id] for r in held) / len(held) > 0.95


def test_quality_on_held_out_rows(spark):
    df, labels, marks = labelled(spark, lambda rng, good: plain_text(rng) if good else " | ".join(plain_text(rng, 2) for _ in range(30)))
    df = df.withColumn("score", F.lit(1)).withColumn("label", F.lit(1))
    rows = quality_scores(df, labels).collect()
    check_scores(rows, marks, THRESHOLD)
    other = labels.withColumn("quality", F.when(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r.doc_id: r.score for r in quality_scores(df, other).collect()}  # labels of held-out rows change nothing
    assert all(abs(again[r.doc_id] - r.score) < 1e-6 for r in rows)
    kept = drop_low_quality(df, labels)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if r.predicted}


def test_toxicity_on_held_out_rows(spark):
    def make(rng, toxic):
        words = plain_text(rng, rng.randint(30, 300)).split()
        for w in rng.sample(["blorpy", "zuckle", "vexmog"], 2 if toxic else 0):
            words.insert(rng.randrange(len(words)), w)
        return " ".join(words)
    df, labels, marks = labelled(spark, make)
    check_scores(toxicity_scores(df.withColumn("label", F.lit(1)), labels).collect(), marks, 0.5)


@pytest.mark.parametrize("scores", [quality_scores, toxicity_scores])
def test_classifiers_on_odd_tables(spark, scores):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    odd = docs_of(spark, [None, "", "a", "a", "x" * 100_000], [1, 2, 3, 3, None])
    assert [round(r.score, 6) for r in scores(odd, none).collect()] == [0.5] * 5
    one = spark.createDataFrame([(1, 1, 1), (3, 1, 1), (None, 0, 0), (3, None, 7)], "doc_id long, quality int, toxic int")
    assert all(r.score > 0.99 for r in scores(odd, one).collect())
    assert scores(docs_of(spark, []), none).count() == 0


def test_statistics_read_the_whole_text():
    a = text_statistics(pa.array(["a b c " * 5000 + "!!!!", "a b c " * 5000, "", None]))
    assert a[0, 4] > a[1, 4] == 0 and np.isfinite(a).all() and (a[2] == a[3]).all()


def test_pool_adjacent_is_the_monotone_least_squares_fit():
    steps, levels = pool_adjacent(np.array([1.0, 2.0, 3.0, 4.0, 4.0]), np.array([0.0, 1.0, 0.0, 1.0, 0.0]))
    assert np.interp([1, 2, 3, 4], steps, levels).tolist() == [0.0, 0.5, 0.5, 0.5]


def test_single_shared_windows_make_suspects(spark):
    """An item of few words needs one or two shared windows; wherever these begin, they are seen."""
    words = "where does the quiet river meet stones".split()
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    rows = [(k, " ".join([*(f"w{chr(97 + i)}" for i in range(k)), *words[:6], "other"])) for k in range(13)]
    assert {r.doc_id for r in leaks(docs_of(spark, rows), bench).collect()} == set(range(13))
