"""Main text over hosts of all sizes, the style tree and the benchmark aligner against plain Python."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from riskloom.llm.decontaminate import UNITS, drop_leaks, leaks
from riskloom.llm.exact_dedup import drop_exact_copies
from riskloom.llm.html_text import DECAY, PRIOR, PageTree, _observations, importance, main_texts, observe
from riskloom.llm.near_dup import drop_near_copies
from riskloom.llm.quality import drop_low_quality
from tests.llm.test_runs_alignment_languages import docs_of


def extract(spark, rows):
    return {r.page_id: r.text for r in main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_unique_pages_keep_their_text_on_hosts_of_any_size(spark):
    rows, want = [], {}
    for n in (1, 2, 3, 5, 7, 8, 9, 10, 12, 25, 40):
        for i in range(n):
            lines = [f"story {n} {i} part {k} of what was told" for k in range(3)]
            items = "".join(f"<li>point {n} {i} {k}</li>" for k in range(2))
            key = 1000 * n + i
            rows.append((key, f"http://h{n}.example/{i}", f"<html><body><div><div>{lines[0]}</div><p>{lines[1]}</p><div>{lines[2]}</div>"
                                                         f"<ul>{items}</ul></div><div class='footer-links'>imprint</div></body></html>"))
            want[key] = "\n".join([*lines, f"point {n} {i} 0", f"point {n} {i} 1"])
    assert extract(spark, rows) == want


ARTICLE = "<article><h1>Title</h1><p>The text of the article is here.</p></article>"
TEXT = "Title\nThe text of the article is here."


@pytest.mark.parametrize("html, text", [
    (f'<div class="content-sidebar-wrap"><main>{ARTICLE}</main></div>', TEXT),
    (f'<div class="site has-sidebar">{ARTICLE}</div>', TEXT),
    ('<article class="post category-legal"><h1>Title</h1><p>The text of the article is here.</p></article>', TEXT),
    ('<main><h1>Title</h1><section class="notice-period"><p>The text of the article is here.</p></section></main>', TEXT),
    ('<article><header class="entry-header"><h1>Title</h1></header><p>The text of the article is here.</p></article>', TEXT),
    ('<article><p>a one</p><svg width="1"/><p>b two</p></article>', "a one\nb two"),
    ('<article><p>a one</p><datalist id="x"><option>q<option>r</datalist><p>b two</p></article>', "a one\nb two"),
    ('<article><p>a one</p><video src="x"><p>b two</p></article>', "a one\nb two"),
    ('<article><p>a one</p><svg><svg><text>no</text></svg><text>no</text></svg><p>b two</p></article>', "a one\nb two"),
    ('<article><p>a one <a class="share-button" href="#">Share this</a></p></article>', "a one"),
    ('<article><p>a one</p><div class="comment-list"><p>nice</p></div></article>', "a one"),
    ('<div id="comments"><article class="comment"><p>nice</p></article></div><div class="body"><p>a one and more</p></div>', "a one and more"),
    (f'<aside><article>teaser</article></aside>{ARTICLE}', TEXT),
    ('<div class="widget-area"><p>the only text of this page, all of it</p></div><div class="menu">x</div>', "the only text of this page, all of it"),
    ("<script>var a = '<p>no</p>';", ""),
])
def test_single_pages(html, text):
    tree = PageTree().read(f"<html><head><title>t</title></head><body>{html}</body></html>")
    assert "\n".join(t for n, t in tree.blocks if not n.noise and not n.outside) == text


def brute_importance(pages):
    """The merged tree of one host in plain Python."""
    seen = defaultdict(lambda: (Counter(), Counter()))
    for html in pages:
        for path, prior, kind, feature in _observations(PageTree().read(html)):
            seen[path, prior][kind == "text"][feature] += 1
    out = {}
    for (path, prior), (styles, texts) in seen.items():
        m = sum(styles.values())
        value = 1.0
        if m > 1:
            entropy = -sum(c / m * math.log(c / m, m) for c in styles.values())
            told = 1 - sum(math.log(c, m) for c in texts.values()) / len(texts) if texts else 0.0
            value = (1 - DECAY) * entropy + DECAY * told
        out[path, prior] = 1.0 if prior == "main" else (m * value + PRIOR[prior][1] * PRIOR[prior][0]) / (m + PRIOR[prior][1])
    return out


def test_importance_equals_plain_python(spark):
    rng = random.Random(4)
    hosts = {}
    for n in (1, 2, 7, 8, 9, 23, 40):
        def block(depth=0):
            tag = rng.choice(["div", "p", "section", "ul", "div class='promo'", "article"])
            inner = "".join(block(depth + 1) for _ in range(rng.randrange(3))) if depth < 3 else ""
            return f"<{tag}>{rng.choice(['same words', f'words {rng.random()}', ''])}{inner}</{tag.split()[0]}>"
        hosts[f"h{n}.example"] = [f"<body>{''.join(block() for _ in range(rng.randrange(1, 4)))}</body>" for _ in range(n)]
    rows = [(i, f"https://{h}/{i}", html) for h, pages in hosts.items() for i, html in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {(r.host, r.path, r.prior): r.importance for r in importance(observe(df)).collect()}
    want = {(h, *k): v for h, pages in hosts.items() for k, v in brute_importance(pages).items()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


# benchmark leaks

def brute_forms(text):
    """(template, raw) in the forms TYPED, PLAIN and RUNS."""
    out = []
    for m in re.finditer(r"(?:(?<=\d)[.,](?=\d)|[^\W_])+", text):
        w = m[0]
        capital = len(w) > 1 and w[0].isupper() and w[1].islower()
        inside = capital and re.search(r"[^\W\d_A-ZÄÖÜ] $|\d $|[,;] $", text[:m.start()])
        out.append((w.lower().replace(".", "·").replace(",", "·"), capital, bool(inside)))

    def typed(words):
        template = []
        for word, name in words:
            if name:
                template.append("<name>")
            elif re.fullmatch(r"[0-9][0-9·]*", word):
                template.append("<number>")
            elif word in UNITS and template and template[-1] == "<number>":
                template.append("<unit>")
            else:
                template.append(word)
        return template, [w for w, _ in words]

    runs = []
    for word, capital, _ in out:
        if capital and runs and runs[-1][1]:
            runs[-1] = (f"{runs[-1][0]}_{word}", True)
        else:
            runs.append((word, capital))
    raw = [w for w, _, _ in out]
    return [typed([(w, inside) for w, _, inside in out]), (raw, raw), typed(runs)]


def brute_leaks(docs, items, size=6, least=8):
    kinds = ("<name>", "<number>", "<unit>")
    found = set()
    for item_id, item in items:
        for form, (ti, ri) in enumerate(brute_forms(item)):
            kept = {p for p in range(len(ti) - size + 1) if form == 1 or 2 * sum(w not in kinds for w in ti[p:p + size]) >= size}
            total = len(ti) - size + 1 if form == 2 else len(kept)
            for doc_id, doc in docs:
                td, rd = brute_forms(doc or "")[form]
                hits = [(at, p) for p in kept for at in range(len(td) - size + 1) if td[at:at + size] == ti[p:p + size]]
                for shift in {at - p for at, p in hits}:
                    places = [p for at, p in hits if at - p == shift]
                    if len(places) < min(least, math.ceil(total / 2)):
                        continue
                    values, ok = {}, True
                    for q in {q for p in places for q in range(p, p + size)}:
                        if ti[q] in kinds:
                            a, b = ri[q].split("_"), rd[q + shift].split("_")
                            for x, y in zip(a, b) if len(a) == len(b) else [(ri[q], rd[q + shift])]:
                                ok &= values.setdefault((ti[q], x), y) == y
                    if ok:
                        found.add((doc_id, item_id))
    return found


def test_leaks_equal_a_plain_aligner(spark):
    rng = random.Random(11)
    names, places = ["Tom", "Ann", "Robert Smith", "Maria"], ["Paris", "New York", "Rome"]
    shapes = [
        "{n} has {a} red apples and {m} has {b} green pears in {p}. {n} buys {a} more apples from {m} on Monday. How many apples does {n} have?",
        "A train leaves {p} with {a} km to go and needs {b} hours for the way to the coast; how fast does it go on the whole way then?",
        "the quick brown fox jumps over the lazy dog while {a} birds look down from the old tree near the river bank",
        "What is {a} + {b} * 3 - 45 / 9 + 16 - 8 * 2 + {a} - 6 + 77 - 5?"]

    def fill(shape):
        n, m = rng.sample(names, 2)
        return shape.format(n=n, m=m, p=rng.choice(places), a=rng.randrange(2, 99), b=f"{rng.randrange(2, 9)}.5")

    items = [(i, fill(s)) for i, s in enumerate(shapes * 2)]
    filler = "some other words that have nothing to do with the matter at all and go on for a while".split()
    docs = []
    for i in range(150):
        text = rng.choice([fill(rng.choice(shapes)), rng.choice(items)[1], rng.choice(items)[1].lower(), rng.choice(items)[1].upper(),
                           " ".join(rng.choices(filler, k=40))])
        words = text.split(" ")
        if rng.random() < 0.4:
            words = words[rng.randrange(len(words)):] if rng.random() < 0.5 else words[:rng.randrange(len(words))]
        if rng.random() < 0.3 and words:
            words[rng.randrange(len(words))] = rng.choice(["Zoe", "13", "km", "thing", "\n"])
        docs.append((i, " ".join(rng.choices(filler, k=rng.randrange(20)) + words + rng.choices(filler, k=rng.randrange(20)))))
    docs += [(900, None), (901, ""), (902, "word")]
    want = brute_leaks(docs, items)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in leaks(docs_of(spark, docs), benchmark).collect()}
    assert got == want and 40 < len({i for i, _ in want}) < 140


def test_stages_with_clashing_columns(spark):
    text = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    df = docs_of(spark, [(1, text), (2, text), (3, "something else entirely"), (None, None), (4, None)])
    for name in ("_gone", "_low", "_kept_id", "key", "form"):
        df = df.withColumn(name, F.lit("x"))
    benchmark = spark.createDataFrame([(1, text)], "item_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert {r.doc_id for r in drop_exact_copies(df).collect()} == {1, 3, 4}
    assert {r.doc_id for r in drop_near_copies(df).collect()} == {1, 3, None, 4}
    assert {r.doc_id for r in drop_leaks(df, benchmark).collect()} == {3, None, 4}
    assert drop_low_quality(df, labels).columns == df.columns
    for stage in (drop_exact_copies, drop_near_copies, lambda d: drop_leaks(d, benchmark), lambda d: drop_low_quality(d, labels)):
        assert stage(df.limit(0)).count() == 0
