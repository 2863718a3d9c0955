"""Shards, archives and packing against plain Python and exact round trips."""

import base64
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import warc
from riskloom.llm.packing import pack_documents, plan_sequences
from riskloom.llm.queries import vocabulary
from riskloom.llm.sharding import assign_shards, shard_of, shard_tree
from tests.llm.test_dedup import docs_of

TEXTS = [f"text {i % 50} é" for i in range(3000)]


def test_shards(spark):
    rows = assign_shards(docs_of(spark, TEXTS).withColumn("shard", F.lit("x")).withColumn("slot", F.lit("x"))).collect()
    by = defaultdict(list)
    for r in rows:
        text = TEXTS[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(text) + 8, zlib.crc32(text), "key")
        assert r.grown_shard in (r.shard, 24)
        by[r.shard].append(r.slot)
    assert sorted(by) == list(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert max(map(len, by.values())) < 3000 / 24 * 1.5
    assert 60 < sum(r.grown_shard == 24 for r in rows) < 190
    again = {r.doc_id: r.shard for r in assign_shards(docs_of(spark, ["other"] * 100)).collect()}
    assert all(again[r.doc_id] == r.shard for r in rows if r.doc_id < 100)


def test_shards_odd_tables(spark):
    rows = assign_shards(docs_of(spark, [None, None, "", "a", "a"], [None, None, 1, 2, 2])).collect()
    assert sorted(r.size for r in rows) == [8, 8, 8, 9, 9]
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert assign_shards(docs_of(spark, [])).count() == 0


@pytest.mark.parametrize("shards", [5, 24, 25, 30])
def test_one_more_shard_takes_rows_only_into_itself(spark, shards):
    base = min(shards, 24)
    ids = spark.range(4000)
    moved = ids.select(shard_of(F.col("id"), shard_tree(shards, base=base)).alias("a"),
                       shard_of(F.col("id"), shard_tree(shards + 1, base=base)).alias("b")).collect()
    assert all(r.b in (r.a, shards) for r in moved)


def test_weights_and_subtrees(spark):
    tree = [[[(0, 1.0), (1, 3.0)], [(2, 2.0)]], [[(3, 2.0)]]]
    light = [[[(0, 1.0), (1, 1.0)], [(2, 2.0)]], [[(3, 2.0)]]]
    rows = spark.range(20_000).select(shard_of(F.col("id"), tree).alias("a"), shard_of(F.col("id"), light).alias("b")).collect()
    n = Counter(r.a for r in rows)
    assert all(abs(n[s] / 20_000 - w / 8) < 0.02 for s, w in ((0, 1), (1, 3), (2, 2), (3, 2)))
    assert all(r.b != r.a for r in rows if r.a != r.b)
    assert not [r for r in rows if r.a in (2, 3) and r.b == 1]  # less weight draws nothing in


def page(i, html):
    return (i, f"http://h{i}.example/", html)


PAGES = [page(1, "<p>a"), page(2, "<p>a"), page(5, None), page(4, ""), page(3, "é" * 90_000), page(9, "WARC/1.1\r\nx\r\n\r\n"), page(8, "b")]


@pytest.mark.parametrize("least", [0, 3])
def test_warc_round_trip(spark, tmp_path, least):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("digest", F.lit(0))
    warc.write_warc(df, str(tmp_path / "w"), least_revisit_bytes=least, records_per_file=2)
    got = {r.page_id: r for r in warc.read_warc(spark, str(tmp_path / "w")).collect()}
    last = {}
    for i, _, h in PAGES:
        last[h or ""] = max(last.get(h or "", 0), i)
    assert len(got) == len(PAGES)
    for i, url, h in PAGES:
        body, r = (h or "").encode(), got[i]
        full = last[h or ""] == i or len(body) < least
        assert (r.kind, r.url, r.record_type) == ("record", url, "response" if full else "revisit")
        assert r.payload_bytes == len(body)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(body).digest()).decode()
        assert r.refers_to == (None if full else last[h or ""])
        assert r.payload is None if not full else bytes(r.payload) == body


def test_warc_odd_tables(spark, tmp_path):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_warc(empty, str(tmp_path / "e"))
    assert warc.read_warc(spark, str(tmp_path / "e")).count() == 0
    odd = spark.createDataFrame([(None, None, "x"), (7, "a\r\nb", "x"), (7, "a\r\nb", "x")], "page_id long, url string, html string")
    warc.write_warc(odd, str(tmp_path / "o"))
    rows = warc.read_warc(spark, str(tmp_path / "o")).collect()
    assert sorted((r.page_id or 0, r.record_type, r.refers_to or 0) for r in rows) == [(0, "revisit", 7), (7, "response", 0), (7, "response", 0)]


def records(n):
    return [warc.record_bytes(i, "http://x/", f"payload {i}".encode() * 20, base64.b32encode(
        hashlib.sha1(f"payload {i}".encode() * 20).digest()).decode()) for i in range(n)]


@pytest.mark.parametrize("packed", [True, False])
def test_salvage(packed):
    made = [warc._gzip(r) if packed else r for r in records(6)]
    at = [0, *np.cumsum([len(m) for m in made]).tolist()]
    data = bytearray(b"".join(made))
    data[at[2] + len(made[2]) // 2] ^= 0xFF  # a flipped byte inside the third record
    found = list(warc.salvage(bytes(data)))
    assert [x[0] for x in found] == ["record", "record", "gap", "record", "record", "record"]
    assert found[2][1:3] == (at[2], at[3])
    cut = bytes(data[:at[5] + 30])  # the last record is cut short
    assert [x[0] for x in warc.salvage(cut)] == ["record", "record", "gap", "record", "record", "gap"]
    junk = b"junk" + b"".join(made[:2])
    assert [x[:3] for x in warc.salvage(junk)][0] == ("gap", 0, 4)
    assert list(warc.salvage(b"")) == []
    assert [x[0] for x in warc.salvage(b"nothing here")] == ["gap"]
    good = [(x[1], x[2]) for x in found]
    assert all(a[1] <= b[0] for a, b in zip(good, good[1:]))  # every byte is told once


def test_read_tells_gaps(spark, tmp_path):
    made = records(4)
    (tmp_path / "x.warc").write_bytes(made[0] + made[1][:-40] + made[2] + made[3])
    rows = warc.read_warc(spark, str(tmp_path)).collect()
    assert sorted((r.kind, r.page_id) for r in rows if r.kind == "record") == [("record", 0), ("record", 2), ("record", 3)]
    gap = next(r for r in rows if r.kind == "gap")
    assert (gap.start_byte, gap.end_byte) == (len(made[0]), len(made[0]) + len(made[1]) - 40) and gap.reason


def hf_ids(text):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(vocabulary().tokenizer).encode(text or "", add_special_tokens=False).ids + [0]


def test_packing(spark):
    rng = random.Random(5)
    words = ["the", "The", "naïve", "x1", "don't", "über", "..", "a-b", "日本"]
    texts = [None, "", " ", " a", "a ", "a  b\n\nc", "a\tb c", "<|endoftext|> a", "\n", "a\r\nb \n c"]
    texts += [" ".join(rng.choices(words, k=rng.choice([1, 5, 40, 300]))) for _ in range(150)]
    texts += [" ".join(rng.choices(words, k=5000)), " ".join(["the"] * 2047), " ".join(["the"] * 4095)]
    df = docs_of(spark, texts).withColumn("length", F.lit("x")).withColumn("sequence_id", F.lit("x"))
    rows = pack_documents(df, vocabulary(), with_ids=True).collect()
    held, by = defaultdict(list), defaultdict(list)
    for r in rows:
        held[r.doc_id].append(r)
        by[r.sequence_id].append((r.offset, r.length))
    for i, text in enumerate(texts):
        ids, at = hf_ids(text), 0
        for k, r in enumerate(sorted(held[i], key=lambda r: r.piece)):
            body = np.asarray(ids[at:at + r.length], "<u4").tobytes()
            assert (r.piece, r.start, r.ids_crc32, bytes(r.ids)) == (k, at, zlib.crc32(body), body)
            assert r.length == 2048 or k == 0
            at += r.length
        assert at == len(ids) and len(held[i]) == -(-len(ids) // 2048)
    total = sum(r.length for r in rows)
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by) <= -(-total // 2048) + 2
    assert pack_documents(docs_of(spark, []), vocabulary()).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    sizes = [rng.integers(1, 65, 500), np.minimum(64, rng.lognormal(2.5, 1, 3000).astype(int) + 1), np.full(40, 33), np.array([64, 63, 1, 1]),
             rng.choice([20, 21, 22, 23], 300), np.array([], int)][seed]
    histogram = Counter(sizes.tolist())
    plan = plan_sequences(histogram, 64)
    used = Counter()
    for p in plan:
        assert p.count > 0 and sum(p.lengths) <= 64
        for x in p.lengths:
            used[x] += p.count
    assert used == histogram
    if seed == 1:
        assert sum(p.count for p in plan) <= -(-int(sizes.sum()) // 64) + 1


def test_complements_of_one_two_and_three():
    assert [p.lengths for p in plan_sequences({60: 1, 40: 1}, 100)] == [(60, 40)]
    assert [p.lengths for p in plan_sequences({50: 1, 30: 1, 20: 1}, 100)] == [(50, 30, 20)]
    assert [p.lengths for p in plan_sequences({40: 1, 30: 1, 20: 1, 10: 1}, 100)] == [(40, 30, 20, 10)]
    assert [p.lengths for p in plan_sequences({25: 4}, 100)] == [(25, 25, 25, 25)]


def test_salvage_inside_a_member():
    made = records(6)
    bad = bytearray(made[2])
    bad[-10] ^= 1
    whole = warc._gzip(made[0] + made[1] + bytes(bad) + made[3])
    found = list(warc.salvage(whole + warc._gzip(made[4])))
    assert [x[0] for x in found] == ["record", "record", "gap", "record", "record"] and "unpacked bytes" in found[2][3]
    noise = [warc.record_bytes(i, "http://x/", p, base64.b32encode(hashlib.sha1(p).digest()).decode()) for i, p in enumerate(random.Random(k).randbytes(40_000) for k in range(4))]
    cut = warc._gzip(b"".join(noise))[:100_000]
    found = list(warc.salvage(cut + warc._gzip(made[4])))
    assert [x[0] for x in found] == ["record", "record", "gap", "record"]
