"""Alignment of two tokenizers over a corpus, scored through inverted pair bitmaps.

Both cut a text into tokens; tokens whose bytes overlap are linked. A pair of ids (A, B) is posted, per block of documents,
as a compressed bitmap of the documents that hold it linked, with further bitmaps (planes) for the bits of how often they
do. Popcounts give the pairs' document and link counts, and the postings take the counts back to the documents.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import slices, text_or_empty
from riskloom.session import materialize

#: A block of postings ends after so many documents or bytes of text. Places in a block take 16 bits.
BLOCK_ROWS, BLOCK_BYTES = 1 << 14, 16 << 20
#: A task remembers the alignment of so many different words.
CACHE_WORDS = 200_000

# Texts with white space other than single spaces and line ends inside are aligned whole, not word by word.
_ODD = re.compile(r"[^\S \n]|  | \n|\n |^ | $|[\x1c-\x1f\x85]")


class Tokenizers(NamedTuple):
    """A byte-level tokenizer file (A), the same vocabulary as ranks, the pattern that cuts words, and a piece model (B)."""

    tokenizer: str
    ranks: str
    pattern: str
    pieces: str


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    size = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter((i for x in lists for i in x), np.int64, int(size.sum())), size


def _gathered(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Positions of spans, one span after the other."""
    stop = np.cumsum(size)
    return np.arange(int(stop[-1]) if len(stop) else 0) + np.repeat(start - (stop - size), size)


class Aligned(NamedTuple):
    """Alignments of some strings: whether both tokenizers give back its bytes, sizes, linked pairs, groups as text."""

    ok: np.ndarray
    a: np.ndarray
    b: np.ndarray
    groups: np.ndarray
    links: np.ndarray
    pairs: np.ndarray  # A id << 16 | B id, in order
    texts: list[str]


class Aligner:
    """The two tokenizers, and the bytes of their tokens.

    Neither joins a single space to what stands before it (no token has a space behind another character), so a text may
    be cut before each single space, and both cut there. What is known of a word is kept for later texts.
    """

    def __init__(self, files: Tokenizers):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.whole_a = Tokenizer.from_file(files.tokenizer)
        self.whole_a.encode_special_tokens = True  # their strings in a text are ordinary text
        with open(files.ranks, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.words_a = tiktoken.Encoding("words", pat_str=files.pattern, mergeable_ranks=ranks, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=files.pieces)
        self.bytes_a = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_a[rank] = token
        self.bytes_b = [
            bytes([int(self.pieces.id_to_piece(i)[3:5], 16)]) if self.pieces.is_byte(i)
            else self.pieces.id_to_piece(i).replace("▁", " ").encode() for i in range(self.pieces.get_piece_size())]
        self.length_a, self.length_b = (np.array([len(t) for t in x], np.int64) for x in (self.bytes_a, self.bytes_b))
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        none = np.zeros(0, np.int64)
        self.known = Aligned(np.zeros(0, bool), none, none, none, none, none, [])
        self.start = none

    def align(self, strings: list[str], ids_a: list[list[int]], ids_b: list[list[int]]) -> Aligned:
        """Strings (each with its leading space) and their ids in both."""
        ok = np.array([
            b"".join([self.bytes_a[i] for i in x]) == b"".join([self.bytes_b[i] for i in y]) == s.encode()
            for s, x, y in zip(strings, ids_a, ids_b)], bool)
        a, size_a = _flat([x if k else [] for x, k in zip(ids_a, ok)])
        b, size_b = _flat([y if k else [] for y, k in zip(ids_b, ok)])
        # all strings stand side by side; the ends of both kinds of tokens cut them into stretches, each in one A and one B token
        end_a, end_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        ends = np.union1d(end_a, end_b)
        at_a, at_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        shared = np.intersect1d(end_a, end_b, assume_unique=True)
        size = np.cumsum(np.array([len(s.encode()) if k else 0 for s, k in zip(strings, ok)], np.int64))
        links, groups = (np.diff(np.searchsorted(x, size, side="right"), prepend=0) for x in (ends, shared))
        stop_a, stop_b = (np.searchsorted(x, shared, side="right").tolist() for x in (end_a, end_b))
        names_a, names_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
        parts, i, j = [], 0, 0
        for p, q in zip(stop_a, stop_b):
            parts.append(f"{names_a[i]}|{names_b[j]}" if p == i + 1 and q == j + 1 else f"{','.join(names_a[i:p])}|{','.join(names_b[j:q])}")
            i, j = p, q
        cut = np.concatenate([[0], np.cumsum(groups)]).tolist()
        texts = [";".join(parts[cut[k]:cut[k + 1]]) for k in range(len(strings))]
        return Aligned(ok, size_a, size_b, groups, links, a[at_a] << 16 | b[at_b], texts)

    def _learn(self, words: list[str]) -> None:
        fresh = self.align(words, [self.words_a.encode_ordinary(w) for w in words], self.pieces.encode([w[1:] for w in words], num_threads=1))
        old = self.known
        self.known = Aligned(*[np.concatenate([x, y]) for x, y in zip(old[:6], fresh[:6])], old.texts + fresh.texts)
        self.start = np.cumsum(self.known.links) - self.known.links
        for w in words:
            self.number[w] = len(self.number)

    def by_words(self, texts: list[str]) -> Aligned:
        """Alignments of texts whose white space is single spaces and line ends inside; the sizes and pairs of all their words."""
        cut = [(" " + t).split(" ")[1:] for t in texts]
        words = [[" " + w for w in text] for text in cut]
        if len(self.number) > CACHE_WORDS:
            self.forget()
        new = list(dict.fromkeys(w for text in words for w in text if w not in self.number))
        if new:
            self._learn(new)
        size = np.fromiter(map(len, words), np.int64, len(words))
        at = np.fromiter((self.number[w] for text in words for w in text), np.int64, int(size.sum()))
        begin = np.cumsum(size) - size
        whole = np.add.reduceat(self.known.ok[at], begin) == size if len(at) else np.zeros(0, bool)
        at = at[np.repeat(whole, size)]  # a text with a word that either changes has no tokens
        size = np.where(whole, size, 0)
        edge = np.concatenate([[0], np.cumsum(size)])
        sums = [np.diff(np.concatenate([[0], np.cumsum(x[at])])[edge]) for x in (self.known.a, self.known.b, self.known.groups, self.known.links)]
        pairs = self.known.pairs[_gathered(self.start[at], self.known.links[at])]
        place, known = at.tolist(), self.known.texts
        joined = [";".join([known[i] for i in place[edge[k]:edge[k + 1]]]) for k in range(len(texts))]
        return Aligned(whole, *sums, pairs, joined)

    def whole(self, texts: list[str]) -> Aligned:
        ids_a = [x.ids for x in self.whole_a.encode_batch([" " + t for t in texts], add_special_tokens=False)]
        return self.align([" " + t for t in texts], ids_a, self.pieces.encode(texts, num_threads=1))


_ALIGNERS: dict[Tokenizers, Aligner] = {}


def _aligner(files: Tokenizers) -> Aligner:
    """One per worker process."""
    if files not in _ALIGNERS:
        _ALIGNERS[files] = Aligner(files)
    return _ALIGNERS[files]


def _containers(block: int, plane: int, pairs: np.ndarray, places: np.ndarray, rows: int) -> Iterator[pa.RecordBatch]:
    """Postings ordered by pair, then place: per pair a list of 16-bit places, or a bitmap where that is smaller."""
    first = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]])) if len(pairs) else np.zeros(0, np.int64)
    size = np.diff(np.append(first, len(pairs)))
    width = (rows + 7) // 8
    dense = 2 * size > width
    for as_bits in (False, True):
        chosen = np.flatnonzero(dense == as_bits)
        for part in np.array_split(chosen, max(1, -(-len(chosen) // (512 if as_bits else 50_000)))):
            if not len(part):
                continue
            held = places[_gathered(first[part], size[part])]
            if as_bits:
                bits = np.zeros((len(part), 8 * width), bool)
                bits[np.repeat(np.arange(len(part)), size[part]), held] = True
                body, width_of = np.packbits(bits, axis=1, bitorder="little").tobytes(), np.full(len(part), width)
            else:
                body, width_of = held.astype("<u2").tobytes(), 2 * size[part]
            cuts = np.concatenate([[0], np.cumsum(width_of)]).astype(np.int32)
            docs = pa.BinaryArray.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(cuts.tobytes()), pa.py_buffer(body)])
            yield _row(block, plane, pa.array(pairs[first[part]].astype(np.int64)), as_bits, docs)


def _row(block: int, plane: int, pairs: pa.Array, dense: bool, docs: pa.Array) -> pa.RecordBatch:
    n = len(docs)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, block)), pa.array(np.full(n, plane, np.int32)), pairs, pa.array(np.full(n, dense)), docs],
        names=["block", "plane", "pair", "dense", "docs"])


_DOCS = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
                   ("groups_sha256", pa.string()), ("groups", pa.string())])


class _Block:
    """What the documents of a block give, until it is inverted."""

    def __init__(self, number: int, with_groups: bool):
        self.number, self.with_groups = number, with_groups
        self.rows, self.bytes, self.keys, self.times, self.docs = 0, 0, [], [], []

    def add(self, ids: pa.Array, found: Aligned, size: int) -> None:
        links = pa.array(found.links)
        hashed = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in found.texts]
        groups = found.texts if self.with_groups else [None] * len(hashed)
        self.docs.append(pa.RecordBatch.from_arrays(
            [ids, *map(pa.array, (found.a, found.b, found.groups)), links, pa.array(hashed, pa.string()), pa.array(groups, pa.string())], schema=_DOCS))
        place = np.repeat(np.arange(self.rows, self.rows + len(ids), dtype=np.uint64), found.links)
        keys, times = np.unique(found.pairs.astype(np.uint64) << np.uint64(16) | place, return_counts=True)
        self.keys.append(keys)
        self.times.append(times.astype(np.uint32))
        self.rows += len(ids)
        self.bytes += size

    def inverted(self) -> Iterator[pa.RecordBatch]:
        """The block's documents in one row of plane -1, then its postings, plane by plane."""
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, _DOCS) as out:
            for batch in self.docs:
                out.write_batch(batch)
        yield _row(self.number, -1, pa.nulls(1, pa.int64()), False, pa.array([sink.getvalue().to_pybytes()], pa.binary()))
        keys = np.concatenate(self.keys)
        order = np.argsort(keys, kind="stable")
        keys, more = keys[order], np.concatenate(self.times)[order] - 1
        self.keys, self.times = [], []
        pairs, places = keys >> np.uint64(16), (keys & np.uint64(0xFFFF)).astype(np.uint16)
        plane, bits = 0, np.ones(len(keys), bool)
        while len(keys):
            yield from _containers(self.number, plane, pairs[bits], places[bits], self.rows)
            if not (more >> plane).any():
                break
            bits = (more >> plane) & 1 == 1
            plane += 1


_POSTINGS = "block long, plane int, pair long, dense boolean, docs binary"


def pair_bitmaps(docs: DataFrame, files: Tokenizers, key: str = "doc_id", text: str = "text", with_groups: bool = False) -> DataFrame:
    """Postings (block, plane, pair, dense, docs): plane 0 has the documents that hold the pair linked, plane j > 0 those
    in whose number of further links bit j - 1 is set. One row of a block, of plane -1, holds its documents."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(files)
        number = TaskContext.get().partitionId() << 32
        block = _Block(number, with_groups)
        for batch in slices(batches, "text"):
            texts = batch.column(1).to_pylist()
            odd = np.array([bool(_ODD.search(t)) for t in texts], bool)
            for whole in (False, True):
                chosen = np.flatnonzero(odd == whole)
                if not len(chosen):
                    continue
                picked = [texts[i] for i in chosen.tolist()]
                ids = batch.column(0).take(pa.array(chosen))
                size = sum(map(len, picked))
                # an empty text is all space and no token
                found = aligner.whole(picked) if whole else aligner.by_words(picked)
                for begin in range(0, len(picked), BLOCK_ROWS - 1):
                    part = slice(begin, begin + BLOCK_ROWS - 1)
                    edge = np.concatenate([[0], np.cumsum(found.links)])
                    cut = found.pairs[edge[begin]:edge[min(part.stop, len(picked))]]
                    if block.rows and (block.rows + len(picked[part]) > BLOCK_ROWS or block.bytes + size > BLOCK_BYTES):
                        yield from block.inverted()
                        number += 1
                        block = _Block(number, with_groups)
                    block.add(ids[part], Aligned(*[x[part] for x in found[:5]], cut, found.texts[part]), size)
        aligner.forget()  # later stages run in the same workers
        if block.rows:
            yield from block.inverted()

    source = docs.select(F.col(key).cast("long").alias("doc_id"), text_or_empty(F.col(text)).alias("text"))
    return source.mapInArrow(rows, _POSTINGS)


def pair_counts(postings: DataFrame) -> DataFrame:
    """pair, documents, links, best (no pair of its A id is in more documents). Blocks share no document, so the bitmaps
    of a pair are merged by laying them side by side, and their popcounts add up; partly before the shuffle."""
    set_bits = F.when(F.col("dense"), F.bitmap_count("docs")).otherwise(F.expr("octet_length(docs) div 2"))
    weight = F.expr("CASE WHEN plane = 0 THEN 1L ELSE shiftleft(1L, plane - 1) END")
    counted = materialize(postings.where("plane >= 0").groupBy("pair").agg(
        F.sum(F.when(F.col("plane") == 0, set_bits)).alias("documents"), F.sum(set_bits * weight).alias("links")), "pair-counts")
    most = counted.groupBy(F.expr("shiftright(pair, 16)").alias("a")).agg(F.max("documents").alias("most"))
    joined = counted.join(most, F.expr("shiftright(pair, 16)") == F.col("a"))
    return joined.select("pair", "documents", "links", (F.col("documents") == F.col("most")).alias("best"))


def _scores(postings: pa.Table, counts: pa.Table, with_groups: bool) -> pa.Table:
    """The documents of one block, with the sums that its postings hand them."""
    plane = postings.column("plane").to_numpy()
    stream = postings.column("docs")[int(np.flatnonzero(plane == -1)[0])].as_py()
    docs = pa.ipc.open_stream(pa.py_buffer(stream)).read_all()
    pairs = counts.column("posted").to_numpy()
    order = np.argsort(pairs)
    pairs, documents, best = (counts.column(c).to_numpy(zero_copy_only=False)[order] for c in ("posted", "documents", "best"))
    total, chosen = np.zeros(len(docs), np.int64), np.zeros(len(docs), np.int64)
    for dense in (False, True):
        some = postings.filter(pa.array((plane >= 0) & (postings.column("dense").to_numpy(zero_copy_only=False) == dense)))
        for batch in some.to_batches(max_chunksize=64 if dense else 20_000):
            weight = np.left_shift(1, np.maximum(batch.column("plane").to_numpy().astype(np.int64) - 1, 0))
            at = np.searchsorted(pairs, batch.column("pair").to_numpy())
            bodies = batch.column("docs").to_pylist()
            if dense:
                owner, place = np.nonzero(np.unpackbits(np.frombuffer(b"".join(bodies), np.uint8).reshape(len(bodies), -1), axis=1, bitorder="little"))
            else:
                owner = np.repeat(np.arange(len(bodies)), [len(x) // 2 for x in bodies])
                place = np.frombuffer(b"".join(bodies), "<u2").astype(np.int64)
            np.add.at(total, place, (weight * documents[at])[owner])
            np.add.at(chosen, place, (weight * best[at])[owner])
    out = docs.append_column("n_best", pa.array(chosen)).append_column("count_sum", pa.array(total))
    return out if with_groups else out.drop_columns(["groups"])


def align_tokenizers(docs: DataFrame, files: Tokenizers, key: str = "doc_id", text: str = "text", with_groups: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_a, n_b, n_groups, n_links, groups_sha256 (, groups), n_best, count_sum.

    A encodes a space and the text, B the text, to which it adds the space. Groups are the stretches between offsets
    where tokens of both end, written `a1,a2|b1;a3|b2`; links are the overlapping pairs of tokens. A pair's count is the
    number of rows of the table that hold it linked; `count_sum` adds it up over a row's links, `n_best` counts the links
    whose count is the highest of their A id, ties included.

    Texts are tokenized once. Their postings, blocks of at most BLOCK_ROWS rows and BLOCK_BYTES bytes (or one longer
    text), are written to the shared folder. Pair and block numbers meet the counts in a join that adaptive execution can
    split, since counts are unique per pair and written first; then each block is scored by itself. No task holds more
    than a block, whatever pair or source is frequent.

    Null and empty texts, and texts whose joined bytes in A or B differ from the space and the text (those with U+2581),
    have no tokens: zeros and an empty digest. Rows with a null id keep it and count as documents, as do repeated rows.
    An empty table gives no rows. Other columns are not read.
    """
    postings = materialize(pair_bitmaps(docs, files, key, text, with_groups), "pair-bitmaps")
    counts = materialize(pair_counts(postings), "pair-scores")
    posted = postings.where("plane = 0").select(F.col("block").alias("of"), F.col("pair").alias("posted"))
    asked = posted.join(counts, F.col("posted") == F.col("pair")).select("of", "posted", "documents", "best")
    names = ["doc_id long", "n_a long", "n_b long", "n_groups long", "n_links long", "groups_sha256 string", *["groups string"] * with_groups,
             "n_best long", "count_sum long"]
    return postings.groupBy("block").cogroup(asked.groupBy("of")).applyInArrow(
        lambda left, right: _scores(left, right, with_groups), ", ".join(names))
