"""Packing documents into sequences of fixed token length by exact-complement hashing and best fit.

The plan is made on the histogram of piece lengths (at most one entry per length up to the sequence length), whatever
the number of pieces; pieces find their place by their rank among the pieces of their length.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import gapless_rank, slices, span_hashes, text_or_empty, utf8_bytes
from riskloom.session import materialize

CACHE_WORDS = 3_000_000
# White space other than single spaces and line ends, and strings that may be special tokens: such texts are encoded whole.
_ODD = re.compile(r"[^\S \n]|  | \n|\n |^ | $|[\x1c-\x1f\x85]|<\|")


class WordTokens:
    """Token ids of whole texts, word by word.

    The tokenizer never joins a single space to what stands before it, so a text may be cut before each single space.
    The different words of a batch are found by 64-bit hashes and encoded once per worker, by a faster library with the
    same vocabulary; ids of whole texts are then gathered. Texts with other white space go to the tokenizer whole.
    """

    def __init__(self, tokenizer: str, ranks: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer)
        with open(ranks, "rb") as lines:
            known = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.words = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=known, special_tokens={})
        self.forget()

    def forget(self) -> None:
        self.keys, self.start = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.size, self.ids = np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        """Add ascending new keys and their words."""
        if len(self.keys) > CACHE_WORDS:
            self.forget()
        got = [self.words.encode_ordinary(w) for w in words]
        size = np.fromiter(map(len, got), np.int64, len(got))
        start = len(self.ids) + np.cumsum(size) - size
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(got), np.uint32, int(size.sum()))])
        at = np.searchsorted(self.keys, keys)
        self.keys, self.start, self.size = (np.insert(a, at, b) for a, b in ((self.keys, keys), (self.start, start), (self.size, size)))

    def _regular(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts that have single spaces only, and where each text's ids start and end."""
        spaces = np.flatnonzero(data == 0x20)
        nonempty = offsets[:-1][np.diff(offsets) > 0]
        starts = np.sort(np.concatenate([spaces, nonempty]))  # a word takes the space before it along
        ends = np.append(starts[1:], len(data))
        keys, first, back = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        spot = np.searchsorted(self.keys, keys)
        new = np.flatnonzero(self.keys[np.minimum(spot, len(self.keys) - 1)] != keys) if len(self.keys) else np.arange(len(keys))
        if len(new):
            plain = data.tobytes()
            before = len(self.keys)
            self._learn(keys[new], [plain[starts[i]:ends[i]].decode() for i in first[new]])
            if len(self.keys) < before + len(new):  # the cache was emptied on the way
                return self._regular(data, offsets)
            spot = np.searchsorted(self.keys, keys)
        size = self.size[spot][back]
        stop = np.cumsum(size)
        total = int(stop[-1]) if len(stop) else 0
        ids = self.ids[np.arange(total) + np.repeat(self.start[spot][back] - (stop - size), size)]
        return ids, np.concatenate([[0], stop])[np.searchsorted(starts, offsets)]

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        odd = [bool(_ODD.search(t)) for t in self._suspects(texts)]
        whole = np.zeros(len(texts), bool)
        whole[self._suspect] = odd
        data, offsets = utf8_bytes(texts.filter(pa.array(~whole)))
        ids, at = self._regular(data, offsets) if len(offsets) > 1 else (np.zeros(0, np.uint32), np.zeros(1, np.int64))
        k = 0
        for i in range(len(texts)):
            if whole[i]:
                yield np.asarray(self.tokenizer.encode(texts[i].as_py() or "", add_special_tokens=False).ids, np.uint32)
            else:
                yield ids[at[k]:at[k + 1]]
                k += 1

    def _suspects(self, texts: pa.Array) -> list[str]:
        """Texts with bytes that odd white space may consist of; the others need no closer look."""
        data, offsets = utf8_bytes(texts)
        rare = _RARE[data]
        space = (data == 0x20) | (data == 0x0A)
        pair = np.zeros(len(data), bool)
        pair[:-1] = space[:-1] & space[1:] & ~((data[:-1] == 0x0A) & (data[1:] == 0x0A))
        hits = np.concatenate([[0], np.cumsum(rare | pair)])
        some = np.diff(offsets) > 0
        edge = np.zeros(len(offsets) - 1, bool)
        edge[some] = (data[offsets[:-1][some]] == 0x20) | (data[offsets[1:][some] - 1] == 0x20)
        self._suspect = np.flatnonzero((hits[offsets[1:]] > hits[offsets[:-1]]) | edge)
        return [texts[int(i)].as_py() or "" for i in self._suspect]


_RARE = np.zeros(256, bool)
_RARE[[0x09, 0x0B, 0x0C, 0x0D, *range(0x1C, 0x20), 0x3C, 0xC2, 0xE1, 0xE2, 0xE3]] = True
_TOKENS: dict[tuple, WordTokens] = {}


def _word_tokens(*paths: str) -> WordTokens:
    """One per worker process; what it has learned serves later tasks."""
    if paths not in _TOKENS:
        _TOKENS[paths] = WordTokens(*paths)
    return _TOKENS[paths]


class Vocabulary(NamedTuple):
    """A tokenizer file, the same vocabulary as ranks, and the pattern that cuts words."""

    tokenizer: str
    ranks: str
    pattern: str


def token_pieces(docs: DataFrame, vocabulary: Vocabulary, length: int = 2048, end_id: int = 0, key: str = "doc_id", text: str = "text",
                 with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and ids as bytes).

    A document is its token ids and `end_id`; a null or empty text is `end_id` alone. Only a document of more than
    `length` ids is cut: its last pieces are full, the first takes what is left over.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _word_tokens(*vocabulary)
        end = int(end_id).to_bytes(4, "little")
        for batch in slices(batches, "text"):
            out = {"doc_id": [], "piece": [], "start": [], "length": [], "ids_crc32": [], "ids": []}
            for key_, ids in zip(batch.column(0).to_pylist(), words.encode(batch.column(1))):
                ids = ids.astype("<u4").tobytes() + end
                n = len(ids) // 4
                at = [0, *range((n - 1) % length + 1, n, length), n]
                for i in range(len(at) - 1):
                    body = ids[4 * at[i]:4 * at[i + 1]]
                    for name, value in zip(out, (key_, i, at[i], at[i + 1] - at[i], zlib.crc32(body), body)):
                        out[name].append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            columns = {n: pa.array(v, k) for (n, v), k in zip(out.items(), kinds) if with_ids or n != "ids"}
            yield pa.RecordBatch.from_pydict(columns)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return docs.select(F.col(key).cast("long").alias("doc_id"), text_or_empty(F.col(text)).alias("text")).mapInArrow(cut, schema)


@dataclass(frozen=True)
class Pattern:
    """`count` sequences that all hold pieces of these lengths, in this order."""

    lengths: tuple[int, ...]
    count: int


def _complement(have: np.ndarray, gap: int) -> tuple[int, ...] | None:
    """One, two or three available lengths that add up to the gap; long ones first."""
    if have[gap] > 0:
        return (gap,)
    there = np.flatnonzero(have[1:gap] > 0) + 1  # lengths below the gap
    if not len(there):
        return None
    other = gap - there
    fits = (there >= other) & (have[other] > (there == other))
    if fits.any():
        a = int(there[fits][-1])
        return (a, gap - a)
    for a in there[::-1].tolist():
        rest = gap - a
        if 3 * a < gap:
            break
        b = there[(there <= a) & (there < rest)]
        c = rest - b
        ok = (b >= c) & (c > 0)
        b, c = b[ok], c[ok]
        need_b = 1 + (b == a)
        fits = (have[b] >= need_b) & (have[c] >= 1 + (c == b) + (c == a))
        if fits.any():
            b_ = int(b[fits][-1])
            return (a, b_, rest - b_)
    return None


def plan_sequences(histogram: dict[int, int], length: int) -> list[Pattern]:
    """Patterns that use every piece of the histogram once.

    From the longest down, a length looks in the index of single, pair and triple sums for lengths that fill its gap
    exactly, and as many sequences are made as the counts allow. What finds no complement is packed best fit: into the
    open sequences with the least room that still fits, else into new ones.
    """
    have = np.zeros(length + 1, np.int64)
    for size, n in histogram.items():
        have[size] += n
    patterns, rest = [], {}
    if have[length]:
        patterns.append(Pattern((length,), int(have[length])))
        have[length] = 0
    for size in range(length - 1, 0, -1):
        while have[size] > 0:
            have[size] -= 1  # its own copy is taken before the search
            fill = _complement(have, length - size)
            have[size] += 1
            if fill is None:
                rest[size] = int(have[size])
                have[size] = 0
                break
            whole = (size, *fill)
            kinds, times = np.unique(whole, return_counts=True)
            n = int((have[kinds] // times).min())
            have[kinds] -= times * n
            patterns.append(Pattern(tuple(sorted(whole, reverse=True)), n))
    room: dict[int, list[list]] = {}
    for size in sorted(rest, reverse=True):
        left = rest[size]
        while left:
            free = min((r for r, held in room.items() if r >= size and held), default=None)
            if free is None:
                group, free, most = (), length, left
            else:
                group, most = room[free].pop()
            each = min(free // size, left)
            n = min(most, left // each)
            if n < most and group:
                room[free].append([group, most - n])
            room.setdefault(free - each * size, []).append([group + (size,) * each, n])
            left -= each * n
    patterns += [Pattern(group, n) for held in room.values() for group, n in held]
    return patterns


def place_pieces(pieces: DataFrame, length: int = 2048) -> DataFrame:
    """The pieces with sequence_id and offset.

    To the driver comes the histogram (at most `length` rows), from it goes the plan (a few entries per length). Pieces
    of one length are interchangeable and are ranked in bounded tasks, so a length that most pieces have is split.
    """
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    segments: dict[int, list[tuple]] = {}
    used = dict.fromkeys(histogram, 0)
    first = 0
    for p in plan_sequences(histogram, length):
        starts = np.cumsum([0, *p.lengths[:-1]]).tolist()
        for size in dict.fromkeys(p.lengths):
            offsets = [s for s, x in zip(starts, p.lengths) if x == size]
            segments.setdefault(size, []).append((size, used[size], len(offsets), first, offsets))
            used[size] += len(offsets) * p.count
        first += p.count
    rows = [s for size in sorted(segments) for s in segments[size]]
    keys = np.array([(s[0] << 44) + s[1] for s in rows], np.int64)
    begin, width, base = (np.array([s[i] for s in rows], np.int64) for i in (1, 2, 3))
    table = np.array([o for s in rows for o in s[4]], np.int64)
    where = np.cumsum([0, *width[:-1]]) if len(rows) else width

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, rank = (batch.column(batch.schema.get_field_index(n)).to_numpy() for n in ("length", "_rank"))
            seg = np.searchsorted(keys, (size.astype(np.int64) << 44) + rank, side="right") - 1
            run, spot = np.divmod(rank - begin[seg], width[seg])
            kept = {f.name: batch.column(i) for i, f in enumerate(batch.schema) if f.name != "_rank"}
            yield pa.RecordBatch.from_pydict(kept | {"sequence_id": pa.array(base[seg] + run), "offset": pa.array(table[where[seg] + spot])})

    ranked = gapless_rank(pieces, ["length"], ["doc_id", "piece", "ids_crc32"], "_rank", sum(histogram.values()))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema]
    return ranked.mapInArrow(place, ", ".join([*fields, "sequence_id long", "offset long"]))


def pack_documents(docs: DataFrame, vocabulary: Vocabulary, length: int = 2048, end_id: int = 0, key: str = "doc_id",
                   text: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and the ids).

    Texts are tokenized once; the pieces are written to the shared folder before they are counted and placed. Repeated
    rows are packed like any others. An empty table gives no rows. Other columns are not read.
    """
    pieces = materialize(token_pieces(docs, vocabulary, length, end_id, key, text, with_ids), "pieces")
    return place_pieces(pieces, length)
