"""Language of texts by prediction by partial matching: per language a frozen tree of byte contexts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import slices, text_or_empty, utf8_bytes
from riskloom.session import materialize

#: Bytes of context.
ORDER = 4
#: About so many bytes of text are learned per language, from rows picked by a hash of the id; longer texts are not learned from.
SAMPLE_BYTES = 4 << 20
#: A worker remembers the costs of so many different strings of ORDER + 1 bytes.
CACHE_GRAMS = 1_500_000
CHUNK = 1 << 20
UNKNOWN = "und"


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(True))


def _grams(texts: pa.Array, order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pieces of (text number, string): every byte of the texts behind the `order` bytes before it, zeros before the start."""
    data, offsets = utf8_bytes(texts)
    for begin in range(0, len(data), CHUNK):
        end = min(begin + CHUNK, len(data))
        owner = np.searchsorted(offsets, np.arange(begin, end), side="right") - 1 if len(offsets) < 64 else np.repeat(
            np.arange(len(offsets) - 1), np.minimum(np.maximum(offsets[1:], begin), end) - np.minimum(np.maximum(offsets[:-1], begin), end))
        inside = np.arange(begin, end) - offsets[owner]
        grams = data[begin:end].astype(np.uint64)
        for back in range(1, order + 1):
            before = np.zeros(end - begin, np.uint64)
            from_ = max(begin - back, 0)
            part = data[from_:end - back]
            before[end - begin - len(part):] = part
            before[inside < back] = 0
            grams |= before << np.uint64(8 * back)
        yield owner, grams


@dataclass(frozen=True)
class _Order:
    """Contexts of one length: their counts, and per context what is left out after an escape from it to the next shorter one."""

    symbols: np.ndarray  # context and next byte, ascending
    seen: np.ndarray
    contexts: np.ndarray  # ascending
    total: np.ndarray
    kinds: np.ndarray
    left_out: np.ndarray


def _tree(grams: np.ndarray, counts: np.ndarray, order: int) -> list[_Order]:
    """The contexts of 0 to `order` bytes from the counts of the longest; a context's bytes also follow its shorter ones."""
    orders: list[_Order] = []
    tables = []
    for length in range(order, -1, -1):
        symbols, back = np.unique(grams & np.uint64((1 << 8 * (length + 1)) - 1), return_inverse=True)
        tables.append((length, symbols, np.bincount(back, counts, len(symbols)).astype(np.int64)))
    for length, symbols, seen in reversed(tables):
        context = symbols >> np.uint64(8)
        contexts, first, kinds = np.unique(context, return_index=True, return_counts=True)
        total = np.add.reduceat(seen, first) if len(first) else np.zeros(0, np.int64)
        if length:  # counts, in the shorter context, of the bytes that follow the longer one
            shorter = orders[-1]
            spot = np.searchsorted(shorter.symbols, symbols & np.uint64((1 << 8 * length) - 1))
            left_out = np.add.reduceat(shorter.seen[spot], first) if len(first) else np.zeros(0, np.int64)
        else:
            left_out = np.zeros(len(contexts), np.int64)
        orders.append(_Order(symbols, seen, contexts, total, kinds.astype(np.int64), left_out))
    return orders


def _spot(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def code_lengths(tree: list[_Order], grams: np.ndarray) -> np.ndarray:
    """Bits for the last byte of each string behind the others.

    The longest known context codes the byte if it has seen it, with its count against the total and the number of
    different bytes, which is the weight of the escape. After an escape the next shorter context codes it, without the
    bytes that the longer one would have coded. Last come the bytes never seen, all alike.
    """
    bits = np.zeros(len(grams))
    open_ = np.arange(len(grams))  # not coded yet
    gone, gone_kinds = np.zeros(len(grams), np.int64), np.zeros(len(grams), np.int64)
    for length in range(len(tree) - 1, -1, -1):
        order = tree[length]
        symbol = grams[open_] & np.uint64((1 << 8 * (length + 1)) - 1)
        node, known = _spot(order.contexts, symbol >> np.uint64(8))
        at, coded = _spot(order.symbols, symbol)
        here, node = open_[known], node[known]
        escape = order.kinds[node] - gone_kinds[here]
        whole = order.total[node] - gone[here] + escape
        weight = np.where(coded[known], order.seen[at[known]], escape) if len(order.seen) else escape
        paid = whole > 0  # where all its bytes are left out, a context is passed without cost
        bits[here[paid]] += np.log2(whole[paid] / weight[paid])
        gone[here], gone_kinds[here] = order.left_out[node], order.kinds[node]
        open_ = open_[~coded]
    bits[open_] += np.log2(np.maximum(256 - gone_kinds[open_], 1))
    return bits


@dataclass
class LanguageModel:
    """The trees of all languages; the costs of strings met before are remembered per worker."""

    names: list[str]
    trees: list[list[_Order]]
    order: int
    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    costs: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))

    def _costs(self, grams: np.ndarray) -> np.ndarray:
        """Bits of ascending different strings, one column per language."""
        at, known = _spot(self.keys, grams)
        new = grams[~known]
        if not len(new):
            return self.costs[at]
        if len(self.keys) + len(new) > CACHE_GRAMS:
            self.keys, at, known, new = np.zeros(0, np.uint64), at[:0], np.zeros(len(grams), bool), grams
        fresh = np.stack([code_lengths(t, new) for t in self.trees], axis=1)
        if not len(self.keys):
            self.keys, self.costs = new, fresh
            return fresh
        spot = np.searchsorted(self.keys, new)
        self.keys, self.costs = np.insert(self.keys, spot, new), np.insert(self.costs, spot, fresh, axis=0)
        return self.costs[np.searchsorted(self.keys, grams)]

    def bits(self, texts: pa.Array) -> np.ndarray:
        """Code lengths of whole texts, one column per language."""
        out = np.zeros((len(texts), len(self.names)))
        for owner, grams in _grams(texts, self.order):
            different, back = np.unique(grams, return_inverse=True)
            begin = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            out[owner[begin]] += np.add.reduceat(self._costs(different)[back], begin, axis=0)
        return out


def count_grams(rows: DataFrame, order: int = ORDER) -> DataFrame:
    """lang, gram, n: how often each string of `order` + 1 bytes occurs in the texts of a language. Counted per task first."""
    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            langs = batch.column(0).dictionary_encode()
            number = langs.indices.to_numpy()
            for owner, grams in _grams(batch.column(1), order):
                for i, lang in enumerate(langs.dictionary.to_pylist()):
                    found, n = np.unique(grams[number[owner] == i], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(found), pa.string()), pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])

    return rows.select("lang", "text").mapInArrow(strings, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit_languages(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample_bytes: int = SAMPLE_BYTES,
                  order: int = ORDER) -> LanguageModel:
    """Trees from the texts outside the held-out third that have a language.

    To the driver come the languages with their sizes, and the counts of at most about `sample_bytes` strings per
    language: the tasks need all of them. `order` is at most 7.
    """
    if not 0 <= order <= 7:
        raise ValueError("order is 0 to 7")
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    size = F.octet_length("text")
    rows = rows.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull() & (size <= sample_bytes) & (size > 0))
    share = {r["lang"]: sample_bytes / r["n"] for r in rows.groupBy("lang").agg(F.sum(size).alias("n")).collect()}
    if not share:
        return LanguageModel([], [], order)
    draw = F.pmod(F.xxhash64("doc_id", F.lit(13)), F.lit(1 << 30))
    limits = F.create_map(*[F.lit(x) for name, s in share.items() for x in (name, int(min(s, 1.0) * (1 << 30)))])
    sample = materialize(rows.where(draw < F.element_at(limits, F.col("lang"))).select("lang", "text"), "language-sample")
    found = count_grams(sample, order).toArrow()
    langs, grams, n = (found.column(c).to_numpy(zero_copy_only=False) for c in ("lang", "gram", "n"))
    names = sorted(set(langs.tolist()))
    trees = [_tree(np.ascontiguousarray(grams[langs == name]).view(np.uint64), n[langs == name], order) for name in names]
    return LanguageModel(names, trees, order)


def predict_languages(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample_bytes: int = SAMPLE_BYTES,
                      order: int = ORDER) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score, bits_per_byte (in the predicted language).

    The text's exact code length under each language's frozen tree decides; `score` is the share of the best among
    2^-bits of all, as equally frequent languages would have it. Every byte of every text counts. Texts are scored
    where they lie; the trees, whose size `sample_bytes` bounds, go to the tasks as a broadcast.

    Null text and text without a letter are `und` with score 0 (bits null). Equal lengths: the language first by name.
    Without a text to learn from, all are `und`; with one language only, that one scores 1. A null id counts as held
    out. Repeated rows are scored one by one; an empty table gives no rows. Other columns are not read.
    """
    model = fit_languages(docs, key, text, lang, sample_bytes, order)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in slices(batches, "text"):
            texts = batch.column(1)
            letters = np.array([next(filter(str.isalpha, t), None) is not None for t in texts.to_pylist()], bool)
            if not model.names:
                letters[:] = False
                bits = np.zeros((len(texts), 1))
            else:
                bits = model.bits(texts)
            best = bits.argmin(axis=1)
            least = bits.min(axis=1) if len(bits) else np.zeros(0)
            share = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1)
            size = np.maximum(np.diff(utf8_bytes(texts)[1]), 1)
            names = [model.names[i] if ok else UNKNOWN for i, ok in zip(best.tolist(), letters.tolist())]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(names, pa.string()), pa.array(np.where(letters, share, 0.0)),
                pa.array(least / size, mask=~letters)], names=["doc_id", "lang_pred", "score", "bits_per_byte"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), text_or_empty(F.col(text)).alias("text"))
    return rows.mapInArrow(score, "doc_id long, lang_pred string, score double, bits_per_byte double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "bits_per_byte")
