"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WHITE = "[\\x20\\x09-\\x0D]+"  # the white space of all contracts: space, tab, line ends

SLICE_BYTES = 2 << 20


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a text column holds about `limit` bytes; a longer single text stays whole."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        sizes = np.cumsum(pc.binary_length(batch.column(at)).fill_null(0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = sizes[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(sizes, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def utf8_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each text starts and ends; null counts as empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]] if len(offsets) else data[:0], offsets - offsets[0] if len(offsets) else np.zeros(1, np.int64)


_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: nearby inputs get unrelated outputs."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX2
    return x ^ (x >> np.uint64(31))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words `[^\\x20\\x09-\\x0D]+` (A-Z lower-cased) of all texts, and each text's number of words.
    """
    n = len(data)
    counts = np.zeros(len(offsets) - 1, np.int64)
    if n == 0:
        return np.zeros(0, np.uint64), counts
    word = ~_SPACE[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    cuts = offsets[(offsets > 0) & (offsets < n)]
    first[cuts] = word[cuts]
    last = word.copy()
    last[:-1] &= ~word[1:]
    last[cuts - 1] = word[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    counts = np.searchsorted(starts, offsets[1:]) - np.searchsorted(starts, offsets[:-1])
    if len(starts) == 0:
        return np.zeros(0, np.uint64), counts
    return span_hashes(_LOWER[data], starts, ends), counts


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, by Horner's rule over all spans side by side, position by position: spans are short."""
    length = ends - starts
    hashes = np.zeros(len(starts), np.uint64)
    alive = np.flatnonzero(length > 0)
    for k in range(int(length.max(initial=0))):
        if k == 64:  # the few very long spans, one by one
            for i in alive[length[alive] > k]:
                h = int(hashes[i])
                for b in data[starts[i] + 64:ends[i]].tolist():
                    h = (h * 0x9E3779B97F4A7C15 + b + 1) & 0xFFFFFFFFFFFFFFFF
                hashes[i] = h
            break
        if k:
            alive = alive[length[alive] > k]
        hashes[alive] = hashes[alive] * _ODD + data[starts[alive] + k] + np.uint64(1)
    return mix(hashes + length.astype(np.uint64) * _MIX2)


def shingle_hashes(words: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the `size`-word shingles of each text, and their number; a shorter text is one shingle, an empty one none."""
    ends = np.cumsum(counts)
    begins = ends - counts
    made = np.where(counts == 0, 0, np.maximum(counts - size + 1, 1))
    total = int(made.sum())
    shift = np.cumsum(made) - made
    at = np.arange(total) - np.repeat(shift - begins, made)
    stop = np.repeat(ends, made)
    out = np.repeat(np.minimum(counts, size).astype(np.uint64), made)
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    for k in range(size):
        part = padded[at + k]
        part[at + k >= stop] = 0
        out = (out + part) * _ODD
        out ^= out >> np.uint64(29)
    return mix(out), made


def gapless_rank(df: DataFrame, groups: list[str], order: list[str], name: str, rows: int, per_bucket: int = 1000) -> DataFrame:
    """Number the rows of each group from 0 without gaps, in tasks of bounded size.

    Rows of a group are dealt into hash buckets of about `per_bucket` rows, as many as the whole table (`rows`) would
    need, so a group that holds most rows is split like any other. A row's number is its place in its bucket plus the
    rows of the group's earlier buckets; only the bucket counts meet in one place.
    """
    buckets = max(1, ceil(rows / per_bucket))
    keyed = df.withColumn("_bucket", F.pmod(F.xxhash64(*order, F.lit(17)), F.lit(buckets)))
    keys = [*groups, "_bucket"]
    counts = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(*keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    ranked = keyed.withColumn("_place", place)
    base = base.select(*[F.col(k).alias(f"_g{i}") for i, k in enumerate(keys)], "_base")
    same = [F.col(k).eqNullSafe(F.col(f"_g{i}")) for i, k in enumerate(keys)]
    joined = ranked.join(base, same, "inner").withColumn(name, (F.col("_base") + F.col("_place") - 1).cast("long"))
    return joined.drop("_bucket", "_place", "_base", *[f"_g{i}" for i in range(len(keys))])
