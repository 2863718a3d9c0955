"""n-grams of many rows at once, in numpy on Arrow batches.

Texts come with white space or blanks between the words; here the n-grams of a run of
rows become numbers, which are sorted and counted per row. A word is cut into
characters once per run, however often it occurs, and strings are made only once
per different n-gram of the run.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

RUN = 1 << 22  # characters or listed words that are counted together; a longer row is a run of its own
_WIDEST = 1 << 62
# White space as Unicode sees it (`text.SPACE`), by its length in UTF-8.
_SPACE_1 = np.isin(np.arange(256), [*range(9, 14), *range(28, 33)])
_SPACE_3 = np.array([0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])


@dataclass(frozen=True)
class Counts:
    """How often (`tf`) the n-gram `names[gram]` occurs in row `row`; each pair once, sorted by row, or by n-gram if so asked."""

    row: np.ndarray
    gram: np.ndarray
    tf: np.ndarray
    names: pa.Array


def _offsets(column: pa.Array) -> np.ndarray:
    if not len(column):
        return np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_list(column.type)
    found = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    return found[column.offset:column.offset + len(column) + 1].astype(np.int64)


def _numbered(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different codes, and of each code its place among them."""
    found = pa.array(codes).dictionary_encode()
    return found.dictionary.to_numpy(), found.indices.to_numpy().astype(np.int64)


def _tally(major: np.ndarray, minor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different pairs in order, and how often each occurs."""
    width = int(minor.max(initial=0)) + 1
    narrow = (int(major.max(initial=0)) + 1) * width < 1 << 32  # half as many bytes to sort
    keys = (major * width + minor).astype(np.uint32 if narrow else np.int64)
    keys.sort()
    at = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]]))
    times = np.diff(np.append(at, len(keys)))
    keys = keys[at]
    major = keys // keys.dtype.type(width)
    return major.astype(np.int64), (keys - major * keys.dtype.type(width)).astype(np.int64), times


def _counts(row: np.ndarray, gram: np.ndarray, names: pa.Array, by_gram: bool = False) -> Counts:
    if by_gram:
        gram, row, tf = _tally(gram, row)
    else:
        row, gram, tf = _tally(row, gram)
    return Counts(row, gram, tf, names)


def _blanked(column: pa.Array) -> pa.Array:
    """The texts with blanks for white space, one for each of its bytes."""
    at = _offsets(column)
    if at[-1] == at[0]:
        return column
    raw = np.frombuffer(column.buffers()[2], np.uint8)[at[0]:at[-1]].copy()
    raw[_SPACE_1[raw]] = 32
    first = np.flatnonzero(raw == 0xC2)
    first = first[np.isin(raw[first + 1], [0x85, 0xA0])]
    raw[first] = raw[first + 1] = 32
    first = np.flatnonzero((raw >= 0xE1) & (raw <= 0xE3))
    points = ((raw[first].astype(np.int32) & 15) << 12) | ((raw[first + 1].astype(np.int32) & 63) << 6) | (raw[first + 2] & 63)
    first = first[np.isin(points, _SPACE_3)]
    raw[first] = raw[first + 1] = raw[first + 2] = 32
    return pa.Array.from_buffers(pa.large_string(), len(column), [None, pa.py_buffer(at - at[0]), pa.py_buffer(raw)])


def _flat_words(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(row, word) of lists of words, or of the pieces of texts between blanks."""
    if not pa.types.is_nested(column.type):
        column = pc.split_pattern(column, " ")
    at = _offsets(column)
    return np.repeat(np.arange(len(column)), np.diff(at)), column.values.slice(at[0], at[-1] - at[0]).cast(pa.string())


def _char_grams(column: pa.Array, low: int, high: int) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(row, gram) of every place and the names of the grams, of texts that begin and end with a blank: n-grams that reach over no blank."""
    at = _offsets(column)
    raw = np.frombuffer(column.buffers()[2], np.uint8)[at[0]:at[-1]] if at[-1] > at[0] else np.zeros(0, np.uint8)
    before = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])  # characters before each byte
    starts = before[at - at[0]]
    points = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    row_of = np.repeat(np.arange(len(column)), np.diff(starts))
    letters, letter = _numbered(points)
    blank = points == 32
    rows, grams, names, have = [], [], [], 0
    code, radix = letter, max(1, len(letters))
    inside = np.zeros(len(points), bool)  # whether a blank lies strictly inside the n-gram that starts here
    for n in range(2, high + 1):
        if len(points) < n:
            break
        last = len(points) - n + 1
        if radix > _WIDEST // max(1, len(letters)):
            known, code = _numbered(code)
            radix = len(known)
        code = code[:last] * len(letters) + letter[n - 1:]
        radix *= max(1, len(letters))
        inside = inside[:last] | blank[n - 2:len(points) - 1] if n > 2 else inside[:last]
        if n < low:
            continue
        # two neighbouring blanks end one row and begin the next
        places = np.flatnonzero(~inside & (row_of[:last] == row_of[n - 1:]))
        if not len(places):
            continue
        _, gram = _numbered(code[places])
        count = int(gram.max()) + 1
        first = np.empty(count, np.int64)
        first[gram[::-1]] = places[::-1]
        text = points[first[:, None] + np.arange(n)].astype("<u4").tobytes().decode("utf-32-le")
        names.append(pa.array([text[i:i + n] for i in range(0, count * n, n)], pa.string()))
        rows.append(row_of[places])
        grams.append(gram + have)
        have += count
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), pa.array([], pa.string())
    return np.concatenate(rows), np.concatenate(grams), pa.concat_arrays(names)


@dataclass(frozen=True)
class _Places:
    """Word `word` stands in row `row`, at every place; the n-grams of word w are the next `sizes[w]` of `grams` from `starts[w]`."""

    row: np.ndarray
    word: np.ndarray
    sizes: np.ndarray
    starts: np.ndarray
    grams: np.ndarray
    names: pa.Array

    def repeated(self, row: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, gram) of all n-grams of words that stand in rows."""
        times = self.sizes[word]
        at = np.repeat(self.starts[word] - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))
        return np.repeat(row, times), self.grams[at]


def _char_places(column: pa.Array, low: int, high: int) -> _Places:
    """The words of texts, each different one cut into character n-grams once, with one blank around it."""
    row, flat = _flat_words(_blanked(column))
    there = pc.binary_length(flat).to_numpy() > 0
    found = flat.filter(pa.array(there)).dictionary_encode()
    of, grams, names = _char_grams(pc.binary_join_element_wise("", found.dictionary, "", " "), low, high)
    sizes = np.bincount(of, minlength=len(found.dictionary))
    return _Places(row[there], found.indices.to_numpy().astype(np.int64), sizes, np.cumsum(sizes) - sizes, grams[np.argsort(of, kind="stable")], names)


def _char_counts(column: pa.Array, low: int, high: int, by_gram: bool = False) -> Counts:
    """Character n-grams that reach over no white space."""
    places = _char_places(column, low, high)
    return _counts(*places.repeated(places.row, places.word), places.names, by_gram)


def _char_totals(column: pa.Array, low: int, high: int, copies: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """`totals_of` without a count per row: a word counts once per row for `df` and `docs`, and as often as it stands for `total`."""
    p = _char_places(column, low, high)
    width = len(p.names)
    often = np.repeat(np.bincount(p.word, minlength=len(p.sizes)), p.sizes)
    row, word, _ = _tally(p.row, p.word)
    row, gram, _ = _tally(*p.repeated(row, word))
    df = np.bincount(gram, copies[row], width)
    return p.names, df.astype(np.int64), np.bincount(gram, minlength=width), np.bincount(p.grams, often, width).astype(np.int64)


def _word_counts(column: pa.Array, low: int, high: int, by_gram: bool = False) -> Counts:
    """Words and pairs of neighbouring words of lists of words; of a text, pieces of one character are no words."""
    row_of, flat = _flat_words(column)
    if not pa.types.is_nested(column.type):
        there = pc.utf8_length(flat).to_numpy() > 1
        row_of, flat = row_of[there], flat.filter(pa.array(there))
    flat = flat.dictionary_encode()
    words, word = flat.dictionary, flat.indices.to_numpy().astype(np.int64)
    rows, grams, names = [], [], []
    if low == 1:
        rows, grams, names = [row_of], [word], [words]
    if high == 2 and len(word) > 1:
        places = np.flatnonzero(row_of[:-1] == row_of[1:])
        known, pair = _numbered(word[places] * len(words) + word[places + 1])
        rows.append(row_of[places])
        grams.append(pair + sum(map(len, names)))
        names.append(pc.binary_join_element_wise(words.take(pa.array(known // len(words))), words.take(pa.array(known % len(words))), " "))
    if not rows:
        return _counts(np.zeros(0, np.int64), np.zeros(0, np.int64), pa.array([], pa.string()))
    return _counts(np.concatenate(rows), np.concatenate(grams), pa.concat_arrays(names), by_gram)


def counts_of(column: pa.Array, kind: str, low: int, high: int, by_gram: bool = False) -> Counts:
    """The counts of a column of texts, for words with blanks for all that is no word, or of lists of words."""
    return (_word_counts if kind == "word" else _char_counts)(column, low, high, by_gram)


def totals_of(column: pa.Array, kind: str, low: int, high: int, copies: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(names, df, docs, total): n-grams, rows with them counted as often as ``copies`` says, rows as they stand, occurrences."""
    if kind != "word":
        return _char_totals(column, low, high, copies)
    found = _word_counts(column, low, high)
    width = len(found.names)
    return found.names, *[np.bincount(found.gram, n, width).astype(np.int64) for n in (copies[found.row], None, found.tf)]


def parts_of(batch: pa.RecordBatch, cut: int = 1) -> Iterator[pa.RecordBatch]:
    """Runs of rows of a batch whose first ``cut`` columns are what is counted."""
    sizes = sum((np.diff(_offsets(batch.column(i))) for i in range(cut)), np.ones(batch.num_rows, np.int64))
    at = np.concatenate([[0], np.cumsum(sizes)])
    start = 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(at, at[start] + RUN, "right")) - 1)
        yield batch.slice(start, end - start)
        start = end


def runs(batch: pa.RecordBatch, kind: str, low: int, high: int, by_gram: bool = False) -> Iterator[tuple[pa.RecordBatch, Counts]]:
    """Runs of rows of a batch with the counts of its first column."""
    for part in parts_of(batch):
        yield part, counts_of(part.column(0), kind, low, high, by_gram)
