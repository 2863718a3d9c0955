"""Periodic runs of words by a dictionary of basic factors."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import slices, text_or_empty

#: A run has so many words at least, and so many periods.
LEAST_WORDS, LEAST_PERIODS = 12, 2

_NONE = np.zeros(0, np.int64)


def _renamed(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys occur more than once, and small numbers for those."""
    _, back, times = np.unique(keys, return_inverse=True, return_counts=True)
    repeated = times > 1
    return repeated[back], (np.cumsum(repeated) - 1)[back]


def _spans(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... for each size, one after the other."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _proposals(names: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) from the factors of one length: periods from `size` to under twice that.

    Occurrences of a factor no more than half its length apart are an arithmetic progression, whose step is the factor's
    smallest period. Two places in one progression propose no period of this range that a smaller one doesn't divide, so
    only places in different progressions of the factor do; these are more than half its length apart, so the next three
    reach as far as needed. The distances between two progressions are one more progression: no pairs are listed.
    """
    at = np.flatnonzero(names >= 0)
    at = at[np.argsort(names[at], kind="stable")]
    if len(at) < 2:
        return _NONE, _NONE
    gap, same = np.diff(at), names[at[1:]] == names[at[:-1]]
    joined = same & (2 * gap <= size)
    head = np.flatnonzero(np.concatenate([[True], ~joined]))
    tail = np.append(head[1:], len(at)) - 1
    low, high, members, name = at[head], at[tail], tail - head + 1, names[at[head]]
    step = np.where(members > 1, gap[np.minimum(head, len(gap) - 1)], 0)
    places, periods = [], []
    for ahead in (1, 2, 3):
        if ahead >= len(head):
            break
        near = low[ahead:] - high[:-ahead]
        left = np.flatnonzero((name[ahead:] == name[:-ahead]) & (near < 2 * size))
        right, near = left + ahead, near[left]
        by = np.maximum(np.maximum(step[left], step[right]), 1)
        first = np.maximum(0, -((near - size) // by))
        last = np.minimum(members[left] + members[right] - 2, (2 * size - 1 - near) // by)
        made = np.maximum(last - first + 1, 0)
        turn = np.repeat(first, made) + _spans(made)
        by = np.repeat(by, made)
        back = np.maximum(0, turn - np.repeat(members[right] - 1, made)) * by
        places.append(np.repeat(high[left], made) - back)
        periods.append(np.repeat(near, made) + turn * by)
    return (np.concatenate(places), np.concatenate(periods)) if places else (_NONE, _NONE)


def word_runs(names: np.ndarray, stop: np.ndarray, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> np.ndarray:
    """Rows (start, end, period) of all maximal runs, by start, then period.

    `names` numbers the words of one or more texts, each text with numbers of its own; `stop` holds, for every word,
    the end of its text. A factor of 2^k words is named by the names of its halves. Factors that occur once in their
    text are left out at every length, so in ordinary text little is left after a few lengths. A run of smallest period
    q has two occurrences, q apart, of the factor at its start whose length is the greatest power of two up to q.
    """
    keep, small = _renamed(names)
    level = np.where(keep, small, -1)
    levels, places, periods = [], [], []
    size = 1
    while (level >= 0).any():
        levels.append(level)
        place, period = _proposals(level, size)
        places.append(place)
        periods.append(period)
        here = np.flatnonzero(level >= 0)
        here = here[here + 2 * size <= stop[here]]
        here = here[level[here + size] >= 0]
        keep, small = _renamed(level[here] * np.int64(len(names) + 1) + level[here + size])
        level = np.full(len(names), -1, np.int64)
        level[here[keep]] = small[keep]
        size *= 2
    if not levels:
        return np.zeros((0, 3), np.int64)
    place, period = np.concatenate(places), np.concatenate(periods)
    order = np.lexsort((place, period))
    place, period = place[order], period[order]
    # proposals of one period at places no farther apart than the factor's length lie in one run
    fresh = np.ones(len(place), bool)
    reach = np.left_shift(1, np.log2(np.maximum(period, 1)).astype(np.int64))
    fresh[1:] = (period[1:] != period[:-1]) | (place[1:] - place[:-1] > reach[1:])
    place, period = place[fresh], period[fresh]
    start, end = place.copy(), place + period
    for k in range(len(levels) - 1, -1, -1):  # what two places share on the right, then on the left, by binary lifting
        i, j = end - period, np.minimum(end, len(names) - 1)
        ok = (end < len(names)) & (levels[k][i] >= 0) & (levels[k][i] == levels[k][j])
        end = end + np.where(ok, 1 << k, 0)
    for k in range(len(levels) - 1, -1, -1):
        i = start - (1 << k)
        j = np.maximum(i, 0)
        ok = (i >= 0) & (levels[k][j] >= 0) & (levels[k][j] == levels[k][j + period])
        start = np.where(ok, i, start)
    long = end - start >= np.maximum(least_words, least_periods * period)
    runs = np.stack([start[long], end[long], period[long]], axis=1)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    first = np.ones(len(runs), bool)  # of the periods of one stretch, the smallest
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[first]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _numbered(texts: list[str]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """The words of all texts, their numbers and the ends of the texts. `bytes.split` cuts at just the contracts' white space."""
    words = [t.encode().split() for t in texts]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    names, base = [], 0
    for text in words:
        numbers = defaultdict(count(base).__next__)
        names.append(np.fromiter(map(numbers.__getitem__, text), np.int64, len(text)))
        base += len(numbers)
    return words, np.concatenate(names) if names else _NONE, np.cumsum(sizes)


def collapse_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", least_words: int = LEAST_WORDS,
                  least_periods: int = LEAST_PERIODS) -> DataFrame:
    """One row per input row: doc_id, runs (array of start, length, period in words, by start, then period), collapsed.

    A run is a stretch of at least `least_words` words and `least_periods` periods (2 or more) in which words one
    smallest period apart are the same, and which no neighbouring word extends. `collapsed` is the text's words, one
    space between them, without those that stand in a run after its first period.

    Whole texts are read where they lie; nothing is shuffled. Memory in a task is bounded by a slice of texts, or by one
    text if that is longer (about 8 bytes a word and power of two). Null, empty and blank texts have no runs and
    collapse to ''. Rows with a null id keep it. Repeated rows are worked one by one. An empty table gives no rows.
    Other columns are not read, so their names don't matter.
    """
    if least_periods < 2:
        raise ValueError("a run holds at least two periods")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words, names, ends = _numbered(batch.column(1).to_pylist())
            begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
            runs = word_runs(names, np.repeat(ends, ends - begins), least_words, least_periods)
            drop = np.zeros(len(names) + 1, np.int64)
            np.add.at(drop, runs[:, 0] + runs[:, 2], 1)
            np.add.at(drop, runs[:, 1], -1)
            kept = np.cumsum(drop[:-1]) == 0
            owner = np.searchsorted(ends, runs[:, 0], side="right")
            cuts = np.searchsorted(owner, np.arange(len(words) + 1)).astype(np.int32)
            struct = pa.StructArray.from_arrays([
                pa.array(runs[:, 0] - begins[owner]), pa.array(runs[:, 1] - runs[:, 0]), pa.array(runs[:, 2])], ["start", "length", "period"])
            short = [
                b" ".join(text if cuts[i] == cuts[i + 1] else compress(text, kept[begins[i]:ends[i]].tolist())).decode()
                for i, text in enumerate(words)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(cuts), struct), pa.array(short, pa.string())], names=["doc_id", "runs", "collapsed"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), text_or_empty(F.col(text)).alias("text"))
    return rows.mapInArrow(find, "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
