"""Quality classifier: random Fourier features of document statistics, ridge regression, isotonic calibration."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import shingle_hashes, slices, text_or_empty, utf8_bytes, word_hashes
from riskloom.session import materialize

THRESHOLD = 0.3
SAMPLE_ROWS = 40_000  # labelled rows that a fit reads at most; scoring reads all rows
FEATURES = 256
RIDGE = 1e-3

_CLASSES = {
    "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "stop": b".,;:", "bang": b"!?",
    "symbol": b"#$%&*+=@^~_<>\\{}[]()/`", "bar": b"|", "quote": b"'\"-", "line": b"\n", "high": range(128, 256),
}
STATISTICS = [*_CLASSES, "bytes", "words", "word_bytes", "different_words", "different_shingles", "different_lines"]


def _per_text(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _different(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Share of different values among each text's values; 1 where it has none."""
    owner = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)
    mixed = np.sort((hashes >> np.uint64(24)) | (owner << np.uint64(40)))  # 40 bits are plenty to tell words of one text apart
    first = np.ones(len(mixed), bool)
    first[1:] = mixed[1:] != mixed[:-1]
    seen = np.bincount((mixed[first] >> np.uint64(40)).astype(np.int64), minlength=len(counts))
    return np.where(counts > 0, seen / np.maximum(counts, 1), 1.0)


def text_statistics(texts: pa.Array) -> np.ndarray:
    """One row of STATISTICS per text, over the whole text; an empty or null text has zero counts."""
    data, offsets = utf8_bytes(texts)
    size = np.diff(offsets)
    whole = np.maximum(size, 1)
    table = np.zeros(256, np.uint8)
    for i, members in enumerate(_CLASSES.values()):
        table[list(members)] = i + 1
    kind = table[data]
    out = [_per_text(kind == i + 1, offsets) / whole for i in range(len(_CLASSES))]
    words, counts = word_hashes(data, offsets)
    shingles, made = shingle_hashes(words, counts, 3)
    lines = np.array([0 if not t else len(set(t.split("\n"))) / (t.count("\n") + 1) for t in texts.to_pylist()], float)
    return np.stack([*out, np.log1p(size), np.log1p(counts), size / np.maximum(counts, 1) / 10, _different(words, counts),
                     _different(shingles, made), lines], axis=1)


def with_statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and its statistics; texts stay where they are."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            stats = text_statistics(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(list(stats), pa.list_(pa.float64()))], names=["doc_id", "stats"])

    return docs.select(F.col(key).cast("long").alias("doc_id"), text_or_empty(F.col(text)).alias("text")).mapInArrow(
        rows, "doc_id long, stats array<double>")


def held_out(key: Column) -> Column:
    """Rows that no fit may learn from; a null id counts as held out."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string")), F.lit(5)) == 0, F.lit(True))


@dataclass(frozen=True)
class QualityModel:
    """Bounded by the number of features and of calibration rows."""

    mean: np.ndarray
    spread: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    steps: np.ndarray   # raw scores, ascending
    levels: np.ndarray  # the calibrated score at each step

    def fourier(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.spread, -8, 8)
        z = np.sqrt(2.0 / len(self.phases)) * np.cos(x @ self.directions + self.phases)
        return np.concatenate([z, np.ones((len(z), 1))], axis=1)

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.fourier(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        if len(self.steps) == 0:
            return np.full(len(stats), self.levels[0])
        return np.clip(np.interp(self.raw(stats), self.steps, self.levels), 0.0, 1.0)


def pool_adjacent(scores: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The non-decreasing step function of least squares, as points to interpolate between."""
    values, back, n = np.unique(scores, return_inverse=True, return_counts=True)
    sums = np.bincount(back, labels)
    blocks: list[list[float]] = []
    for v, s, c in zip(values, sums, n):
        blocks.append([s, c, v, v])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s2, c2, _, high = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s2, blocks[-1][1] + c2, blocks[-1][2], high]
    steps = np.array([x for b in blocks for x in (b[2], b[3])])
    levels = np.array([x for b in blocks for x in (b[0] / b[1],) * 2])
    return steps, levels


def _training_rows(stats: DataFrame, labels: DataFrame, label: str, limit: int) -> DataFrame:
    """A bounded sample of the labelled rows by hash of the id, with the fold that calibrates."""
    marks = labels.select(F.col("doc_id").cast("long").alias("_l"), F.col(label).cast("double").alias("label")).where(
        ~held_out(F.col("_l")) & F.col("label").isin(0.0, 1.0))
    total = marks.count()
    if total > limit:
        marks = marks.where(F.pmod(F.xxhash64("_l", F.lit(5)), F.lit(1 << 20)) < int((1 << 20) * limit / total))
    rows = stats.join(marks, F.col("doc_id") == F.col("_l")).select("doc_id", "stats", "label")
    return rows.withColumn("calibrates", F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(4)) == 0)


def fit_quality(stats: DataFrame, labels: DataFrame, label: str = "quality", limit: int = SAMPLE_ROWS,
                features: int = FEATURES, ridge: float = RIDGE, seed: int = 7) -> QualityModel:
    """Fit on labelled rows outside the held-out fold.

    Random directions stand for a Gaussian kernel whose width is the square root of the number of statistics. Each
    task sums its share of the normal equations and the shares are summed row by row of the matrix; the driver
    solves a system of `features` + 1 unknowns. Ridge scores of a quarter of the sample, left out of the sums, calibrate.
    """
    rows = materialize(_training_rows(stats, labels, label, limit), "quality-train")
    moments = rows.where("not calibrates").select(F.posexplode("stats").alias("i", "x")).groupBy("i").agg(
        F.avg("x").alias("m"), F.stddev_pop("x").alias("s")).orderBy("i").collect()
    both = {r["label"] for r in rows.groupBy("label", "calibrates").count().collect()}
    wide = len(STATISTICS)
    rng = np.random.default_rng(seed)
    mean = np.array([r["m"] for r in moments]) if moments else np.zeros(wide)
    spread = np.array([max(r["s"], 1e-9) for r in moments]) if moments else np.ones(wide)
    model = QualityModel(mean, spread, rng.normal(size=(wide, features)) / np.sqrt(wide), rng.uniform(0, 2 * np.pi, features),
                         np.zeros(features + 1), np.zeros(0), np.array([0.5]))
    if len(both) < 2:  # nothing to tell apart: the score is the one label, or 0.5 without any
        return QualityModel(*[getattr(model, n) for n in ("mean", "spread", "directions", "phases", "weights", "steps")],
                            np.array([both.pop() if both else 0.5]))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((features + 1, features + 2))
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                z = model.fourier(np.array(part.column(0).to_pylist()))
                total += z.T @ np.column_stack([z, part.column(1).to_numpy()])
        yield pa.RecordBatch.from_pydict({"i": pa.array(range(features + 1), pa.int32()), "v": pa.array([r.tobytes() for r in total], pa.binary())})

    def add(table: pa.Table) -> pa.Table:
        v = sum(np.frombuffer(x, np.float64) for x in sorted(table.column("v").to_pylist()))
        return pa.table({"i": table.column("i").slice(0, 1), "v": pa.array([v.tobytes()], pa.binary())})

    fit = rows.where("not calibrates").select("stats", "label")
    summed = fit.mapInArrow(sums, "i int, v binary").groupBy("i").applyInArrow(add, "i int, v binary").collect()
    both_sides = np.stack([np.frombuffer(r["v"], np.float64) for r in sorted(summed, key=lambda r: r["i"])])
    gram, right = both_sides[:, :-1], both_sides[:, -1]
    n = gram[-1, -1]
    penalty = ridge * n / features * np.eye(features + 1)
    penalty[-1, -1] = 0
    weights = np.linalg.solve(gram + penalty + 1e-9 * np.eye(features + 1), right)
    fitted = QualityModel(mean, spread, model.directions, model.phases, weights, np.zeros(0), np.zeros(1))
    rest = rows.where("calibrates").select("stats", "label").collect()  # a quarter of the bounded sample
    if not rest:
        rest = rows.select("stats", "label").collect()
    steps, levels = pool_adjacent(fitted.raw(np.array([r["stats"] for r in rest])), np.array([r["label"] for r in rest]))
    return QualityModel(mean, spread, model.directions, model.phases, weights, steps, levels)


def score_column(model: QualityModel):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                scores = model.score(np.array(part.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores)], names=["doc_id", "score"])
    return rows


def quality_scores(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted.

    The statistics of all texts are computed once and written to the shared folder; model and scores start from there.
    Null text counts as empty; empty texts are scored like others. Labels that are neither 0 nor 1 are ignored. Without
    labels every score is 0.5, with one label only it is that label. An empty table gives no rows. Repeated rows are
    scored one by one. Texts are read whole, a slice or one longer text at a time. Other columns are not read.
    """
    stats = materialize(with_statistics(docs, key, text), "quality-stats")
    model = fit_quality(stats, labels, label)
    scored = stats.select("doc_id", "stats").mapInArrow(score_column(model), "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


def drop_low_quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that the classifier does not reject, with all their columns, whatever these are called.

    Rows are told apart by id: of rows that repeat an id, none stays if one of them is rejected. Null text is scored as
    empty text. An empty table stays empty.
    """
    low = quality_scores(docs, labels, key, text).where("predicted = 0").select(F.col("doc_id").alias("_low")).distinct()
    return docs.join(low, docs[key].eqNullSafe(low["_low"]), "left_anti")
