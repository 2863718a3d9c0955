"""Toxicity classifier: linear over character n-grams, scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import mix, slices, text_or_empty
from riskloom.llm.quality import held_out
from riskloom.session import materialize

THRESHOLD = 0.5
SAMPLE_ROWS = 20_000  # labelled rows that a fit reads at most; scoring reads all rows
SIZES = (4, 5, 6)
BUCKETS = 1 << 20
KEEP = 4096  # n-grams with a weight of their own, by strength of evidence
CHUNKS = 64
SLICE_BYTES = 1 << 19  # of text in work at a time; its n-grams take some hundred times that


def ngram_buckets(texts: list[str | None], sizes: tuple[int, ...] = SIZES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hash buckets of the character n-grams of all texts, size by size, with the text each belongs to.

    Letters are lower-cased, white-space runs become one space, and every text starts and ends with a space.
    """
    parts = [" " + " ".join((t or "").lower().split()) + " " for t in texts]
    codes = np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32)
    length = np.fromiter(map(len, parts), np.int64, len(parts))
    owner = np.repeat(np.arange(len(parts), dtype=np.int32), length)
    h = np.zeros(len(codes), np.uint64)
    for k in range(max(sizes)):
        n = len(codes) - k
        if n <= 0:
            return
        h = h[:n] * np.uint64(0x100000001B3) + codes[k:]
        if k + 1 in sizes:
            inside = owner[:n] == owner[k:]
            yield (mix(h[inside] + np.uint64(k)) >> np.uint64(44)).astype(np.int32), owner[:n][inside]


def _seen(texts: list[str | None], wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Each (text, bucket) once; with `wanted`, only buckets where it is not negative, renumbered by it."""
    keys = []
    for buckets, owner in ngram_buckets(texts):
        if wanted is not None:
            buckets = wanted[buckets]
            hit = buckets >= 0
            buckets, owner = buckets[hit], owner[hit]
        keys.append(owner.astype(np.int64) << 20 | buckets)
    keys = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
    return keys >> 20, keys & (BUCKETS - 1)


@dataclass(frozen=True)
class ToxicityModel:
    """At most KEEP buckets have a number and a weight."""

    number: np.ndarray
    weight: np.ndarray
    intercept: float

    def score(self, texts: list[str | None]) -> np.ndarray:
        owner, feature = _seen(texts, self.number)
        margin = np.bincount(owner, self.weight[feature], minlength=len(texts)) + self.intercept
        return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def _sample(docs: DataFrame, labels: DataFrame, label: str, key: str, text: str, limit: int) -> DataFrame:
    marks = labels.select(F.col("doc_id").cast("long").alias("_l"), F.col(label).cast("double").alias("label")).where(
        ~held_out(F.col("_l")) & F.col("label").isin(0.0, 1.0))
    total = marks.count()
    if total > limit:
        marks = marks.where(F.pmod(F.xxhash64("_l", F.lit(3)), F.lit(1 << 20)) < int((1 << 20) * limit / total))
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), text_or_empty(F.col(text)).alias("text"))
    return rows.join(marks, F.col("doc_id") == F.col("_l")).select("text", "label")


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", text: str = "text",
                 limit: int = SAMPLE_ROWS, keep: int = KEEP, reg: float = 1e-4) -> ToxicityModel:
    """Fit on labelled rows outside the held-out fold.

    Tasks count in how many toxic and clean texts each n-gram occurs; counts are summed in CHUNKS slices. An n-gram's
    log-count ratio scales its feature; the `keep` ratios farthest from zero against their own uncertainty get a weight
    by logistic regression.
    """
    rows = materialize(_sample(docs, labels, label, key, text, limit), "toxic-train")
    size = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    nothing = np.full(BUCKETS, -1, np.int32)
    if len(size) < 2:  # nothing to tell apart
        return ToxicityModel(nothing, np.zeros(1), 0.0 if not size else 20.0 if 1.0 in size else -20.0)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BUCKETS), np.int32)
        for batch in slices(batches, "text", SLICE_BYTES):
            owner, bucket = _seen(batch.column(0).to_pylist())
            toxic = batch.column(1).to_numpy()[owner] == 1
            total[1] += np.bincount(bucket[toxic], minlength=BUCKETS).astype(np.int32)
            total[0] += np.bincount(bucket[~toxic], minlength=BUCKETS).astype(np.int32)
        if total.any():
            cut = np.ascontiguousarray(total.reshape(2, CHUNKS, -1).transpose(1, 0, 2))
            yield pa.RecordBatch.from_pydict({"chunk": pa.array(range(CHUNKS), pa.int32()), "n": pa.array([c.tobytes() for c in cut], pa.binary())})

    def strongest(table: pa.Table) -> pa.Table:
        n = sum(np.frombuffer(x, np.int32).astype(np.int64) for x in table.column("n").to_pylist()).reshape(2, -1)
        p, q = n[1] + 0.5, n[0] + 0.5
        ratio = np.log(p / (size[1.0] + 1)) - np.log(q / (size[0.0] + 1))
        z = np.abs(ratio) / np.sqrt(1 / p + 1 / q)
        best = np.argsort(-z, kind="stable")[:keep]
        best = best[n[:, best].sum(axis=0) > 1]
        chunk = table.column("chunk")[0].as_py()
        return pa.table({"bucket": pa.array(best + chunk * (BUCKETS // CHUNKS), pa.int32()), "ratio": ratio[best], "z": z[best]})

    counted = rows.select("text", "label").mapInArrow(count, "chunk int, n binary")
    found = (counted.groupBy("chunk").applyInArrow(strongest, "bucket int, ratio double, z double")
             .orderBy(F.desc("z"), "bucket").limit(keep).collect())
    if not found:
        prior = np.log(size[1.0] / size[0.0])
        return ToxicityModel(nothing, np.zeros(1), float(prior))
    number = nothing.copy()
    number[[r["bucket"] for r in found]] = np.arange(len(found), dtype=np.int32)
    ratios = np.array([r["ratio"] for r in found])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            owner, feature = _seen(batch.column(0).to_pylist(), number)
            cuts = np.searchsorted(owner, np.arange(batch.num_rows + 1)).astype(np.int32)
            names = pa.array(feature.astype(str).tolist(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(cuts), names), batch.column(1)], names=["words", "label"])

    bags = materialize(rows.select("text", "label").mapInArrow(features, "words array<string>, label double"), "toxic-bags")
    vectors = CountVectorizerModel.from_vocabulary([str(i) for i in range(len(found))], "words", "x").transform(bags)
    scaled = ElementwiseProduct(scalingVec=Vectors.dense(ratios), inputCol="x", outputCol="features").transform(vectors)
    fitted = LogisticRegression(regParam=reg, standardization=False, maxIter=200, tol=1e-6).fit(scaled.select("features", "label"))
    return ToxicityModel(number, fitted.coefficients.toArray() * ratios, float(fitted.intercept))


def toxicity_scores(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted.

    Whole texts are scored where they lie: nothing is shuffled but the bounded sample. Null text counts as empty; a
    text without weighted n-grams has the score of the intercept. Labels that are neither 0 nor 1 are ignored. Without
    labels every score is 0.5; with one label only the score is near that label. An empty table gives no rows; repeated
    rows are scored one by one. Texts are read whole, a slice or one longer text at a time. Other columns are not read.
    """
    model = fit_toxicity(docs, labels, label, key, text)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(batch.column(1).to_pylist()))], names=["doc_id", "score"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), text_or_empty(F.col(text)).alias("text"))
    return rows.mapInArrow(score, "doc_id long, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
