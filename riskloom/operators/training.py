"""Training of linear text models.

The vocabulary is fitted as a table (see `features`) and at most its limit of
terms comes to the driver, as any Spark ML vocabulary does. Rows stay on the
executors: they are counted and weighted in the tasks that read them,
the optimiser (`solver`) sums gradients over the partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.types import StructType

from riskloom.constants import ALERT_THRESHOLD, ALPHA_GRID, C_GRID, LINEAR_MODEL
from riskloom.functions.grams import counts_of, parts_of
from riskloom.operators.evaluation import best_grid_row, binary_metrics, ranking_metrics
from riskloom.operators.features import CHAR, WORD, Family, cut, vocabulary_of, weigh
from riskloom.operators.solver import LinearFit, Scales, fit_binary, fit_classes, hold_features, with_margins
from riskloom.operators.teacher import with_soft_labels
from riskloom.session import materialize
from riskloom.sources.tables import LinearModel


@dataclass
class Vectoriser:
    """Fitted vocabularies of one or more families."""

    families: Sequence[Family]
    terms: dict[str, list[str]]
    idf: dict[str, list[float]]

    @property
    def scales(self) -> Scales:
        """How the features are made of counts: times the idf of the term, over the length of the family's block."""
        widths = [len(self.terms[f.name]) for f in self.families]
        return Scales(np.concatenate([*[np.asarray(self.idf[f.name], float) for f in self.families], [1.0]]), np.unique(np.cumsum([0, *widths])))

    def transform(self, df: DataFrame, text: str = "model_text") -> DataFrame:
        """Adds `features`: the unit-length blocks of all families side by side,
        and a constant 1 at the end whose coefficient is the intercept."""
        spans, width, names = [], 0, [*df.columns, "features"]
        for f in self.families:
            spans.append((f, width, self.terms[f.name], self.idf[f.name]))
            width += len(self.terms[f.name])

        def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = [(pa.array(terms, pa.string()), np.asarray(idf, float)) for _, _, terms, idf in spans]
            for batch in batches:
                for part in parts_of(batch, len(spans)):
                    n = part.num_rows
                    found = [weigh(counts_of(part.column(i), f.kind, f.low, f.high), *known[i]) for i, (f, *_) in enumerate(spans)]
                    row = np.concatenate([*[r for r, _, _ in found], np.arange(n)])
                    column = np.concatenate([*[c + start for (_, c, _), (_, start, *_) in zip(found, spans)], np.full(n, width)])
                    value = np.concatenate([*[v for _, _, v in found], np.ones(n)])
                    order = np.argsort(row * (width + 1) + column)
                    ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))]).astype(np.int32))
                    vectors = pa.StructArray.from_arrays([
                        pa.array(np.zeros(n, np.int8)), pa.array(np.full(n, width + 1, np.int32)),
                        pa.ListArray.from_arrays(ends, pa.array(column[order].astype(np.int32))),
                        pa.ListArray.from_arrays(ends, pa.array(value[order]))], names=["type", "size", "indices", "values"])
                    yield pa.RecordBatch.from_arrays([*part.columns[len(spans):], vectors], names=names)

        rows = df.select(*[cut(f, text).alias(f"_cut_{f.name}") for f in self.families], *df.columns)
        return rows.mapInArrow(features, StructType([*df.schema.fields]).add("features", VectorUDT()))


def fit_vectoriser(df: DataFrame, text: str = "model_text", key: str = "sample_id",
                   families: Sequence[Family] = (WORD, CHAR)) -> Vectoriser:
    terms, idf = {}, {}
    for f in families:
        if f.max_features is None:
            raise ValueError("a trained vocabulary needs a limit")
        vocab = vocabulary_of(df, f, text)
        rows = vocab.select("term", "idf").orderBy("term").collect()  # at most max_features rows
        terms[f.name], idf[f.name] = [r.term for r in rows], [r.idf for r in rows]
    return Vectoriser(families, terms, idf)


def class_weights(df: DataFrame, label: str = "alert_flag", balanced: bool = False, source: DataFrame | None = None) -> DataFrame:
    """Weight 1, or n / (classes · n of the class) when balanced. ``source`` has the same rows, if ``df`` is costly to count."""
    if not balanced:
        return df.withColumn("weight", F.lit(1.0))
    sizes = {r[0]: r["n"] for r in (df if source is None else source).groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(sizes.values())
    chain = F.lit(1.0)
    for value, n in sizes.items():
        chain = F.when(F.col(label) == value, F.lit(total / (len(sizes) * n))).otherwise(chain)
    return df.withColumn("weight", chain)


def _sides(label, weight=1.0):
    """What a row counts as positive and as negative."""
    return F.col(label) * weight, (1 - F.col(label)) * weight


def fit_logreg(features: DataFrame, C: float = 1.0, balanced: bool = False, label: str = "alert_flag",
               source: DataFrame | None = None, scales: Scales | None = None) -> LinearFit:
    """Binary L2 logistic regression that minimises |w|²/2 + C·Σ weight·loss, intercept included.

    ``source`` is the frame the features were made of, so that the classes are counted without making them once more, and
    ``scales`` those of the vectoriser that made them, so that they take less room.
    """
    weighted = class_weights(features, label, balanced, source)
    return fit_binary(weighted, [_sides(label, F.col("weight"))], [C], scales)[0]


def fit_logreg_soft(features: DataFrame, C: float = 1.0, soft: str = "soft_y", scales: Scales | None = None) -> LinearFit:
    """Soft labels: every row counts as positive with weight y and as negative with 1-y."""
    return fit_binary(features, [_sides(soft)], [C], scales)[0]


def with_scores(model: LinearFit, features: DataFrame, out: str = "score") -> DataFrame:
    scored = with_margins(model, features)
    return scored.withColumn(out, 1 / (1 + F.exp(-F.element_at("margins", 1)))).drop("margins")


def to_linear_model(spark: SparkSession, model: LinearFit, vec: Vectoriser, name: str = LINEAR_MODEL,
                    threshold: float = ALERT_THRESHOLD, meta: dict | None = None) -> LinearModel:
    """The fitted model as a weights table, for `score_linear` and for storing."""
    coef = model.coefficients
    rows, at = [], 0
    for f in vec.families:
        for term, idf in zip(vec.terms[f.name], vec.idf[f.name]):
            rows.append((f.name, term, float(idf), float(coef[at])))
            at += 1
    weights = spark.createDataFrame(rows, "family string, term string, idf double, coef double")
    names = ",".join(f.name for f in vec.families)
    return LinearModel(weights, float(coef[at]), threshold, name, {**(meta or {}), "families": names})


# --- grids ----------------------------------------------------------------------


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def evaluate_scored(scored: DataFrame, by: Sequence[str], label: str = "alert_flag", threshold: float = ALERT_THRESHOLD) -> DataFrame:
    """All metrics of scored rows per model, in one pass over the union of the models."""
    scored = materialize(scored, "scored")
    flagged = scored.withColumn("pred", (F.col("score") >= threshold).cast("int"))
    return binary_metrics(flagged, label, "pred", by).join(ranking_metrics(scored, label, "score", by), list(by))


def grid_alpha_c(
    train: DataFrame, valid: DataFrame, alphas: Sequence[float] = ALPHA_GRID, cs: Sequence[float] = C_GRID,
    text: str = "model_text", families: Sequence[Family] = (WORD, CHAR),
) -> tuple[DataFrame, Callable[[float, float], LinearFit], Vectoriser]:
    """Valid metrics for every pair (alpha, C) of a distilled student.

    ``train`` holds `alert_flag`, `teacher_label`, `teacher_confidence` and the
    text. The features are built once and packed; each pass over them serves all
    pairs. Returns the grid, the fitted models by parameters, and the vectoriser.
    """
    vec = fit_vectoriser(train, text, families=families)
    x_train = vec.transform(train, text).select("alert_flag", "teacher_label", "teacher_confidence", "features")
    for i, a in enumerate(alphas):
        x_train = with_soft_labels(x_train, a).withColumnRenamed("soft_y", f"_soft_{i}")
    x_train = x_train.select("features", *[f"_soft_{i}" for i in range(len(alphas))])
    x_valid = hold_features(vec.transform(valid, text).select("sample_id", "alert_flag", "features"))
    params = [(float(a), float(c)) for a in alphas for c in cs]
    sides = [_sides(f"_soft_{i}") for i in range(len(alphas)) for _ in cs]
    models = dict(zip(params, fit_binary(x_train, sides, [c for _, c in params], vec.scales)))
    scored = [
        with_scores(m, x_valid).select(F.lit(a).alias("alpha"), F.lit(c).alias("C"), "sample_id", "alert_flag", "score")
        for (a, c), m in models.items()]
    grid = evaluate_scored(_union(scored), ["alpha", "C"])
    return grid, lambda alpha, c: models[(float(alpha), float(c))], vec


def best_of_grid(grid: DataFrame) -> DataFrame:
    return best_grid_row(grid, tie=["alpha", "C"])


def class_folds(df: DataFrame, folds: int, label: str, key: str) -> DataFrame:
    """Adds `fold`: the rows of each class are dealt out in turn, in order of a hash of the key."""
    turn = Window.partitionBy(label, "_part").orderBy(F.xxhash64(key), key)
    parts = df.withColumn("_part", F.pmod(F.xxhash64(key, F.lit(1)), F.lit(max(1, df.count() // 10_000))))
    return parts.withColumn("fold", F.pmod(F.row_number().over(turn) - 1, F.lit(folds)).cast("int")).drop("_part")


def grid_search_cv(
    train: DataFrame, cs: Sequence[float] = C_GRID, weights: Sequence[str] = ("none", "balanced"), folds: int = 3,
    text: str = "model_text", key: str = "sample_id", families: Sequence[Family] = (WORD, CHAR),
) -> DataFrame:
    """Cross-validated F1 for every (C, class weight), best first.

    The vectoriser is refitted on the training part of every fold. Every fold
    has its share of each class; one pass serves all parameters of a fold.
    """
    folded = materialize(class_folds(train.select(key, "alert_flag", text), folds, "alert_flag", key), "folds")
    params = [(float(c), mode) for mode in weights for c in cs]

    def scored(fold: int) -> DataFrame:
        fit_on, test_on = folded.filter(F.col("fold") != fold), folded.filter(F.col("fold") == fold)
        vec = fit_vectoriser(fit_on, text, key, families)
        x_fit = class_weights(vec.transform(fit_on.select("alert_flag", text), text), balanced=True, source=fit_on)
        sides = [_sides("alert_flag", F.col("weight") if mode == "balanced" else F.lit(1.0)) for _, mode in params]
        models = fit_binary(x_fit, sides, [c for c, _ in params], vec.scales)
        x_test = hold_features(vec.transform(test_on.select("alert_flag", text), text).select("alert_flag", "features"))
        return materialize(_union([
            with_scores(model, x_test).select(
                F.lit(c).alias("C"), F.lit(mode).alias("class_weight"), F.lit(fold).alias("fold"), "alert_flag",
                (F.col("score") >= ALERT_THRESHOLD).cast("int").alias("pred"))
            for (c, mode), model in zip(params, models)]), "fold-scores")

    # the folds wait for each other's passes only where the cores are busy
    with ThreadPoolExecutor(folds) as pool:
        scored = _union([*pool.map(scored, range(folds))])
    per_fold = binary_metrics(scored, "alert_flag", "pred", ["C", "class_weight", "fold"])
    return per_fold.groupBy("C", "class_weight").agg(
        F.avg("f1").alias("mean_f1"), F.avg("precision").alias("mean_precision"), F.avg("recall").alias("mean_recall"),
        F.count(F.lit(1)).alias("folds")).orderBy(F.desc("mean_f1"), "C", "class_weight")


def evaluate_models(models: dict[str, Callable[[DataFrame], DataFrame]], df: DataFrame, threshold: float = ALERT_THRESHOLD) -> DataFrame:
    """Metrics of named scorers on the same rows with a frozen threshold."""
    scored = [score(df).select(F.lit(name).alias("model"), "alert_flag", "score") for name, score in models.items()]
    return evaluate_scored(_union(scored), ["model"], threshold=threshold)


def fit_risk_type(features: DataFrame, label: str = "risk_type_4cls", C: float = 1.0,
                  source: DataFrame | None = None, scales: Scales | None = None) -> tuple[LinearFit, list[str]]:
    """Multinomial model of the risk type, intercepts without penalty: (model, class names in label order).

    ``source`` is the frame the features were made of, where the classes are looked up."""
    names = sorted(r[0] for r in (features if source is None else source).select(label).distinct().collect())
    index = F.array_position(F.array(*[F.lit(n) for n in names]), F.col(label)) - 1
    return fit_classes(features.withColumn("_class", index.cast("int")), "_class", len(names), C, scales), names


def predict_risk_type(model: LinearFit, names: Sequence[str], features: DataFrame, out: str = "risk_type_pred") -> DataFrame:
    table = F.array(*[F.lit(n) for n in names])
    scored = with_margins(model, features)
    best = F.array_position("margins", F.array_max("margins")).cast("int")
    return scored.withColumn(out, F.element_at(table, best)).drop("margins")
