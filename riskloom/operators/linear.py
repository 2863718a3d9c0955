"""Scoring with a stored linear text model, inside the row."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.features import FAMILIES_BY_NAME, score_linear_joined
from riskloom.operators.training import Vectoriser
from riskloom.sources.tables import LinearModel

#: A model of more terms is not broadcast; its terms are joined instead.
MOST_TERMS = 500_000


def score_linear(df: DataFrame, model: LinearModel, key: str, text: str, out: str = "score", most_terms: int = MOST_TERMS) -> DataFrame:
    """Probability of the positive class for every row of ``df``, as column ``out``.

    The model's size is counted first. Up to ``most_terms`` terms, its vocabularies, idf and weights become Spark ML
    transformers, whose broadcasts that number bounds: every row is cut into terms, weighted and scored where it lies,
    and nothing is shuffled. A larger model is joined term by term (`score_linear_joined`). A text without known terms,
    a null text too, gets the intercept.
    """
    known = model.weights.select("family", "term", "idf", "coef")
    rows = known.limit(most_terms + 1).collect()
    if len(rows) > most_terms:
        return score_linear_joined(df, model, key, text, out)
    names = sorted(model.meta.get("families", "word,char").split(","))
    of = {name: sorted((r for r in rows if r.family == name), key=lambda r: r.term) for name in names}
    vectoriser = Vectoriser([FAMILIES_BY_NAME[n] for n in names], {n: [r.term for r in of[n]] for n in names}, {n: [r.idf for r in of[n]] for n in names})
    weights = [r.coef for n in names for r in of[n]] + [float(model.intercept)]  # the last feature is always 1
    spark = df.sparkSession
    # Python has no constructor for a model whose weights are known already
    made = spark._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
        "linear", _py2java(spark.sparkContext, Vectors.dense(weights)), 0.0)
    fitted = LogisticRegressionModel(made).setFeaturesCol("features").setRawPredictionCol("").setPredictionCol("").setProbabilityCol("_p")
    scored = fitted.transform(vectoriser.transform(df, text))
    return scored.withColumn(out, F.get(vector_to_array("_p"), F.lit(1))).drop("_p", "features")
