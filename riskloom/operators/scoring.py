"""Risk scores and what is derived from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.constants import (
    ALERT_THRESHOLD, BASE_SCORE, KEYWORD_MODEL, MAX_SCORE, NO_RISK, RISK_TERM_WEIGHTS,
)
from riskloom.functions.rows import compute_once
from riskloom.functions.text import model_text
from riskloom.operators.items import resolve_entity
from riskloom.session import materialize

# Weights are added up as whole millionths: the sum does not depend on order.
UNIT = 1_000_000


def _units(x: float) -> int:
    return round(x * UNIT)


def keyword_risk_score(
    df: DataFrame, weights: Mapping[str, float] = RISK_TERM_WEIGHTS, base: float = BASE_SCORE,
    top: float = MAX_SCORE, text: Column | None = None, out: str = "score",
) -> DataFrame:
    """Base plus the weight of every term contained in the text, capped.

    A term counts once, and also inside a word.
    """
    low = df.withColumn("_low", F.lower(model_text() if text is None else text))
    total = F.lit(_units(base))
    for term, weight in weights.items():
        total = total + F.contains(F.col("_low"), F.lit(term)).cast("int") * F.lit(_units(weight))
    score = F.least(total, F.lit(_units(top))) / F.lit(float(UNIT))
    return compute_once(low, **{out: score}).drop("_low")


def apply_threshold(
    df: DataFrame, threshold: float = ALERT_THRESHOLD, model_name: str = KEYWORD_MODEL, score: str = "score",
) -> DataFrame:
    """Flag from the unrounded score; the stored score has six decimals."""
    raw = F.col(score)
    return df.withColumns({
        "risk_score": F.round(raw, 6),
        "alert_flag": (raw >= F.lit(threshold)).cast("int"),
        "threshold": F.lit(float(threshold)),
        "model_name": F.lit(model_name),
    })


def score_items(
    items: DataFrame, aliases=None, weights: Mapping[str, float] = RISK_TERM_WEIGHTS,
    threshold: float = ALERT_THRESHOLD, model=None,
) -> DataFrame:
    """Entity, model text, score and flag of every item in one pass.

    Without a fitted ``model`` the keyword model is used.
    """
    resolved = resolve_entity(items) if aliases is None else resolve_entity(items, aliases)
    if model is None:
        return apply_threshold(keyword_risk_score(resolved, weights), threshold)
    from riskloom.operators.linear import score_linear

    scored = score_linear(resolved.withColumn("model_text", model_text()), model, key="id", text="model_text")
    return apply_threshold(scored.drop("model_text"), model.threshold, model.model_name)


def predictions(scored: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    return scored.select(
        F.col("id").alias("news_item_id"), "batch_id", "user_id", "risk_score", "alert_flag", "model_name", "threshold", *carry,
    )


def rank_by_risk(df: DataFrame, key: str = "news_item_id") -> DataFrame:
    """Highest risk first, ties by key.

    A global sort reads its input twice, first to sample the ranges. The rows are written before, so what made them,
    such as scoring texts, runs once; the sort reads what is written.
    """
    return materialize(df, "ranked").orderBy(F.desc("risk_score"), F.col(key))


def recent_first(df: DataFrame, at: str = "created_at", key: str = "id") -> DataFrame:
    return df.orderBy(F.desc(at), F.desc(key))


# --- rules the product documents describe ---------------------------------------


def find_risk_keywords(df: DataFrame, terms: Sequence[str], text: Column | None = None,
                       out: str = "found_risk_keywords") -> DataFrame:
    """Dictionary terms found in the text, in dictionary order, joined by `;`."""
    low = df.withColumn("_low", F.lower(model_text() if text is None else text))
    hits = [F.when(F.contains(F.col("_low"), F.lit(t)), F.lit(t)) for t in terms]
    return compute_once(low, **{out: F.concat_ws(";", *hits)}).drop("_low")


def classify_risk_type(
    df: DataFrame, families: Mapping[str, Sequence[str]], keywords: str = "found_risk_keywords",
    out: str = "risk_type", otherwise: str = NO_RISK,
) -> DataFrame:
    """First family, in the given order, with one of its terms among the keywords."""
    found = F.split(F.col(keywords), ";")
    chain = F.lit(otherwise)
    for name, terms in reversed(list(families.items())):
        chain = F.when(F.arrays_overlap(found, F.array(*[F.lit(t) for t in terms])), F.lit(name)).otherwise(chain)
    return df.withColumn(out, chain)


def explainable_risk_score(
    df: DataFrame, weights: Mapping[str, float], out: str = "risk_score_v1", threshold: float = 0.70,
) -> DataFrame:
    """Weighted sum of factor columns, capped to [0, 1], with each part shown."""
    parts = F.struct(*[(F.col(c) * F.lit(w)).alias(c) for c, w in weights.items()])
    total = F.lit(0.0)
    for c, w in weights.items():
        total = total + F.coalesce(F.col(c), F.lit(0.0)) * F.lit(w)
    score = F.least(F.greatest(total, F.lit(0.0)), F.lit(1.0))
    return df.withColumns({"score_parts": parts, out: score, "alert": (score >= threshold).cast("int")})


def alert_card(df: DataFrame, teams: Mapping[str, str], default_team: str) -> DataFrame:
    """Alerts with their reasons and the team that has to look at them."""
    route = F.create_map(*[F.lit(x) for kv in teams.items() for x in kv])
    return df.filter(F.col("alert_flag") == 1).select(
        "news_item_id", "entity_norm", "risk_type", "risk_score",
        F.filter(F.split("found_risk_keywords", ";"), lambda x: x != "").alias("reasons"),
        F.coalesce(F.try_element_at(route, F.col("risk_type")), F.lit(default_team)).alias("team"),
    )
