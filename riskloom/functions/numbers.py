"""Small numeric and JSON expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.constants import SOFT_LABEL_FLOOR
from riskloom.functions.text import col


def clip(c: Column | str, low: float, high: float) -> Column:
    c = col(c)
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def sigmoid(c: Column) -> Column:
    return 1 / (1 + F.exp(-c))


def positive_score(logits: Column | str) -> Column:
    """Probability of the positive class from an array of one or two logits."""
    x = col(logits)
    return sigmoid(F.when(F.size(x) == 2, x[1] - x[0]).otherwise(x[0]))


def confidence(score: Column | str) -> Column:
    return F.greatest(col(score), 1 - col(score))


def numeric_or_null(c: Column | str) -> Column:
    """Number in a text, null where the text is no number."""
    return col(c).try_cast("double")


def is_close(a: Column | str, b: Column | str, rtol: float = 1e-5, atol: float = 1e-8) -> Column:
    a, b = col(a), col(b)
    return F.coalesce(F.abs(a - b) <= F.lit(atol) + F.lit(rtol) * F.abs(b), F.lit(False))


def ratio_or_zero(num: Column, den: Column) -> Column:
    return F.when(den == 0, F.lit(0.0)).otherwise(num / den)


def teacher_soft_label(label="teacher_label", conf="teacher_confidence", floor: float = SOFT_LABEL_FLOOR) -> Column:
    """Probability of the positive class according to the teacher.

    ``floor=0`` gives the variant that is only clipped to [0, 1].
    """
    c = clip(col(conf).cast("double"), 0.0, 1.0)
    return clip(F.when(col(label) == 1, c).otherwise(1 - c), floor, 1 - floor)


def blend_soft_label(hard: Column | str, teacher: Column | str, alpha: float, floor: float = SOFT_LABEL_FLOOR) -> Column:
    mixed = F.lit(1 - alpha) * col(hard).cast("double") + F.lit(alpha) * col(teacher)
    return clip(mixed, floor, 1 - floor)


def display_name(c: Column | str, names: Mapping[str, str]) -> Column:
    """Replace values found in ``names``; others stay."""
    if not names:
        return col(c)
    table = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    return F.coalesce(F.try_element_at(table, col(c)), col(c))


def custom_rank(c: Column | str, ranks: Mapping[str, int], unknown: int = 99) -> Column:
    table = F.create_map(*[F.lit(x) for kv in ranks.items() for x in kv])
    return F.coalesce(F.try_element_at(table, col(c)), F.lit(unknown))


def parse_binary_answer(c: Column | str) -> Column:
    """First free-standing 0 or 1 of an answer, -1 where there is none."""
    found = F.regexp_extract(F.coalesce(col(c), F.lit("")), r"(?<![\p{L}\p{N}_])([01])(?![\p{L}\p{N}_])", 1)
    return F.coalesce(F.nullif(found, F.lit("")).cast("int"), F.lit(-1))
