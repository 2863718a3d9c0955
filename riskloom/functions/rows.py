"""Row-level helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once.

    An expression that is used several times, or inside a lambda, is computed as often; a lambda's own argument is not.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def compute_once(df: DataFrame, **cols: Column) -> DataFrame:
    """Add costly columns in a way that later filters do not repeat them.

    A filter on a plain computed column is pushed below the projection by
    substituting the whole expression, which then runs again for every use.
    Through a one-row generator the value is an attribute like any other.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))))
