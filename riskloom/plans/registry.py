"""Registered queries: a DataFrame form and, where SQL can say it, an oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from riskloom.plans.adapters import Views


@dataclass(frozen=True)
class Query:
    name: str
    covers: str          # ids of the operator inventory
    build: Callable[[Views], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(covers: str, sql: str | None = None):
    """Register a function of `Views` under its own name."""
    def add(fn: Callable[[Views], DataFrame]):
        if fn.__name__ in REGISTRY:
            raise ValueError(f"query {fn.__name__} is registered twice")
        REGISTRY[fn.__name__] = Query(fn.__name__, covers, fn, sql)
        return fn
    return add


def as_callable(q: Query) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return q.build(Views(spark, sf_dir))
    run.__name__ = q.name
    return run
