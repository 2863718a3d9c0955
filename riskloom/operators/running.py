"""Running aggregates that no single task has to hold.

A running sum over a whole key (or over the whole table) would put all its
rows into one task. Here the order column is cut into buckets: bucket totals
are small, their running aggregate gives every bucket its start value, and the
rows only run inside their own bucket.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from math import ceil

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import materialize

BUCKET_ROWS = 50_000  # rows of a bucket, about; more rows make more buckets


def order_edges(df: DataFrame, column: str, buckets: int) -> list[float]:
    """At most ``buckets`` cut points of a numeric column, about equally filled.

    Only the cut points come to the driver. Their exact place does not matter
    for any result, it only balances the tasks.
    """
    if buckets < 2:
        return []
    probs = [i / buckets for i in range(1, buckets)]
    cuts = df.stat.approxQuantile(column, probs, 1 / (4 * buckets))
    return sorted(set(cuts))


def with_bucket(df: DataFrame, column: str, edges: Sequence[float], out: str = "_bucket") -> DataFrame:
    if not edges:
        return df.withColumn(out, F.lit(0.0))
    splits = [float("-inf"), *edges, float("inf")]
    cut = Bucketizer(splits=splits, inputCol="_cut", outputCol=out, handleInvalid="keep")
    return cut.transform(df.withColumn("_cut", F.col(column).cast("double"))).drop("_cut")


def running_sums(
    df: DataFrame, values: Sequence[str], order: str, keys: Sequence[str] = (),
    descending: bool = False, buckets: int | None = None,
) -> DataFrame:
    """Adds ``<value>_upto``: sum over the rows of the key up to this one.

    ``order`` must not repeat within a key. Sums stay exact for integer and
    decimal values. The number of buckets follows the number of rows, which
    are read several times: pass a written table.
    """
    keys = list(keys)
    if buckets is None:
        buckets = ceil(df.count() / BUCKET_ROWS)
    edges = order_edges(df, order, buckets)
    rows = with_bucket(df, order, edges)
    by_bucket = F.desc("_bucket") if descending else F.asc("_bucket")
    by_row = F.desc(order) if descending else F.asc(order)

    totals = rows.groupBy(*keys, "_bucket").agg(*[F.sum(v).alias(f"_t_{v}") for v in values])
    # One row per key and bucket.
    over_buckets = Window.partitionBy(*keys).orderBy(by_bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*keys, "_bucket", *[
        F.coalesce(F.sum(f"_t_{v}").over(over_buckets), F.lit(0)).alias(f"_s_{v}") for v in values])

    inside = Window.partitionBy(*keys, "_bucket").orderBy(by_row).rowsBetween(Window.unboundedPreceding, 0)
    ran = rows.withColumns({f"_r_{v}": F.sum(v).over(inside) for v in values})
    on = [ran[c].eqNullSafe(starts[c]) for c in (*keys, "_bucket")]
    out = ran.join(starts, reduce(lambda a, b: a & b, on), "inner")
    return out.select(
        *[ran[c] for c in df.columns],
        *[(ran[f"_r_{v}"] + starts[f"_s_{v}"]).alias(f"{v}_upto") for v in values],
    )


def percentiles(
    counts: DataFrame, probs: Mapping[str, float], value: str = "value", n: str = "n", keys: Sequence[str] = (),
) -> DataFrame:
    """One row per key: exact percentiles of counted values, linear between two ranks.

    ``counts`` is a written table with one row per key and value, no value
    null. A value's running count tells its ranks, so values are never
    gathered: each percentile is a minimum over the values that reach its rank.
    """
    keys = list(keys)
    ran = running_sums(counts, [n], value, keys)
    totals = counts.groupBy(*keys).agg(F.sum(n).alias("_n"))
    if keys:
        sizes = totals.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_n")
        same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
        ranked = ran.join(sizes, reduce(lambda a, b: a & b, same), "inner")
    else:
        ranked = ran.withColumn("_n", totals.scalar())
    upto, at = F.col(f"{n}_upto"), {name: (F.col("_n") - 1) * F.lit(float(p)) for name, p in probs.items()}
    reached = ranked.groupBy(*keys).agg(
        F.max("_n").alias("_n"),
        *[F.min(F.when(upto > F.floor(spot), F.col(value))).alias(f"_low_{name}") for name, spot in at.items()],
        *[F.min(F.when(upto > F.ceil(spot), F.col(value))).alias(f"_high_{name}") for name, spot in at.items()])
    return reached.select(*keys, *[
        F.when(F.floor(spot) == F.ceil(spot), F.col(f"_low_{name}")).otherwise(
            (F.ceil(spot) - spot) * F.col(f"_low_{name}") + (spot - F.floor(spot)) * F.col(f"_high_{name}")).alias(name)
        for name, spot in at.items()])


def in_slices(df: DataFrame, key: str, order: Sequence[str], rows: int = BUCKET_ROWS) -> DataFrame:
    """The rows, written once, with `_slice`: consecutive ranges of (key, order) of about ``rows`` rows.

    Spark's range partitioning picks the cut points from a sample of the rows, so a key with a third of the table, or a
    day with two thirds of it, takes as many slices as its rows need. Rows that are equal in key and order stay
    together: make the order unique.
    """
    number = max(1, ceil(df.count() / rows))
    return materialize(df.repartitionByRange(number, key, *order).withColumn("_slice", F.spark_partition_id()), "slices")


def running_in_order(
    df: DataFrame, key: str, order: Sequence[str], aggs: Mapping[str, tuple[str, Column]], rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Running ``sum`` or ``max`` per key over its rows in order, in slices of about ``rows`` rows.

    ``aggs`` maps an output name to (``"sum"`` or ``"max"``, value). No task holds a key: rows run inside their slice,
    and the totals of a key's earlier slices, one row each, give its start. Rows of a null key run together.
    """
    fn = {"sum": F.sum, "max": F.max}
    cut = in_slices(df.withColumns({f"_v_{n}": v for n, (_, v) in aggs.items()}), key, order, rows)
    totals = cut.groupBy(key, "_slice").agg(*[fn[k](f"_v_{n}").alias(f"_t_{n}") for n, (k, _) in aggs.items()])
    before = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        F.col(key).alias("_key"), F.col("_slice").alias("_start"),
        *[fn[k](f"_t_{n}").over(before).alias(f"_s_{n}") for n, (k, _) in aggs.items()])
    inside = Window.partitionBy(key, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    ran = cut.withColumns({f"_r_{n}": fn[k](f"_v_{n}").over(inside) for n, (k, _) in aggs.items()})
    out = ran.join(starts, ran[key].eqNullSafe(starts["_key"]) & (ran["_slice"] == starts["_start"]), "inner")

    def merged(n: str, kind: str) -> Column:
        a, b = F.col(f"_s_{n}"), F.col(f"_r_{n}")
        if kind == "sum":
            return F.coalesce(a + b, b, a)
        return F.when(a.isNull() | (b >= a), b).otherwise(a)

    return out.select(*[ran[c] for c in df.columns], *[merged(n, k).alias(n) for n, (k, _) in aggs.items()])
