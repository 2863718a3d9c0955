"""Reproducible samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PREFIX = 4  # hexadecimal digits of the hash that are counted: 65,536 prefixes


def sample_hash(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))


def sample_n(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """``n`` rows picked by the hash of their key, the same on every run."""
    return df.withColumn("_h", sample_hash(key, seed)).orderBy("_h", key).limit(n).drop("_h")


def smallest_hashes(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """The ``n`` rows with the smallest key hash, for an ``n`` of any size.

    Rows are counted per hash prefix (at most 65,536 counts). Prefixes below
    the cut are kept whole; inside the one prefix at the cut the last hash to
    keep is looked up.
    """
    rows = df.withColumn("_h", sample_hash(key, seed)).withColumn("_p", F.substring("_h", 1, PREFIX))
    left, cut = n, None
    for p, c in sorted((r["_p"], r["c"]) for r in rows.groupBy("_p").agg(F.count(F.lit(1)).alias("c")).collect()):
        if c > left:
            cut = p
            break
        left -= c
    if cut is None:
        return rows.drop("_h", "_p")
    last = rows.filter(F.col("_p") == cut).select("_h").orderBy("_h").limit(left).agg(F.max("_h")).first()[0]
    kept = F.col("_p") < cut
    if last is not None:
        kept = kept | ((F.col("_p") == cut) & (F.col("_h") <= last))
    return rows.filter(kept).drop("_h", "_p")


def stratified_few_shot(df: DataFrame, k: int, label: str = "alert_flag", key: str = "sample_id", seed: int = 42) -> DataFrame:
    """Up to ``k`` train rows per class.

    The rank filter also runs before the shuffle: each task passes on at most
    ``k`` rows per class.
    """
    w = Window.partitionBy(label).orderBy("_h", key)
    ranked = (
        df.filter(F.col("split") == "train").withColumn("_h", sample_hash(key, seed))
        .withColumn("_rn", F.row_number().over(w))
    )
    return ranked.filter(F.col("_rn") <= k).drop("_h", "_rn")
