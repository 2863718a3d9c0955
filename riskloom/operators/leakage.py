"""What crosses the train / valid / test border, and splits that avoid it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.text import digest, hash_bucket
from riskloom.session import materialize


def leaking_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur in more than one split (null is a value of its own)."""
    return (
        df.groupBy(digest(*key).alias("_key"))
        .agg(F.min("split").alias("_a"), F.max("split").alias("_b"), F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("_a") != F.col("_b"))
    )


def cross_split_leaks(df: DataFrame, checks: dict[str, Sequence[str]]) -> DataFrame:
    """Per named key: leaking keys and the rows that carry them.

    One pass over the data for all checks; first and last split per key are
    enough to tell whether there are two.
    """
    cells = F.array(*[F.struct(F.lit(n).alias("check"), digest(*k).alias("k")) for n, k in checks.items()])
    keys = df.select("split", F.inline(cells)).groupBy("check", "k").agg(
        F.min("split").alias("a"), F.max("split").alias("b"), F.count(F.lit(1)).alias("n"))
    leak = F.col("a") != F.col("b")
    return keys.groupBy("check").agg(
        F.count_if(leak).alias("leaking_keys"),
        F.coalesce(F.sum(F.when(leak, F.col("n"))), F.lit(0)).alias("rows"),
    )


def rows_for_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """All rows whose key leaks.

    The leaking keys are written first: each side of the join has an exchange
    of its own, so a key with very many rows can be split.
    """
    keyed = df.withColumn("_key", digest(*key))
    leaking = materialize(leaking_keys(df, key).select("_key"), "leaking-keys")
    return keyed.join(leaking, "_key", "left_semi").drop("_key")


def split_key_overlap(df: DataFrame, key: str) -> DataFrame:
    """Number of keys two splits have in common, for every pair that shares any.

    Per key the set of its splits is tiny; the pairs come from that set, so no
    row is ever joined with another row of the same key.
    """
    per_key = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.array_sort(F.collect_set("split")).alias("s"))
    pairs = F.flatten(F.transform("s", lambda a: F.transform(
        F.filter("s", lambda b: b > a), lambda b: F.struct(a.alias("left_split"), b.alias("right_split")))))
    return (
        per_key.filter(F.size("s") > 1).select(F.inline(pairs))
        .groupBy("left_split", "right_split").agg(F.count(F.lit(1)).alias("overlap"))
    )


def group_aware_split(
    df: DataFrame, group: str = "event_group_id", shares: Sequence[tuple[str, int]] = (("train", 14), ("valid", 3), ("test", 3)),
    out: str = "split",
) -> DataFrame:
    """Split by a hash of the group, so that a group never crosses splits."""
    total = sum(n for _, n in shares)
    spot = hash_bucket(group, total)
    chain, upto = None, 0
    for name, n in shares:
        upto += n
        chain = F.when(spot < upto, name) if chain is None else chain.when(spot < upto, name)
    return df.withColumn(out, chain)


def drop_exact_duplicates(df: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """First row of each group of equal keys.

    The rank filter is applied per task before the shuffle as well, so a group
    of copies sends at most one row per task.
    """
    w = Window.partitionBy("_key").orderBy(order)
    ranked = df.withColumn("_key", digest(*key)).withColumn("_rn", F.row_number().over(w))
    return ranked.filter("_rn = 1").drop("_rn", "_key")


def balance_train(df: DataFrame, flag: str = "alert_flag", key: str = "sample_id", seed: int = 42) -> DataFrame:
    """Train rows with the larger class cut down to the size of the smaller.

    Which rows stay is decided by their hash: the n-th smallest hash of the
    class is found exactly on counted hash prefixes, so no class is ever
    sorted in one place.
    """
    from riskloom.operators.sampling import smallest_hashes

    train = df.filter(F.col("split") == "train")
    sizes = {r[0]: r["n"] for r in train.groupBy(flag).agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return train
    n = min(sizes.values())
    parts = [
        train.filter(F.col(flag) == v) if sizes[v] == n
        else smallest_hashes(train.filter(F.col(flag) == v), n, key, seed)
        for v in sorted(sizes)
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
