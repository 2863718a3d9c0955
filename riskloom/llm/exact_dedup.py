"""Exact duplicates: group by a 128-bit content hash, compare bytes inside the groups, keep the smallest id.

DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import WHITE, text_or_empty


def normalised(text: Column) -> Column:
    """White-space runs become one space; null counts as empty."""
    return F.regexp_replace(text_or_empty(text), WHITE, " ")


def hash128(text: Column) -> Column:
    return F.unhex(F.md5(text))


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text",
                 content_hash: Callable[[Column], Column] = hash128) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    The rows of a group are counted by content hash *and* bytes, so texts that share a hash by accident fall into
    groups of their own. Counting starts in each task before the shuffle: a text with millions of copies arrives as one
    row per task, and every different text crosses the network once per task that holds it. Rows then look up their
    group by two digests, without their text; that join's sides have their own exchanges, so adaptive execution splits
    a hot group.

    Null text counts as empty, and empty texts form one group. Rows that repeat an id with the same text are counted
    one by one and share the fate of that id. A null id is never the smallest where the group has another one; a group
    of null ids alone has a null keep_id and keeps its rows. Texts are read whole, whatever their length; an empty table
    gives no rows. Other columns are not read.
    """
    rows = docs.select(F.col(key).alias("doc_id"), normalised(F.col(text)).alias("t"))
    sha = F.sha2("t", 256)
    groups = (
        rows.select("doc_id", "t", content_hash(F.col("t")).alias("h")).groupBy("h", "t")
        .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("h", F.unhex(sha).alias("s"), "keep_id", "group_size"))
    digests = rows.select("doc_id", content_hash(F.col("t")).alias("h"), F.unhex(sha).alias("s"))
    return digests.join(groups, ["h", "s"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("s")).alias("text_sha256"))


def drop_exact_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns, whatever these are called.

    Rows are told apart by id: rows that repeat a kept id all stay, also where they differ in text. Null text counts as
    empty; a null id stays only if its group has no other. An empty table stays empty.
    """
    kept = exact_groups(docs, key, text).filter("kept").select(F.col("doc_id").alias("_kept_id")).distinct()
    return docs.join(kept, docs[key].eqNullSafe(kept["_kept_id"]), "left_semi")
