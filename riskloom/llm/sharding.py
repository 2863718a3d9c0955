"""Shard assignment by a hierarchical weighted hash tree: region, then rack, then shard."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import gapless_rank, text_or_empty

#: regions -> racks -> (shard, weight)
Tree = list[list[list[tuple[int, float]]]]


def shard_tree(shards: int, regions: int = 2, racks: int = 3, base: int = 24) -> Tree:
    """A tree of equal shards. The first `base` shards fill the regions and racks; each further one opens a region of its own.

    A shard added to an existing rack would also draw rows into its neighbours there, as the weights of its region and
    rack grow. In a region of its own it takes rows from every other region, and gives them to nobody else.
    """
    first = min(shards, base)
    slots = regions * racks
    cut = [first * i // slots for i in range(slots + 1)]
    nodes = [[(s, 1.0) for s in range(cut[i], cut[i + 1])] for i in range(slots)]
    tree = [[rack for rack in nodes[r * racks:(r + 1) * racks] if rack] for r in range(regions)]
    return [r for r in tree if r] + [[[(s, 1.0)]] for s in range(first, shards)]


def _weight(node) -> float:
    return float(node[1]) if isinstance(node, tuple) else sum(map(_weight, node))


def _draw(key: Column, path: tuple[int, ...], weight: float) -> Column:
    """An exponential variable of rate `weight`, given by the key and the node's place alone."""
    bits = F.shiftrightunsigned(F.xxhash64(key, *[F.lit(p) for p in path]), 11)
    return -F.log((bits + 1) / F.lit(float(2**53))) / F.lit(weight)


def _descend(key: Column, node, path: tuple[int, ...]) -> Column:
    if isinstance(node, tuple):
        return F.lit(int(node[0]))
    inside = [_descend(key, child, (*path, i)) for i, child in enumerate(node)]
    if len(node) == 1:
        return inside[0]
    draws = [F.struct(_draw(key, (*path, i), _weight(child)).alias("d"), F.lit(i).alias("i")) for i, child in enumerate(node)]
    winner = F.least(*draws)["i"]
    return reduce(lambda rest, i: F.when(winner == i, inside[i]).otherwise(rest), range(len(node) - 1), inside[-1])


def shard_of(key: Column, tree: Tree) -> Column:
    """The shard of a key: at each level the child with the smallest draw wins; a child of weight w wins in proportion to w.

    A draw depends on the key and its own node only. Changing a weight changes no other node's draw, so rows move only
    between a subtree whose weight changed and its siblings.
    """
    return _descend(key, tree, ())


def assign_shards(docs: DataFrame, shards: int = 24, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, law `key`, shard, slot, grown_shard.

    The id and the number of shards decide alone. Slots number the rows of a shard from 0 without gaps; rows of equal
    id and text are interchangeable. Null text has size 8 and the checksum of no bytes; null ids share one shard (they
    are one key). The text itself, however long, is not shuffled, and no shard is gathered in one task (`gapless_rank`).
    An empty table gives no rows. Other columns are not read.
    """
    body = text_or_empty(F.col(text))
    id_ = F.col(key)
    rows = docs.select(
        id_.alias("doc_id"), (F.octet_length(body) + 8).cast("long").alias("size"), F.crc32(body).alias("text_crc32"),
        F.lit("key").alias("law"), shard_of(id_, shard_tree(shards)).alias("shard"),
        shard_of(id_, shard_tree(shards + 1)).alias("grown_shard"))
    ranked = gapless_rank(rows, ["shard"], ["doc_id", "text_crc32"], "slot", docs.count())
    return ranked.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
