"""Near duplicates by a signature-coordinate inverted join, confirmed on full shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import mix, shingle_hashes, slices, text_or_empty, utf8_bytes, word_hashes
from riskloom.session import materialize

#: Shingles of so many words; links from so many per cent of similarity.
WORDS, PER_CENT = 4, 80
#: A pair of similarity 0.8 agrees in fewer than MATCHES of COORDINATES coordinates once in about 800,000 cases.
COORDINATES, MATCHES = 32, 14

_RNG = np.random.default_rng(20240)
_FLIP = _RNG.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)
_TURN = _RNG.integers(0, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def shingle_sets(texts: pa.Array, words: int = WORDS) -> list[np.ndarray]:
    """The ascending distinct 64-bit shingle hashes of each text; a text without words has none."""
    hashes, counts = word_hashes(*utf8_bytes(texts))
    shingles, made = shingle_hashes(hashes, counts, words)
    stop = np.cumsum(made)
    return [np.unique(shingles[b - n:b]) for b, n in zip(stop.tolist(), made.tolist())]


def sketches(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, a 128-bit key of the shingle set, and the signature: per coordinate the least permuted hash."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = shingle_sets(batch.column(1), words)
            size = np.array([len(s) for s in sets], np.int64)
            flat = np.concatenate([s for s in sets if len(s)] or [np.zeros(0, np.uint64)])
            begin = (np.cumsum(size) - size)[size > 0]
            low = np.zeros((COORDINATES, len(begin)), np.uint32)
            one, two = np.zeros(len(sets), np.uint64), np.zeros(len(sets), np.uint64)
            if len(begin):
                for j in range(COORDINATES):
                    low[j] = np.minimum.reduceat((flat ^ _FLIP[j]) * _TURN[j], begin) >> np.uint64(32)
                one[size > 0] = np.add.reduceat(flat, begin)
                two[size > 0] = np.bitwise_xor.reduceat(mix(flat), begin)
            signature = np.full(len(sets), None, object)
            signature[size > 0] = [r.tobytes() for r in low.T.copy()]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "n_shingles": pa.array(size), "set_1": pa.array(_signed(one)),
                "set_2": pa.array(_signed(two)), "signature": pa.array(signature.tolist(), pa.binary())})

    return docs.select(F.col(key).cast("long").alias("doc_id"), text_or_empty(F.col(text)).alias("text")).mapInArrow(
        rows, "doc_id long, n_shingles long, set_1 long, set_2 long, signature binary")


def postings(reps: DataFrame) -> DataFrame:
    """One row per document and coordinate: (coordinate, value) as one number, document, set size."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 5000):
                part = batch.slice(at, 5000)
                low = np.frombuffer(b"".join(part.column(2).to_pylist()), np.uint32).reshape(-1, COORDINATES)
                keys = (np.arange(COORDINATES, dtype=np.int64) << 32) + low
                yield pa.RecordBatch.from_pydict({
                    "coordinate": pa.array(keys.ravel()), "rep": pa.array(np.repeat(part.column(0).to_numpy(), COORDINATES)),
                    "n": pa.array(np.repeat(part.column(1).to_numpy(), COORDINATES))})

    return reps.select("rep", "n", "signature").mapInArrow(rows, "coordinate long, rep long, n long")


def _sizes_allow(n, m, per_cent: int):
    return F.lit(100) * F.least(n, m) >= F.lit(per_cent) * F.greatest(n, m)


def _with_matches(pairs: DataFrame, reps: DataFrame, least: int) -> DataFrame:
    """The pairs (a, b) whose signatures agree in at least `least` coordinates."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint32).reshape(-1, COORDINATES) for i in (2, 3))
            yield batch.select([0, 1]).filter(pa.array((left == right).sum(axis=1) >= least))

    both = pairs.join(reps.select(F.col("rep").alias("a"), F.col("signature").alias("left")), "a").join(
        reps.select(F.col("rep").alias("b"), F.col("signature").alias("right")), "b")
    return both.select("a", "b", "left", "right").mapInArrow(rows, "a long, b long")


#: Bits per id of the filter that picks texts by id, and its size in bits at most; for more ids texts are joined by id.
BITS_PER_ID, MOST_BITS = 16, 1 << 27
#: Rows of one shingle that are compared with each other in one task.
BLOCK = 2_000


def _sets_of(ids: DataFrame, docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """(id, set) for the ids of a one-column table, and for a few others.

    Up to MOST_BITS / BITS_PER_ID ids, texts are not shuffled for it: a bitmap of hashed ids, sized by their number, goes
    to the tasks that scan the texts. More ids than that meet the texts in a join.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), text_or_empty(F.col(text)).alias("text")).where("doc_id is not null")
    ids = ids.where(F.col(ids.columns[0]).isNotNull()).distinct()
    count = ids.count()
    if count * BITS_PER_ID > MOST_BITS:
        wanted = materialize(ids, "wanted")
        joined = rows.join(wanted, rows["doc_id"] == wanted[wanted.columns[0]], "left_semi")

        def every(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text"):
                found = [s.tobytes() for s in shingle_sets(batch.column(1), words)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["id", "set"])

        return materialize(joined.mapInArrow(every, "id long, set binary"), "shingle-sets")
    filter_bits = 1 << max(20, (count * BITS_PER_ID - 1).bit_length())
    bit = F.pmod(F.xxhash64(ids.columns[0]), F.lit(filter_bits)) + 1
    parts = ids.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).collect()
    bits = np.zeros(filter_bits // 8 + 4096, np.uint8)
    for r in parts:
        bits[(r["part"] - 1) * 4096:r["part"] * 4096] = np.frombuffer(r["bits"], np.uint8)
    # bits and buckets count from 1 (a bit 0 would lie in a bucket 0); a bucket number tells the same position for a bit wherever it is asked
    spot = F.pmod(F.xxhash64("doc_id"), F.lit(filter_bits)) + 1
    rows = rows.withColumn("spot", (F.bitmap_bucket_number(spot) - 1) * 32768 + F.bitmap_bit_position(spot))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            spots = batch.column(2).to_numpy()
            wanted = batch.filter(pa.array((bits[spots >> 3] >> (spots & 7).astype(np.uint8)) & 1 == 1))
            if wanted.num_rows:
                found = [s.tobytes() for s in shingle_sets(wanted.column(1), words)]
                yield pa.RecordBatch.from_arrays([wanted.column(0), pa.array(found, pa.binary())], names=["id", "set"])

    return materialize(rows.mapInArrow(sets, "id long, set binary"), "shingle-sets")


def _confirmed(pairs: DataFrame, held: DataFrame, per_cent: int) -> DataFrame:
    """The pairs whose full shingle sets reach the similarity."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "left"):
            keep = []
            for left, right in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
                same = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * same >= per_cent * (len(x) + len(y) - same))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(held.select(F.col("id").alias("a"), F.col("set").alias("left")), "a").join(
        held.select(F.col("id").alias("b"), F.col("set").alias("right")), "b")
    return both.select("a", "b", "left", "right").mapInArrow(check, "a long, b long")


def _crossing_pairs(suspects: DataFrame, held: DataFrame, per_cent: int) -> DataFrame:
    """Pairs (a, b) of suspects (rep, n, of) of different groups `of` that can reach the similarity.

    A suspect's shingles are ordered by the number of groups that share them. Linked sets share one of the first
    n - 0.8 n + 1 (of n), and from the first one they share on, what is left of both must suffice. A passage that many
    suspects share stands at the end of that order, so it forms no pairs unless it is nearly the whole of both texts.
    """
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "set"):
            sets = [np.frombuffer(s, np.int64) for s in batch.column(3).to_pylist()]
            size = [len(s) for s in sets]
            columns = [pa.array(np.repeat(batch.column(i).to_numpy(), size)) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.concatenate(sets))], names=["rep", "n", "of", "shingle"])

    own = suspects.join(held, F.col("rep") == F.col("id")).select("rep", "n", "of", "set").dropDuplicates(["rep"])
    terms = materialize(own.mapInArrow(spread, "rep long, n long, of long, shingle long"), "terms")
    sharers = terms.groupBy("shingle", "of").agg(F.count(F.lit(1)).alias("k")).groupBy("shingle").agg(
        F.count(F.lit(1)).alias("sharers")).where("sharers > 1")
    shared = terms.join(materialize(sharers, "sharers"), "shingle")
    shared = shared.withColumn("at", F.row_number().over(Window.partitionBy("rep").orderBy("sharers", "shingle"))).withColumn(
        "all", F.count(F.lit(1)).over(Window.partitionBy("rep")))
    place = F.col("n") - F.col("all") + F.col("at") - 1
    first = shared.withColumn("place", place).where(
        (F.col("all") * 100 >= F.col("n") * per_cent) & (F.col("place") * 100 <= F.col("n") * (100 - per_cent)))
    first = materialize(first.select("shingle", "rep", "n", "of", "place"), "prefix")
    # the rows of a frequent shingle are dealt over pairs of blocks, so that no task compares all of them
    hot = first.groupBy("shingle").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > BLOCK)
    hot = materialize(hot.select(F.col("shingle").alias("hot"), F.ceil(F.col("rows") / BLOCK).cast("int").alias("blocks")), "hot-shingles")
    cut = first.join(hot, F.col("shingle") == F.col("hot"), "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    cut = cut.withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    left = cut.select("shingle", F.col("own").alias("i"), F.explode(F.sequence("own", F.col("blocks") - 1)).alias("j"),
                      F.col("rep").alias("a"), F.col("n").alias("na"), F.col("of").alias("oa"), F.col("place").alias("pa"))
    right = cut.select(F.col("shingle").alias("s"), F.explode(F.sequence(F.lit(0), "own")).alias("k"), F.col("own").alias("l"),
                       F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("of").alias("ob"), F.col("place").alias("pb"))
    most = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
    enough = most * (100 + per_cent) >= (F.col("na") + F.col("nb")) * per_cent
    same = (F.col("shingle") == F.col("s")) & (F.col("i") == F.col("k")) & (F.col("j") == F.col("l"))
    once = (F.col("i") < F.col("j")) | (F.col("a") < F.col("b"))
    met = left.join(right, same & once & (F.col("oa") != F.col("ob")) & enough)
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component), the smallest node each node can reach.

    Nodes hand the least node they see first to their larger, then to their smaller neighbours, until every node has one
    link, to a node without smaller ones. The least nodes are written before they are joined, so each side of a join has
    an exchange of its own and a node with very many links is split.
    """
    now = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")

    def settled(edges: DataFrame) -> bool:
        ends = edges.select(F.col("u").alias("node"), "v").unionByName(
            edges.select(F.col("v").alias("node"), F.lit(None).cast("long").alias("v")))
        seen = ends.groupBy("node").agg(F.min("v").alias("low"), F.max("v").alias("high"), F.max(F.col("v").isNull()).alias("least"))
        return seen.where((F.col("low") != F.col("high")) | (F.col("low").isNotNull() & F.col("least"))).isEmpty()

    while not settled(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = materialize(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "least")
        up = materialize(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")), "links")
        low = materialize(up.groupBy("u").agg(F.min("v").alias("m")), "least")
        down = up.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        now = materialize(down, "links")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, per_cent: int = PER_CENT,
                    matches: int = MATCHES) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    1. Documents of equal shingle set become one class. Every class is posted under each of its coordinate values.
    2. Each class is compared with the least class of every list it is in. That is one pair per posting, however long
       the list, and joins dense groups of copies without listing their pairs.
    3. Lists that still hold several groups are counted. Only a class that is in `matches` of them can agree with a class
       of another group in so many coordinates; these few are paired by the rarest of their shingles, with the lists
       that common passages fill skipped (`_crossing_pairs`). Every pair of different groups that can reach the
       similarity is formed.
    4. Pairs over the match threshold are confirmed on their full sets; their links join the groups.

    Null text counts as empty. A text without words is linked with nothing and is its own component; so is a row with a
    null id, whose component is null. Repeated rows share their class; an id with several texts joins their groups. An
    empty table gives no rows. Other columns are not read.
    """
    sketch = materialize(sketches(docs, key, text, words), "sketches")
    some = sketch.where("n_shingles > 0 and doc_id is not null")
    classes = materialize(some.groupBy("set_1", "set_2", "n_shingles").agg(F.min("doc_id").alias("rep")), "classes")
    heads = classes.select("rep", F.col("set_1").alias("s1"), F.col("set_2").alias("s2"))
    reps = some.join(heads, (F.col("doc_id") == F.col("rep")) & (F.col("set_1") == F.col("s1")) & (F.col("set_2") == F.col("s2")))
    reps = materialize(reps.select("rep", F.col("n_shingles").alias("n"), "signature").dropDuplicates(["rep"]), "reps")

    posted = postings(reps)
    lists = posted.groupBy("coordinate").agg(F.count(F.lit(1)).alias("long"), F.min("rep").alias("pivot")).where("long > 1")
    lists = materialize(lists.select("coordinate", "pivot"), "lists")
    shared = materialize(posted.join(lists, "coordinate"), "shared")

    stars = shared.where("rep <> pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b"), "n").distinct()
    sizes = reps.select(F.col("rep").alias("a"), F.col("n").alias("na"))
    stars = materialize(stars, "stars").join(sizes, "a").where(_sizes_allow(F.col("n"), F.col("na"), per_cent)).select("a", "b")
    first = materialize(_with_matches(stars, reps, matches), "candidates")
    ends = first.select("a").union(first.select("b")).distinct()
    links = materialize(_confirmed(first, _sets_of(ends, docs, key, text, words), per_cent), "links")
    groups = materialize(components(links), "groups")

    labelled = shared.select("coordinate", "rep", "n").join(groups.select(F.col("node").alias("rep"), "component"), "rep", "left")
    labelled = materialize(labelled.select("coordinate", "rep", "n", F.coalesce("component", "rep").alias("of")), "labelled")
    mixed = labelled.groupBy("coordinate", "of").agg(F.count(F.lit(1)).alias("k")).groupBy("coordinate").agg(
        F.count(F.lit(1)).alias("sharers")).where("sharers > 1")
    crossing = labelled.join(materialize(mixed, "mixed"), "coordinate")
    suspects = crossing.groupBy("rep", "n", "of").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") >= matches)
    suspects = materialize(suspects.select("rep", "n", "of"), "suspects")
    held = _sets_of(suspects.select("rep"), docs, key, text, words)
    met = materialize(_crossing_pairs(suspects, held, per_cent), "met")
    second = materialize(_with_matches(met, reps, matches), "candidates")
    more = materialize(_confirmed(second, held, per_cent), "links")
    for end in ("a", "b"):
        names = groups.select(F.col("node").alias(end), F.col("component").alias("of"))
        more = more.join(names, end, "left").withColumn(end, F.coalesce("of", end)).drop("of")
    merged = components(more).select(F.col("node").alias("from"), F.col("component").alias("into"))

    found = classes.join(groups, F.col("rep") == F.col("node"), "left").withColumn("of", F.coalesce("component", "rep"))
    found = found.join(merged, F.col("of") == F.col("from"), "left").select(
        F.col("set_1").alias("s1"), F.col("set_2").alias("s2"), F.col("n_shingles").alias("ns"), F.coalesce("into", "of").alias("of"))
    found = materialize(found, "class-groups")
    joined = sketch.select("doc_id", "n_shingles", "set_1", "set_2").join(
        found, (F.col("set_1") == F.col("s1")) & (F.col("set_2") == F.col("s2")) & (F.col("n_shingles") == F.col("ns")), "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("of")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"),
                         F.col("doc_id").eqNullSafe(component).alias("kept"))


def drop_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group, with all columns, whatever these are called.

    Rows are told apart by id, so rows that repeat an id share its fate. Texts without words, null ones too, and rows
    with a null id stay. An empty table stays empty.
    """
    gone = near_duplicates(docs, key, text).where("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs[key].eqNullSafe(gone["_gone"]), "left_anti")
