"""Text features as long tables (key, term, weight), and linear scoring on them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructType

from riskloom.functions.grams import Counts, parts_of, runs, totals_of
from riskloom.functions.numbers import sigmoid
from riskloom.functions.rows import bound
from riskloom.functions.text import blanks_between, char_grams, pairs_of, text_or_empty, visible_words, words
from riskloom.session import materialize


@dataclass(frozen=True)
class Family:
    """One feature family and the limits of its vocabulary."""

    name: str
    kind: str                      # "word" or "char"
    low: int
    high: int
    min_df: int = 2
    max_df: float | None = 0.9     # share of the documents
    max_features: int | None = 30_000


WORD = Family("word", "word", 1, 2)
CHAR = Family("char", "char", 3, 5)
CHAR_ONLY = Family("char", "char", 3, 5, max_features=50_000)
# Similarity keeps every term of at least two documents.
WORD_SIMILARITY = Family("word", "word", 1, 2, max_df=None, max_features=None)
CHAR_SIMILARITY = Family("char", "char", 3, 5, max_df=None, max_features=None)


def terms_of(family: Family, text: str) -> Column:
    """All terms of a text, repeated as often as they occur."""
    if family.kind == "word":
        if not 1 <= family.low <= family.high <= 2:
            raise ValueError("word n-grams are built for n = 1 and 2")
        if family.high == 1:
            return words(text)
        return bound(words(text), lambda w: F.concat(w, pairs_of(w)) if family.low == 1 else pairs_of(w))
    return F.flatten(F.transform(visible_words(text), lambda w: char_grams(w, family.low, family.high)))


def cut(family: Family, text: str) -> Column:
    """What is cut into n-grams: the lower-cased text, for words with blanks for all that is no word."""
    if family.kind == "word":
        if not 1 <= family.low <= family.high <= 2:
            raise ValueError("word n-grams are built for n = 1 and 2")
        return blanks_between(text)
    if family.low < 2:
        raise ValueError("character n-grams are built from n = 2")
    return F.make_valid_utf8(F.lower(text_or_empty(text)))


def doc_terms(df: DataFrame, family: Family, key: str, text: str, carry: Sequence[str] = ()) -> DataFrame:
    """(key, carried columns, term, tf) of every row, counted in its task: no text and no term is shuffled for it.

    A text's terms are in memory at once, so a task needs as much as its longest text has.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, found in runs(batch, family.kind, family.low, family.high):
                kept = [part.column(i).take(pa.array(found.row)) for i in range(1, part.num_columns)]
                yield pa.RecordBatch.from_arrays([*kept, found.names.take(pa.array(found.gram)), pa.array(found.tf)], names=[key, *carry, "term", "tf"])

    rows = df.select(cut(family, text).alias("_cut"), key, *carry)
    return rows.mapInArrow(count, StructType([*rows.schema.fields[1:]]).add("term", StringType()).add("tf", LongType()))


def postings(df: DataFrame, family: Family, key: str, text: str) -> DataFrame:
    """(term, docs): the `doc_terms` of a run of rows, one row per term and run with its array of (key, tf)."""
    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, found in runs(batch, family.kind, family.low, family.high, by_gram=True):
                ends = np.concatenate([[0], np.cumsum(np.bincount(found.gram, minlength=len(found.names)))])
                docs = pa.StructArray.from_arrays([part.column(1).take(pa.array(found.row)), pa.array(found.tf)], names=[key, "tf"])
                yield pa.RecordBatch.from_arrays([found.names, pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), docs)], names=["term", "docs"])

    rows = df.select(cut(family, text).alias("_cut"), key)
    held = StructType([rows.schema.fields[1]]).add("tf", LongType())
    return rows.mapInArrow(group, StructType().add("term", StringType()).add("docs", ArrayType(held)))


def term_counts(df: DataFrame, family: Family, text: str, copies: str | None = None) -> DataFrame:
    """(term, df, docs, total): rows with the term, each counted as often as ``copies`` says, rows as they stand, occurrences.

    Terms are counted per run of rows in the task, so what is shuffled is partial counts.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts_of(batch):
                names, *sums = totals_of(part.column(0), family.kind, family.low, family.high, part.column(1).to_numpy())
                yield pa.RecordBatch.from_arrays([names, *map(pa.array, sums)], names=["term", "df", "docs", "total"])

    rows = df.select(cut(family, text).alias("_cut"), (F.lit(1) if copies is None else F.col(copies)).cast("long").alias("_n"))
    return rows.mapInArrow(count, "term string, df long, docs long, total long").groupBy("term").agg(
        F.sum("df").alias("df"), F.sum("docs").alias("docs"), F.sum("total").alias("total"))


def word_ngrams(df: DataFrame, key: str, text: str, low: int = 1, high: int = 2) -> DataFrame:
    return doc_terms(df, Family("word", "word", low, high), key, text)


def char_wb_ngrams(df: DataFrame, key: str, text: str, low: int = 3, high: int = 5) -> DataFrame:
    return doc_terms(df, Family("char", "char", low, high), key, text)


def idf(n_docs: Column, df: Column) -> Column:
    return F.log((1 + n_docs) / (1 + df)) + 1


def fit_vocabulary(terms: DataFrame, n_docs: Column, family: Family) -> DataFrame:
    """(term, df, total, idf): frequent enough, not too common, most frequent first.

    ``n_docs`` is the number of documents as a column, e.g. a scalar subquery.
    """
    return pick_vocabulary(terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total")), n_docs, family)


def vocabulary_of(df: DataFrame, family: Family, text: str) -> DataFrame:
    """`fit_vocabulary` of the texts of a frame."""
    return pick_vocabulary(term_counts(df, family, text).drop("docs"), document_count(df), family)


def pick_vocabulary(counts: DataFrame, n_docs: Column, family: Family) -> DataFrame:
    """The vocabulary from the counts (term, df, total) of all terms."""
    vocab = counts.filter(F.col("df") >= family.min_df)
    if family.max_df is not None:
        vocab = vocab.filter(F.col("df") <= F.lit(family.max_df) * n_docs)
    if family.max_features is not None:
        vocab = vocab.orderBy(F.desc("total"), "term").limit(family.max_features)
    return vocab.withColumn("idf", idf(n_docs, F.col("df")))


def document_count(df: DataFrame) -> Column:
    return df.agg(F.count(F.lit(1))).scalar()


def tfidf(terms: DataFrame, vocab: DataFrame, key: str) -> DataFrame:
    """(key, term, weight) with unit length per document. Adaptive execution broadcasts a vocabulary that is small when built."""
    raw = terms.join(vocab.select("term", "idf"), "term").withColumn("_w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(key)))
    return raw.withColumn("weight", F.col("_w") / norm).select(key, "term", "weight")


def raw_weights(found: Counts, terms: pa.Array, idf_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, number of the term, tf times idf) of the counted terms that are among ``terms``."""
    place = pc.fill_null(pc.index_in(found.names, value_set=terms), -1).to_numpy()[found.gram]
    row, place, tf = found.row[place >= 0], place[place >= 0], found.tf[place >= 0]
    return row, place, tf * idf_of[place]


def weigh(found: Counts, terms: pa.Array, idf_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, number of the term, weight) with unit length per row."""
    row, place, raw = raw_weights(found, terms, idf_of)
    return row, place, raw / np.sqrt(np.bincount(row, raw * raw))[row]


def tfidf_of(df: DataFrame, vocab: DataFrame, family: Family, key: str, text: str) -> DataFrame:
    """`tfidf` of the texts of a frame, inside the tasks: every row is weighted where it lies.

    The vocabulary comes to the driver and to every task, so the family must limit it. Rows that repeat a key are one
    document, whose length is added up over them; only their squares are shuffled for that.
    """
    if family.max_features is None:
        raise ValueError("a vocabulary without limit is joined")
    known = vocab.select("term", "idf").collect()  # at most max_features rows
    names, idfs = [r.term for r in known], [r.idf for r in known]

    def weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, idf_of = pa.array(names, pa.string()), np.asarray(idfs, float)
        for batch in batches:
            for part, found in runs(batch, family.kind, family.low, family.high):
                row, place, raw = raw_weights(found, terms, idf_of)
                yield pa.RecordBatch.from_arrays(
                    [part.column(1).take(pa.array(row)), terms.take(pa.array(place)), pa.array(raw), pa.array(np.bincount(row, raw * raw)[row])],
                    names=[key, "term", "_w", "_square"])

    def weighted(rows: DataFrame) -> DataFrame:
        rows = rows.select(cut(family, text).alias("_cut"), key)
        kind = StructType([*rows.schema.fields[1:]]).add("term", StringType()).add("_w", DoubleType()).add("_square", DoubleType())
        return rows.mapInArrow(weights, kind)

    again = materialize(df.groupBy(F.col(key).alias("_key")).count().where("count > 1").select("_key"), "repeated-keys")
    repeats = df.join(again, F.col(key).eqNullSafe(F.col("_key")), "left_semi")
    whole = materialize(weighted(repeats).groupBy(F.col(key).alias("_key")).agg(F.sum(F.col("_w") * F.col("_w")).alias("_whole")), "repeated-lengths")
    rows = weighted(df).join(whole, F.col(key).eqNullSafe(F.col("_key")), "left")
    return rows.select(key, "term", (F.col("_w") / F.sqrt(F.coalesce("_whole", "_square"))).alias("weight"))


def fit_transform(df: DataFrame, family: Family, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    vocab = materialize(vocabulary_of(df, family, text), "vocabulary")
    if family.max_features is None:
        return vocab, tfidf(doc_terms(df, family, key, text), vocab, key)
    return vocab, tfidf_of(df, vocab, family, key, text)


def feature_union(*blocks: tuple[str, DataFrame]) -> DataFrame:
    """Independently normalised blocks side by side: (key, family, term, weight)."""
    out = None
    for name, block in blocks:
        tagged = block.withColumn("family", F.lit(name))
        out = tagged if out is None else out.unionByName(tagged)
    return out


FAMILIES_BY_NAME = {"word": WORD, "char": CHAR}


def score_linear_joined(df: DataFrame, model, key: str, text: str, out: str = "score") -> DataFrame:
    """Probability of the positive class by joining terms with weights, for models too large to broadcast.

    Per family one aggregate gives both the weighted sum and the length of the document vector. A term meets its weight
    once per run of rows, with the keys and counts of these rows (`postings`); only that is shuffled until the sums go
    back to the rows. A text without known terms gets the intercept. The weights are written first: from the size of the
    file Spark knows whether the terms must be shuffled to meet them.
    """
    sums, known = None, materialize(model.weights.select("family", "term", "idf", "coef"), "weights")
    for name in sorted(model.meta.get("families", "word,char").split(",")):
        family = FAMILIES_BY_NAME[name]
        weights = known.filter(F.col("family") == name).select("term", "idf", "coef")
        w = F.col("tf") * F.col("idf")
        part = (
            postings(df, family, key, text).join(weights, "term").select("idf", "coef", F.inline("docs")).groupBy(key)
            .agg((F.sum(w * F.col("coef")) / F.sqrt(F.sum(w * w))).alias("_z"))
        )
        sums = part if sums is None else sums.unionByName(part)
    z = sums.groupBy(key).agg(F.sum("_z").alias("_z"))
    return df.join(z, key, "left").withColumn(out, sigmoid(F.coalesce("_z", F.lit(0.0)) + F.lit(float(model.intercept)))).drop("_z")
