"""Text expressions. All are built-in Spark expressions, no Python per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.functions.rows import bound

# White space as Unicode sees it (the `trim` of SQL only knows the blank).
SPACE = r"[\s\p{Z}\x0B\x1C-\x1F\x85]"
NOT_SPACE = r"[^\s\p{Z}\x0B\x1C-\x1F\x85]"
# Words: two or more letters, digits or underscores, in any script.
WORD = r"[\p{L}\p{N}_]{2,}"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_or_empty(c: Column | str) -> Column:
    return F.coalesce(col(c).cast("string"), F.lit(""))


def trim_ws(c: Column | str) -> Column:
    return F.regexp_replace(col(c), f"^{SPACE}+|{SPACE}+$", "")


def is_blank(c: Column | str) -> Column:
    """Null, empty or white space only; stops at the first visible character."""
    return ~text_or_empty(c).rlike(NOT_SPACE)


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(col(c), F.lit(""))


def model_text(title="title", entity="entity_norm", fragment="text_fragment") -> Column:
    """Model input: title, entity and fragment on separate lines."""
    nl = F.lit("\n")
    return F.concat(text_or_empty(title), nl, text_or_empty(entity), nl, text_or_empty(fragment))


def model_text_spaced(title="title", fragment="text_fragment", entity="entity_norm") -> Column:
    """Input of the earlier models: other column order, joined by blanks."""
    sp = F.lit(" ")
    return F.concat(text_or_empty(title), sp, text_or_empty(fragment), sp, text_or_empty(entity))


def title_and_fragment(title="title", fragment="text_fragment") -> Column:
    return F.concat(text_or_empty(title), F.lit(" "), text_or_empty(fragment))


def compare_text(c: Column | str) -> Column:
    return F.translate(F.lower(col(c)), "ё", "е")


def char_count(c: Column | str) -> Column:
    return F.length(text_or_empty(c))


def word_count(c: Column | str) -> Column:
    return F.regexp_count(text_or_empty(c), F.lit(f"{NOT_SPACE}+"))


def keyword_array(c: Column | str) -> Column:
    parts = F.transform(F.split(text_or_empty(c), ";"), trim_ws)
    return F.filter(parts, lambda x: x != "")


def keyword_count(c: Column | str) -> Column:
    return F.size(keyword_array(c))


def words(c: Column | str) -> Column:
    return F.regexp_extract_all(F.lower(text_or_empty(c)), F.lit(f"({WORD})"), F.lit(1))


def blanks_between(c: Column | str) -> Column:
    """The lower-cased text with a blank for what is neither letter, digit nor underscore; pieces of two and more are its `words`."""
    return F.regexp_replace(F.lower(text_or_empty(c)), r"[^\p{L}\p{N}_]+", " ")


def pairs_of(tokens: Column) -> Column:
    """Neighbouring tokens joined by a blank."""
    n = F.greatest(F.size(tokens) - 1, F.lit(0))
    return F.zip_with(
        F.slice(tokens, F.lit(1), n), F.slice(tokens, F.lit(2), n),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )


def visible_words(c: Column | str) -> Column:
    """Lower-cased pieces between white space."""
    return F.regexp_extract_all(F.lower(text_or_empty(c)), F.lit(f"({NOT_SPACE}+)"), F.lit(1))


def char_grams(word: Column, low: int, high: int) -> Column:
    """Character n-grams of one blank-padded word, as an array. A word shorter than n has none of that size."""
    def cut(padded: Column) -> Column:
        return F.flatten(F.transform(
            F.filter(F.sequence(F.lit(low), F.lit(high)), lambda n: n <= F.length(padded)),
            lambda n: F.transform(F.sequence(F.lit(1), F.length(padded) - n + 1), lambda i: F.substring(padded, i, n)),
        ))

    return bound(F.concat(F.lit(" "), word, F.lit(" ")), cut)


def counted(terms: Column) -> Column:
    """(term, tf) of the different strings of an array, inside the row: sorted, then cut where neighbours differ."""
    def runs(a: Column) -> Column:
        places = F.when(F.size(a) > 0, F.sequence(F.lit(0), F.size(a) - 1)).otherwise(F.array().cast("array<int>"))
        starts = F.filter(places, lambda i: (i == 0) | (F.get(a, i) != F.get(a, i - 1)))
        return bound(starts, lambda s: F.transform(s, lambda at, k: F.struct(
            F.get(a, at).alias("term"), (F.coalesce(F.get(s, k + 1), F.size(a)) - at).cast("long").alias("tf"))))

    return bound(F.sort_array(terms), runs)


def digest(*cols: Column | str) -> Column:
    """Fixed-size stand-in for a tuple of values, null kept apart from "".

    Used as grouping key so that long texts are not shuffled.
    """
    return F.sha2(F.to_json(F.struct(*[col(c).cast("string").alias(f"k{i}") for i, c in enumerate(cols)])), 256)


def hash_bucket(c: Column | str, buckets: int) -> Column:
    """Reproducible bucket of a value, the same in any engine with md5."""
    head = F.substring(F.md5(col(c).cast("string")), 1, 7)
    return F.conv(head, 16, 10).cast("long") % buckets
