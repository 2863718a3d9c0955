"""Benchmark decontamination by template canonicalisation. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import text_or_empty
from riskloom.session import materialize

WINDOW = 6
#: So many windows in one alignment make a leak, or half of the item's windows if it has fewer than twice as many.
LEAST_WINDOWS = 8
#: Documents are first searched for pieces of windows that begin at every so many words.
PROBE_STEP = 3

TYPED, PLAIN, RUNS = 0, 1, 2
NUMBER, UNIT, NAME, CAPITAL = "\u0001", "\u0002", "\u0003", "\u0004"
UNITS = ["mm", "cm", "m", "km", "in", "inch", "inches", "ft", "feet", "foot", "yd", "yards", "mile", "miles", "mg", "g", "kg", "oz",
         "lb", "lbs", "pounds", "tons", "ml", "l", "litre", "litres", "liter", "liters", "gallon", "gallons", "second", "seconds",
         "minute", "minutes", "hour", "hours", "day", "days", "week", "weeks", "month", "months", "year", "years", "cent", "cents",
         "dollar", "dollars", "euro", "euros", "percent", "degrees", "mph", "kmh", "watts", "volts"]


def _plain(text: Column) -> Column:
    """Lower-case words and numbers between single spaces. A capitalised word inside a sentence is marked as a name, another as capital.

    Patterns start with what is rare and look behind from there, so that most places fail at their first character.
    """
    capital = F.regexp_replace(text, "\\p{Lu}(?<![\\p{L}\\p{N}]\\p{Lu})(?=\\p{Ll})", f"{CAPITAL}$0")
    named = F.regexp_replace(capital, f"{CAPITAL}(?<=[\\p{{Ll}}\\d,;] {CAPITAL})", NAME)
    whole = F.regexp_replace(named, "[.,](?<=\\d[.,])(?=\\d)", "·")
    return F.trim(F.regexp_replace(F.lower(whole), f"[^\\p{{L}}\\p{{N}}{NAME}{CAPITAL}·]+", " "))


def _counted(plain: Column) -> Column:
    return F.regexp_replace(plain, "\\d(?<![^ ]\\d)[\\d·]*+(?![^ ])", NUMBER)


def _measured(counted: Column) -> Column:
    return F.regexp_replace(counted, f"{NUMBER} (?:{'|'.join(UNITS)})(?![^ ])", f"{NUMBER} {UNIT}")


def _without(joined: Column, mark: str) -> Column:
    return F.replace(joined, F.lit(mark), F.lit(""))


def _raw(plain: Column) -> Column:
    return _without(_without(plain, NAME), CAPITAL)


def _words(joined: Column) -> Column:
    """The words; of an empty text one empty word, which fills no window."""
    return F.split(joined, " ")


def _literal(words: Column) -> Column:
    """Words of a window that are no placeholders; at least half must be, or chance would match."""
    return F.size(F.filter(words, lambda w: ~w.isin(NUMBER, UNIT, NAME))) * 2 >= F.size(words)


def _templates(plain: Column, counted: Column) -> list[Column]:
    """The words that must agree, in the three forms TYPED, PLAIN and RUNS.

    In RUNS every capitalised word counts as a name, at the start of a sentence or a line too, and a run of them is one word.
    """
    typed = F.regexp_replace(_without(counted, CAPITAL), f"{NAME}(?<![^ ]{NAME})[^ ]+", NAME)
    runs = F.regexp_replace(F.replace(counted, F.lit(CAPITAL), F.lit(NAME)), f"{NAME}(?<![^ ]{NAME})[^ ]+(?: {NAME}[^ ]+)*+", NAME)
    return [_words(_measured(typed)), _words(_raw(plain)), _words(_measured(runs))]


def _forms(plain: Column, counted: Column) -> Column:
    """The forms in which a text is compared: their number, the words that must agree and the words behind them."""
    raw = _words(_raw(plain))
    joined = F.regexp_replace(F.replace(plain, F.lit(CAPITAL), F.lit(NAME)), f"{NAME}(?<![^ ]{NAME})([^ ]+) (?={NAME})", f"{NAME}$1_")
    typed, literal, runs = _templates(plain, counted)
    return F.array(
        F.struct(F.lit(TYPED).alias("form"), typed.alias("template"), raw.alias("raw")),
        F.struct(F.lit(PLAIN).alias("form"), literal.alias("template"), raw.alias("raw")),
        F.struct(F.lit(RUNS).alias("form"), runs.alias("template"), _words(_raw(joined)).alias("raw")))


def _prepared(source: DataFrame, key: str, text: str, *more: str) -> DataFrame:
    """key, plain, counted: one column after the other, so that each is computed once for all that use it."""
    return source.select(F.col(key).cast("long").alias("key"), _plain(text_or_empty(F.col(text))).alias("plain"), *more).where(
        "key is not null").select("key", "plain", _counted(F.col("plain")).alias("counted"), *more)


def _places(template: str, size: int, step: int = 1) -> str:
    return f"CASE WHEN size({template}) >= {size} THEN sequence(1, size({template}) - {size - 1}, {step}) ELSE array() END"


def _inlined(source: DataFrame, *more: str) -> DataFrame:
    """key, form, template, raw. The outer forms of inline and explode, here and below, keep the optimizer from testing for
    empty arrays beforehand, which would compute the arrays twice."""
    return source.select("key", *more, F.inline_outer(_forms(F.col("plain"), F.col("counted"))))


def _windows(source: DataFrame, size: int) -> DataFrame:
    """key, form, place, window, its hash and the words behind it, at every place."""
    rows = _inlined(source).select("key", "form", F.posexplode_outer(F.expr(
        f"transform({_places('template', size)}, i -> struct(slice(template, i, {size}) AS template, slice(raw, i, {size}) AS raw))")).alias("place", "w"))
    return rows.where("place is not null").select(
        "key", "form", "place", F.xxhash64("form", "w.template").alias("h"), F.col("w.template").alias("template"), F.col("w.raw").alias("raw"))


def _probe(size: int) -> tuple[int, int]:
    """Length and step of probes. Every window of `size` words holds one whole probe, wherever it begins."""
    step = min(PROBE_STEP, size)
    return size - step + 1, step


def _hashes(source: DataFrame, size: int) -> DataFrame:
    """key, h of the different probes of a text; the words behind the placeholders are not made."""
    length, step = _probe(size)
    forms = [F.struct(F.lit(i).alias("form"), t.alias("template")) for i, t in enumerate(_templates(F.col("plain"), F.col("counted")))]
    return source.select("key", F.array(*forms).alias("forms")).select("key", F.explode_outer(F.expr(
        f"array_distinct(flatten(transform(forms, f -> transform({_places('f.template', length, step)}, "
        f"i -> xxhash64(f.form, slice(f.template, i, {length}))))))")).alias("h"))


def _probes_of(windows: DataFrame, size: int) -> DataFrame:
    """h of every probe that a document with one of these windows may hold."""
    length, step = _probe(size)
    return windows.select(F.explode(F.expr(f"transform(sequence(1, {step}), i -> xxhash64(form, slice(template, i, {length})))")).alias("h")).distinct()


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", size: int = WINDOW,
          least: int = LEAST_WINDOWS) -> DataFrame:
    """One row per document and benchmark item it holds: doc_id, item_id, windows, item_windows, renamed.

    Texts are compared in three forms. In one, numbers, names and units become typed placeholders in documents and items
    alike; windows that are mostly placeholders don't count there. Another is their lower-case words as they stand, so
    a copy is found whatever its numbers and names, and whatever its capitals. Both count words, so slots that are mixed
    up in an alignment rule it out in both. In the third, a run of capitalised words is one name, wherever it stands, so
    names at the start of sentences and of other lengths are found; names in a text without capitals are not. A document's
    pieces of `size` - 2 words at every third word meet all such pieces of the items' windows in a hash join: any shared
    window holds such a piece whole, wherever it begins, so a single shared window makes a suspect. Documents that
    meet none go no further: they share no window. Of the others all windows, at every word, are joined, checked word by
    word and counted by alignment (place in the document less place in the item). A leak has `least` windows in one
    alignment, or half the item's if that is fewer, and consistent slots: in the alignment every value of the item's
    placeholders always stands against the same value in the document, so a re-parameterised question is found and
    a different question of the same shape with mixed-up slots is not. `renamed` tells that some value differs.

    The larger side of each join is the documents' windows, spread by document or by hash; nothing is listed pairwise
    within documents. Whole texts are read. Null or short texts (fewer than `size` words) hold no leak; neither do items
    so short. Rows with a null id give no row (they can't be named). Repeated documents or items give one row per pair
    of ids. Empty tables give no rows. Other columns are not read.
    """
    items = _prepared(benchmark, "item_id", "text").distinct()
    kept = (F.col("form") == PLAIN) | _literal(F.col("template"))
    all_windows = _windows(items, size).withColumnRenamed("key", "item_id")
    item_windows = materialize(all_windows.where(kept), "item-windows")
    # few windows of an item in runs may be words that any text has: there all of its windows count
    total = all_windows.where(kept | (F.col("form") == RUNS)).groupBy("item_id", "form").agg(F.countDistinct("place").alias("item_windows"))

    plain = _prepared(docs, key, text)
    seeds = materialize(item_windows.select("h").distinct(), "item-hashes")
    probes = materialize(_probes_of(item_windows, size), "item-probes")
    hit = materialize(_hashes(plain, size).join(probes, "h", "left_semi").select("key").distinct(), "suspects")

    # the suspects' texts are written once; of them, first the places whose hash an item has, then the words at these places
    named = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    suspects = materialize(named.join(hit, "key", "left_semi"), "suspect-texts")
    at = _inlined(_prepared(suspects, "key", "text")).select("key", "form", F.posexplode_outer(F.expr(
        f"transform({_places('template', size)}, i -> xxhash64(form, slice(template, i, {size})))")).alias("at", "h"))
    met_at = at.join(seeds, "h", "left_semi").groupBy(F.col("key").alias("_key")).agg(F.collect_set(F.struct("form", "at")).alias("places"))
    here = suspects.join(met_at, F.col("key") == F.col("_key"))
    there = _inlined(_prepared(here, "key", "text", "places"), "places").select(F.col("key").alias("doc_id"), "form", F.inline_outer(F.expr(
        f"transform(filter(places, p -> p.form = form), p -> struct(p.at AS at, slice(template, p.at + 1, {size}) AS t, slice(raw, p.at + 1, {size}) AS r))")))
    there = there.withColumn("h", F.xxhash64("form", "t"))
    met = there.join(item_windows, ["h", "form"]).where(F.col("t") == F.col("template"))
    slots = F.expr(
        "filter(transform(template, (w, i) -> struct(w AS kind, raw[i] AS value, r[i] AS other)), "
        f"s -> s.kind IN ('{NUMBER}', '{UNIT}', '{NAME}'))")
    # names of as many words stand against each other word by word
    slots_by_word = F.expr(
        "flatten(transform(slots, s -> CASE WHEN size(split(s.value, '_')) = size(split(s.other, '_')) "
        "THEN transform(sequence(0, size(split(s.value, '_')) - 1), "
        "k -> struct(s.kind AS kind, split(s.value, '_')[k] AS value, split(s.other, '_')[k] AS other)) ELSE array(s) END))")
    runs_only = (F.col("form") == RUNS).alias("by_run")
    met = materialize(met.select("doc_id", "item_id", "form", (F.col("at") - F.col("place")).alias("shift"), "place", slots.alias("slots")), "met")
    runs = met.groupBy("doc_id", "item_id", "form", "shift").agg(F.countDistinct("place").alias("windows"))
    values = met.select("doc_id", "item_id", runs_only, "shift", F.explode(slots_by_word).alias("s")).groupBy(
        "doc_id", "item_id", "by_run", "shift", "s.kind", "s.value").agg(F.min("s.other").alias("low"), F.max("s.other").alias("high"))
    mixed = values.groupBy("doc_id", "item_id", "by_run", "shift").agg(
        F.max(F.col("low") != F.col("high")).alias("mixed"), F.max(F.col("low") != F.col("value")).alias("renamed"))
    found = runs.withColumn("by_run", runs_only).join(mixed, ["doc_id", "item_id", "by_run", "shift"], "left").join(total, ["item_id", "form"]).where(
        (F.col("windows") >= F.least(F.lit(least), F.ceil(F.col("item_windows") / 2))) & ~F.coalesce("mixed", F.lit(False)))
    return found.groupBy("doc_id", "item_id").agg(
        F.max("windows").alias("windows"), F.max("item_windows").alias("item_windows"),
        F.min(F.coalesce("renamed", F.lit(False))).alias("renamed"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that hold no benchmark item, with all their columns, whatever these are called.

    Rows are told apart by id: of rows that repeat an id, none stays if one of them holds an item. Null texts and rows
    with a null id stay. An empty table stays empty; without benchmark items all rows stay.
    """
    gone = materialize(leaks(docs, benchmark, key, text).select(F.col("doc_id").alias("_gone")).distinct(), "leaks")
    return docs.join(gone, docs[key] == gone["_gone"], "left_anti")
