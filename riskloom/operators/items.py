"""From uploaded rows to news items with an entity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.constants import CARD_PREVIEW_CHARS, ENTITY_ALIASES, UNKNOWN_ENTITY
from riskloom.functions.rows import compute_once
from riskloom.functions.text import (
    blank_to_null, char_count, text_or_empty, title_and_fragment, trim_ws, word_count,
)

Aliases = Mapping[str, Sequence[str]]


ABSENT = 2**31 - 2


def _first_position(text: Column, spellings: Sequence[str]) -> Column:
    """Zero-based place of the first spelling found, `ABSENT` if there is none.

    The wrap-around of -1 marks absence without searching the text twice.
    """
    places = [F.pmod(F.instr(text, s) - 1, F.lit(ABSENT + 1)) for s in spellings]
    return F.least(*places) if len(places) > 1 else places[0]


def match_entity(df: DataFrame, aliases: Aliases = ENTITY_ALIASES, out: str = "entity_match") -> DataFrame:
    """Entity whose alias comes first in title and text; ties by dictionary order.

    One expression over the row: no join, no shuffle, whatever the table size.
    """
    low = df.withColumn("_low", F.lower(title_and_fragment()))
    found = low.withColumn("_at", F.array(*[_first_position(F.col("_low"), s) for s in aliases.values()]))
    first = F.array_min("_at")
    names = F.array(*[F.lit(n) for n in aliases])
    best = F.when(first < ABSENT, F.element_at(names, F.array_position("_at", first).cast("int")))
    return compute_once(found, **{out: best}).drop("_low", "_at")


def resolve_entity(
    df: DataFrame, aliases: Aliases = ENTITY_ALIASES, unknown: str = UNKNOWN_ENTITY,
) -> DataFrame:
    """Provided entity, else the matched one, else the marker for unknown."""
    provided = blank_to_null(trim_ws("entity_norm"))
    matched = match_entity(df, aliases)
    return matched.withColumn("entity_norm", F.coalesce(provided, "entity_match", F.lit(unknown))).drop("entity_match")


def normalise_items(df: DataFrame, carry: Sequence[str] = ("id", "batch_id", "user_id")) -> DataFrame:
    """News item rows: empty optional texts become null, keys are carried along."""
    return df.select(
        *[c for c in carry if c in df.columns],
        *[blank_to_null(c).alias(c) for c in ("source", "url", "published_at")],
        text_or_empty("title").alias("title"),
        text_or_empty("text_fragment").alias("text_fragment"),
        "entity_norm",
    )


def result_card(df: DataFrame, preview: int = CARD_PREVIEW_CHARS) -> DataFrame:
    """What a result card shows: short text, "has more", score text, label text."""
    text = text_or_empty("text_fragment")
    return df.select(
        "news_item_id", "title", "entity_norm",
        F.substring(text, 1, preview).alias("preview"),
        (F.length(text) > preview).alias("has_more"),
        F.format_string("%.3f", F.col("risk_score")).alias("score_text"),
        F.when(F.col("alert_flag") == 1, "risk").otherwise("no risk").alias("label_text"),
    )


def only_alerts(df: DataFrame) -> DataFrame:
    return df.filter(F.col("alert_flag") == 1)


def alert_totals(df: DataFrame, by: Sequence[str] = (), alerts_only: bool = False) -> DataFrame:
    """All rows, alerts, and rows shown under the current filter."""
    alerts = F.count_if(F.col("alert_flag") == 1)
    total = F.count(F.lit(1))
    return df.groupBy(*by).agg(
        total.alias("total"), alerts.alias("alerts"), (alerts if alerts_only else total).alias("shown"),
    )


def text_lengths(df: DataFrame, cols: Sequence[str] = ("title", "text_fragment")) -> DataFrame:
    return df.withColumns({
        **{f"{c}_chars": char_count(c) for c in cols},
        **{f"{c}_words": word_count(c) for c in cols},
    })


def publication_parts(df: DataFrame, column: str = "published_at") -> DataFrame:
    """Year and month of a publication date; null where the text is no date."""
    day = F.try_to_date(F.substring(F.col(column), 1, 10), "yyyy-MM-dd")
    return df.withColumns({"published_year": F.year(day), "published_month": F.month(day)})


# --- extracting fragments around a mention -----------------------------------

SENTENCE = r"[^.!?\n]+[.!?]*"


def extract_mentions(
    df: DataFrame, aliases: Aliases = ENTITY_ALIASES, around: int = 1, min_words: int = 5,
    key: str = "id", text: str = "text_fragment",
) -> DataFrame:
    """One row per article and entity: the sentences around its first mention.

    The sentence with the first alias and ``around`` neighbours on each side
    form the fragment; fragments with fewer than ``min_words`` words go.
    Everything happens inside the row, so a long article or a frequent entity
    moves no data.
    """
    pieces = F.regexp_extract_all(text_or_empty(text), F.lit(f"({SENTENCE})"), F.lit(1))
    sentences = F.filter(F.transform(pieces, trim_ws), lambda s: s != "")
    base = df.select(key, "title", sentences.alias("_s"))
    low = base.withColumn("_low", F.transform("_s", F.lower))

    def first_sentence(spellings: Sequence[str]) -> Column:
        def has(s: Column) -> Column:
            out = F.lit(False)
            for a in spellings:
                out = out | F.contains(s, F.lit(a))
            return out
        return F.array_position(F.transform("_low", has), F.lit(True)).cast("int")

    mentions = F.array_compact(F.array(*[
        F.when(first_sentence(spellings) > 0, F.struct(
            F.lit(name).alias("entity_norm"), first_sentence(spellings).alias("sentence")))
        for name, spellings in aliases.items()
    ]))
    rows = low.select(key, "title", "_s", F.explode(mentions).alias("m")).select(key, "title", "_s", "m.*")
    start = F.greatest(F.col("sentence") - around, F.lit(1))
    length = F.col("sentence") + around - start + 1
    return (
        rows.withColumn("text_fragment", F.array_join(F.slice("_s", start, length), " "))
        .drop("_s")
        .filter(word_count("text_fragment") >= min_words)
    )
