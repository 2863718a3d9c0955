"""Profiling of a labelled dataset."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.constants import NO_RISK
from riskloom.functions.text import digest, is_blank, keyword_array, words
from riskloom.operators.running import percentiles
from riskloom.session import materialize

TEXT_KEY = ["text_fragment"]
FULL_KEY = ["title", "text_fragment", "entity_norm"]


def _distinct_per_column(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, digest of value, rows, blank rows): one small row per value.

    The values are replaced by digests before the shuffle and counted per task
    first, so neither long texts nor one very frequent value hurt.
    """
    cells = F.array(*[
        F.struct(
            F.lit(c).alias("column"),
            F.when(F.col(c).isNotNull(), F.sha2(F.col(c).cast("string"), 256)).alias("value"),
            is_blank(c).alias("blank"),
        ) for c in cols
    ])
    return (
        df.select(F.inline(cells)).groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if("blank").alias("n_blank"))
    )


def column_profile(df: DataFrame) -> DataFrame:
    """Per column: type, missing-or-blank rows, distinct values incl. null."""
    per_value = _distinct_per_column(df, df.columns)
    types = F.create_map(*[F.lit(x) for n, t in df.dtypes for x in (n, t)])
    return (
        per_value.groupBy("column")
        .agg(F.sum("n_blank").alias("missing_or_empty"), F.count(F.lit(1)).alias("unique_values"))
        .withColumn("dtype", F.element_at(types, F.col("column")))
        .orderBy(F.desc("missing_or_empty"), "column")
    )


def dataset_summary(
    df: DataFrame, distinct: Sequence[str], flag: str = "alert_flag", year: str = "published_year",
) -> DataFrame:
    """(metric, value) rows: size, distinct ids, positives, first and last year."""
    uniques = (
        _distinct_per_column(df, distinct).filter(F.col("value").isNotNull())
        .groupBy("column").agg(F.count(F.lit(1)).cast("double").alias("value"))
        .select(F.concat(F.lit("unique_"), F.col("column")).alias("metric"), "value")
    )
    n, pos = F.count(F.lit(1)), F.count_if(F.col(flag) == 1)
    base = df.agg(
        n.cast("double").alias("rows"),
        F.lit(float(len(df.columns))).alias("columns"),
        pos.cast("double").alias("positive_rows"),
        (pos / n).alias("positive_share"),
        F.min(year).cast("double").alias("first_year"),
        F.max(year).cast("double").alias("last_year"),
    )
    return base.unpivot([], base.columns, "metric", "value").unionByName(uniques)


def duplicate_counts(df: DataFrame, checks: dict[str, Sequence[str]]) -> DataFrame:
    """Repeats beyond the first, per named key."""
    cells = F.array(*[F.struct(F.lit(n).alias("check"), digest(*k).alias("value")) for n, k in checks.items()])
    per_value = df.select(F.inline(cells)).groupBy("check", "value").agg((F.count(F.lit(1)) - 1).alias("extra"))
    return per_value.groupBy("check").agg(F.sum("extra").alias("count"))


def duplicate_rows(df: DataFrame, key: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Every row whose key occurs more than once.

    The repeated keys are found on digests with per-task counting and joined
    back from a written table. That gives each side of the join an exchange of
    its own (or broadcasts the keys, if few), so adaptive execution can split a
    key with very many rows.
    """
    keyed = df.withColumn("_key", digest(*key))
    repeated = materialize(keyed.groupBy("_key").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1"), "repeated")
    rows = keyed.join(repeated, "_key").drop("_key")
    return rows.orderBy(*order) if order else rows


def value_distribution(
    df: DataFrame, column: str, dropna: bool = True, share: bool = False, by: Sequence[str] = (),
) -> DataFrame:
    rows = df.filter(F.col(column).isNotNull()) if dropna else df
    counts = rows.groupBy(*by, column).agg(F.count(F.lit(1)).alias("count"))
    if not share:
        return counts
    # The share is of all rows, as a scalar; the counts stay spread out.
    total = df.agg(F.count(F.lit(1)).cast("double")).scalar()
    return counts.withColumn("share", F.col("count") / total)


def crosstab(df: DataFrame, a: str, b: str, values: Sequence) -> DataFrame:
    """Count table with one column per value of ``b``."""
    counts = df.filter(F.col(a).isNotNull()).groupBy(a).pivot(b, list(values)).count()
    return counts.na.fill(0)


def crosstab_margins(df: DataFrame, a: str, b: str, values: Sequence, label: str = "All") -> DataFrame:
    """Count table with an `All` row and an `All` column."""
    cells = (
        df.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
        .select(F.col(a).cast("string").alias(a), F.col(b).cast("string").alias(b))
        .groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    )
    cube = cells.cube(a, b).agg(F.sum("n").alias("n"), F.grouping(a).alias("_ga"), F.grouping(b).alias("_gb"))
    named = cube.select(
        F.when(F.col("_ga") == 1, label).otherwise(F.col(a)).alias(a),
        F.when(F.col("_gb") == 1, label).otherwise(F.col(b)).alias(b), "n")
    return named.groupBy(a).pivot(b, [*map(str, values), label]).agg(F.sum("n")).na.fill(0)


def crosstab_share(df: DataFrame, a: str, b: str, values: Sequence, digits: int = 3) -> DataFrame:
    counts = crosstab(df, a, b, values)
    total = sum((F.col(str(v)) for v in values), F.lit(0))
    return counts.select(a, *[F.round(F.col(str(v)) / total, digits).alias(str(v)) for v in values])


def _value_counts(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols])
    return (
        df.select(*by, F.inline(cells)).filter(F.col("value").isNotNull())
        .groupBy(*by, "column", "value").agg(F.count(F.lit(1)).alias("n"))
    )


def _same(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])


def grouped_stats(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """count, mean, std, min, quartiles and max per column (and group).

    Rows are first counted per distinct value. Quartiles come from running
    counts and the spread from a second pass, so a column of as many values as
    rows is never gathered in one task.
    """
    n, v, keys = F.col("n"), F.col("value"), [*by, "column"]
    counts = materialize(_value_counts(df, cols, by), "value-counts")
    stats = materialize(counts.groupBy(*keys).agg(
        F.sum("n").alias("count"), (F.sum(v * n) / F.sum("n")).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max")),
        "value-stats")
    means = stats.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("mean").alias("_mean"))
    apart = v - F.col("_mean")
    squares = counts.join(means, _same(keys), "inner").groupBy(*keys).agg(F.sum(n * apart * apart).alias("_squares"))
    quarters = percentiles(counts, {"p25": 0.25, "median": 0.5, "p75": 0.75}, keys=keys)
    out = stats
    for side in (squares, quarters):
        named = side.withColumnsRenamed({k: f"_k{i}" for i, k in enumerate(keys)})
        out = out.join(named, _same(keys), "inner").drop(*[f"_k{i}" for i in range(len(keys))])
    return out.select(
        *keys, "count", "mean", F.when(F.col("count") > 1, F.sqrt(F.col("_squares") / (F.col("count") - 1))).alias("std"),
        "min", "p25", "median", "p75", "max",
    )


def describe_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return grouped_stats(df, cols)


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Counts in equal bins between minimum and maximum; the last bin is closed.

    Empty bins are listed with 0.
    """
    lo, hi = df.agg(F.min(column).cast("double"), F.max(column).cast("double")).first()
    if lo is None:
        lo = hi = 0.0
    width = (hi - lo) / bins or 1.0
    spot = F.least(F.floor((F.col(column) - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = df.filter(F.col(column).isNotNull()).groupBy(spot.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return grid.join(counts, "bin", "left").select(
        "bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("left_edge"),
        F.coalesce("count", F.lit(0)).cast("long").alias("count"))


def split_summary(df: DataFrame, group: str = "event_group_id", flag: str = "alert_flag") -> DataFrame:
    """Rows, positive rate and distinct groups per split.

    Counted per (split, group) first, so that the distinct count needs no
    row of its own per record.
    """
    per_group = df.groupBy("split", group).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(flag) == 1).alias("pos"))
    return per_group.groupBy("split").agg(
        F.sum("n").alias("rows"), (F.sum("pos") / F.sum("n")).alias("positive_rate"),
        F.count(group).alias("event_groups"),
    )


def target_by_split(df: DataFrame, flag: str = "alert_flag") -> DataFrame:
    return df.groupBy("split", flag).agg(F.count(F.lit(1)).alias("count"))


def keyword_frequency(df: DataFrame, column: str = "found_risk_keywords", by: Sequence[str] = ()) -> DataFrame:
    return (
        df.select(*by, F.explode(keyword_array(column)).alias("keyword"))
        .groupBy(*by, "keyword").agg(F.count(F.lit(1)).alias("count"))
    )


def top_words(
    df: DataFrame, text: Column | str, k: int = 30, where: Column | None = None, stop_words: Sequence[str] = (),
) -> DataFrame:
    """The ``k`` most frequent words; ties by word."""
    rows = df if where is None else df.filter(where)
    counts = rows.select(F.explode(words(text)).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("count"))
    if stop_words:
        counts = counts.filter(~F.col("word").isin(list(stop_words)))
    return counts.orderBy(F.desc("count"), "word").limit(k)


def expected_alert(risk: str = "risk_type_4cls") -> Column:
    return (F.col(risk) != NO_RISK).cast("int")


def target_mismatches(df: DataFrame, risk: str = "risk_type_4cls", flag: str = "alert_flag") -> DataFrame:
    return df.filter(F.col(flag) != expected_alert(risk))


def rule_checks(df: DataFrame, risk="risk_type_4cls", flag="alert_flag", keywords="found_risk_keywords", examples: int = 5) -> DataFrame:
    """The four labelling rules: violating rows, the first `examples` of them (by id) and the very first."""
    pos = F.col(flag).cast("int") == 1
    none = F.col(risk) == NO_RISK
    bare = is_blank(keywords)
    rules = {
        "no_risk_but_alert": none & pos,
        "risk_but_no_alert": ~none & ~pos,
        "alert_without_keywords": pos & bare,
        "no_alert_with_keywords": ~pos & ~bare,
    }
    cells = F.array(*[F.struct(F.lit(n).alias("check"), c.alias("hit")) for n, c in rules.items()])
    checked = df.select("sample_id", F.inline(cells))
    counts = checked.groupBy("check").agg(
        F.count_if("hit").alias("rows"), F.min(F.when(F.col("hit"), F.col("sample_id"))).alias("first_example"))
    # The rank limit is applied per task before the shuffle.
    ranked = checked.filter("hit").withColumn("_rn", F.row_number().over(Window.partitionBy("check").orderBy("sample_id")))
    some = ranked.filter(F.col("_rn") <= examples).groupBy("check").agg(F.array_sort(F.collect_list("sample_id")).alias("examples"))
    return counts.join(some, "check", "left")


def temporal_drift(df: DataFrame, part: str = "published_year", flag: str = "alert_flag") -> DataFrame:
    return crosstab(df, part, flag, [0, 1])
