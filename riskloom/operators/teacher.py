"""Teacher labels: prompts, answers, joins with the data, soft labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.constants import TEACHER_COLUMNS
from riskloom.functions.numbers import blend_soft_label, clip, teacher_soft_label
from riskloom.functions.text import text_or_empty
from riskloom.sources.csv_files import require_columns

SLOT = "{text}"


def build_prompts(
    df: DataFrame, template: str, text: Column | str = "model_text", key: str = "sample_id",
    max_chars: int | None = None,
) -> DataFrame:
    """Prompt per row from a template with one ``{text}`` slot.

    The text goes in whole unless the labeller has a window of ``max_chars``.
    """
    head, slot, tail = template.partition(SLOT)
    if not slot:
        raise ValueError("the template has no {text} slot")
    body = text_or_empty(text)
    if max_chars is not None:
        body = F.substring(body, 1, max_chars)
    return df.select(key, F.concat(F.lit(head), body, F.lit(tail)).alias("prompt"))


def parse_teacher_json(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Label and confidence from an answer that holds one JSON object.

    Text around the object is ignored. Numbers may be written as texts. A
    label that is a JSON number loses its fraction (1.7 is 1), one that is a
    text must be a whole number. A broken answer gives label -1, no confidence
    and the reason.
    """
    body = F.regexp_extract(text_or_empty(raw), r"(?s)(\{.*\})", 1)
    parsed = F.from_json(body, "label string, confidence string")
    message = F.try_parse_json(body)
    kind = F.schema_of_variant(F.try_variant_get(message, "$.label", "variant"))
    number = F.try_variant_get(message, "$.label", "double").try_cast("int")
    label = F.when((kind == "BIGINT") | (kind == "DOUBLE") | kind.startswith("DECIMAL"), number).otherwise(F.col("_a.label").try_cast("int"))
    conf = F.col("_a.confidence").try_cast("double")
    reason = (
        F.when(F.col("_a").isNull() | (F.col("_a.label").isNull() & F.col("_a.confidence").isNull()), "no json")
        .when(label.isNull() | ~label.isin(0, 1), "bad label")
        .when(conf.isNull(), "bad confidence")
        .otherwise("ok")
    )
    return (
        df.withColumn("_a", parsed)
        .withColumn("teacher_reason", reason)
        .withColumn("teacher_label", F.when(F.col("teacher_reason") == "ok", label).otherwise(F.lit(-1)))
        .withColumn("teacher_confidence", F.when(F.col("teacher_reason") == "ok", clip(conf, 0.0, 1.0)))
        .drop("_a")
    )


def normalise_teacher_schema(df: DataFrame, version: str) -> DataFrame:
    """Uniform column names, missing text columns empty, version stamped."""
    names = {"label": "teacher_label", "confidence": "teacher_confidence"}
    renames = {old: new for old, new in names.items() if old in df.columns and new not in df.columns}
    out = df.withColumnsRenamed(renames).withColumn("teacher_prompt_version", F.lit(version))
    added = [c for c in ("teacher_response_raw", "teacher_reason") if c not in out.columns]
    return out.withColumns({c: F.lit("") for c in added}) if added else out


def is_valid_teacher(label="teacher_label", conf="teacher_confidence") -> Column:
    return F.coalesce(F.col(label).isin(0, 1), F.lit(False)) & F.col(conf).isNotNull()


def valid_teacher_rows(df: DataFrame) -> DataFrame:
    return df.filter(is_valid_teacher())


def teacher_coverage(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows with a usable label out of all rows."""
    n, valid = F.count(F.lit(1)), F.count_if(is_valid_teacher())
    return df.groupBy(*by).agg(valid.alias("n_valid"), n.alias("n_total"), (valid / n).alias("coverage"))


def require_unique(df: DataFrame, key: str, what: str) -> None:
    """Raise if a key repeats. Pre-aggregated per task, reads back one row."""
    twice = df.groupBy(key).count().filter(F.col("count") > 1).limit(1).collect()
    if twice:
        raise ValueError(f"{key} is not unique in {what}, e.g. {twice[0][0]!r}")


def attach_teacher(
    train: DataFrame, teacher: DataFrame, how: str = "inner", key: str = "sample_id", validate: bool = True,
) -> DataFrame:
    """Join teacher labels one to one, then keep the rows with a valid label.

    ``how="inner"`` is the strict form, ``how="left"`` the lenient one; after
    the validity filter both hold the same rows, so the plan is an inner join.
    """
    require_columns(teacher, TEACHER_COLUMNS)
    if how not in ("inner", "left"):
        raise ValueError(how)
    if validate:
        require_unique(train, key, "the data")
        require_unique(teacher, key, "the teacher labels")
    joined = train.join(teacher.select(*TEACHER_COLUMNS), key, how)
    return valid_teacher_rows(joined)


def attach_teacher_all(train: DataFrame, teacher: DataFrame, key: str = "sample_id", suffix: str = "") -> DataFrame:
    """Left join that keeps every row; teacher columns may get a suffix."""
    names = {c: f"{c}{suffix}" for c in TEACHER_COLUMNS if c != key} if suffix else {}
    return train.join(teacher.select(*TEACHER_COLUMNS).withColumnsRenamed(names), key, "left")


def with_soft_labels(df: DataFrame, alpha: float, hard: str = "alert_flag") -> DataFrame:
    soft = df.withColumn("teacher_soft_y", teacher_soft_label())
    return soft.withColumn("soft_y", blend_soft_label(hard, "teacher_soft_y", alpha))


def expand_soft_rows(df: DataFrame, soft: str = "soft_y") -> DataFrame:
    """Each row twice: as label 1 with weight y and as label 0 with weight 1-y."""
    y = F.col(soft)
    both = F.array(
        F.struct(F.lit(1).alias("label"), y.alias("weight")),
        F.struct(F.lit(0).alias("label"), (1 - y).alias("weight")),
    )
    return df.select("*", F.inline(both))


def few_shot_messages(df: DataFrame, prefix: str, text: str = "model_text", key: str = "sample_id",
                      answer: str = "alert_flag", max_chars: int | None = None) -> DataFrame:
    """Each example as a user message followed by the expected answer."""
    body = text_or_empty(text)
    if max_chars is not None:
        body = F.substring(body, 1, max_chars)
    pair = F.array(
        F.struct(F.lit(0).alias("turn"), F.lit("user").alias("role"), F.concat(F.lit(prefix), body).alias("content")),
        F.struct(F.lit(1).alias("turn"), F.lit("assistant").alias("role"), F.col(answer).cast("string").alias("content")),
    )
    return df.select(key, F.inline(pair))
