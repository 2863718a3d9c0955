"""Parquet tables, reports and model artifacts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.constants import TEACHER_COLUMNS
from riskloom.schemas import PARTITION_COLUMNS, TABLES
from riskloom.sources.csv_files import missing_columns, read_news_csv


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{root}/{name}")


def _declared(df: DataFrame, name: str) -> DataFrame:
    """Columns in declared order and type; no unknown column gets in."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in TABLES[name].fields])


def append_table(df: DataFrame, root: str, name: str) -> None:
    writer = _declared(df, name).write.mode("append")
    if name in PARTITION_COLUMNS:
        writer = writer.partitionBy(PARTITION_COLUMNS[name])
    writer.parquet(f"{root}/{name}")


def replace_batches(df: DataFrame, root: str, name: str) -> None:
    """Write whole batches: a batch that is already stored is replaced.

    Only the partitions present in ``df`` are overwritten, so a retried batch
    never leaves duplicate rows and other batches stay as they are.
    """
    if name not in PARTITION_COLUMNS:
        raise ValueError(f"{name} is not stored by batch")
    key = PARTITION_COLUMNS[name]
    (
        _declared(df, name).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(key)
        .parquet(f"{root}/{name}")
    )


def write_report(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", "true").csv(path)
    else:
        writer.parquet(path)


def _first_readable(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        df = read_news_csv(spark, path) if path.endswith(".csv") else spark.read.parquet(path)
        return df if df.columns else None
    except (AnalysisException, ValueError):
        return None


def load_teacher_labels(spark: SparkSession, paths: Sequence[str], version: str) -> DataFrame:
    """First candidate that exists, has the needed columns and one valid label."""
    from riskloom.operators.teacher import normalise_teacher_schema, valid_teacher_rows

    for path in paths:
        found = _first_readable(spark, path)
        if found is None:
            continue
        labels = normalise_teacher_schema(found, version)
        if missing_columns(labels, TEACHER_COLUMNS):
            continue
        labels = labels.withColumn("teacher_label", F.col("teacher_label").try_cast("double").cast("int"))
        labels = labels.withColumn("teacher_confidence", F.col("teacher_confidence").try_cast("double"))
        if not labels.filter(F.col("teacher_label").isin(0, 1)).isEmpty():
            return labels
    raise FileNotFoundError("no usable teacher labels in: " + ", ".join(paths))


@dataclass
class LinearModel:
    """A fitted linear text model.

    ``weights`` holds one row per feature (`family`, `term`, `idf`, `coef`) and
    is bounded by the vocabulary limit; ``meta`` is a few settings.
    """

    weights: DataFrame
    intercept: float
    threshold: float
    model_name: str
    meta: dict = field(default_factory=dict)


def save_model(model: LinearModel, path: str) -> None:
    spark = model.weights.sparkSession
    model.weights.select("family", "term", "idf", "coef").write.mode("overwrite").parquet(f"{path}/weights")
    row = [(model.model_name, float(model.threshold), float(model.intercept),
            {str(k): str(v) for k, v in model.meta.items()})]
    (
        spark.createDataFrame(row, "model_name string, threshold double, intercept double, meta map<string,string>")
        .write.mode("overwrite").parquet(f"{path}/meta")
    )


def load_model(spark: SparkSession, path: str) -> LinearModel | None:
    """The stored model, or None so that the caller falls back to keywords."""
    try:
        meta = spark.read.parquet(f"{path}/meta").first()
        weights = spark.read.parquet(f"{path}/weights")
    except AnalysisException:
        return None
    if meta is None:
        return None
    return LinearModel(weights, meta.intercept, meta.threshold, meta.model_name, dict(meta.meta))
