"""Table and document sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barline.schemas import RAW_BARS, RUN_METRICS, conform


def read_table(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame:
    """A catalog table by name, or a path in ``fmt``."""
    if "/" in name_or_path or ":" in name_or_path:
        return spark.read.format(fmt).load(name_or_path)
    return spark.read.table(name_or_path)


def read_bars(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame:
    """Raw bars conformed to the contract (extra columns, e.g. a partition
    column, are dropped; types are cast by name)."""
    return conform(read_table(spark, name_or_path, fmt), RAW_BARS)


def _missing(exc: Exception) -> bool:
    text = str(exc)
    return "PATH_NOT_FOUND" in text or "does not exist" in text or "UNABLE_TO_INFER_SCHEMA" in text


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The run-metrics document; an empty frame when it is absent or
    unreadable, so drift detection is skipped rather than failing the run."""
    try:
        df = spark.read.schema(RUN_METRICS).json(path)
        df.limit(1).collect()
        return conform(df, RUN_METRICS)
    except Exception as exc:
        if _missing(exc):
            return spark.createDataFrame([], RUN_METRICS)
        raise
