"""Table sinks (K1, K2, K4, K7-K9).

Writes go through Spark's file commit protocol: an overwrite replaces the
table in one job, so a half-loaded table is never visible, and a retried task
rewrites only its own files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from barline.operators.clean import duplicate_keys
from barline.schemas import DEFAULT_SPEC, SeriesSpec, conform


def write_table(df: DataFrame, path: str, schema=None, mode: str = "overwrite",
                partition_by: Sequence[str] = (), replace_all: bool = True, fmt: str = "parquet",
                rebalance: bool = False, keys: Sequence[str] = (), observe: tuple[Observation, Sequence[Column]] | None = None) -> None:
    """K1/K2/K7: conform to ``schema`` (by name, after the series ``keys``) and write.  ``replace_all``
    truncates the whole table on overwrite; otherwise only the partitions
    present in ``df`` are replaced.  ``rebalance`` (for input not clustered by
    the partition columns) adds the REBALANCE hint: AQE groups rows of a
    partition value into tasks of the advisory size, splitting a hot value
    over several tasks and merging small ones, so each task writes few,
    reasonably sized files.  ``observe``: an observation and its aggregates over the rows written.  It
    stands after the shuffle, in the tasks that write: Spark counts each of those once, while a map task that
    runs again after a lost executor would count twice."""
    out = df
    if schema is not None:
        conform(df, schema)  # fails on a missing column
        extra = [c for c in partition_by if c not in schema.fieldNames()]
        out = df.select(*keys, *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields], *extra)
    if rebalance and partition_by:
        out = out.hint("rebalance", *partition_by)
    if observe is not None:
        out = out.observe(observe[0], *observe[1])
    w = out.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if mode == "overwrite":
        w = w.option("partitionOverwriteMode", "static" if replace_all else "dynamic")
    w.save(path)


def write_with_readback(spark: SparkSession, df: DataFrame, path: str, schema=None,
                        partition_by: Sequence[str] = (), name: str = "written",
                        rebalance: bool = False) -> dict:
    """K9: count rows in the tasks that write them (an ``Observation``, no extra pass), then
    count the written table; both must agree."""
    obs = Observation(name)
    write_table(df, path, schema, partition_by=partition_by, rebalance=rebalance, observe=(obs, [F.count(F.lit(1)).alias("rows")]))
    written = obs.get["rows"]
    readback = spark.read.parquet(path).count()
    if written != readback:
        raise RuntimeError(f"row-count mismatch: written={written}, readback={readback}")
    return {"written": written, "readback": readback}


def write_document(df: DataFrame, path: str) -> None:
    """K4: a small record (one row) as a single JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def assert_unique(df: DataFrame, spec: SeriesSpec = DEFAULT_SPEC) -> None:
    """K8: the key ``(keys, time)`` must be unique before a write."""
    n = duplicate_keys(df, spec).limit(1).count()
    if n:
        raise RuntimeError("duplicate keys in output")
