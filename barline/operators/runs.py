"""Run statistics, drift, run ledger, verdict and ingest guardrails
(R21, Q12-Q17, K5, K6).

The run ledger holds one row per run, so it stays small; drift reads the last
few rows of it.  Per-day "runs" over a feature table are computed with the
same operators grouped by ``(keys, day)``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.functions import round_places
from barline.operators import backtest
from barline.schemas import DEFAULT_SPEC, INGESTION_LEDGER, RUN_LEDGER, VERDICT, SeriesSpec, conform

METRIC_NAMES = ("optimal_threshold", "alert_rate", "crash_index_mean", "crash_index_std")
# Fixed values of the drift test: history length and z limit.
DRIFT_HISTORY = 5
DRIFT_Z = 3.0
METRIC_DIGITS = 4


def run_metrics(final: DataFrame, threshold: Column, digits: int = METRIC_DIGITS) -> DataFrame:
    """One row of the four run metrics, rounded to ``digits`` places."""
    return final.agg(
        F.avg("crash_index").alias("_mean"),
        F.stddev_samp("crash_index").alias("_std"),
        F.avg("crash_alert_flag").alias("_rate"),
    ).select(
        round_places(threshold, digits).alias("optimal_threshold"),
        round_places("_rate", digits).alias("alert_rate"),
        round_places("_mean", digits).alias("crash_index_mean"),
        round_places("_std", digits).alias("crash_index_std"),
    )


def daily_runs(features: DataFrame, spec: SeriesSpec = DEFAULT_SPEC,
               grid: Sequence[float] = backtest.DEFAULT_GRID, digits: int = METRIC_DIGITS) -> DataFrame:
    """One run per ``(keys, day)``: the day's own threshold choice, alert rate
    and index statistics, as a day-by-day batch would record them."""
    by = spec.group
    best = backtest.best_per_group(features, by, grid=grid, extra=(
        "avg(crash_index) AS _mean", "stddev_samp(crash_index) AS _std", "count(1) AS analytics_rows"))
    # Alerts at the chosen threshold are its tp + fp.
    return best.select(
        *by,
        "analytics_rows",
        round_places("threshold", digits).alias("optimal_threshold"),
        round_places((F.col("tp") + F.col("fp")) / F.col("analytics_rows"), digits).alias("alert_rate"),
        round_places("_mean", digits).alias("crash_index_mean"),
        round_places("_std", digits).alias("crash_index_std"),
    )


def drift_flag(current: Column, mean: Column, pstd: Column, n: Column, z: float = DRIFT_Z) -> Column:
    """Q12: false if current is NULL, fewer than 2 history values, or zero
    spread; else ``|current - mean| / pstd > z``."""
    usable = current.isNotNull() & (n >= 2) & pstd.isNotNull() & (pstd != 0)
    return F.when(usable, F.abs(current - mean) / pstd > z).otherwise(F.lit(False))


def _history(m: str, over: str = "") -> str:
    """Mean, spread and number of the earlier values of a metric (NULL skipped), as one struct."""
    return f"struct(avg({m}){over} AS mean, stddev_pop({m}){over} AS std, count({m}){over} AS n)"


def _flagged(df: DataFrame, metrics: Sequence[str], z: float) -> DataFrame:
    """Adds ``<m>_drift`` from ``_h_<m>`` and ``drift_detected``."""
    flags = {f"{m}_drift": drift_flag(F.col(m), F.col(f"_h_{m}.mean"), F.col(f"_h_{m}.std"), F.col(f"_h_{m}.n"), z) for m in metrics}
    out = df.withColumns(flags).drop(*[f"_h_{m}" for m in metrics])
    return out.withColumn("drift_detected", F.array_contains(F.array(*flags), True))


def drift_test(runs: DataFrame, order: str, by: Sequence[str] = (), history: int = DRIFT_HISTORY,
               z: float = DRIFT_Z, metrics: Sequence[str] = METRIC_NAMES) -> DataFrame:
    """Q13: compare each run with the ``history`` runs before it (per ``by``).

    NULL metrics of earlier runs are skipped (aggregates ignore NULL).  The
    ledger has one row per run, so the window is small.
    """
    part = f"PARTITION BY {', '.join(by)} " if by else ""
    over = f" OVER ({part}ORDER BY {order} ROWS BETWEEN {history} PRECEDING AND 1 PRECEDING)"
    return _flagged(runs.withColumns({f"_h_{m}": F.expr(_history(m, over)) for m in metrics}), metrics, z)


def drift_against(current: DataFrame, ledger: DataFrame, history: int = DRIFT_HISTORY, z: float = DRIFT_Z,
                  exclude_run: str | None = None, metrics: Sequence[str] = METRIC_NAMES) -> DataFrame:
    """Q13/L3: drift of the current metrics against the latest ``history`` runs of the ledger
    (by ``execution_ts``, ties by ``run_id``)."""
    led = ledger if exclude_run is None else ledger.filter(F.col("run_id") != exclude_run)
    recent = led.orderBy(F.col("execution_ts").desc(), F.col("run_id").desc()).limit(history)
    stats = recent.agg(*[F.expr(_history(m)).alias(f"_h_{m}") for m in metrics])
    # one scalar subquery returning a struct, evaluated once
    out = current.withColumn("_h", stats.select(F.struct(*stats.columns)).scalar())
    return _flagged(out.withColumns({c: F.col(f"_h.{c}") for c in stats.columns}).drop("_h"), metrics, z)


def read_ledger(spark: SparkSession, path: str, schema=RUN_LEDGER) -> DataFrame:
    """The run ledger, or an empty frame of its schema when absent."""
    try:
        return conform(spark.read.schema(schema).parquet(path), schema)
    except Exception as exc:  # missing path
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
            return spark.createDataFrame([], schema)
        raise


def upsert_run(row: DataFrame, path: str) -> None:
    """K6: insert-or-replace by ``run_id``.  Stored partitioned by run id with
    dynamic partition overwrite: a rerun replaces its own partition only."""
    (conform(row, RUN_LEDGER).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id").parquet(path))


def ledger_row(spark: SparkSession, run_id: str, values: dict) -> DataFrame:
    """One ledger row; ``execution_ts`` defaults to the current time."""
    from pyspark.sql import types as T
    fields = [f for f in RUN_LEDGER.fields if f.name != "execution_ts"]
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])
    data = {**{f.name: values.get(f.name) for f in fields}, "run_id": run_id}
    df = spark.createDataFrame([tuple(data[f.name] for f in fields)], schema)
    when = values.get("execution_ts")
    ts = F.lit(when).cast("timestamp_ntz") if when is not None else F.localtimestamp()
    return conform(df.withColumn("execution_ts", ts), RUN_LEDGER)


@dataclass(frozen=True)
class Gate:
    """A condition over the verification record, the verdict field it decides (if any), and
    the message of its failure (formatted with the record)."""

    passed: str
    message: str
    field: str | None = None


#: Evaluated in order; the first that does not hold ends the verification.
GATES = (
    Gate("analytics_rows > 0", "the feature table holds no row"),
    Gate("analytics_rows <= raw_rows_distinct", "{analytics_rows} feature rows from {raw_rows_distinct} distinct bars"),
    Gate("coverage_ok", "features cover {coverage_ratio:.2%} of the distinct bars", "row_coverage_ratio"),
    Gate("date_range_ok", "days differ: bars {min_raw} to {max_raw}, features {min_analytics} to {max_analytics}", "date_range_ok"),
    Gate("{errors} = 0", "rules violated: {failing}", "crash_index_ok"),
)


def verdict_row(record: DataFrame, errors: Sequence[str]) -> DataFrame:
    """Q14: the eight-field verdict of a verification record, one row, plus ``failed_gate``
    (number of the first gate that does not hold, from 0).  ``errors``: counts of the record that
    must be 0.  A field is true when its gate and all before it hold."""
    total = " + ".join(errors) or "0"
    holds = [f"coalesce({g.passed.format(errors=f'({total})')}, false)" for g in GATES]
    out = record.withColumn("failed_gate", F.expr(
        "CASE " + " ".join(f"WHEN NOT {h} THEN {k}" for k, h in enumerate(holds)) + " END"))
    fields = {g.field: F.expr(f"failed_gate IS NULL OR failed_gate > {k}") for k, g in enumerate(GATES) if g.field}
    failing = F.expr("concat_ws(', ', " + ", ".join(f"IF({e} > 0, '{e}', NULL)" for e in errors) + ")")
    return out.select(
        "raw_rows_distinct", "analytics_rows", *[fields[n].alias(n) for n in ("row_coverage_ratio", "date_range_ok", "crash_index_ok")],
        F.lit(False).alias("sample_read_ok"), F.when(F.col("failed_gate").isNull(), F.col("checksum")).alias("checksum"),
        "failed_gate", failing.alias("failing"))


def make_verdict(spark: SparkSession, values: dict) -> DataFrame:
    """The verdict document from its values (missing: NULL, flags false)."""
    row = tuple(values.get(f.name, False if f.dataType.typeName() == "boolean" else None)
                for f in VERDICT.fields)
    return spark.createDataFrame([row], VERDICT)


def gate(verdict: DataFrame | None) -> dict:
    """Q15: fail when the verdict is missing or carries an error."""
    rows = [] if verdict is None else verdict.limit(2).collect()
    if len(rows) != 1:
        raise RuntimeError("no verdict of this run to read")
    v = rows[0].asDict()
    if v.get("error"):
        raise RuntimeError(f"the run did not pass: {v['error']}")
    return v


# ---- ingest guardrails -----------------------------------------------------

def guardrail_decisions(incoming: DataFrame, ledger: DataFrame, existing: DataFrame | None = None,
                        by: Sequence[str] = (), use_row_guard: bool = True) -> DataFrame:
    """Decide per incoming dataset ``(… by, dataset_hash, row_count)``.

    ``skip_known`` when its hash is in the ledger (left semi join on hash);
    otherwise ``skip_covered`` when the stored rows (``existing``: ``(*by,
    existing_rows)``) already reach its input rows; otherwise ``ingest``.
    """
    known = ledger.select(F.col("dataset_hash").alias("_h")).distinct()
    marked = incoming.join(known, incoming["dataset_hash"] == known["_h"], "left").withColumn(
        "already_ingested", F.col("_h").isNotNull()).drop("_h")
    if existing is not None and use_row_guard:
        marked = marked.join(existing, on=list(by), how="left") if by else marked.withColumn(
            "existing_rows", existing.select("existing_rows").scalar())
        marked = marked.withColumn("existing_rows", F.coalesce("existing_rows", F.lit(0).cast("bigint")))
        covered = F.col("existing_rows") >= F.col("row_count")
    else:
        covered = F.lit(False)
    return marked.withColumn(
        "decision",
        F.when(F.col("already_ingested"), "skip_known").when(covered, "skip_covered").otherwise("ingest"))


def ledger_entries(fingerprints: DataFrame) -> DataFrame:
    """K5: ledger rows for datasets just ingested (hash, input row count, now)."""
    return conform(fingerprints.select("dataset_hash", "row_count",
                                       F.localtimestamp().alias("ingested_at")), INGESTION_LEDGER)


def new_files(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """J4 per file: the rows of ``files`` (``path, dataset_hash, ...``) whose content no ledger row has; of files
    with equal content the first path."""
    known = ledger.select(F.col("dataset_hash").alias("_h")).distinct()
    rest = files.join(known, files["dataset_hash"] == known["_h"], "left_anti")
    values = [c for c in rest.columns if c != "dataset_hash"]
    first = rest.groupBy("dataset_hash").agg(F.min(F.struct("path", *[c for c in values if c != "path"])).alias("_f"))
    return first.select(*[("dataset_hash" if c == "dataset_hash" else F.col(f"_f.{c}").alias(c)) for c in rest.columns])
