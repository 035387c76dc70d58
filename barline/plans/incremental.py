"""The batch job over what is new: files that were not loaded, days that changed, keys that differ.

``ingest_files`` keeps a ledger row per file and merges new files into the days they touch;
``analyze_changed`` computes only days whose bars changed and takes the threshold and the run
metrics from states kept per day; ``reconcile`` lists what a feature table lacks, reading only
days that differ.  The driver holds one row per file and one per day, as the table's own
partition list has.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barline.functions import round_places
from barline.operators import backtest, clean, quality, reconcile as rec, risk, runs
from barline.plans.stages import FILE_LINES, Paths, _exists, _raw_frame, _remove, _rule_aggs, score
from barline.schemas import CSV_COLUMNS, DEFAULT_SPEC, FEATURES, RAW_BARS, SeriesSpec
from barline.session import staging_path
from barline.sinks.writers import write_document, write_table
from barline.sources import fingerprint
from barline.sources.csv import GOOD, REJECTED, read_line_outcomes

log = logging.getLogger("barline")

FILE_LEDGER = "path string, dataset_hash string, row_count bigint, loaded bigint, missing bigint, rejected bigint, ingested_at timestamp_ntz"
DAY_STATE = "day date, n_rows bigint, fingerprint string"
SWEEP_STATE = "bucket int, n bigint, positives bigint, scored bigint, mean double, m2 double, day date"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if _exists(spark, path) else spark.createDataFrame([], schema)


def _drop_days(spark: SparkSession, path: str, column: str, days: Sequence) -> None:
    for day in days:
        _remove(spark, f"{path}/{column}={'__HIVE_DEFAULT_PARTITION__' if day is None else day}")


# ---- files ------------------------------------------------------------------------

def _raw_schema(spec: SeriesSpec, key_types: dict) -> T.StructType:
    fields = [T.StructField(k, key_types.get(k, T.StringType())) for k in spec.keys]
    return T.StructType([*fields, *RAW_BARS.fields, T.StructField("source_file", T.StringType()), T.StructField(spec.day, T.DateType())])


def _merge_pending(spark: SparkSession, paths: Paths, spec: SeriesSpec) -> None:
    """Puts the days of a finished merge in place; doing so again changes nothing."""
    merged = spark.read.parquet(f"{paths.pending}/rows")
    write_table(merged, paths.raw, partition_by=[spec.day], replace_all=False, rebalance=True)
    touched = [r[0] for r in spark.read.parquet(f"{paths.pending}/days").collect()]
    left = {r[0] for r in merged.select(spec.day).distinct().collect()}
    _drop_days(spark, paths.raw, spec.day, [d for d in touched if d not in left])
    _remove(spark, paths.pending)


def ingest_files(spark: SparkSession, paths: Paths, csv_path: str | Sequence[str], spec: SeriesSpec = DEFAULT_SPEC) -> dict:
    """Loads the files of a folder that were not loaded yet and merges their bars into their days.

    A file is known by the digest of its lines; of new files with equal lines one is loaded.  A path
    whose content changed replaces its earlier rows.  Lines that cannot be read go to the table of rejected lines
    with file and reason, in the same pass.  The merged days are written aside before they
    replace the old ones, and the ledger last: a run that was cut off is finished by the next one."""
    if _exists(spark, f"{paths.pending}/days/_SUCCESS"):
        _merge_pending(spark, paths, spec)
    elif _exists(spark, paths.pending):
        _remove(spark, paths.pending)
    lines = spark.createDataFrame(fingerprint.file_lines(spark, csv_path, [*CSV_COLUMNS, *spec.keys]).collect(), FILE_LINES)
    ledger = _read(spark, paths.file_ledger, FILE_LEDGER)
    new = runs.new_files(lines.withColumnRenamed("fingerprint", "dataset_hash"), ledger).collect()
    if not new:
        return {"status": "nothing_new", "files": 0}
    files = spark.createDataFrame(new)
    headers = fingerprint.header_files(files)
    stage = staging_path(spark, uuid.uuid4().hex, "lines")
    read_line_outcomes(spark, headers, keys=spec.keys).write.partitionBy("outcome").parquet(stage)  # one pass over the new files
    outcomes = spark.read.parquet(stage)
    good = _raw_frame(outcomes.filter(F.col("outcome") == GOOD), spec, ["file"]).withColumnRenamed("file", "source_file")
    good = good.withColumn(spec.day, F.to_date(spec.time))
    schema = _raw_schema(spec, {f.name: f.dataType for f in good.schema.fields})
    raw = spark.read.schema(schema).parquet(paths.raw) if _exists(spark, paths.raw) else spark.createDataFrame([], schema)
    own = F.col("source_file").isin([r["path"] for r in new])
    replaced = ledger.filter(F.col("path").isin([r["path"] for r in new])).count() > 0
    days = {r[0] for r in good.select(spec.day).distinct().collect()}
    if replaced:
        days |= {r[0] for r in raw.filter(own).select(spec.day).distinct().collect()}
    kept = rec.on_days(raw, sorted(days, key=str), spec).filter(~F.coalesce(own, F.lit(False)))
    good.select(*kept.columns).unionByName(kept).write.parquet(f"{paths.pending}/rows")
    spark.createDataFrame([(d,) for d in days], f"{spec.day} date").write.parquet(f"{paths.pending}/days")
    _merge_pending(spark, paths, spec)

    rejects = outcomes.filter(F.col("outcome").isin(list(REJECTED))).select("line", F.col("outcome").alias("reason"), "file")
    (rejects.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("file").parquet(paths.rejects))
    count = lambda cond, name: F.count_if(cond).alias(name)
    per = outcomes.groupBy("file").agg(count(F.col("outcome") == GOOD, "loaded"), count(F.col("outcome") == "missing", "missing"),
                                       count(F.col("outcome").isin(list(REJECTED)), "rejected"))
    entries = files.join(per, files["path"] == per["file"], "left").select(
        "path", "dataset_hash", (F.col("filled") - 1).alias("row_count"), *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("loaded", "missing", "rejected")],
        F.localtimestamp().alias("ingested_at")).collect()
    wrong = [r for r in entries if r["row_count"] != r["loaded"] + r["missing"] + r["rejected"]]
    if wrong:
        raise RuntimeError(f"lines and outcomes do not add up: {wrong}")
    spark.createDataFrame(entries, FILE_LEDGER).write.mode("append").parquet(paths.file_ledger)
    _remove(spark, stage)
    totals = {k: sum(r[k] for r in entries) for k in ("row_count", "loaded", "missing", "rejected")}
    log.info("%s new files, %s days: %s", len(new), len(days), totals)
    return {"status": "ingested", "files": len(new), "days": len(days), **totals}


# ---- days -------------------------------------------------------------------------

def changed_days(current: dict, before: dict) -> tuple[list, list]:
    """Days that are new or have other rows than before, and days that are gone."""
    return (sorted((d for d, v in current.items() if before.get(d) != v), key=str), sorted((d for d in before if d not in current), key=str))


def _other_days(days: Sequence, column: str = "day") -> Column:
    known = [d for d in days if d is not None]
    return ~(F.coalesce(F.col(column).isin(known), F.lit(False)) if known else F.lit(False)) & (F.col(column).isNotNull() if len(known) < len(days) else F.lit(True))


def analyze_changed(spark: SparkSession, paths: Paths, run_id: str | None = None, spec: SeriesSpec = DEFAULT_SPEC,
                    grid: Sequence[float] = backtest.DEFAULT_GRID) -> dict:
    """The feature table and run metrics that ``stages.analyze`` gives, computing only changed days.

    Windows never cross a day, so the features of a day follow from its bars; a day is changed if the digest of its
    bars is.  The threshold comes from the buckets of all days, new for changed days and kept for the others.
    Files of other days are rewritten only if the threshold moved, and then from the table itself.
    The day digests are written last: a run that was cut off is done again."""
    run_id = run_id or uuid.uuid4().hex
    raw = spark.read.parquet(paths.raw)
    raw = _raw_frame(raw, spec, [spec.day])
    per_day = fingerprint.row_fingerprint(raw.drop(spec.day), by=[F.col(spec.time).cast("date").alias("day")]).collect()
    current = {r["day"]: (r["n_rows"], r["fingerprint"]) for r in per_day}
    if not current:
        raise RuntimeError("the raw table holds no bar")
    known = _exists(spark, paths.day_state)
    before = {r["day"]: (r["n_rows"], r["fingerprint"]) for r in _read(spark, paths.day_state, DAY_STATE).collect()}
    changed, gone = changed_days(current, before)
    if known and not changed and not gone:
        return {"run_id": run_id, "status": "unchanged", "changed": 0}

    # features of the changed days, every check of them before anything is replaced
    part = rec.on_days(raw, changed, spec).drop(spec.day)
    bars = clean.valid_bars(clean.with_trade_date(clean.deduplicate(part, spec), spec), spec)
    seen, stage = Observation("changed"), staging_path(spark, run_id, "changed")
    (score(bars, spec).observe(seen, F.count(F.lit(1)).alias("rows"), *_rule_aggs(quality.JOB_RULES)).write.mode("overwrite").parquet(stage))
    q = seen.get
    hard = [r.name for r in quality.JOB_RULES if r.level == "error" and q.get(r.name)]
    if hard:
        raise RuntimeError(f"rules violated, nothing written: {hard} ({q})")
    staged = spark.read.parquet(stage)

    touched = [*changed, *gone]
    kept = _read(spark, paths.sweep_state, SWEEP_STATE).filter(_other_days(touched)) if known else spark.createDataFrame([], SWEEP_STATE)
    new = backtest.sweep_state(staged.withColumnRenamed(spec.day, "day"), ["day"], grid=grid)
    state_path = staging_path(spark, run_id, "state")
    kept.unionByName(new).write.mode("overwrite").parquet(state_path)
    state = spark.read.parquet(state_path)
    best = backtest.best(backtest.scores(backtest.sweep_of_state(state, grid))).first()
    threshold = float(best["threshold"])
    old = spark.read.schema("threshold double").json(paths.threshold).first() if known else None
    moved = old is None or old["threshold"] != threshold

    final = risk.with_alerts(staged, F.lit(threshold))
    gate = quality.checked(final, [F.count(F.lit(1)).alias("rows"), *quality.alert_counts()], spec).first().asDict()
    if gate["duplicate_keys"] or gate["severity_mismatch"]:
        raise RuntimeError(f"checks failed, nothing written: {gate}")
    _remove(spark, paths.day_state)  # from here on a run that is cut off starts anew
    if not known:
        write_table(final, paths.features, schema=FEATURES, keys=spec.keys, partition_by=[spec.day], rebalance=True)
    else:
        if moved:  # other days: the same features, new alerts
            others = spark.read.parquet(paths.features).filter(_other_days(touched, spec.day)).drop("crash_alert_flag", "crash_severity")
            aside = staging_path(spark, run_id, "others")
            risk.with_alerts(others, F.lit(threshold)).write.mode("overwrite").parquet(aside)
            write_table(spark.read.parquet(aside), paths.features, schema=FEATURES, keys=spec.keys, partition_by=[spec.day], replace_all=False, rebalance=True)
            _remove(spark, aside)
        if gate["rows"]:
            write_table(final, paths.features, schema=FEATURES, keys=spec.keys, partition_by=[spec.day], replace_all=False, rebalance=True)
        left = {r[0] for r in state.select("day").distinct().collect()}
        _drop_days(spark, paths.features, spec.day, [d for d in touched if d not in left])
    state.repartition(1).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(paths.sweep_state)
    write_document(spark.createDataFrame([(threshold,)], "threshold double"), paths.threshold)
    r4 = lambda c: round_places(c, runs.METRIC_DIGITS)
    m = backtest.metrics_of_state(state, threshold, grid).select(
        "rows", r4(F.lit(threshold)).alias("optimal_threshold"), *[r4(c).alias(c) for c in ("alert_rate", "crash_index_mean", "crash_index_std")]).first()
    metrics = {k: m[k] for k in runs.METRIC_NAMES}
    write_document(spark.createDataFrame([tuple(metrics.values())], ", ".join(f"{k} double" for k in metrics)), paths.metrics)
    write_table(spark.createDataFrame([(d, *v) for d, v in current.items()], DAY_STATE), paths.day_state)
    for path in (stage, state_path):
        _remove(spark, path)
    return {"run_id": run_id, "status": "analyzed", "changed": len(changed), "gone": len(gone), "threshold_moved": moved, "rows": m["rows"], "metrics": metrics}


# ---- keys -------------------------------------------------------------------------

def reconcile(spark: SparkSession, paths: Paths, spec: SeriesSpec = DEFAULT_SPEC) -> dict:
    """Writes the keys that the feature table lacks or should not have (``Paths.differences``); days whose key
    digests agree are read for the digest only."""
    raw, found = _raw_frame(spark.read.parquet(paths.raw), spec, [spec.day]), spark.read.parquet(paths.features)
    days = [r[0] for r in rec.differing_days(rec.expected_keys(raw.drop(spec.day), spec), found, spec).collect()]
    expected = rec.expected_keys(rec.on_days(raw, days, spec).drop(spec.day), spec)
    write_table(rec.key_differences(expected, found, spec, days), paths.differences, partition_by=[spec.day])
    out = spark.read.schema(T.StructType([*[f for f in found.schema.fields if f.name in spec.keys], T.StructField(spec.time, T.TimestampNTZType()),
                                          T.StructField("finding", T.StringType()), T.StructField("n", T.LongType()), T.StructField(spec.day, T.DateType())])
                            ).parquet(paths.differences)
    counts = {r["finding"]: r["n"] for r in out.groupBy("finding").agg(F.sum("n").alias("n")).collect()}
    return {"days": len(days), "lost": counts.get("lost", 0), "unexpected": counts.get("unexpected", 0)}
