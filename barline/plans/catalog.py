"""Named queries over the driver's tables (``events`` through the bar adapter).

Each query takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole table.  Floating outputs are rounded to ``DIGITS`` places so results
compare across engines whose window sums differ in the last bits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barline.functions import round_places
from barline.operators import backtest, clean, features, moments, ordered, quality, reconcile, risk, runs
from barline.schemas import DEFAULT_SPEC, FEATURES
from barline.sources import fingerprint
from barline.sources.csv import GOOD, conform_bars, line_outcomes
from barline.sources.events import bars_from_events, read_events

DIGITS = 6
SPEC = DEFAULT_SPEC
# Each event type as its own series: the keyed (multi-instrument) layout.
KEYED = DEFAULT_SPEC.with_keys("event_type")
# A series key that is NULL for a seventh of the users.
NULL_KEYED = DEFAULT_SPEC.with_keys("series")


def _r(c, digits: int = DIGITS):
    """Rounded for comparison; ``+ 0.0`` turns a rounded -0.0 into 0.0."""
    return round_places(c, digits) + F.lit(0.0)


# ---- shared stages (lazy) -----------------------------------------------------

def raw_bars(spark: SparkSession, sf: str, spec=DEFAULT_SPEC) -> DataFrame:
    """Adapter output, one raw bar per event (with ``event_id`` and the keys)."""
    events = read_events(spark, sf)
    if "series" in spec.keys:  # a key that is NULL for some events
        events = events.withColumn("series", F.expr("IF(user_id % 7 = 0, NULL, event_type)"))
    return bars_from_events(events, keys=spec.keys)


def dedup_bars(spark: SparkSession, sf: str, spec=DEFAULT_SPEC) -> DataFrame:
    d = clean.deduplicate(raw_bars(spark, sf, spec), spec, tiebreak=["event_id"]).drop("event_id")
    return clean.with_trade_date(d, spec)


def valid_bars(spark: SparkSession, sf: str, spec=DEFAULT_SPEC) -> DataFrame:
    return clean.valid_bars(dedup_bars(spark, sf, spec), spec)


def scored(spark: SparkSession, sf: str, spec=DEFAULT_SPEC, split_rows: int | None = None) -> DataFrame:
    """Features, VaR proxy, crash index and label (everything but the alert)."""
    f = features.with_features(valid_bars(spark, sf, spec), spec, split_rows=split_rows)
    return risk.with_label(risk.with_crash_index(risk.with_var_proxy(f)))


def final_parts(spark: SparkSession, sf: str, spec=DEFAULT_SPEC, split_rows: int | None = None):
    """``(feature table, threshold column)``: the 27-column table (plus keys) with the F1-chosen
    threshold as a scalar subquery over the same scored plan; its shuffles are reused."""
    s = scored(spark, sf, spec, split_rows)
    t = backtest.best_threshold(s).select("threshold").scalar()
    out = risk.with_alerts(s.withColumn("_t", t), F.col("_t")).select(*spec.keys, *FEATURES.fieldNames())
    return out, t


def returns(spark: SparkSession, sf: str, spec=DEFAULT_SPEC) -> DataFrame:
    """The rows of the feature table without the rolling features: for checks that need only
    keys, times and returns."""
    return features.with_log_returns(valid_bars(spark, sf, spec), spec)


def final(spark: SparkSession, sf: str, spec=DEFAULT_SPEC) -> DataFrame:
    return final_parts(spark, sf, spec)[0]


# ---- queries ------------------------------------------------------------------

def q_bars_adapter(spark, sf):
    return clean.with_trade_date(raw_bars(spark, sf), SPEC)


def q_duplicate_keys(spark, sf):
    return clean.duplicate_keys(raw_bars(spark, sf), SPEC)


def q_top_duplicate_keys(spark, sf):
    return clean.top_duplicate_keys(raw_bars(spark, sf), SPEC, n=20)


def q_dedup_bars(spark, sf):
    return dedup_bars(spark, sf)


def q_valid_bars(spark, sf):
    return valid_bars(spark, sf)


def q_input_profile(spark, sf):
    return clean.input_profile(dedup_bars(spark, sf), SPEC)


def q_log_returns(spark, sf):
    r = features.with_log_returns(valid_bars(spark, sf), SPEC)
    return r.select("trade_timestamp", "trade_date", "close_price", _r("log_return").alias("log_return"))


def _feature_cols(*cols):
    def q(spark, sf):
        s = scored(spark, sf)
        return s.select("trade_timestamp", *[_r(c).alias(c) for c in cols])
    return q


def q_volume_ratio(spark, sf):
    s = features.with_features(valid_bars(spark, sf), SPEC)
    return s.select("trade_timestamp", "volume", _r("avg_volume_30min").alias("avg_volume_30min"),
                    _r("volume_ratio").alias("volume_ratio"))


def q_true_crash(spark, sf):
    s = scored(spark, sf)
    return s.select("trade_timestamp", _r("drawdown").alias("drawdown"), "true_crash")


def q_confusion_sweep(spark, sf):
    return backtest.confusion_sweep(scored(spark, sf))


def q_f1_scores(spark, sf):
    sc = backtest.scores(backtest.confusion_sweep(scored(spark, sf)))
    return sc.select("threshold", "tp", "fp", "fn", *[_r(c).alias(c) for c in ("precision", "recall", "f1")])


def q_best_threshold(spark, sf):
    b = backtest.best_threshold(scored(spark, sf))
    return b.select("threshold", _r("f1").alias("f1"))


def q_alert_flag(spark, sf):
    return final(spark, sf).select("trade_timestamp", _r("crash_index").alias("crash_index"), "crash_alert_flag")


def q_crash_severity(spark, sf):
    return final(spark, sf).select("trade_timestamp", "crash_alert_flag", "crash_severity")


def q_severity_counts(spark, sf):
    return risk.severity_counts(final(spark, sf))


def q_null_checks(spark, sf):
    r = returns(spark, sf)
    return quality.null_checks(features.with_rolling(r, [x for x in features.level1(SPEC) if x.name.startswith("momentum")], SPEC))


def q_validation_summary(spark, sf):
    return quality.validation_summary(final(spark, sf))


def q_rule_violations(spark, sf):
    f = final(spark, sf)
    return quality.rule_violations(f, quality.JOB_RULES, SPEC, "job").unionByName(
        quality.rule_violations(f, quality.VERIFY_RULES, SPEC, "verify"))


def q_gap_rows(spark, sf):
    return quality.gap_rows(returns(spark, sf), SPEC)


def q_gap_count(spark, sf):
    return quality.gap_count(returns(spark, sf), SPEC)


def q_row_coverage(spark, sf):
    out = quality.row_coverage(raw_bars(spark, sf), returns(spark, sf), SPEC)
    return out.withColumn("coverage_ratio", _r("coverage_ratio"))


def q_date_range_match(spark, sf):
    return quality.date_range_match(raw_bars(spark, sf), returns(spark, sf), SPEC)


def q_latest_rows(spark, sf):
    out = quality.latest_rows(final(spark, sf), SPEC, n=10)
    return out.withColumn("crash_index", _r("crash_index"))


def q_table_checksum(spark, sf):
    return quality.table_checksum(final(spark, sf), SPEC)


def q_row_fingerprint(spark, sf):
    return fingerprint.row_fingerprint(raw_bars(spark, sf).drop("event_id"))


def q_daily_runs(spark, sf):
    return runs.daily_runs(scored(spark, sf), SPEC)


def q_drift_test(spark, sf):
    d = runs.daily_runs(scored(spark, sf), SPEC)
    out = runs.drift_test(d, order="trade_date")
    return out.select("trade_date", *runs.METRIC_NAMES,
                      *[f"{m}_drift" for m in runs.METRIC_NAMES], "drift_detected")


def q_run_metrics(spark, sf):
    f, t = final_parts(spark, sf)
    return runs.run_metrics(f, t)


def q_feature_table(spark, sf):
    return _rounded(final(spark, sf))


# Chunk size of the split evaluation in the catalog: small enough to cut every
# day of the test data into several chunks (a cluster would use ~10^6).
SPLIT_ROWS = 128


def q_feature_table_split(spark, sf):
    """The feature table through the split (skew-proof) window evaluation."""
    out, _ = final_parts(spark, sf, SPEC, split_rows=SPLIT_ROWS)
    return _rounded(out)


def q_gap_rows_split(spark, sf):
    """Gap rows through the split (skew-proof) previous-row lookup."""
    return quality.gap_rows(returns(spark, sf), SPEC, split=True)


def q_verification_row(spark, sf):
    return quality.verification_row(final(spark, sf), SPEC)


def q_verification_record(spark, sf):
    rec = quality.verification_record(raw_bars(spark, sf), final(spark, sf), SPEC)
    return rec.withColumn("coverage_ratio", _r("coverage_ratio"))


def q_ingest_guardrail(spark, sf):
    """Each day of events is an incoming dataset.  The ledger holds the fingerprints of every
    third day; of the days after those, all rows are stored already; of the rest, the bars."""
    ev = read_events(spark, sf)
    incoming = fingerprint.row_fingerprint(ev, by=[F.to_date("ts").alias("trade_date")]).select(
        "trade_date", F.col("fingerprint").alias("dataset_hash"), F.col("n_rows").alias("row_count"))
    ledger = incoming.filter(F.dayofmonth("trade_date") % 3 == 0).select("dataset_hash")
    existing = ev.groupBy(F.to_date("ts").alias("trade_date")).agg(F.expr(
        "IF(day(trade_date) % 3 = 1, count(1), count(DISTINCT date_trunc('minute', ts)))").alias("existing_rows"))
    return runs.guardrail_decisions(incoming, ledger, existing, by=["trade_date"])


# ---- tables with planted faults ----------------------------------------------------

def planted(spark, sf):
    """The feature table with every rule violated somewhere, by the minute of the day modulo 97,
    and some rows twice."""
    n = "((hour(trade_timestamp) * 60 + minute(trade_timestamp)) % 97)"
    change = {
        "volatility_30min": f"IF({n} = 2, -1.0D, volatility_30min)",
        "crash_index": f"CASE {n} WHEN 3 THEN NULL WHEN 4 THEN double('NaN') WHEN 7 THEN 51.0D ELSE crash_index END",
        "volume_ratio": f"IF({n} = 5, -1.0D, volume_ratio)",
        "volatility_zscore": f"IF({n} = 6, 11.0D, volatility_zscore)",
        "crash_alert_flag": f"IF({n} = 8, 1, crash_alert_flag)",
        "crash_severity": f"IF({n} = 8, 'LOW', crash_severity)",
        "drawdown": f"IF({n} = 9, 0.5D, drawdown)",
        "log_return": f"IF({n} = 10, NULL, log_return)",
        "momentum_5min": f"IF({n} = 11, double('NaN'), momentum_5min)",
        "momentum_15min": f"IF({n} = 12, NULL, momentum_15min)",
        "trade_timestamp": f"IF({n} = 1, NULL, trade_timestamp)",
        "_twice": f"explode(IF({n} = 13, array(1, 2, 3), array(1)))",
    }
    f = final(spark, sf)
    return f.select(*[F.expr(change.get(c, c)).alias(c) for c in f.columns], F.expr(change["_twice"]).alias("_twice")).drop("_twice")


def q_rule_violations_planted(spark, sf):
    f = planted(spark, sf)
    return quality.rule_violations(f, quality.JOB_RULES, SPEC, "job").unionByName(
        quality.rule_violations(f, quality.VERIFY_RULES, SPEC, "verify"))


def q_validation_summary_planted(spark, sf):
    return quality.validation_summary(planted(spark, sf))


def q_null_checks_planted(spark, sf):
    return quality.null_checks(planted(spark, sf))


def q_verification_row_planted(spark, sf):
    return quality.verification_row(planted(spark, sf), SPEC)


def q_verification_row_planted_split(spark, sf):
    return quality.verification_row(planted(spark, sf), SPEC, split=True)


def q_table_checksum_planted(spark, sf):
    return quality.table_checksum(planted(spark, sf), SPEC)


def q_valid_bars_planted(spark, sf):
    """Bars with NaN, NULL and negative prices among them."""
    b = dedup_bars(spark, sf).withColumns({
        "close_price": F.expr("IF(volume % 17 = 0, double('NaN'), close_price)"),
        "open_price": F.expr("IF(volume % 19 = 0, NULL, open_price)"),
        "low_price": F.expr("IF(volume % 23 = 0, -low_price - 1, low_price)")})
    return clean.valid_bars(b, SPEC)


def q_dedup_bars_by_value(spark, sf):
    """Copies ordered by their values, no id."""
    return clean.deduplicate(raw_bars(spark, sf).drop("event_id"), SPEC)


def q_csv_text_bars(spark, sf):
    """Events as the text of a CSV file (names in odd case, doubled blanks, missing tokens and
    fields), through the CSV conversion."""
    bars = raw_bars(spark, sf)
    stamp = F.date_format("trade_timestamp", "yyyyMMdd  HH:mm:ss")
    text = bars.select(
        "event_id", stamp.alias(" Date "), F.col("open_price").cast("string").alias("OPEN"), F.col("high_price").cast("string").alias("high"),
        F.col("low_price").cast("string").alias("Low"),
        F.expr("CASE event_id % 11 WHEN 0 THEN 'NA' WHEN 1 THEN 'NaN' ELSE CAST(close_price AS string) END").alias("Close"),
        F.expr("IF(event_id % 13 = 0, NULL, CAST(volume AS string))").alias("volume"),
        F.col("bar_count").cast("string").alias("barCount"), F.col("average_price").cast("string").alias("average"))
    # two files: the second has a column more, which the first loses nothing by
    noted = text.filter("event_id % 2 = 1").withColumn("note", F.expr("IF(event_id % 17 = 0, '', 'x')")).drop("event_id")
    return conform_bars(text.filter("event_id % 2 = 0").drop("event_id")).unionByName(conform_bars(noted))


def _ledger(spark, sf):
    """Daily runs as a run ledger, with some metrics missing."""
    d = runs.daily_runs(scored(spark, sf), SPEC)
    return d.select(F.col("trade_date").cast("string").alias("run_id"), F.col("trade_date").cast("timestamp_ntz").alias("execution_ts"),
                    "optimal_threshold", F.expr("IF(day(trade_date) % 4 = 0, NULL, alert_rate)").alias("alert_rate"),
                    "crash_index_mean", F.expr("IF(day(trade_date) % 3 = 0, NULL, crash_index_std)").alias("crash_index_std"))


def q_run_drift(spark, sf):
    """Every run against the latest five of the ledger."""
    led = _ledger(spark, sf)
    out = runs.drift_against(led.drop("execution_ts"), led)
    return out.select("run_id", *[f"{m}_drift" for m in runs.METRIC_NAMES], "drift_detected")


def q_verdict(spark, sf):
    """Verdicts of three tables: the features as they are, the same with their times closed up
    (every check passes), and an empty one."""
    raw, f = raw_bars(spark, sf), final(spark, sf)
    minute = F.row_number().over(Window.partitionBy("trade_date").orderBy("trade_timestamp"))
    closed = f.withColumn("trade_timestamp", F.col("trade_date").cast("timestamp_ntz") + F.make_dt_interval(mins=minute))
    out = None
    for name, r, t in (("events", raw, f), ("closed_up", closed, closed), ("empty", raw, f.filter("false"))):
        v = runs.verdict_row(quality.verification_record(r, t, SPEC), quality.VERIFY_ERRORS).withColumn("source", F.lit(name))
        out = v if out is None else out.unionByName(v)
    return out


# ---- order-sensitive digest, running moments, reconciliation, mergeable states ------------

def q_ordered_checksum(spark, sf):
    return ordered.ordered_checksum(final(spark, sf), SPEC)


def q_ordered_checksum_split(spark, sf):
    return ordered.ordered_checksum(final(spark, sf), SPEC, split=True)


def q_ordered_checksum_planted(spark, sf):
    """A table with NULL times, missing cells and repeated rows."""
    return ordered.ordered_checksum(planted(spark, sf), SPEC)


def q_keyed_ordered_checksum(spark, sf):
    return ordered.ordered_checksum(final(spark, sf, KEYED), KEYED)


def q_rolling_moments(spark, sf):
    """Every rolling column from running sums."""
    f = moments.with_running_features(valid_bars(spark, sf), SPEC)
    return f.select("trade_timestamp", *_rolled())


def q_keyed_rolling_moments(spark, sf):
    f = moments.with_running_features(valid_bars(spark, sf, KEYED), KEYED)
    return f.select("event_type", "trade_timestamp", *_rolled())


#: Rolling columns and what is made of them row by row.  The average prices stand as logarithms: quotients
#: of two-digit prices often end in a 5, where two correct sums that differ in the last bit round apart.
ROLLED = ("momentum_5min", "momentum_15min", "volatility_15min", "volatility_30min", "volatility_60min", "volume_ratio",
          "avg_range_15min", "rolling_peak", "drawdown", "volatility_mean_60", "volatility_std_60", "volatility_zscore")


def _rolled():
    return [*[_r(c).alias(c) for c in ROLLED], *[_r(F.log(c)).alias(f"log_{c}") for c in ("vwap_15min", "vwap_30min")]]


def _lossy(spark, sf, spec=DEFAULT_SPEC):
    """Keys that a feature table should have, and one with losses on every fifth day: a row in
    seven gone, one in eleven twice, one in thirteen half a minute late."""
    expected = returns(spark, sf, spec).select(*spec.group, spec.time)
    hit = "dayofyear(trade_date) % 5 = 0 AND minute(trade_timestamp) % {} = 0"
    found = expected.filter(f"NOT ({hit.format(7)})").selectExpr(
        *spec.group, f"trade_timestamp + IF({hit.format(13)}, INTERVAL 30 SECOND, INTERVAL 0 SECOND) AS trade_timestamp",
        f"explode(IF({hit.format(11)}, array(1, 2), array(1))) AS _twice").drop("_twice")
    return expected, found


def q_missing_keys(spark, sf):
    return reconcile.key_differences(*_lossy(spark, sf), SPEC)


def q_keyed_missing_keys(spark, sf):
    return reconcile.key_differences(*_lossy(spark, sf, NULL_KEYED), NULL_KEYED)


def q_differing_days(spark, sf):
    return reconcile.differing_days(*_lossy(spark, sf), SPEC)


def q_distinct_bars_bitmap(spark, sf):
    """Distinct keys of the raw bars, a tenth of them moved off the minute."""
    moved = raw_bars(spark, sf).withColumn("trade_timestamp", F.expr(
        "trade_timestamp + IF(event_id % 10 = 0, INTERVAL 20 SECOND, INTERVAL 0 SECOND)"))
    return reconcile.distinct_keys(moved, SPEC)


def q_keyed_distinct_bars_bitmap(spark, sf):
    return reconcile.distinct_keys(raw_bars(spark, sf, NULL_KEYED), NULL_KEYED)


def _bar_lines(spark, sf):
    """Bars as the lines of a CSV file per day, some with a field too many, a time or number that is none, or a
    missing value."""
    price = "CAST(CAST({} AS decimal(18,4)) AS string)"
    fields = ["IF(event_id % 23 = 0, date_format(trade_timestamp, 'yyyy-MM-dd'), date_format(trade_timestamp, 'yyyyMMdd HH:mm:ss'))",
              *[price.format(c) for c in ("open_price", "high_price", "low_price")],
              f"IF(event_id % 31 = 0, 'NA', {price.format('close_price')})", "IF(event_id % 29 = 0, 'x', CAST(volume AS string))",
              "CAST(event_id AS string)", price.format("average_price"), "IF(event_id % 19 = 0, '9', NULL)"]
    lines = raw_bars(spark, sf).selectExpr("CAST(to_date(trade_timestamp) AS string) AS file", f"concat_ws(',', {', '.join(fields)}) AS value")
    return line_outcomes(lines, "date,open,high,low,close,volume,barcount,average")


def q_rejected_rows(spark, sf):
    return _bar_lines(spark, sf).filter(F.col("outcome") != GOOD).select("file", "line", "outcome")


def q_line_outcomes(spark, sf):
    return _bar_lines(spark, sf).groupBy("file", "outcome").agg(F.count(F.lit(1)).alias("n"), F.count("trade_timestamp").alias("loaded"))


def q_new_files(spark, sf):
    """Every hour of events is a file, every fourth of them twice; a third of the hours is in the ledger."""
    ev = read_events(spark, sf).withColumn("path", F.date_format("ts", "yyyy-MM-dd HH"))
    files = fingerprint.row_fingerprint(ev.drop("path"), by=[F.date_format("ts", "yyyy-MM-dd HH").alias("path")]).select(
        "path", F.col("fingerprint").alias("dataset_hash"), F.col("n_rows").alias("row_count"))
    hour = F.substring("path", 12, 2).cast("int")
    copies = files.filter(hour % 4 == 0).withColumn("path", F.concat(F.lit("copy of "), "path"))
    return runs.new_files(files.unionByName(copies), files.filter(hour % 3 == 0).select("dataset_hash"))


def q_sweep_state_merge(spark, sf):
    """The sweep from states kept per day."""
    return backtest.sweep_of_state(backtest.sweep_state(scored(spark, sf), ["trade_date"]))


def q_merged_index_stats(spark, sf):
    """Number, mean and deviation of the index over the buckets of the whole table, merged from the days'."""
    whole = backtest.merge_states(backtest.sweep_state(scored(spark, sf), ["trade_date"]))
    return whole.select("bucket", "n", "positives", _r("mean").alias("mean"), _r(F.expr("IF(scored > 1, sqrt(m2 / (scored - 1)), NULL)")).alias("deviation"))


# ---- keyed series (one series per event type) ------------------------------------

def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[_r(c).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def q_keyed_dedup_bars(spark, sf):
    return dedup_bars(spark, sf, KEYED)


def q_keyed_feature_table(spark, sf):
    return _rounded(final(spark, sf, KEYED))


def q_keyed_feature_table_split(spark, sf):
    """Split evaluation over series of which one has a NULL key."""
    return _rounded(final_parts(spark, sf, NULL_KEYED, split_rows=SPLIT_ROWS)[0])


def q_keyed_daily_runs(spark, sf):
    return runs.daily_runs(scored(spark, sf, KEYED), KEYED)


def q_keyed_drift_test(spark, sf):
    d = runs.daily_runs(scored(spark, sf, KEYED), KEYED)
    out = runs.drift_test(d, order="trade_date", by=list(KEYED.keys))
    return out.select(*KEYED.keys, "trade_date", *runs.METRIC_NAMES,
                      *[f"{m}_drift" for m in runs.METRIC_NAMES], "drift_detected")


def q_keyed_gap_count(spark, sf):
    return quality.gap_count(returns(spark, sf, KEYED), KEYED)


def q_keyed_table_checksum(spark, sf):
    return quality.table_checksum(final(spark, sf, KEYED), KEYED)


def q_keyed_verification_row(spark, sf):
    return quality.verification_row(final(spark, sf, KEYED), KEYED)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bars_adapter": q_bars_adapter,
    "duplicate_keys": q_duplicate_keys,
    "top_duplicate_keys": q_top_duplicate_keys,
    "dedup_bars": q_dedup_bars,
    "valid_bars": q_valid_bars,
    "input_profile": q_input_profile,
    "log_returns": q_log_returns,
    "momentum": _feature_cols("momentum_5min", "momentum_15min"),
    "rolling_volatility": _feature_cols("volatility_15min", "volatility_30min", "volatility_60min"),
    "volume_ratio": q_volume_ratio,
    "vwap": _feature_cols("vwap_15min", "vwap_30min"),
    "avg_range": _feature_cols("avg_range_15min"),
    "volatility_baseline": _feature_cols("volatility_mean_60", "volatility_std_60"),
    "volatility_zscore": _feature_cols("volatility_zscore"),
    "drawdown": _feature_cols("rolling_peak", "drawdown"),
    "var_proxy": _feature_cols("var_95_proxy"),
    "crash_index": _feature_cols("crash_index"),
    "true_crash": q_true_crash,
    "confusion_sweep": q_confusion_sweep,
    "f1_scores": q_f1_scores,
    "best_threshold": q_best_threshold,
    "alert_flag": q_alert_flag,
    "crash_severity": q_crash_severity,
    "severity_counts": q_severity_counts,
    "null_checks": q_null_checks,
    "validation_summary": q_validation_summary,
    "rule_violations": q_rule_violations,
    "gap_rows": q_gap_rows,
    "gap_count": q_gap_count,
    "row_coverage": q_row_coverage,
    "date_range_match": q_date_range_match,
    "latest_rows": q_latest_rows,
    "table_checksum": q_table_checksum,
    "row_fingerprint": q_row_fingerprint,
    "daily_runs": q_daily_runs,
    "drift_test": q_drift_test,
    "run_metrics": q_run_metrics,
    "feature_table": q_feature_table,
    "feature_table_split": q_feature_table_split,
    "gap_rows_split": q_gap_rows_split,
    "verification_row": q_verification_row,
    "verification_record": q_verification_record,
    "ingest_guardrail": q_ingest_guardrail,
    "rule_violations_planted": q_rule_violations_planted,
    "validation_summary_planted": q_validation_summary_planted,
    "null_checks_planted": q_null_checks_planted,
    "verification_row_planted": q_verification_row_planted,
    "verification_row_planted_split": q_verification_row_planted_split,
    "table_checksum_planted": q_table_checksum_planted,
    "valid_bars_planted": q_valid_bars_planted,
    "dedup_bars_by_value": q_dedup_bars_by_value,
    "csv_text_bars": q_csv_text_bars,
    "run_drift": q_run_drift,
    "verdict": q_verdict,
    "ordered_checksum": q_ordered_checksum,
    "ordered_checksum_split": q_ordered_checksum_split,
    "ordered_checksum_planted": q_ordered_checksum_planted,
    "keyed_ordered_checksum": q_keyed_ordered_checksum,
    "rolling_moments": q_rolling_moments,
    "keyed_rolling_moments": q_keyed_rolling_moments,
    "missing_keys": q_missing_keys,
    "keyed_missing_keys": q_keyed_missing_keys,
    "differing_days": q_differing_days,
    "distinct_bars_bitmap": q_distinct_bars_bitmap,
    "keyed_distinct_bars_bitmap": q_keyed_distinct_bars_bitmap,
    "rejected_rows": q_rejected_rows,
    "line_outcomes": q_line_outcomes,
    "new_files": q_new_files,
    "sweep_state_merge": q_sweep_state_merge,
    "merged_index_stats": q_merged_index_stats,
    "keyed_feature_table_split": q_keyed_feature_table_split,
    "keyed_dedup_bars": q_keyed_dedup_bars,
    "keyed_feature_table": q_keyed_feature_table,
    "keyed_daily_runs": q_keyed_daily_runs,
    "keyed_drift_test": q_keyed_drift_test,
    "keyed_gap_count": q_keyed_gap_count,
    "keyed_table_checksum": q_keyed_table_checksum,
    "keyed_verification_row": q_keyed_verification_row,
}
