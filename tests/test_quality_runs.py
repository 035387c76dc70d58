"""Rules, gaps, coverage, checksum, drift, ledger and verdict."""

import pytest
from pyspark.sql import functions as F

from barline.operators import quality, runs
from barline.schemas import DEFAULT_SPEC, FEATURES
from tests.conftest import ts


def _feature_rows(spark, rows):
    """rows: dicts of feature values; the rest is filled with benign values."""
    base = {f.name: None for f in FEATURES.fields}
    full = []
    for i, r in enumerate(rows):
        d = dict(base)
        d.update(trade_timestamp=ts(0, i), trade_date=ts(0, 0).date(), open_price=1.0, high_price=1.0,
                 low_price=1.0, close_price=1.0, volume=1, log_return=0.0, momentum_5min=0.0,
                 momentum_15min=0.0, volatility_30min=0.1, volume_ratio=1.0, drawdown=-0.01,
                 volatility_zscore=0.0, crash_index=0.3, crash_alert_flag=0, crash_severity="LOW", true_crash=0)
        d.update(r)
        full.append(tuple(d[f.name] for f in FEATURES.fields))
    return spark.createDataFrame(full, FEATURES)


RULE_ROWS = {
    "null_timestamp": None,  # not constructible: trade_timestamp is NOT NULL
    "negative_volatility": {"volatility_30min": -0.1},
    "null_crash_index": {"crash_index": None, "crash_severity": "CRITICAL"},
    "negative_volume_ratio": {"volume_ratio": -1.0},
    "extreme_zscore": {"volatility_zscore": 11.0},
    "extreme_crash_index": {"crash_index": 51.0, "crash_alert_flag": 1, "crash_severity": "CRITICAL"},
    "severity_mismatch": {"crash_alert_flag": 1},
    "invalid_drawdown": {"drawdown": 0.01},
    "null_returns": {"log_return": None},
    "null_momentum_5min": {"momentum_5min": None},
    "null_momentum_15min": {"momentum_15min": None},
}


@pytest.mark.parametrize("rule", [k for k, v in RULE_ROWS.items() if v is not None])
def test_each_rule_trips_alone(spark, rule):
    df = _feature_rows(spark, [{}, RULE_ROWS[rule], {}])
    counts = quality.rule_counts(df, quality.JOB_RULES).first().asDict()
    assert counts[rule] == 1
    assert all(v == 0 for k, v in counts.items() if k != rule), counts


def test_rule_violations_long_format(spark):
    df = _feature_rows(spark, [{}, {"drawdown": 0.02}])
    job = {r.rule: r for r in quality.rule_violations(df, quality.JOB_RULES, rule_set="job").collect()}
    ver = {r.rule: r for r in quality.rule_violations(df, quality.VERIFY_RULES, rule_set="verify").collect()}
    # the same condition is a warning in the job and a failure in verification
    assert job["invalid_drawdown"].violations == 1 and not job["invalid_drawdown"].failed
    assert ver["positive_drawdown"].failed and ver["gaps"].violations == 0


def test_gaps_ignore_overnight(spark):
    rows = [(ts(0, 0),), (ts(0, 1),), (ts(0, 3),), (ts(1, 0),), (ts(1, 1),)]
    df = spark.createDataFrame(rows, "trade_timestamp timestamp_ntz").withColumn("trade_date", F.to_date("trade_timestamp"))
    g = quality.gap_rows(df).collect()
    assert [(r.prev_timestamp, r.trade_timestamp) for r in g] == [(ts(0, 1), ts(0, 3))]
    assert quality.gap_count(df).first().gap_count == 1


def test_split_neighbours_equal_plain(spark):
    import datetime as dt
    spec = DEFAULT_SPEC.with_keys("symbol")
    minutes = [m for m in range(300) if m % 17 not in (3, 4)]          # holes inside each day
    rows = [(k, ts(d, m)) for k in ("A", None) for d in range(2) for m in minutes]
    rows += [(None, ts(0, 5))] * 3 + [("A", ts(1, 20)), ("A", None), ("A", None)]  # copies, missing times
    rows += [("A", ts(0, 7) + dt.timedelta(microseconds=k)) for k in (1, 2, 3)]    # several in one second
    df = spark.createDataFrame(rows, "symbol string, trade_timestamp timestamp_ntz").withColumn(
        "trade_date", F.to_date("trade_timestamp"))

    def all_rows(split):
        return sorted((tuple(r) for r in quality.with_previous(df, spec, split).select(
            "symbol", "trade_date", "trade_timestamp", "prev_timestamp", F.col("_copy").cast("bigint")).collect()), key=repr)

    assert all_rows(True) == all_rows(False) and len(all_rows(True)) == len(rows)
    gaps = [quality.gap_count(df, spec, split=s).first().gap_count for s in (False, True)]
    assert gaps[0] == gaps[1] > 10
    counts = [quality.checked(df, [F.count(F.lit(1)).alias("n")], spec, s).first().asDict() for s in (False, True)]
    assert counts[0] == counts[1] and counts[0]["duplicate_keys"] == 2
    assert counts[0]["distinct_keys"] == len(set(rows))


def test_verification_is_one_scan_and_one_shuffle(spark, tmp_root):
    feats = _feature_rows(spark, [{} for _ in range(5)])
    feats.write.parquet(f"{tmp_root}/f")
    feats.select("trade_timestamp").write.parquet(f"{tmp_root}/r")
    rec = quality.verification_record(spark.read.parquet(f"{tmp_root}/r"), spark.read.parquet(f"{tmp_root}/f"))
    plan = rec._jdf.queryExecution().executedPlan().toString()
    assert plan.count(f"{tmp_root}/f") == 1
    assert plan.count("hashpartitioning(trade_date") == 1


def test_nan_counts_as_missing(spark):
    nan = float("nan")
    df = _feature_rows(spark, [{}, {"crash_index": nan, "crash_severity": "CRITICAL"}, {"log_return": nan}])
    counts = quality.rule_counts(df, quality.JOB_RULES).first().asDict()
    assert counts["null_crash_index"] == 1 and counts["null_returns"] == 1
    assert quality.table_checksum(df).first().n_rows == 3


def test_verification_row_counts_duplicates(spark):
    df = _feature_rows(spark, [{}, {}]).unionByName(_feature_rows(spark, [{}]))
    r = quality.verification_row(df).first()
    assert r.duplicate_count == 1 and r.gap_count == 0


def test_coverage_and_date_range(spark):
    raw = spark.createDataFrame([(ts(0, m),) for m in range(20)] + [(ts(0, 0),)], "trade_timestamp timestamp_ntz")
    feats = _feature_rows(spark, [{} for _ in range(19)])
    cov = quality.row_coverage(raw, feats).first()
    assert (cov.raw_rows_distinct, cov.analytics_rows, cov.coverage_ok) == (20, 19, True)
    assert quality.row_coverage(raw, _feature_rows(spark, [{}] * 18)).first().coverage_ok is False
    assert quality.date_range_match(raw, feats).first().date_range_ok is True
    raw2 = raw.union(spark.createDataFrame([(ts(3, 0),)], "trade_timestamp timestamp_ntz"))
    assert quality.date_range_match(raw2, feats).first().date_range_ok is False


def test_verification_record_agrees_with_the_separate_checks(spark):
    raw = spark.createDataFrame([(ts(0, m),) for m in range(20)] + [(ts(0, 0),)], "trade_timestamp timestamp_ntz")
    feats = _feature_rows(spark, [{"drawdown": 0.02}] + [{} for _ in range(18)])
    rec = quality.verification_record(raw, feats).first()
    cov = quality.row_coverage(raw, feats).first()
    dr = quality.date_range_match(raw, feats).first()
    ver = quality.verification_row(feats).first()
    assert (rec.raw_rows_distinct, rec.analytics_rows, rec.coverage_ok) == (
        cov.raw_rows_distinct, cov.analytics_rows, cov.coverage_ok)
    assert rec.date_range_ok == dr.date_range_ok and rec.min_raw == dr.min_raw
    assert rec.positive_drawdown == ver.positive_drawdown == 1 and rec.gap_count == ver.gap_count
    assert rec.checksum == quality.table_checksum(feats).first().checksum


def test_checksum_invariant_to_layout_and_sensitive_to_cells(spark):
    df = _feature_rows(spark, [{"close_price": float(i)} for i in range(30)])
    a = quality.table_checksum(df).first().checksum
    b = quality.table_checksum(df.repartition(7).orderBy(F.rand(3))).first().checksum
    assert a == b
    changed = df.withColumn("crash_index", F.when(F.col("close_price") == 7.0, 0.31).otherwise(F.col("crash_index")))
    assert quality.table_checksum(changed).first().checksum != a
    # a row with a missing part takes part too
    with_null = df.unionByName(_feature_rows(spark, [{"crash_index": None}]).withColumn(
        "trade_timestamp", F.lit(ts(0, 50))))
    assert quality.table_checksum(with_null).first().checksum != a


def test_day_digests_localise_a_change(spark):
    rows = [{"close_price": float(i)} for i in range(10)]
    df = _feature_rows(spark, rows).unionByName(
        _feature_rows(spark, rows).withColumn("trade_date", F.lit(ts(1, 0).date()))
        .withColumn("trade_timestamp", F.col("trade_timestamp") + F.expr("INTERVAL 1 DAY")))
    a = {r.trade_date: (r.n_rows, r.digest) for r in quality.day_digests(df).collect()}
    changed = df.withColumn("close_price", F.when((F.col("trade_date") == ts(1, 0).date())
                                                  & (F.col("close_price") == 3.0), 3.5).otherwise(F.col("close_price")))
    b = {r.trade_date: (r.n_rows, r.digest) for r in quality.day_digests(changed).collect()}
    assert a[ts(0, 0).date()] == b[ts(0, 0).date()] and a[ts(1, 0).date()] != b[ts(1, 0).date()]
    assert a[ts(0, 0).date()][0] == 10


def test_latest_rows(spark):
    df = _feature_rows(spark, [{} for _ in range(15)])
    got = [r.trade_timestamp for r in quality.latest_rows(df, n=10).collect()]
    assert got == [ts(0, i) for i in range(14, 4, -1)]


# ---- drift ---------------------------------------------------------------------

def _runs(spark, values):
    rows = [(i, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "seq int, optimal_threshold double")


def _drift_last(spark, history, current):
    df = _runs(spark, history + [current])
    out = runs.drift_test(df, order="seq", metrics=("optimal_threshold",))
    return out.orderBy(F.col("seq").desc()).first().drift_detected


def test_drift_rules(spark):
    assert _drift_last(spark, [], 9.0) is False                 # no history
    assert _drift_last(spark, [1.0], 9.0) is False              # one value
    assert _drift_last(spark, [1.0, 1.0, 1.0], 9.0) is False    # zero spread
    assert _drift_last(spark, [1.0, 3.0], 9.0) is True          # |9-2|/1 = 7
    assert _drift_last(spark, [1.0, 3.0], 5.0) is False         # z exactly 3 is not > 3
    assert _drift_last(spark, [1.0, 3.0], None) is False        # current NULL
    assert _drift_last(spark, [1.0, None, 3.0], 9.0) is True    # NULL history skipped
    # only the last five count: old outliers fall out of the window
    assert _drift_last(spark, [100.0, 1.0, 3.0, 1.0, 3.0, 1.0], 9.0) is True


def test_ledger_upsert_and_drift_against(spark, tmp_root):
    path = f"{tmp_root}/runs"
    for i, t in enumerate([0.5, 0.5, 1.0, 1.0]):
        row = runs.ledger_row(spark, f"r{i}", {"optimal_threshold": t, "alert_rate": 0.1,
                                               "crash_index_mean": 1.0, "crash_index_std": 0.2})
        runs.upsert_run(row, path)
    # rerun of r3 replaces its row, other runs stay
    runs.upsert_run(runs.ledger_row(spark, "r3", {"optimal_threshold": 1.5}), path)
    led = runs.read_ledger(spark, path)
    got = {r.run_id: r.optimal_threshold for r in led.collect()}
    assert got == {"r0": 0.5, "r1": 0.5, "r2": 1.0, "r3": 1.5}
    cur = spark.createDataFrame([(9.0, 0.1, 1.0, 0.2)], ", ".join(f"{m} double" for m in runs.METRIC_NAMES))
    assert runs.drift_against(cur, led).first().drift_detected is True
    assert runs.read_ledger(spark, f"{tmp_root}/none").count() == 0


def test_verdict_and_gate(spark):
    ok = runs.make_verdict(spark, {"raw_rows_distinct": 3, "analytics_rows": 3, "row_coverage_ratio": True})
    assert runs.gate(ok)["analytics_rows"] == 3
    bad = runs.make_verdict(spark, {"error": "boom"})
    with pytest.raises(RuntimeError, match="boom"):
        runs.gate(bad)
    with pytest.raises(RuntimeError, match="no verdict"):
        runs.gate(None)


def test_verdict_row_stops_at_the_first_failing_gate(spark):
    raw = spark.createDataFrame([(ts(0, m),) for m in range(20)], "trade_timestamp timestamp_ntz")

    def verdict(feats, r=raw):
        return runs.verdict_row(quality.verification_record(r, feats), quality.VERIFY_ERRORS).first()

    good = verdict(_feature_rows(spark, [{}] * 20))
    assert good.failed_gate is None and good.checksum and good.crash_index_ok
    bad = verdict(_feature_rows(spark, [{"drawdown": 0.1}] + [{}] * 19))
    assert bad.failed_gate == 4 and bad.failing == "positive_drawdown" and bad.date_range_ok and bad.checksum is None
    assert verdict(_feature_rows(spark, [{}] * 10)).failed_gate == 2
    assert verdict(_feature_rows(spark, [{}] * 21)).failed_gate == 1
    assert verdict(_feature_rows(spark, [{}]).filter("false")).failed_gate == 0


def test_guardrail_decisions(spark):
    incoming = spark.createDataFrame([("d1", "h1", 10), ("d2", "h2", 10), ("d3", "h3", 10)],
                                     "day string, dataset_hash string, row_count long")
    ledger = spark.createDataFrame([("h1",)], "dataset_hash string")
    existing = spark.createDataFrame([("d2", 12), ("d3", 4)], "day string, existing_rows long")
    got = {r.day: r.decision for r in runs.guardrail_decisions(incoming, ledger, existing, by=["day"]).collect()}
    assert got == {"d1": "skip_known", "d2": "skip_covered", "d3": "ingest"}
