"""Dedup, duplicate reports, missing values; threshold sweep and choice."""

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barline.operators import backtest, clean, risk
from tests.conftest import bars_df, ts


# ---- dedup -------------------------------------------------------------------

def test_dedup_keeps_lowest_tiebreak_whatever_the_order(spark):
    rows = [(2, ts(0, 0), 11.0), (1, ts(0, 0), 10.0), (3, ts(0, 0), 12.0), (4, ts(0, 1), 20.0)]
    df = spark.createDataFrame(rows, "event_id long, trade_timestamp timestamp_ntz, close_price double")
    for parts in (1, 3):
        out = clean.deduplicate(df.repartition(parts), tiebreak=["event_id"], keep_count="n")
        got = {r.trade_timestamp: (r.event_id, r.close_price, r.n) for r in out.collect()}
        assert got[ts(0, 0)] == (1, 10.0, 3) and got[ts(0, 1)] == (4, 20.0, 1)


def test_dedup_without_tiebreak_is_deterministic(spark):
    a = bars_df(spark, [(ts(0, 0), 1, 1, 1, 2.0, 5), (ts(0, 0), 1, 1, 1, 1.0, 5)])
    b = bars_df(spark, [(ts(0, 0), 1, 1, 1, 1.0, 5), (ts(0, 0), 1, 1, 1, 2.0, 5)])
    ra, rb = clean.deduplicate(a).collect(), clean.deduplicate(b).collect()
    assert ra == rb and len(ra) == 1


@pytest.mark.parametrize("tiebreak", [["event_id"], None, ["event_id", "close_price"]])
def test_dedup_plan_is_a_partial_hash_aggregate(spark, tiebreak):
    df = spark.createDataFrame([(1, ts(0, 0), 1.0)], "event_id long, trade_timestamp timestamp_ntz, close_price double")
    plan = clean.deduplicate(df, tiebreak=tiebreak)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "Window" not in plan and "SortAggregate" not in plan and "ObjectHash" not in plan


def test_dedup_null_tiebreak_keeps_the_row(spark):
    rows = [(None, ts(0, 0), 11.0), (None, ts(0, 1), 20.0), (7, ts(0, 1), 21.0), (None, ts(0, 2), 30.0), (None, ts(0, 2), 31.0)]
    df = spark.createDataFrame(rows, "event_id long, trade_timestamp timestamp_ntz, close_price double")
    for parts in (1, 4):
        got = {r.trade_timestamp: (r.event_id, r.close_price) for r in clean.deduplicate(df.repartition(parts), tiebreak=["event_id"]).collect()}
        assert got[ts(0, 0)] == (None, 11.0) and got[ts(0, 1)] == (7, 21.0) and got[ts(0, 2)][1] in (30.0, 31.0)


def test_duplicate_keys_and_top_k(spark):
    rows = [(ts(0, m % 4), 1, 1, 1, 1.0, 1) for m in range(11)]  # minutes 0..3 seen 3,3,3,2 times
    df = bars_df(spark, rows)
    d = {r.trade_timestamp: r.n_rows for r in clean.duplicate_keys(df).collect()}
    assert d == {ts(0, 0): 3, ts(0, 1): 3, ts(0, 2): 3, ts(0, 3): 2}
    top = clean.top_duplicate_keys(df, n=2).collect()
    assert [r.trade_timestamp for r in top] == [ts(0, 0), ts(0, 1)]


def test_drop_missing_treats_nan_as_missing(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (None, "c"), (2.0, None)], "x double, y string")
    assert [r.x for r in clean.drop_missing(df).collect()] == [1.0]


def test_valid_bars_rules(spark):
    df = clean.with_trade_date(bars_df(spark, [
        (ts(0, 0), 0.0, 0.0, 0.0, 0.0, 1),      # zero passes
        (ts(0, 1), -0.01, 1.0, 1.0, 1.0, 1),    # negative open fails
        (ts(0, 2), 1.0, None, 1.0, 1.0, 1),     # NULL fails
        (ts(0, 3), 1.0, 1.0, 1.0, float("nan"), 1),  # NaN fails
    ]))
    assert [r.trade_timestamp for r in clean.valid_bars(df).collect()] == [ts(0, 0)]


def test_input_profile(spark):
    df = clean.with_trade_date(bars_df(spark, [(ts(0, 0), 1, 1, 1, 1, 1), (ts(2, 5), 1, 1, 1, 1, 1)]))
    r = clean.input_profile(df).first()
    assert (r.input_rows, r.min_date, r.max_date) == (2, ts(0, 0).date(), ts(2, 0).date())


# ---- back-test -----------------------------------------------------------------

def _scores_df(spark, pairs):
    return spark.createDataFrame(pairs, "crash_index double, true_crash int")


def _loop_sweep(pairs, grid=backtest.DEFAULT_GRID):
    """The per-threshold loop, as the source job ran it."""
    out = []
    for t in grid:
        tp = sum(1 for s, y in pairs if s is not None and s > t and y == 1)
        fp = sum(1 for s, y in pairs if s is not None and s > t and y == 0)
        fn = sum(1 for s, y in pairs if not (s is not None and s > t) and y == 1)
        p = tp / (tp + fp) if tp + fp > 0 else 0
        r = tp / (tp + fn) if tp + fn > 0 else 0
        f1 = 2 * p * r / (p + r) if p + r > 0 else 0
        out.append((t, tp, fp, fn, f1))
    return out


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.floats(-1, 6, allow_nan=False),
                                    st.sampled_from([0.5, 1.0, 2.5, 5.0])),
                          st.integers(0, 1)), min_size=1, max_size=40))
def test_bucket_sweep_equals_loop(spark, pairs):
    got = {r.threshold: (r.tp, r.fp, r.fn, r.f1)
           for r in backtest.scores(backtest.confusion_sweep(_scores_df(spark, pairs))).collect()}
    for t, tp, fp, fn, f1 in _loop_sweep(pairs):
        assert got[t][:3] == (tp, fp, fn)
        assert got[t][3] == pytest.approx(f1)
    best = backtest.best_threshold(_scores_df(spark, pairs)).first()
    loop = _loop_sweep(pairs)
    assert best.threshold == max(loop, key=lambda x: x[4])[0]


def test_best_threshold_cases(spark):
    # best at 2.5: positives score 3, negatives score 2.4
    pairs = [(3.0, 1)] * 5 + [(2.4, 0)] * 5
    assert backtest.best_threshold(_scores_df(spark, pairs)).first().threshold == 2.5
    # no positives: all F1 are 0 -> the lowest threshold
    assert backtest.best_threshold(_scores_df(spark, [(9.0, 0), (0.1, 0)])).first().threshold == 0.5
    # exactly on a threshold is not above it (strict >)
    sw = {r.threshold: r for r in backtest.confusion_sweep(_scores_df(spark, [(1.0, 1)])).collect()}
    assert sw[0.5].tp == 1 and sw[1.0].tp == 0 and sw[1.0].fn == 1
    # NULL scores are never predicted
    sw = {r.threshold: r for r in backtest.confusion_sweep(_scores_df(spark, [(None, 1), (None, 0)])).collect()}
    assert sw[0.5].tp == 0 and sw[0.5].fp == 0 and sw[0.5].fn == 1


def test_tp_non_increasing_in_threshold(spark):
    pairs = [(x / 7.0, x % 2) for x in range(50)]
    sw = sorted(backtest.confusion_sweep(_scores_df(spark, pairs)).collect(), key=lambda r: r.threshold)
    assert all(a.tp >= b.tp for a, b in zip(sw, sw[1:]))


def test_grouped_sweep(spark):
    df = spark.createDataFrame([("a", 3.0, 1), ("a", 0.1, 0), ("b", 0.7, 1)], "g string, crash_index double, true_crash int")
    best = {r.g: r.threshold for r in backtest.best(backtest.scores(backtest.confusion_sweep(df, by=["g"])), by=["g"]).collect()}
    assert best == {"a": 0.5, "b": 0.5}


def test_best_per_group_equals_two_step(spark):
    rows = [(g, (i * 37 % 61) / 10.0, int(i % 3 == 0)) for g in ("a", "b", "c") for i in range(40)]
    rows += [("d", None, 1), ("d", 0.2, 0)]
    df = spark.createDataFrame(rows, "g string, crash_index double, true_crash int")
    two = {r.g: (r.threshold, r.tp, r.fp, r.fn, r.f1)
           for r in backtest.best(backtest.scores(backtest.confusion_sweep(df, by=["g"])), by=["g"]).collect()}
    one = {r.g: (r.threshold, r.tp, r.fp, r.fn, r.f1) for r in backtest.best_per_group(df, ["g"]).collect()}
    assert one == two


def test_severity_edges(spark):
    t = 1.0
    df = spark.createDataFrame([(t,), (1.5 * t,), (2 * t,), (2.0001,), (None,), (0.2,)], "crash_index double")
    out = {r.crash_index: (r.crash_alert_flag, r.crash_severity)
           for r in risk.with_alerts(df, F.lit(t)).collect()}
    assert out[1.0] == (0, "LOW") and out[1.5] == (1, "MEDIUM") and out[2.0] == (1, "HIGH")
    assert out[2.0001] == (1, "CRITICAL") and out[None] == (0, "CRITICAL") and out[0.2] == (0, "LOW")


def test_label_strict(spark):
    df = spark.createDataFrame([(-0.03,), (-0.0300001,), (None,)], "drawdown double")
    got = [r.true_crash for r in risk.with_label(df).collect()]
    assert got == [0, 1, 0]
    assert not math.isnan(0.0)


def test_time_helpers_ignore_session_zone(spark):
    import datetime as dt
    from barline.functions import minute_floor, parse_bar_time
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 2, 30, 45), "20240310 02:30:45", "2024-99")],
                                   "ts timestamp_ntz, a string, b string")
        r = df.select(minute_floor("ts").alias("m"), parse_bar_time("a").alias("p"),
                      parse_bar_time("a", strict=False).alias("q"),
                      parse_bar_time("b", strict=False).alias("bad")).first()
        assert r.m == dt.datetime(2024, 3, 10, 2, 30)
        assert r.p == r.q == dt.datetime(2024, 3, 10, 2, 30, 45) and r.bad is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
