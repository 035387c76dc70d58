"""Rolling moments from running sums against sliding frames."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from barline.operators.features import level1, level2, with_features
from barline.operators.moments import Measure, with_moments, with_running_features
from barline.plans import catalog
from barline.schemas import DEFAULT_SPEC
from tests.conftest import SF_MID, bars_df, ts

OUT = {"s5": ("sum", 5), "a5": ("avg", 5), "d5": ("stddev", 5), "a60": ("avg", 60), "d60": ("stddev", 60)}


def _series(values):
    return [(ts(0, k), ts(0, 0).date(), x) for k, x in enumerate(values)]


def _frames(values, k):
    for i in range(len(values)):
        yield [x for x in values[max(0, i - k + 1):i + 1] if x is not None]


def _run(spark, values):
    df = spark.createDataFrame(_series(values), "trade_timestamp timestamp_ntz, trade_date date, x double")
    return with_moments(df, [Measure("x", OUT)]).orderBy("trade_timestamp").collect()


CASES = {
    "noise": [random.Random(1).gauss(0, 1) for _ in range(400)],
    "huge offset": [1e9 + 1e-3 * random.Random(2).random() + k % 7 for k in range(400)],
    "flat": [0.1] * 300,
    "flat among wild": [0.1] * 80 + [random.Random(3).gauss(0, 50) for _ in range(80)] + [1 / 3] * 80 + [1e5] + [0.7] * 90,
    "steps": [float(k // 9) * 1e-6 for k in range(300)],
    "nulls": [None if k % 3 == 0 else math.sin(k) for k in range(200)],
    "all null": [None] * 20, "one": [2.5], "two": [1.0, 4.0],
    "tiny": [1e-200 * k for k in range(100)], "large": [1e200 * math.cos(k) for k in range(100)],
}


@pytest.mark.parametrize("name", CASES)
def test_against_the_definition(spark, name):
    values = CASES[name]
    present = [x for x in values if x is not None] or [0.0]
    span = max(present) - min(present)
    for row, f5, f60 in zip(_run(spark, values), _frames(values, 5), _frames(values, 60)):
        for f, s, a, d in ((f5, row.s5, row.a5, row.d5), (f60, None, row.a60, row.d60)):
            if not f:
                assert a is None and d is None
                continue
            mean = math.fsum(f) / len(f)
            tol = 1e-13 * span + 4e-16 * abs(mean)
            assert abs(a - mean) <= tol and (s is None or abs(s - math.fsum(f)) <= 5 * tol + 4e-16 * abs(math.fsum(f)))
            if len(f) < 2:
                assert d is None
            elif len(set(f)) == 1:
                assert d == 0.0
            else:
                exact = statistics.stdev(f) if span < 1e100 else span * statistics.stdev([x / span for x in f])
                assert abs(d - exact) <= 1e-12 * span + 1e-9 * exact, (name, f)


def test_long_day_and_keys(spark):
    spec = DEFAULT_SPEC.with_keys("k")
    df = spark.range(40_000).selectExpr("cast(id % 2 AS string) AS k", "timestamp_ntz'2024-01-02 00:00:00' + make_dt_interval(0, 0, 0, id) AS trade_timestamp",
                                        "date'2024-01-02' AS trade_date", "sin(id * 0.37) * (1 + id % 11) AS x")
    got = with_moments(df, [Measure("x", OUT)], spec)
    w = "OVER (PARTITION BY k ORDER BY trade_timestamp ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)"
    bad = got.selectExpr("*", f"avg(x) {w} AS a", f"stddev_samp(x) {w} AS d").filter("abs(a60 - a) > 1e-9 OR abs(d60 - d) > 1e-9 OR (d60 IS NULL) <> (d IS NULL)")
    assert bad.count() == 0


ROLLED = [r.name for r in (*level1(), *level2()) if not r.name.startswith("_")] + ["vwap_15min", "vwap_30min", "volatility_zscore", "drawdown", "volume_ratio"]


def test_features_equal_sliding_frames(spark):
    bars = catalog.valid_bars(spark, SF_MID)
    a, b = (f.select("trade_timestamp", *ROLLED) for f in (with_features(bars), with_running_features(bars)))
    both = a.join(b.select("trade_timestamp", *[F.col(c).alias(f"{c}_r") for c in ROLLED]), "trade_timestamp")
    assert both.count() == a.count()
    for c in ROLLED:
        # a quotient by a deviation carries the deviation's error, relative to it
        tol = f"1e-9 * greatest(1.0D, abs({c}))"
        assert both.filter(f"({c} IS NULL) <> ({c}_r IS NULL) OR abs({c} - {c}_r) > {tol}").count() == 0, c


def test_flat_day_has_no_deviation(spark):
    rows = [(ts(0, k), 10.1, 10.1, 10.1, 10.1, 7) for k in range(90)] + [(ts(1, k), 5 + k % 3, 9.0, 4.0, 5 + k % 3, k) for k in range(90)]
    bars = bars_df(spark, rows).withColumn("trade_date", F.to_date("trade_timestamp"))
    flat = with_running_features(bars).filter(F.col("trade_date") == ts(0, 0).date()).collect()
    assert len(flat) == 89 and {r.volatility_30min for r in flat[1:]} == {0.0} and {r.volatility_zscore for r in flat} == {0.0}


def test_one_shuffle_and_frames_checked(spark):
    bars = catalog.valid_bars(spark, SF_MID)
    plan = with_running_features(bars)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(trade_date") == 1
    with pytest.raises(ValueError):
        with_moments(bars, [Measure("volume", {"x": ("avg", 64)})])
