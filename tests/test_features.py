"""Rolling features against an independent pandas implementation (brute
force on a small fixture), plus hand-checked edge cases."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barline.operators import clean, features, risk
from barline.plans.stages import score
from tests.conftest import bars_df, ts


def _fixture_rows():
    rows = []
    # day 0: 70 bars, a random walk with a drop, a zero close at minute 40
    rng = np.random.default_rng(7)
    price = 100.0
    for m in range(70):
        price = round(price * math.exp(rng.normal(0, 0.004) - (0.01 if 45 <= m < 55 else 0)), 2)
        close = 0.0 if m == 40 else price
        vol = int(rng.integers(0, 500))
        rows.append((ts(0, m), price, price + 0.05, price - 0.05, close, vol))
    # day 1: flat prices (std exactly 0), zero volume for the first 20 bars
    for m in range(40):
        rows.append((ts(1, m), 50.0, 50.0, 50.0, 50.0, 0 if m < 20 else 10))
    # days 2-4: 1, 2 and 3 bars
    rows.append((ts(2, 0), 10.0, 10.0, 10.0, 10.0, 5))
    rows += [(ts(3, 0), 10.0, 10.1, 9.9, 10.0, 5), (ts(3, 1), 10.0, 10.2, 9.8, 10.1, 6)]
    rows += [(ts(4, m), 20.0, 20.5, 19.5, 20.0 + m, 7 + m) for m in range(3)]
    # day 5: a negative price (removed by validity) and a NULL low
    rows += [(ts(5, 0), 5.0, 5.0, 5.0, 5.0, 1), (ts(5, 1), -1.0, 5.0, 5.0, 5.0, 1),
             (ts(5, 2), 5.0, 5.2, None, 5.1, 1), (ts(5, 3), 5.0, 5.3, 4.9, 5.2, 2),
             (ts(5, 4), 5.0, 5.3, 4.9, 5.3, 2)]
    return rows


def _reference(rows) -> pd.DataFrame:
    df = pd.DataFrame(rows, columns=["trade_timestamp", "open_price", "high_price", "low_price",
                                     "close_price", "volume"])
    df = df[(df[["open_price", "high_price", "low_price", "close_price"]].fillna(-1) >= 0).all(axis=1)]
    df = df.sort_values("trade_timestamp")
    df["trade_date"] = df.trade_timestamp.dt.date
    out = []
    for _, g in df.groupby("trade_date"):
        g = g.copy()
        prev = g.close_price.shift(1)
        ratio = g.close_price / prev
        g["log_return"] = np.where((prev > 0) & (ratio > 0), np.log(ratio.where(ratio > 0, 1.0)), np.nan)
        g = g[g.log_return.notna()].copy()
        if g.empty:
            continue

        def roll(s, n, how):
            r = s.rolling(n, min_periods=1)
            return getattr(r, how)()

        lr, v = g.log_return, g.volume.astype(float)
        g["momentum_5min"] = roll(lr, 5, "mean")
        g["momentum_15min"] = roll(lr, 15, "mean")
        g["volatility_15min"] = roll(lr, 15, "std")
        g["volatility_30min"] = roll(lr, 30, "std")
        g["volatility_60min"] = roll(lr, 60, "std")
        g["avg_volume_30min"] = roll(v, 30, "mean")
        g["volume_ratio"] = np.where(g.avg_volume_30min > 0, v / g.avg_volume_30min, 0.0)
        for n in (15, 30):
            num, den = roll(g.close_price * v, n, "sum"), roll(v, n, "sum")
            g[f"vwap_{n}min"] = np.where(den != 0, num / den.where(den != 0, 1.0), np.nan)
        g["avg_range_15min"] = roll(g.high_price - g.low_price, 15, "mean")
        g["rolling_peak"] = g.close_price.cummax()
        g["drawdown"] = (g.close_price - g.rolling_peak) / g.rolling_peak
        g["var_95_proxy"] = g.volatility_30min * 1.65
        g["volatility_mean_60"] = roll(g.volatility_30min, 60, "mean")
        g["volatility_std_60"] = roll(g.volatility_30min, 60, "std")
        sd = g.volatility_std_60
        g["volatility_zscore"] = np.where(sd.notna() & (sd != 0),
                                          (g.volatility_30min - g.volatility_mean_60) / sd.where(sd != 0, 1.0), 0.0)
        g["crash_index"] = (0.35 * g.volatility_zscore + 0.25 * g.volume_ratio
                            + 0.25 * g.drawdown.abs() + 0.15 * g.log_return.abs())
        g["true_crash"] = (g.drawdown < -0.03).astype(int)
        out.append(g)
    return pd.concat(out).set_index("trade_timestamp").sort_index()


COLS = ["log_return", "momentum_5min", "momentum_15min", "volatility_15min", "volatility_30min",
        "volatility_60min", "avg_volume_30min", "volume_ratio", "vwap_15min", "vwap_30min",
        "avg_range_15min", "rolling_peak", "drawdown", "var_95_proxy", "volatility_mean_60",
        "volatility_std_60", "volatility_zscore", "crash_index", "true_crash"]


@pytest.fixture(scope="module")
def computed(spark):
    rows = _fixture_rows()
    bars = clean.valid_bars(clean.with_trade_date(bars_df(spark, rows)))
    got = score(bars).toPandas().set_index("trade_timestamp").sort_index()
    return got, _reference(rows)


def test_rows_match_reference(computed):
    got, ref = computed
    assert list(got.index) == list(ref.index)


@pytest.mark.parametrize("col", COLS)
def test_column_matches_reference(computed, col):
    got, ref = computed
    a, b = got[col].astype(float).to_numpy(), ref[col].astype(float).to_numpy()
    assert np.array_equal(np.isnan(a), np.isnan(b)), col
    m = ~np.isnan(a)
    np.testing.assert_allclose(a[m], b[m], rtol=1e-9, atol=1e-12)


def test_zero_close_removes_two_rows(computed):
    got, _ = computed
    day0 = got[got.trade_date == ts(0, 0).date()]
    # 70 bars: first has no return, the zero close and the bar after it have none
    assert len(day0) == 67


def test_first_rows_of_a_day(computed):
    got, _ = computed
    day3 = got[got.trade_date == ts(3, 0).date()]
    assert len(day3) == 1  # two bars -> one return
    r = day3.iloc[0]
    assert math.isnan(r.volatility_15min) and math.isnan(r.volatility_std_60)
    assert r.volatility_zscore == 0.0
    assert ts(2, 0).date() not in set(got.trade_date)  # a one-bar day has no return


def test_flat_day_and_zero_volume(computed):
    got, _ = computed
    day1 = got[got.trade_date == ts(1, 0).date()]
    assert (day1.volatility_30min.dropna() == 0.0).all()
    assert (day1.volatility_zscore == 0.0).all()
    assert (day1.drawdown == 0.0).all()
    early = day1.iloc[:5]
    assert early.vwap_15min.isna().all() and (early.volume_ratio == 0.0).all()


def test_drawdown_never_positive_and_peak_monotone(computed):
    got, _ = computed
    assert (got.drawdown <= 0).all()
    for _, g in got.groupby("trade_date"):
        assert g.rolling_peak.is_monotonic_increasing


def test_feature_chain_shares_one_exchange(spark):
    bars = clean.valid_bars(clean.with_trade_date(bars_df(spark, _fixture_rows())))
    plan = score(bars)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Window [") >= 3


def test_multi_series_equals_each_series_alone(spark):
    rows = _fixture_rows()
    a = bars_df(spark, rows).withColumn("symbol", F.lit("A"))
    b = bars_df(spark, rows).withColumn("symbol", F.lit("B")).withColumn("close_price", F.col("close_price") * 2)
    from barline.schemas import DEFAULT_SPEC
    spec = DEFAULT_SPEC.with_keys("symbol")
    both = a.unionByName(b).repartition(5)
    got = score(clean.valid_bars(clean.with_trade_date(both, spec), spec), spec)
    one = score(clean.valid_bars(clean.with_trade_date(b.drop("symbol"))))
    g = got.filter("symbol = 'B'").drop("symbol").orderBy("trade_timestamp").collect()
    o = one.orderBy("trade_timestamp").select(*[c for c in got.columns if c != "symbol"]).collect()
    assert [tuple(r) for r in g] == [tuple(r) for r in o]


def test_var_and_index_weights(spark):
    df = spark.createDataFrame([(1.0, 2.0, -0.1, 0.02, 0.5)],
                               "volatility_zscore double, volume_ratio double, drawdown double, "
                               "log_return double, volatility_30min double")
    r = risk.with_crash_index(risk.with_var_proxy(df)).first()
    assert r.var_95_proxy == pytest.approx(0.825)
    assert r.crash_index == pytest.approx(0.35 + 0.5 + 0.025 + 0.003)


def test_log_returns_keep_undefined_when_asked(spark):
    bars = clean.with_trade_date(bars_df(spark, [(ts(0, 0), 1, 1, 1, 1.0, 1), (ts(0, 1), 1, 1, 1, 2.0, 1)]))
    r = features.with_log_returns(bars, drop_undefined=False).orderBy("trade_timestamp").collect()
    assert r[0].log_return is None and r[1].log_return == pytest.approx(math.log(2))


def test_results_do_not_depend_on_input_partitioning(spark):
    rows = _fixture_rows()
    base = bars_df(spark, rows)
    outs = []
    for parts in (1, 3, 11):
        df = base.repartition(parts).orderBy(F.rand(parts))
        got = score(clean.valid_bars(clean.with_trade_date(clean.deduplicate(df))))
        outs.append(sorted(tuple(r) for r in got.collect()))
    assert outs[0] == outs[1] == outs[2]


@pytest.mark.parametrize("split_rows", [3, 7, 90, 1000])
def test_split_evaluation_equals_plain(spark, split_rows):
    from barline.operators.features import SPLIT_HALO
    rows = _fixture_rows()
    bars = clean.valid_bars(clean.with_trade_date(bars_df(spark, rows)))
    plain = features.with_features(bars)
    if split_rows < SPLIT_HALO:
        with pytest.raises(ValueError):
            features.with_features(bars, split_rows=split_rows)
        return
    split = features.with_features(bars, split_rows=split_rows).select(*plain.columns)
    assert sorted(tuple(r) for r in split.collect()) == sorted(tuple(r) for r in plain.collect())


def test_split_evaluation_on_events(spark):
    from barline.plans import catalog
    v = catalog.valid_bars(spark, "/root/testdata/sf0.01")
    plain = features.with_features(v)
    split = features.with_features(v, split_rows=SPLIT).select(*plain.columns)
    a = sorted(tuple(r) for r in plain.collect())
    b = sorted(tuple(r) for r in split.collect())
    assert len(a) == 8927 and a == b


SPLIT = 128


def test_split_evaluation_on_long_days(spark):
    from tests.test_sources_stages import walk_bars
    bars = clean.valid_bars(clean.with_trade_date(walk_bars(spark, days=4, minutes=390)))
    plain = score(bars)
    split = score(bars, split_rows=100).select(*plain.columns)
    assert sorted(tuple(r) for r in split.collect()) == sorted(tuple(r) for r in plain.collect())


def test_split_evaluation_with_null_keys_and_shared_seconds(spark):
    import datetime as dt
    from barline.schemas import DEFAULT_SPEC
    spec = DEFAULT_SPEC.with_keys("symbol")
    rows = [(k, ts(d, 0) + dt.timedelta(microseconds=(m * 37_000_003) % 900_000_000 if m % 3 else m * 1000), 100.0 + (m * 7 + d) % 13)
            for k in ("A", None, "B") for d in range(2) for m in range(300)]
    df = spark.createDataFrame([(k, t, c, c + 1, c - 1, c, int(c), 1, c) for k, t, c in rows],
                               "symbol string, trade_timestamp timestamp_ntz, open_price double, high_price double, low_price double, "
                               "close_price double, volume long, bar_count int, average_price double")
    bars = clean.valid_bars(clean.with_trade_date(clean.deduplicate(df, spec), spec), spec)
    plain = features.with_features(bars, spec)
    split = features.with_features(bars, spec, split_rows=128).select(*plain.columns)
    a, b = ([repr(x) for x in sorted((tuple(r) for r in f.collect()), key=repr)] for f in (plain, split))
    assert a == b and sum("None" in x.split(",")[0] for x in a) > 500


def _exchanges(df):
    import re
    text = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    nodes = re.findall(r"^\(\d+\) (\w+)", text, flags=re.M)
    return nodes


def test_daily_runs_reuse_the_day_partitioning(spark):
    from barline.operators import runs
    bars = clean.valid_bars(clean.with_trade_date(clean.deduplicate(bars_df(spark, _fixture_rows()))))
    nodes = _exchanges(runs.daily_runs(score(bars)))
    # dedup shuffle + window shuffle; the per-day aggregation needs none of its own
    assert nodes.count("Exchange") == 2 and not any(n.endswith("Join") for n in nodes)


def test_verification_record_has_no_join(spark):
    from barline.operators import quality
    bars = clean.valid_bars(clean.with_trade_date(bars_df(spark, _fixture_rows())))
    feats = risk.with_alerts(score(bars), F.lit(1.0))
    nodes = _exchanges(quality.verification_record(bars, feats))
    assert not any(n.endswith("Join") for n in nodes)
