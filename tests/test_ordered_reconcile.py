"""Order-sensitive digests, reconciliation of two tables, distinct keys by bitmaps, mergeable sweep states."""

import datetime as dt
import glob
import random

import pytest
from pyspark.sql import functions as F

from barline.operators import backtest, ordered, reconcile
from barline.plans import catalog
from barline.schemas import DEFAULT_SPEC
from barline.sources.fingerprint import file_lines
from tests.conftest import SF_SMALL, ts

SCHEMA = "trade_timestamp timestamp_ntz, trade_date date, close_price double, crash_index double, crash_alert_flag int"
KEYED = DEFAULT_SPEC.with_keys("k")


def _table(spark, rows):
    """rows: (day, minute, close)"""
    return spark.createDataFrame([(ts(d, m), ts(d, 0).date(), float(c), 0.5, 0) for d, m, c in rows], SCHEMA)


ROWS = [(d, m, 100 * d + m) for d in range(3) for m in range(50)]


def _sum(df, **kw):
    return ordered.ordered_checksum(df, **kw).first().checksum


def test_ordered_checksum_sees_order_and_nothing_else(spark):
    df = _table(spark, ROWS)
    a = _sum(df)
    assert a == _sum(df.repartition(7).orderBy(F.rand(3))) == _sum(df.coalesce(1)) == _sum(df, split=True)
    swapped = dict(((d, m), c) for d, m, c in ROWS)
    swapped[1, 7], swapped[1, 8] = swapped[1, 8], swapped[1, 7]
    assert _sum(_table(spark, [(d, m, c) for (d, m), c in swapped.items()])) != a
    # the values alone, at other places of the order
    shift = [(d, m + 60 if m == 9 else m, c) for d, m, c in ROWS]
    assert _sum(_table(spark, shift), cols=["crash_alert_flag"]) != _sum(df, cols=["crash_alert_flag"])
    for changed in (ROWS[:-1], ROWS + ROWS[:1], [*ROWS[:-1], (2, 49, 0.5)]):
        assert _sum(_table(spark, changed)) != a


def test_parts_combine_to_the_whole(spark):
    df = _table(spark, ROWS)
    parts = ordered.day_parts(df, cols=["close_price"])
    kept = parts.filter(F.col("trade_date") != ts(1, 0).date())
    new = ordered.day_parts(df.filter(F.col("trade_date") == ts(1, 0).date()), cols=["close_price"])
    assert ordered.combined_checksum(kept.unionByName(new)).first() == ordered.ordered_checksum(df, cols=["close_price"]).first()


def test_ordered_checksum_by_the_definition(spark):
    import hashlib
    df = _table(spark, ROWS)
    md5s = [r.m for r in df.orderBy("trade_timestamp").select(ordered.row_md5(df, DEFAULT_SPEC, ["close_price"]).alias("m")).collect()]
    h = [sum((int(m[8 * k:8 * k + 8], 16) % (p - 1) + 1) * pow(b, i, p) for i, m in enumerate(md5s)) % p
         for k, (p, b) in enumerate(zip(ordered.PRIMES, ordered.BASES))]
    want = hashlib.md5("|".join(map(str, [len(md5s), *h])).encode()).hexdigest()
    assert _sum(df, cols=["close_price"]) == want
    empty = ordered.ordered_checksum(df.filter("false")).first()
    assert empty.n_rows == 0 and empty.checksum == hashlib.md5(b"0|0|0|0|0").hexdigest()


def test_ordered_checksum_of_keyed_rows_with_nulls_and_copies(spark):
    df = _table(spark, ROWS + ROWS[:5]).withColumn("k", F.expr("IF(minute(trade_timestamp) % 3 = 0, NULL, minute(trade_timestamp) % 2)"))
    df = df.withColumn("trade_timestamp", F.expr("IF(close_price = 7, NULL, trade_timestamp)"))
    a = _sum(df, spec=KEYED)
    assert a == _sum(df.repartition(9), spec=KEYED) == _sum(df, spec=KEYED, split=True)


def test_no_task_holds_the_table(spark):
    plan = ordered.ordered_checksum(_table(spark, ROWS))._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("split", ["64b", "200b", "1m"])
def test_file_digest_is_of_the_lines_in_order(spark, tmp_root, split):
    lines = [f"line {k} of the file, {'x' * (k % 17)}" for k in range(120)]
    other = list(lines)
    other[30], other[31] = other[31], other[30]
    texts = {"a": "\n".join(lines) + "\n", "same": "\n".join(lines) + "\n", "swapped": "\n".join(other) + "\n",
             "shorter": "\n".join(lines[:-1]) + "\n", "no_end": "\n".join(lines), "returns": "\r\n".join(lines) + "\r\n", "doubled": "\n".join(lines + lines) + "\n"}
    for name, text in texts.items():
        with open(f"{tmp_root}/{name}.csv", "w", newline="") as f:
            f.write(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = {r.path.rsplit("/", 1)[1][:-4]: (r.lines, r.fingerprint) for r in file_lines(spark, tmp_root).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got["a"] == got["same"] and got["a"][0] == 120 and got["doubled"][0] == 240
    assert len({v for k, v in got.items() if k != "same"}) == len(texts) - 1
    SEEN.setdefault("got", got)
    assert SEEN["got"] == got  # the same for any split size


SEEN: dict = {}


def test_differences_by_key(spark):
    expected = _table(spark, ROWS)
    found = [r for r in ROWS if r[0] != 1 or r[1] not in (3, 4)] + [(1, 70, 1), (1, 5, 1), (1, 5, 2)]
    got = {(r.trade_timestamp, r.finding, r.n) for r in reconcile.key_differences(expected, _table(spark, found)).collect()}
    assert got == {(ts(1, 3), "lost", 1), (ts(1, 4), "lost", 1), (ts(1, 70), "unexpected", 1), (ts(1, 5), "unexpected", 2)}
    assert [r.trade_date for r in reconcile.differing_days(expected, _table(spark, found)).collect()] == [ts(1, 0).date()]
    assert reconcile.key_differences(expected, expected.repartition(3)).count() == 0


def test_equal_days_are_not_read(spark, tmp_root):
    for name, rows in (("expected", ROWS), ("found", [r for r in ROWS if r[:2] != (2, 8)])):
        _table(spark, rows).write.partitionBy("trade_date").parquet(f"{tmp_root}/{name}")
    expected, found = (spark.read.parquet(f"{tmp_root}/{n}") for n in ("expected", "found"))
    days = [r[0] for r in reconcile.differing_days(expected, found).collect()]
    assert days == [ts(2, 0).date()]
    for f in glob.glob(f"{tmp_root}/*/trade_date=*/*.parquet"):
        if str(days[0]) not in f:
            with open(f, "wb") as out:  # a file that cannot be read
                out.write(b"nothing")
    diff = reconcile.key_differences(expected, found, days=days)
    assert [(r.trade_timestamp, r.finding) for r in diff.collect()] == [(ts(2, 8), "lost")]


def test_days_may_be_null(spark):
    a = _table(spark, ROWS).withColumn("trade_date", F.expr("IF(day(trade_date) % 2 = 0, NULL, trade_date)"))
    b = a.filter("trade_date IS NOT NULL OR close_price > 20")
    days = [r[0] for r in reconcile.differing_days(a, b).collect()]
    assert days == [None]
    lost = a.count() - b.count()
    assert lost > 0 and reconcile.key_differences(a, b, days=days).count() == reconcile.key_differences(a, b).count() == lost


def test_distinct_keys(spark):
    r = random.Random(5)
    rows = [(str(r.choice("ab")) if r.random() < 0.8 else None, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=r.randrange(90_000), seconds=r.choice([0, 0, 0, 7])))
            for _ in range(4000)] + [("a", None), ("b", dt.datetime(1, 1, 1)), ("b", dt.datetime(9999, 12, 31, 23, 59))]
    df = spark.createDataFrame(rows, "k string, trade_timestamp timestamp_ntz").repartition(5)
    assert reconcile.distinct_keys(df, KEYED).first()[0] == len({x for x in rows if x[1] is not None})
    assert reconcile.distinct_keys(df).first()[0] == len({x[1] for x in rows if x[1] is not None})
    assert reconcile.distinct_keys(df.filter("false")).first()[0] == 0
    on = df.filter("second(trade_timestamp) = 0")
    states = [reconcile.minute_bitmaps(on.filter(f"hash(trade_timestamp) % 2 {op} 0"), KEYED) for op in ("=", "<>")]
    merged = reconcile.merged_bitmaps(states[0].unionByName(states[1]).unionByName(states[0]), KEYED)
    assert merged.selectExpr("sum(bitmap_count(bits))").first()[0] == len({x for x in rows if x[1] is not None and x[1].second == 0})
    assert merged.count() <= 3 * 6  # one row per series and 32,768 minutes


def test_states_merge_to_the_sweep(spark):
    df = catalog.scored(spark, SF_SMALL).select("trade_date", "crash_index", "true_crash")
    df = df.unionByName(df.limit(3).withColumn("crash_index", F.lit(None).cast("double")))
    days = backtest.sweep_state(df, ["trade_date"])
    whole = lambda rows: sorted(map(tuple, rows.collect()))
    assert whole(backtest.sweep_of_state(days)) == whole(backtest.confusion_sweep(df))
    assert whole(backtest.sweep_of_state(backtest.merge_states(days))) == whole(backtest.confusion_sweep(df))
    for t in (0.5, 2.0, 5.0):
        m, e = backtest.metrics_of_state(days, t).first(), df.selectExpr(
            "count(1) AS rows", f"avg(IF(crash_index > {t}, 1, 0)) AS alert_rate", "avg(crash_index) AS crash_index_mean", "stddev_samp(crash_index) AS crash_index_std").first()
        assert m.rows == e.rows and m.alert_rate == pytest.approx(e.alert_rate) and m.crash_index_mean == pytest.approx(e.crash_index_mean)
        assert m.crash_index_std == pytest.approx(e.crash_index_std)
