"""CSV source, fingerprints, end-to-end stages, streaming ingest."""

import datetime as dt
import hashlib
import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from barline.plans import stages
from barline.plans.stages import Paths
from barline.session import staging_path
from barline.sources import csv as csv_src
from barline.sources import fingerprint
from barline.streaming.ingest import start_ingest

HEADER = "date,open,high,low,close,volume,barcount,average"


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


def test_csv_by_name_with_variants(spark, tmp_root):
    text = (" Close ,DATE,Open,HIGH,low,Volume,BarCount,average,Note\n"
            "10.5,20080102 09:30:00,10.0,10.6,9.9,100,5,10.2,x\n"
            "10.6,20080102  09:31:00,10.5,10.7,10.4,120,6,10.55,\n"   # two blanks in date; blank extra
            "NA,20080102 09:32:00,10.5,10.7,10.4,120,6,10.55,y\n"      # NA token -> dropped
            "10.7,20080102 09:33:00,10.6,10.8,10.5,130,7,10.65,z\n")
    p = _write(f"{tmp_root}/a.csv", text)
    got = csv_src.read_bars_csv(spark, p).orderBy("trade_timestamp").collect()
    assert [r.trade_timestamp for r in got] == [dt.datetime(2008, 1, 2, 9, 30), dt.datetime(2008, 1, 2, 9, 33)]
    assert got[0].close_price == 10.5 and got[0].open_price == 10.0 and got[0].volume == 100
    assert got[0].bar_count == 5 and got[0].average_price == 10.2


def test_csv_keeps_series_keys(spark, tmp_root):
    text = ("Symbol,date,open,high,low,close,volume,barcount,average\n"
            "A,20080102 09:30:00,1,1,1,1,1,1,1\nB,20080102 09:30:00,2,2,2,2,2,2,2\n")
    p = _write(f"{tmp_root}/k.csv", text)
    got = sorted((r.symbol, r.close_price) for r in csv_src.read_bars_csv(spark, p, keys=["symbol"]).collect())
    assert got == [("A", 1.0), ("B", 2.0)]


def test_csv_schema_and_parse_errors(spark, tmp_root):
    p = _write(f"{tmp_root}/missing.csv", "date,open,high,low,close,volume,average\n20080102 09:30:00,1,1,1,1,1,1\n")
    with pytest.raises(ValueError, match="no header"):
        csv_src.read_bars_csv(spark, p)
    p = _write(f"{tmp_root}/bad.csv", HEADER + "\n2008-01-02 09:30,1,1,1,1,1,1,1\n")
    with pytest.raises(Exception):
        csv_src.read_bars_csv(spark, p).collect()
    assert csv_src.read_bars_csv(spark, p, strict=False).count() == 0


def _dataset(spark, path):
    return stages.dataset_fingerprint(fingerprint.file_lines(spark, path, ["date"]))


def test_fingerprints(spark, tmp_root):
    text = HEADER + "\n" + "\n".join(f"20080102 09:{m:02d}:00,1,1,1,1,1,1,1" for m in range(30)) + "\n"
    p = _write(f"{tmp_root}/f.csv", text)
    row = fingerprint.file_fingerprints(spark, p).first()
    assert row.dataset_hash == hashlib.sha256(text.encode()).hexdigest()
    h, n = _dataset(spark, p)
    assert n == 30 and len(h) == 64
    # any number of read splits gives the same hash
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100b")
    try:
        assert _dataset(spark, p) == (h, n)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    # a folder of files: independent of listing order, changes with any line of any file
    d = f"{tmp_root}/many"
    os.makedirs(d)
    for i in range(3):
        _write(f"{d}/p{i}.csv", text.replace("09:0", f"1{i}:0"))
    h3, n3 = _dataset(spark, d)
    assert n3 == 90 and len(h3) == 64 and h3 != h
    _write(f"{d}/p1.csv", text.replace("09:0", "11:0").replace("11:05:00,1,", "11:05:00,2,"))
    assert _dataset(spark, d)[0] != h3
    assert {r.path[-6:]: r.row_count for r in fingerprint.input_line_counts(spark, d).collect()} == {
        "p0.csv": 30, "p1.csv": 30, "p2.csv": 30}


def test_csv_short_and_long_rows(spark, tmp_root):
    good, short = "20080102 09:30:00,1,1,1,1,1,1,1", "20080102 09:31:00,1,1,1"
    p = _write(f"{tmp_root}/short.csv", "\n".join([HEADER, good, short]) + "\n")
    assert csv_src.read_bars_csv(spark, p).count() == 1  # the short row misses fields and is dropped
    p = _write(f"{tmp_root}/long.csv", "\n".join([HEADER, good, good + ",9"]) + "\n")
    with pytest.raises(Exception, match="too many fields"):
        csv_src.read_bars_csv(spark, p).collect()


def test_csv_files_with_different_column_order(spark, tmp_root):
    d = f"{tmp_root}/mixed"
    os.makedirs(d)
    _write(f"{d}/a.csv", HEADER + "\n20080102 09:30:00,1,3,0.5,2,10,1,1.5\n")
    _write(f"{d}/b.csv", "Close,Date,low,high,open,average,volume,barcount\n2,20080102 09:31:00,0.5,3,1,1.5,10,1\n")
    got = csv_src.read_bars_csv(spark, d).collect()
    assert len(got) == 2 and {tuple(r)[1:] for r in got} == {(1.0, 3.0, 0.5, 2.0, 10, 1, 1.5)}
    _write(f"{d}/c.csv", "x,y\n1,2\n")
    with pytest.raises(ValueError, match="no header"):
        csv_src.read_bars_csv(spark, d)


def test_assert_unique(spark):
    from barline.sinks import assert_unique
    ok = spark.createDataFrame([(dt.datetime(2024, 1, 1, 9, 30),), (dt.datetime(2024, 1, 1, 9, 31),)],
                               "trade_timestamp timestamp_ntz")
    assert_unique(ok)
    with pytest.raises(RuntimeError, match="duplicate"):
        assert_unique(ok.union(ok))


def test_row_fingerprint_order_free(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("a"), (F.col("id") * 0.5).alias("b"))
    a = fingerprint.row_fingerprint(df).first()
    b = fingerprint.row_fingerprint(df.repartition(5).orderBy(F.rand(1))).first()
    c = fingerprint.row_fingerprint(df.limit(99)).first()
    assert a == b and a.fingerprint != c.fingerprint and a.n_rows == 100


def walk_bars(spark, days=21, minutes=390, seed=42):
    """Gap-free synthetic bars (FIXTURES.md 'walk'); no random state."""
    base = dt.datetime(2023, 1, 2, 9, 30)
    df = spark.range(days * minutes).select(
        "id", (F.col("id") / minutes).cast("int").alias("day"), (F.col("id") % minutes).cast("int").alias("minute"))
    u = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1_000_000)) / 1e6 - 0.5
    v = F.pmod(F.xxhash64("id", F.lit(seed + 1)), F.lit(1000))
    storm = ((F.col("day") % 7) == 3) & (F.col("minute") >= 200)
    step = F.when(storm, 0.01 * u - 0.0015).otherwise(0.0008 * u)
    w = Window.partitionBy("day").orderBy("minute")
    df = df.withColumns({"step": step, "v": v, "storm": storm})
    df = df.withColumn("close", F.round(100 * F.exp(F.sum("step").over(w.rowsBetween(Window.unboundedPreceding, 0))), 4))
    df = df.withColumn("open", F.coalesce(F.lag("close").over(w), F.lit(100.0)))
    return df.select(
        (F.lit(base) + F.make_dt_interval(F.col("day"), F.lit(0), F.col("minute"))).cast("timestamp_ntz")
        .alias("trade_timestamp"),
        F.col("open").alias("open_price"),
        (F.greatest("open", "close") + 0.01).alias("high_price"),
        (F.least("open", "close") - 0.01).alias("low_price"),
        F.col("close").alias("close_price"),
        (1000 + F.col("v") + F.when(F.col("storm"), 4 * F.col("v")).otherwise(0)).cast("bigint").alias("volume"),
        F.lit(1).alias("bar_count"),
        F.col("close").alias("average_price"))


def test_end_to_end_twice(spark, tmp_root):
    paths = Paths(tmp_root)
    bars = walk_bars(spark)
    r1 = stages.run_all(spark, paths, "run-1", bars=bars, dataset_hash="walk-42")
    assert r1["ingest"]["status"] == "ingested"
    assert r1["verify"]["error"] is None and r1["final"]["crash_index_ok"]
    assert r1["analyze"]["rows"] == 21 * 389
    feats = spark.read.parquet(paths.features)
    assert feats.filter("drawdown > 0").count() == 0
    assert feats.filter("(crash_alert_flag = 1) != (crash_severity != 'LOW')").count() == 0
    checksum = r1["verify"]["checksum"]
    # second run with the same data: ingest is skipped, results are identical
    r2 = stages.run_all(spark, paths, "run-1", bars=bars, dataset_hash="walk-42")
    assert r2["ingest"]["status"] == "skipped_known"
    assert r2["verify"]["checksum"] == checksum
    stages.run_all(spark, paths, "run-2", bars=bars, dataset_hash="walk-42")
    led = spark.read.parquet(paths.runs)
    assert sorted(r.run_id for r in led.collect()) == ["run-1", "run-2"]
    m = spark.read.json(paths.metrics).first()
    assert m.optimal_threshold == r1["analyze"]["metrics"]["optimal_threshold"]


def test_gate_fails_on_gaps(spark, tmp_root):
    from barline.sources.events import bars_from_events, read_events
    paths = Paths(tmp_root)
    ev = bars_from_events(read_events(spark, "/root/testdata/sf0.001"))
    stages.ingest(spark, paths, bars=ev.drop("event_id"), dataset_hash="events-0.001")
    res = stages.analyze(spark, paths, "ev-1")
    assert res["rows"] > 0
    ver = stages.verify(spark, paths, "ev-1")
    assert ver["error"] and "gap_count" in ver["error"]
    assert ver["row_coverage_ratio"] and ver["date_range_ok"] and not ver["crash_index_ok"]
    with pytest.raises(RuntimeError):
        stages.finalize(spark, paths)


def test_ingest_csv_and_row_guard(spark, tmp_root):
    lines = [HEADER] + [f"20080102 09:{m:02d}:00,1,1.1,0.9,1.0,10,1,1.0" for m in range(20)] + [
        "20080102 09:59:00,,1,1,1,1,1,1"]
    p = _write(f"{tmp_root}/in.csv", "\n".join(lines) + "\n")
    paths = Paths(f"{tmp_root}/t")
    r = stages.ingest(spark, paths, csv_path=p)
    assert r["status"] == "ingested" and r["written"] == 20 and r["input_rows"] == 21
    assert r["rows_read"] == 21 and r["dropped_missing"] == 1
    assert stages.ingest(spark, paths, csv_path=p)["status"] == "skipped_known"
    p2 = _write(f"{tmp_root}/in2.csv", "\n".join(lines[:10]) + "\n")
    assert stages.ingest(spark, paths, csv_path=p2, row_guard=True)["status"] == "skipped_covered"


def test_streaming_ingest_exactly_once(spark, tmp_root):
    src = f"{tmp_root}/incoming"
    os.makedirs(src)
    raw, ckpt = f"{tmp_root}/raw", f"{tmp_root}/ckpt"

    def drop(name, minutes):
        body = "\n".join(f"20080102 09:{m:02d}:00,1,1.1,0.9,1.0,10,1,1.0" for m in minutes)
        _write(f"{src}/{name}.csv", HEADER + "\n" + body + "\n")

    drop("a", range(0, 10))
    drop("b", range(10, 15))
    start_ingest(spark, src, raw, ckpt).awaitTermination()
    assert spark.read.parquet(raw).count() == 15
    drop("c", range(15, 18))
    start_ingest(spark, src, raw, ckpt).awaitTermination()
    start_ingest(spark, src, raw, ckpt).awaitTermination()   # nothing new
    df = spark.read.parquet(raw)
    assert df.count() == 18 and df.select("trade_timestamp").distinct().count() == 18


def test_streaming_ingest_keeps_series_keys(spark, tmp_root):
    from barline.schemas import DEFAULT_SPEC
    os.makedirs(f"{tmp_root}/in")
    _write(f"{tmp_root}/in/a.csv", HEADER + ",symbol\n20080102 09:30:00,1,1,1,1,1,1,1,A\n20080102 09:30:00,2,2,2,2,2,2,2,B\n")
    start_ingest(spark, f"{tmp_root}/in", f"{tmp_root}/raw", f"{tmp_root}/ck", spec=DEFAULT_SPEC.with_keys("symbol")).awaitTermination()
    assert sorted(r.symbol for r in spark.read.parquet(f"{tmp_root}/raw").collect()) == ["A", "B"]


def test_day_predicates_cover_range_once():
    from barline.sources.jdbc import day_predicates
    preds = day_predicates("trade_timestamp", dt.date(2024, 1, 1), dt.date(2024, 1, 5), days_per_partition=2)
    assert len(preds) == 3
    assert preds[0] == ("trade_timestamp >= TIMESTAMP '2024-01-01 00:00:00' "
                        "AND trade_timestamp < TIMESTAMP '2024-01-03 00:00:00'")
    assert preds[-1].endswith("< TIMESTAMP '2024-01-07 00:00:00'")


def test_cluster_conf_sizes_partitions():
    from barline.session import cluster_conf
    big = cluster_conf(100 * 1024 ** 4, executor_cores=4, executors=1000)
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * 1024 ** 4 // (256 * 1024 ** 2)
    small = cluster_conf(10 * 1024 ** 2, executor_cores=4, executors=10)
    assert int(small["spark.sql.shuffle.partitions"]) == 80
    assert big["spark.sql.adaptive.enabled"] == "true"


def test_cli_runs_all_stages(spark, tmp_root, capsys):
    import json
    from barline.__main__ import main
    lines = [HEADER] + [f"20080102 {9 + (30 + m) // 60:02d}:{(30 + m) % 60:02d}:00,{100 + (m % 7) * 0.1:.2f},"
                        f"{101 + (m % 7) * 0.1:.2f},{99 + (m % 7) * 0.1:.2f},{100 + (m % 5) * 0.1:.2f},{100 + m},1,100"
                        for m in range(90)]
    p = _write(f"{tmp_root}/cli.csv", "\n".join(lines) + "\n")
    assert main(["all", "--root", f"{tmp_root}/tables", "--csv", p, "--run-id", "cli"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["ingest"]["written"] == 90 and out["verify"]["error"] is None
    assert out["finalize"]["analytics_rows"] == 89


def test_end_to_end_with_series_keys(spark, tmp_root):
    from barline.schemas import DEFAULT_SPEC
    spec = DEFAULT_SPEC.with_keys("symbol")
    walk = walk_bars(spark, days=3, minutes=120)
    bars = walk.withColumn("symbol", F.lit("A")).unionByName(
        walk.withColumn("symbol", F.lit("B")).withColumn("close_price", F.col("close_price") * 3)
        .withColumn("high_price", F.col("high_price") * 3).withColumn("low_price", F.col("low_price") * 3)
        .withColumn("open_price", F.col("open_price") * 3))
    paths = Paths(tmp_root)
    r = stages.run_all(spark, paths, "keyed", bars=bars, dataset_hash="walk-ab", spec=spec)
    assert r["verify"]["error"] is None and r["verify"]["analytics_rows"] == 2 * 3 * 119
    feats = spark.read.parquet(paths.features)
    assert sorted(r.symbol for r in feats.select("symbol").distinct().collect()) == ["A", "B"]
    stage = staging_path(spark, "keyed", "scored")
    assert not os.path.exists(stage.removeprefix("file://"))  # removed after success


def test_end_to_end_split_matches_plain(spark, tmp_root):
    bars = walk_bars(spark, days=2, minutes=390)
    a = stages.run_all(spark, Paths(f"{tmp_root}/a"), "plain", bars=bars, dataset_hash="w2")
    b = stages.run_all(spark, Paths(f"{tmp_root}/b"), "split", bars=bars, dataset_hash="w2", split_rows=100)
    assert a["verify"]["error"] is None and b["verify"]["error"] is None
    assert a["verify"]["checksum"] == b["verify"]["checksum"]
    assert a["analyze"]["metrics"] == b["analyze"]["metrics"]


def test_analyze_needs_a_shared_folder(spark, tmp_root, monkeypatch):
    monkeypatch.setattr(stages, "staging_path", lambda s, *p: staging_path(Bare(), *p))

    class Bare:  # a session without spark.checkpoint.dir
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            getConf = staticmethod(lambda: Bare.conf)
            getCheckpointDir = staticmethod(lambda: None)

    paths = Paths(tmp_root)
    stages.ingest(spark, paths, bars=walk_bars(spark, days=1, minutes=100), dataset_hash="w1")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        stages.analyze(spark, paths, "r1")


def test_verify_follows_the_raw_source(spark, tmp_root):
    bars = walk_bars(spark, days=2, minutes=100)
    paths = Paths(tmp_root)
    stages.analyze(spark, paths, "r1", raw=bars)
    ver = stages.verify(spark, paths, "r1", raw=bars)
    assert ver["error"] is None and ver["analytics_rows"] == 198 and ver["sample_read_ok"]
    assert stages.finalize(spark, paths)["checksum"] == ver["checksum"]


def test_feature_files_follow_the_days(spark, tmp_root):
    import glob
    bars = walk_bars(spark, days=5, minutes=100)
    paths = Paths(tmp_root)
    stages.analyze(spark, paths, "r1", raw=bars.repartition(8))
    assert 5 <= len(glob.glob(f"{paths.features}/*/part-*.parquet")) <= 10
    assert [f.name for f in spark.read.parquet(paths.features).schema][:3] == ["trade_timestamp", "open_price", "high_price"]


def test_failed_checks_leave_the_table(spark, tmp_root, monkeypatch):
    from barline.operators import risk
    bars = walk_bars(spark, days=1, minutes=100)
    paths = Paths(tmp_root)
    stages.analyze(spark, paths, "good", raw=bars)
    before = sorted(tuple(r) for r in spark.read.parquet(paths.features).collect())
    plain = risk.with_alerts
    monkeypatch.setattr(risk, "with_alerts", lambda df, t: plain(df, t).withColumn("crash_alert_flag", F.lit(1)))
    with pytest.raises(RuntimeError, match="lowest severity"):
        stages.analyze(spark, paths, "bad", raw=bars)
    monkeypatch.setattr(risk, "with_alerts", lambda df, t: plain(df, t).unionByName(plain(df, t).limit(1)))
    with pytest.raises(RuntimeError, match="more than once"):
        stages.analyze(spark, paths, "bad", raw=bars)
    assert sorted(tuple(r) for r in spark.read.parquet(paths.features).collect()) == before


def test_read_metrics_document(spark, tmp_root):
    from barline.sinks import write_document
    from barline.sources.tables import read_metrics
    assert read_metrics(spark, f"{tmp_root}/absent").count() == 0
    doc = spark.createDataFrame([(0.5, 0.1, 1.2, 0.3)],
                                "optimal_threshold double, alert_rate double, crash_index_mean double, "
                                "crash_index_std double")
    write_document(doc, f"{tmp_root}/m")
    row = read_metrics(spark, f"{tmp_root}/m").first()
    assert (row.optimal_threshold, row.crash_index_std) == (0.5, 0.3)


def test_csv_files_with_different_extra_columns(spark, tmp_root):
    d = f"{tmp_root}/extras"
    os.makedirs(d)
    line = "200801{:02d} 09:30:00,1,1,1,1,1,1,1"
    _write(f"{d}/a.csv", "\n".join([HEADER, *[line.format(k) for k in range(1, 6)]]) + "\n")
    _write(f"{d}/b.csv", "\n".join([HEADER + ",note", *[line.format(k) + ",x" for k in range(6, 11)], line.format(11) + ","]) + "\n")
    got = csv_src.read_bars_csv(spark, d)
    assert sorted(r.trade_timestamp.day for r in got.collect()) == list(range(1, 11))
    text = csv_src.read_text_csv(spark, d)
    assert len(text.collect()) == 11 and "note" in text.columns
    res = stages.ingest(spark, Paths(f"{tmp_root}/root"), csv_path=d)
    assert (res["written"], res["rows_read"], res["dropped_missing"]) == (10, 11, 1)


def test_counts_survive_a_lost_map_output(spark, tmp_root):
    """The rows observed in the writing tasks stay right where a map stage runs again; those
    observed before the shuffle do not."""
    import glob

    from pyspark.sql import Observation
    local = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    dirs, flag = [str(x) for x in local], f"{tmp_root}/lost"

    def lose(batches):
        import os as _os
        from pyspark import TaskContext
        rows = list(batches)
        if TaskContext.get().partitionId() == 0 and not _os.path.exists(flag):
            open(flag, "w").close()
            for f in [x for d in dirs for x in glob.glob(f"{d}/*/shuffle_*.data")]:
                _os.remove(f)
        yield from rows

    before, after = Observation("before"), Observation("after")
    n = F.count(F.lit(1)).alias("n")
    df = spark.range(1000, numPartitions=4).observe(before, n).repartition(40, "id").observe(after, n).mapInArrow(lose, "id long")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df.write.parquet(f"{tmp_root}/out")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert after.get["n"] == 1000 == spark.read.parquet(f"{tmp_root}/out").count() and before.get["n"] > 1000


def test_write_observes_after_the_shuffle(spark, tmp_root):
    from pyspark.sql import Observation

    from barline.sinks.writers import write_table
    seen = Observation("plan")
    df = spark.range(100).withColumn("k", F.col("id") % 5)
    write_table(df, f"{tmp_root}/t", partition_by=["k"], rebalance=True, observe=(seen, [F.count(F.lit(1)).alias("rows")]))
    assert seen.get["rows"] == 100
    plan = df.hint("rebalance", "k").observe(Observation("x"), F.count(F.lit(1)))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("CollectMetrics") < plan.index("Exchange")  # printed from the top: the write's stage
