"""Loading by file, analysis by day, reconciliation of the stored tables."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from barline.operators import reconcile as rec
from barline.plans import catalog, incremental, stages
from barline.plans.incremental import analyze_changed, ingest_files, reconcile
from barline.plans.stages import Paths
from barline.schemas import DEFAULT_SPEC, FEATURES
from barline.sources.csv import line_outcomes
from tests.conftest import SF_SMALL

HEADER = "date,open,high,low,close,volume,barcount,average"


def _file(folder, name, days, minutes=90, scale=1.0, extra=(), header=HEADER):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.csv", "w") as f:
        print(header, file=f)
        for d in days:
            for k in range(minutes):
                c = scale * (50 + (k * 7 + d) % 11 - (20 if (k + d) % 37 == 0 else 0))
                print(f"200801{d:02d} {9 + k // 60:02d}:{k % 60:02d}:00,{c},{c + 1},{c - 1},{c},{100 + k % 5},{k},{c}", file=f)
        for line in extra:
            print(line, file=f)


def _raw(spark, paths):
    return sorted(map(tuple, spark.read.parquet(paths.raw).drop("source_file").collect()), key=repr)


def _stamps(path):
    return {f.rsplit("=", 1)[1]: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/trade_date=*/*.parquet")}


@pytest.fixture()
def place(tmp_root):
    return f"{tmp_root}/in", Paths(f"{tmp_root}/root")


def test_new_files_are_added_and_known_ones_skipped(spark, place):
    folder, paths = place
    _file(folder, "a", [2, 3])
    assert ingest_files(spark, paths, folder)["loaded"] == 180
    first = _stamps(paths.raw)
    assert ingest_files(spark, paths, folder) == {"status": "nothing_new", "files": 0}
    _file(folder, "b", [3, 4], scale=2.0)
    _file(folder, "copy_of_a", [2, 3])  # known content under another name
    res = ingest_files(spark, paths, folder)
    assert (res["files"], res["loaded"], res["days"]) == (1, 180, 2) and spark.read.parquet(paths.raw).count() == 360
    # the day that only the first file has keeps its files
    now = _stamps(paths.raw)
    assert {k: v for k, v in first.items() if k.startswith("2008-01-02")} == {k: v for k, v in now.items() if k.startswith("2008-01-02")}
    ledger = spark.read.parquet(paths.file_ledger)
    assert sorted(r.path.rsplit("/", 1)[1] for r in ledger.collect()) == ["a.csv", "b.csv"]
    # a changed file replaces its rows, also on days it no longer has
    _file(folder, "a", [2], scale=3.0)
    ingest_files(spark, paths, folder)
    rows = spark.read.parquet(paths.raw)
    assert rows.count() == 90 + 180 and rows.filter("trade_date = '2008-01-03'").count() == 90
    _file(folder, "b", [4], scale=2.0)
    ingest_files(spark, paths, folder)
    assert {str(r[0]) for r in spark.read.parquet(paths.raw).select("trade_date").distinct().collect()} == {"2008-01-02", "2008-01-04"}


def test_a_run_that_was_cut_off_is_finished(spark, place, monkeypatch):
    folder, paths = place
    _file(folder, "a", [2, 3])
    ingest_files(spark, paths, folder)
    _file(folder, "b", [3, 4], scale=2.0)

    def stop(*_args, **_kw):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:  # after the merged rows are written, before they are in place
        m.setattr(incremental, "_merge_pending", stop)
        with pytest.raises(KeyboardInterrupt):
            ingest_files(spark, paths, folder)
    assert spark.read.parquet(paths.raw).count() == 180
    with monkeypatch.context() as m:  # after they are in place, before the ledger
        m.setattr(incremental.F, "localtimestamp", stop)
        with pytest.raises(KeyboardInterrupt):
            ingest_files(spark, paths, folder)
    ingest_files(spark, paths, folder)
    assert spark.read.parquet(paths.raw).count() == 360
    assert ingest_files(spark, paths, folder)["status"] == "nothing_new"


def test_rejected_lines_are_kept_with_their_reason(spark, place):
    folder, paths = place
    bad = ["20080102 09:30:00,1,1,1,1,1,1,1,9", "2008-01-02,1,1,1,1,1,1,1", "20080105 09:30:00,x,1,1,1,1,1,1", "20080105 09:31:00,NA,1,1,1,1,1,1",
           "20080105 09:32:00,1,1", "", "20080105 09:33:00,1,1,1,1,1.5,1,1", '20080105 09:34:00,"1",1,1,1,1,1,1']
    _file(folder, "a", [2], extra=bad)
    _file(folder, "b", [4], header=HEADER + ",note", extra=["20080105 09:35:00,1,1,1,1,1,1,1,ok", "20080105 09:36:00,1,1,1,1,1,1,1,"])
    with open(f"{folder}/b.csv") as f:  # the other rows of b lack the note
        assert sum(1 for _ in f) == 93
    res = ingest_files(spark, paths, folder)
    assert (res["row_count"], res["loaded"], res["missing"], res["rejected"]) == (90 + 7 + 90 + 2, 90 + 1 + 1, 1 + 1 + 90 + 1, 4)
    got = {(r.line, r.reason, r.file.rsplit("/", 1)[1]) for r in spark.read.parquet(paths.rejects).collect()}
    assert got == {(bad[0], "fields", "a.csv"), (bad[1], "time", "a.csv"), (bad[2], "number", "a.csv"), (bad[5 + 1 + 0], "number", "a.csv")}


def test_outcomes_add_up(spark):
    lines = spark.createDataFrame([("f", x) for x in ("20080102 09:30:00,1,1,1,1,1,1,1\r", "", "  ", "a,b", "20080102 09:30:00,1,1,1,1,1,1,", ",,,,,,,")], "file string, value string")
    out = {r.outcome: r["count"] for r in line_outcomes(lines, HEADER).groupBy("outcome").count().collect()}
    assert out == {"good": 1, "missing": 3}
    assert line_outcomes(lines.filter("false"), HEADER).count() == 0


def test_a_filter_on_the_outcome_parses_each_line_once(spark):
    stamp = "20080102 09:30:00"
    rows = {f"{stamp},1,1,1,1,1,1,1": "good", f"{stamp},1,1,1,1,1,1,1,9": "fields", f"{stamp},1,1,1,1,1,1,1,": "fields",
            f'{stamp},"1",1,1,1,1,1,1': "good", f'{stamp},"1,5",1,1,1,1,1,1': "number", f'{stamp},"1,5",1,1,1,1,1': "missing",
            f'{stamp},"1,5",1,1,1,1,1,1,9': "fields", f"{stamp},1,1": "missing", f"{stamp},1,NA,1,1,1,1,1": "missing", "x,1,1,1,1,1,1,1": "time",
            "x,1,NA,1,1,1,1,1": "missing", "x,y,1,1,1,1,1,1": "time", f"{stamp},1,1,1,1,1.5,1,1": "number"}
    lines = spark.createDataFrame([(f, x) for f in ("f", None) for x in [*rows, None, "", " ", "\r"]], "file string, value string")
    bad = line_outcomes(lines, HEADER).filter("outcome <> 'good'").select("file", "line", "outcome")
    assert sorted(map(tuple, bad.collect()), key=repr) == sorted([(f, x, o) for f in ("f", None) for x, o in rows.items() if o != "good"], key=repr)
    plan = bad._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv(") == 1


def test_rejected_rows_read_each_event_once(spark):
    plan = catalog.q_rejected_rows(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv(") == 1 and plan.count("date_format(") == 2  # either form of a time


def _features(spark, paths):
    """Rows with floats rounded: a day's features are the same however many days a task holds, but the merged
    metrics add up in another order."""
    return sorted(map(tuple, spark.read.parquet(paths.features).select(*FEATURES.fieldNames()).collect()), key=repr)


def _same_as_full_run(spark, paths, res):
    full = Paths(paths.root + "-full")
    want = stages.analyze(spark, full, "full", raw=spark.read.parquet(paths.raw))
    assert _features(spark, paths) == _features(spark, full)
    assert res["metrics"] == pytest.approx(want["metrics"], abs=1.1e-4) and res["rows"] == want["rows"]
    assert stages.verify(spark, paths, "v")["checksum"] == stages.verify(spark, full, "v", raw=spark.read.parquet(paths.raw))["checksum"]


def test_changed_days_give_the_full_result(spark, place):
    folder, paths = place
    _file(folder, "a", [2, 3, 4])
    ingest_files(spark, paths, folder)
    _same_as_full_run(spark, paths, analyze_changed(spark, paths))
    assert analyze_changed(spark, paths)["status"] == "unchanged"
    before = _stamps(paths.features)
    _file(folder, "b", [5])
    ingest_files(spark, paths, folder)
    res = analyze_changed(spark, paths)
    assert res["changed"] == 1
    if not res["threshold_moved"]:
        now = _stamps(paths.features)
        assert {k: now[k] for k in before} == before and len(now) > len(before)
    _same_as_full_run(spark, paths, res)
    # other bars on one day, and a day that goes
    _file(folder, "a", [2, 3], scale=1.5)
    ingest_files(spark, paths, folder)
    res = analyze_changed(spark, paths)
    assert (res["changed"], res["gone"]) == (2, 1)
    _same_as_full_run(spark, paths, res)


def test_a_moved_threshold_rewrites_alerts(spark, place):
    folder, paths = place
    _file(folder, "a", [2, 3, 4])
    ingest_files(spark, paths, folder)
    analyze_changed(spark, paths)
    stages.write_document(spark.createDataFrame([(4.75,)], "threshold double"), paths.threshold)  # as if it had been another
    before = _stamps(paths.features)
    _file(folder, "b", [5])
    ingest_files(spark, paths, folder)
    res = analyze_changed(spark, paths)
    assert res["threshold_moved"] and not set(before.values()) & set(_stamps(paths.features).values())
    _same_as_full_run(spark, paths, res)


def test_reconcile_lists_lost_keys(spark, place):
    folder, paths = place
    _file(folder, "a", [2, 3, 4])
    ingest_files(spark, paths, folder)
    analyze_changed(spark, paths)
    assert reconcile(spark, paths) == {"days": 0, "lost": 0, "unexpected": 0}
    f = spark.read.parquet(paths.features)
    aside = f.filter("NOT (trade_date = '2008-01-03' AND minute(trade_timestamp) = 17)")
    aside.write.parquet(paths.root + "/less")
    os.rename(paths.features, paths.features + "-old")
    spark.read.parquet(paths.root + "/less").write.partitionBy("trade_date").parquet(paths.features)
    assert reconcile(spark, paths) == {"days": 1, "lost": 2, "unexpected": 0}
    rows = spark.read.parquet(paths.differences).collect()
    assert {(str(r.trade_date), r.trade_timestamp.minute, r.finding) for r in rows} == {("2008-01-03", 17, "lost")}


def test_expected_keys_are_those_of_the_feature_table(spark):
    from barline.plans import catalog
    raw = catalog.raw_bars(spark, SF_SMALL).drop("event_id")
    from barline.operators import clean, features
    bars = clean.valid_bars(clean.with_trade_date(clean.deduplicate(raw), DEFAULT_SPEC))
    assert rec.key_differences(rec.expected_keys(raw), features.with_features(bars)).count() == 0
    assert rec.expected_keys(raw).filter(F.col("trade_date").isNull()).count() == 0
