"""Command line for the batch job (``spark-submit`` or ``python -m barline``).

    python -m barline all --root s3a://bucket/barline --csv s3a://bucket/in/bars.csv --run-id 2024-06-01
    python -m barline analyze --root /data/barline --run-id r1 --keys symbol
    python -m barline analyze --root /data/barline --jdbc-url jdbc:<driver>://h/db \\
        --source-table raw_bars --target-table bar_features

The session comes from the launcher (``getOrCreate``); table locations live
under ``--root`` on a shared file system or object store.
"""

from __future__ import annotations

import argparse
import json
import logging
import os
import sys

from pyspark.sql import SparkSession


def _args(argv):
    p = argparse.ArgumentParser(prog="barline")
    p.add_argument("stage", choices=["ingest", "analyze", "verify", "reconcile", "finalize", "all"])
    p.add_argument("--root", required=True, help="folder holding the raw, feature and ledger tables")
    p.add_argument("--run-id", default=os.environ.get("BARLINE_RUN_ID"))
    p.add_argument("--csv", help="CSV file or folder to ingest")
    p.add_argument("--keys", nargs="*", default=[], help="series key columns (instruments)")
    p.add_argument("--row-guard", action="store_true", help="skip ingest when stored rows >= input rows")
    p.add_argument("--incremental", action="store_true",
                   help="load only new files of --csv and analyze only changed days")
    p.add_argument("--jdbc-url")
    p.add_argument("--jdbc-user", default=os.environ.get("JDBC_USER"))
    p.add_argument("--jdbc-password", default=os.environ.get("JDBC_PASSWORD"))
    p.add_argument("--jdbc-driver")
    p.add_argument("--source-table", help="read raw bars from this JDBC table instead of --root")
    p.add_argument("--target-table", help="also write the feature table to this JDBC table")
    p.add_argument("--jdbc-partitions", type=int, default=64)
    p.add_argument("--write-partitions", type=int, default=16, help="concurrent connections of a JDBC write")
    p.add_argument("--split-rows", type=int, default=None,
                   help="evaluate windows in chunks of so many rows (for key-days too large for one task)")
    return p.parse_args(argv)


def main(argv=None) -> int:
    a = _args(sys.argv[1:] if argv is None else argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s | %(levelname)s | %(message)s")
    from barline.plans import incremental, stages
    from barline.schemas import DEFAULT_SPEC
    from barline.session import BASE_CONF

    spark = SparkSession.builder.appName("barline").getOrCreate()
    for k, v in BASE_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:
            pass
    paths = stages.Paths(a.root)
    spec = DEFAULT_SPEC.with_keys(*a.keys)
    conn = dict(user=a.jdbc_user, password=a.jdbc_password, driver=a.jdbc_driver)
    raw = None
    if a.jdbc_url and a.source_table:
        from barline.sources.jdbc import read_jdbc
        raw = read_jdbc(spark, a.jdbc_url, a.source_table, num_partitions=a.jdbc_partitions, **conn)
    out: dict = {}
    if a.stage in ("ingest", "all") and a.csv:
        out["ingest"] = (incremental.ingest_files(spark, paths, a.csv, spec) if a.incremental
                         else stages.ingest(spark, paths, csv_path=a.csv, row_guard=a.row_guard, spec=spec))
    if a.stage in ("analyze", "all"):
        out["analyze"] = (incremental.analyze_changed(spark, paths, a.run_id, spec) if a.incremental
                          else stages.analyze(spark, paths, a.run_id, spec=spec, raw=raw, split_rows=a.split_rows))
        a.run_id = out["analyze"]["run_id"]
        if a.jdbc_url and a.target_table:
            from barline.sources.jdbc import write_jdbc
            write_jdbc(spark.read.parquet(paths.features), a.jdbc_url, a.target_table,
                       num_partitions=a.write_partitions, **conn)
    if a.stage in ("verify", "all"):
        if not a.run_id:
            raise SystemExit("--run-id is needed for verify")
        out["verify"] = stages.verify(spark, paths, a.run_id, spec, raw=raw, split=bool(a.split_rows))
    if a.stage == "reconcile":
        out["reconcile"] = incremental.reconcile(spark, paths, spec)
    if a.stage in ("finalize", "all"):
        out["finalize"] = stages.finalize(spark, paths)
    print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
