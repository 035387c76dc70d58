"""Driver contract: entry smoke, every query runs, every oracle matches (sf0.001)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import digest, duck  # noqa: E402
from barline.plans.catalog import QUERIES  # noqa: E402
from tests.conftest import SF_SMALL  # noqa: E402


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert len(df.columns) == 27
    assert df.count() > 0


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(E.queries())
    assert set(QUERIES) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_planted_faults_trip_every_rule(spark):
    rows = E.queries()["rule_violations_planted"](spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == 20 and all(r.violations > 0 for r in rows)


def test_guardrail_query_has_all_decisions(spark):
    rows = E.queries()["ingest_guardrail"](spark, "/root/testdata/sf0.01").collect()
    assert {r.decision for r in rows} == {"skip_known", "skip_covered", "ingest"}


def test_verdict_query_has_passing_and_failing_tables(spark):
    rows = {r.source: r for r in E.queries()["verdict"](spark, "/root/testdata/sf0.01").collect()}
    assert rows["closed_up"].failed_gate is None and rows["empty"].failed_gate == 0 and rows["events"].failed_gate is not None
