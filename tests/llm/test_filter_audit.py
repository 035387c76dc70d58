"""The filter audit against a run of every order, and against its SQL."""

import itertools
import re
from collections import defaultdict

import pytest

import __spark_entry__ as E
from barline.llm.filter_audit import audit_filters, failure_counts, worths, potentials
from scripts.check_oracle import digest, duck
from tests.conftest import SF_SMALL
from tests.llm.helpers import AWKWARD, blank_words, frame

COLS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def fails(rows):
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    out = []
    for i, t, part in rows:
        t, words = t or "", blank_words(t)
        out.append((i, part or "", {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and i > least[t]}))
    return out


def brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    parts, out = defaultdict(list), []
    for r in fails(rows):
        parts[r[1]].append(r)
    for part, rs in parts.items():
        shapley, found = defaultdict(int), []
        for order in itertools.permutations("ABCDE"):
            left = rs
            for step, f in enumerate(order, 1):
                gone = [r for r in left if r[2][f]]
                kept = [r for r in left if not r[2][f]]
                failing = [r for r in rs if r[2][f]]
                shapley[f] += len(gone)
                found.append((part, "".join(order), step, len(kept), len(gone), len(failing) - len(gone), sum(sum(r[2].values()) == 1 for r in failing),
                              sum(r[0] in good for r in gone), sum(r[0] in toxic for r in gone)))
                left = kept
        out += [x + (shapley[x[1][x[2] - 1]],) for x in found]
    return sorted(out)


def got(df):
    return sorted(tuple(r[c] for c in COLS) for r in df.collect())


LABELS = "doc_id long, quality int, toxic int"


def test_awkward_rows(spark):
    texts = AWKWARD + [(None, "one"), (20, "one"), (14, None), (8, "other | text"), (30, "A%" * 50), (31, "low " * 300)]
    full = [(i, t, (None, "", "s1", "s2")[k % 4], "x", 1) for k, (i, t) in enumerate(texts)]
    docs = spark.createDataFrame(full, "doc_id long, text string, source string, part string, mask long").repartition(3)
    labels = [(1, 1, 0), (20, 1, 1), (20, 0, 0), (8, None, 1), (None, 1, 1), (31, 1, None)]
    rows = [(i, t, s) for i, t, s, _, _ in full]
    assert got(audit_filters(docs, spark.createDataFrame(labels, LABELS))) == brute(rows, labels)


def test_one_text_and_one_id_hold_most_rows(spark):
    rows = [(k, "same & text " * 5, f"s{k % 2}") for k in range(400)] + [(5, f"text {k} " * 150, "s1") for k in range(300)] + [(5, "same & text " * 5, "s9")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    labels = [(k, k % 2, k % 3 == 0) for k in range(0, 400, 5)]
    labels = [(a, b, int(c)) for a, b, c in labels]
    assert got(audit_filters(docs, spark.createDataFrame(labels, LABELS))) == brute(rows, labels)


def test_no_rows(spark):
    assert audit_filters(frame(spark, []).filter("false"), spark.createDataFrame([], LABELS)).collect() == []


def test_potential_is_the_recursion_and_sums_to_the_worth(spark):
    docs, labels = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    for r in worths(failure_counts(docs, labels)).withColumn("p", potentials("v")).collect():
        p = [0] * 32
        for s in range(1, 32):
            members = [k for k in range(5) if s >> k & 1]
            p[s] = (r.v[s] + sum(p[s ^ (1 << k)] for k in members)) / len(members)
        assert r.p == [round(120 * x) for x in p]
        assert sum(r.p[31] - r.p[31 ^ (1 << k)] for k in range(5)) == 120 * r.v[31]


@pytest.mark.parametrize("sf", [SF_SMALL])
def test_registered_query_equals_its_sql(spark, sf):
    df = E.queries()["op11_filter_audit"](spark, sf)
    cur = duck(sf).execute(E.oracle_sql()["op11_filter_audit"])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(cols, cur.fetchall())[0]
