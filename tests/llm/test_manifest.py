"""The Merkle manifest against a direct evaluation of its definition."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from barline.llm.common import table
from barline.llm.manifest import fold, manifest
from barline.llm.queries import op13_merkle_manifest
from tests.conftest import SF_SMALL
from tests.llm.helpers import AWKWARD, frame


def h(*parts):
    return hashlib.sha256("".join(parts).encode("utf-8", "surrogatepass")).hexdigest()


def leaf(row, columns=("doc_id", "source", "lang", "n_chars", "text")):
    return h(*["-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in columns])


def tree(nodes, fanout=2):
    """The root, and for each node its siblings level by level as (left, right)."""
    proofs, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for k, p in enumerate(at):
            lo = p // fanout * fanout
            proofs[k].append(("".join(level[lo:p]), "".join(level[p + 1:lo + fanout])))
            at[k] = p // fanout
        level = [h(*level[k:k + fanout]) for k in range(0, len(level), fanout)]
    return level[0], proofs


def expected(rows, fanout=2):
    groups = defaultdict(list)
    for r in rows:
        groups[(b"" if r["lang"] is None else b"1" + r["lang"].encode())].append(r)
    subs, out = {}, []
    for g, rs in groups.items():
        rs.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        subs[g] = tree([leaf(r) for r in rs], fanout)
    names = sorted(subs)
    root, tops = tree([subs[g][0] for g in names], fanout)
    for g, top in zip(names, tops):
        for r, proof in zip(groups[g], subs[g][1]):
            steps, claim = proof + top, dict(r)
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0 and r["n_chars"] is not None:
                claim["n_chars"] += 1
            folded = leaf(claim)
            for a, b in steps:
                folded = h(a, folded, b)
            out.append((r["doc_id"], leaf(r), subs[g][0], root, h(*[a + b for a, b in steps]), folded, folded == root))
    return sorted(out, key=repr)


COLS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def got(df):
    return sorted((tuple(r[c] for c in COLS) for r in df.collect()), key=repr)


def test_registered_query_on_the_whole_table(spark):
    rows = [r.asDict() for r in table(spark, SF_SMALL, "documents").collect()]
    assert got(op13_merkle_manifest(spark, SF_SMALL)) == expected(rows)


def tampered():
    return {"n_chars": F.when(F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0), F.col("n_chars") + 1)
            .otherwise(F.col("n_chars"))}


@pytest.mark.parametrize("n,fanout,levels", [(1, 2, 1), (2, 2, 1), (3, 2, 1), (7, 2, 0), (33, 2, 2), (64, 2, 2), (65, 2, 2), (40, 3, 1), (28, 3, 1), (100, 4, 1)])
def test_blocks_of_any_size_and_number(spark, n, fanout, levels):
    rows = [(k * 5 % n, f"text {k}", lang, f"s{k % 3}", 6) for lang, m in (("en", n), ("de", n // 2), (None, 1)) for k in range(m)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    out = manifest(docs, claims=tampered(), fanout=fanout, levels=levels).withColumn("verified", F.col("folded_root") == F.col("root"))
    want = expected([dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r)) for r in rows], fanout)
    assert got(out) == want
    for r in out.collect():
        claim_is_true = r.folded_root == r.root
        assert (fold(r.leaf, [(s.left, s.right) for s in r.proof]) == r.root) and (claim_is_true or r.verified is False)


def test_awkward_rows(spark):
    df = frame(spark, AWKWARD + AWKWARD[-4:], partitions=3)
    out = manifest(df, claims=tampered(), levels=2).withColumn("verified", F.col("folded_root") == F.col("root"))
    assert got(out) == expected([r.asDict() for r in df.collect()])


def test_empty_table_and_one_repeated_row(spark):
    assert manifest(frame(spark, []).filter("false")).collect() == []
    rows = [(7, "same")] * 90
    df = spark.createDataFrame([(i, t, "en", None, 4) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    out = manifest(df, levels=3)
    assert {r.folded_root == r.root for r in out.collect()} == {True} and out.count() == 90


def test_changed_text_is_found_by_its_proof(spark):
    docs = table(spark, SF_SMALL, "documents")
    out = manifest(docs, claims={"text": F.when(F.col("doc_id") == 5, F.concat("text", F.lit(" "))).otherwise(F.col("text"))}, levels=4)
    assert [r.doc_id for r in out.filter("folded_root <> root").select("doc_id").collect()] == [5]
