"""Registered queries as registered, over whole tables, against plain versions."""

import hashlib

import pytest
import zstandard

from barline.llm import compression, quality
from barline.llm.common import shuffles_end_with_query, table
from barline.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.helpers import AWKWARD, frame, remainder
from tests.llm.test_tables import brute


@pytest.fixture(scope="module")
def documents(spark):
    return [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]


def test_op3(spark, documents):
    items = [(r.item_id, r.text) for r in table(spark, SF_SMALL, "benchmark").collect()]
    got = sorted(QUERIES["op3_decontamination"](spark, SF_SMALL).collect())
    want = sorted((i, words, hit, len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), hit > 0)
                  for i, words, hit, found in brute(documents, items))
    assert [(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got] == want
    assert any(r.contaminated for r in got) and not all(r.contaminated for r in got)


def ratios(text):
    """Ratio of the whole text and of its chunks (none where it fits one), by their definition."""
    data, size = (text or "").encode(), compression.CHUNK_BYTES
    press = zstandard.ZstdCompressor(level=compression.LEVEL).compress
    if not data:
        return 1.0, []
    parts = []
    if len(data) > size:
        starts = list(range(0, len(data), size))
        if len(data) - starts[-1] < size / 2:
            starts.pop()  # a short rest belongs to the chunk before
        parts = [data[a:b] for a, b in zip(starts, [*starts[1:], len(data)])]
    return len(press(data)) / len(data), [len(press(p)) / len(p) for p in parts]


def verdict(text):
    n, (whole, parts) = len((text or "").encode()), ratios(text)
    checks = [(whole, compression.WHOLE), *((p, compression.CHUNKS) for p in parts)]
    found = []
    for ratio, bands in checks:
        band = max((b for b in bands if b.min_bytes <= n), key=lambda b: b.min_bytes)
        found.append("repetitive" if ratio < band.low else "incompressible" if ratio > band.high else "ok")
    return next((v for v in ("repetitive", "incompressible") if v in found), "ok")


def check_bands(rows, got):
    assert len(got) == len(rows)
    texts = {}
    for i, t in rows:
        texts.setdefault(i, set()).add(t)
    for r in got:
        assert (r.band_verdict, r.kept) in {(v := verdict(t), v == "ok" and not r.base_failed) for t in texts[r.doc_id]}
        assert any(r.ratio == pytest.approx(ratios(t)[0]) for t in texts[r.doc_id])


def test_op4_ratios_and_verdict(spark, documents):
    got = QUERIES["op4_compression_bands"](spark, SF_SMALL).collect()
    check_bands(documents, got)
    assert {r.kept for r in got} == {True, False}


def test_op4_awkward_rows(spark):
    check_bands(AWKWARD, compression.compression_rules(frame(spark, AWKWARD)).collect())


def test_op8(spark, documents):
    got = QUERIES["op8_quality_classifier"](spark, SF_SMALL).collect()
    assert sorted(r.doc_id for r in got) == sorted(i for i, _ in documents)
    for r in got:
        assert r.held_out == (remainder(r.doc_id, 4) == 2)
        assert 0 <= r.score <= 1 and r.predicted == (1 if r.score >= quality.THRESHOLD else 0)
    labels = {r.doc_id: r.quality for r in table(spark, SF_SMALL, "labels").collect() if remainder(r.doc_id, 4) == 2}
    hits = [r.predicted == labels[r.doc_id] for r in got if r.doc_id in labels]
    assert sum(hits) >= 0.85 * len(hits) > 0


def test_shuffles_end_with_query(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    with shuffles_end_with_query(spark):
        df = spark.range(1000).selectExpr("id % 7 k").groupBy("k").count()
        first = sorted(df.collect())
        assert spark.conf.get(key) == "true"
    assert spark.conf.get(key, None) == before
    assert sorted(df.collect()) == first == sorted((k, 143 if k < 6 else 142) for k in range(7))
