"""op3, op5, op8 and the pipeline."""

import hashlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from barline.llm import decontaminate, jaccard, pii, quality, sharding
from barline.llm.common import remainder as fold, table
from tests.conftest import SF_MID, SF_SMALL
from tests.llm.helpers import AWKWARD, alnum_words, frame, remainder, rows_of


# ---- op3 -------------------------------------------------------------------------

def windows_of(items, window=10):
    out = defaultdict(set)
    for i, t in items:
        w = alnum_words(t)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            out[tuple(w[k:k + window])].add("" if i is None else str(i))
    return out


def brute(rows, items):
    windows, out = windows_of(items), []
    sizes = {len(w) for w in windows}
    for i, t in rows:
        w, hit, found = alnum_words(t), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (o := windows.get(tuple(w[k:k + n]))):
                    found |= o
                    hit.update(range(k, k + n))
        out.append((i, len(w), len(hit), sorted(found)))
    return sorted(out, key=repr)


def bench(spark, items):
    return spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id long, text string, words string")


ITEMS = [(1, "one two three four five six seven eight nine ten eleven twelve"), (2, "short item"), (3, None), (4, ""), (None, "null id"),
         (5, "two three four five six seven eight nine ten eleven"), (5, "short item"), (6, "a a a a a a a a a a a a"), (10, "!!!")]
TEXTS = AWKWARD + [(50, "Zero ONE, two-three four five six seven eight nine ten eleven twelve thirteen"), (51, "x short item short item y null id"),
                   (52, "a " * 40), (53, "short"), (54, "one two three four five six seven eight nine"), (55, "SHORT\x00item")]


def test_leaks_equal_brute_force(spark):
    docs, b = table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "benchmark")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    items = [(r.item_id, r.text) for r in b.collect()]
    assert rows_of(decontaminate.find_leaks(docs, b), "doc_id", "n_words", "n_hit", "items") == brute(rows, items)


@pytest.mark.parametrize("shard,block", [(2_000_000, 8 << 20), (40, 20)])
def test_leaks_awkward(spark, monkeypatch, shard, block):
    monkeypatch.setattr(decontaminate.write_phrases, "__defaults__", (10, block, "item_id", "text"))
    found = decontaminate.find_leaks(frame(spark, TEXTS), bench(spark, ITEMS), shard_words=shard)
    assert rows_of(found, "doc_id", "n_words", "n_hit", "items") == brute(TEXTS, ITEMS)
    for r in found.collect():
        assert sum(s.end - s.start for s in r.spans) == r.n_hit
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))


def test_leaks_empty_sides(spark):
    assert decontaminate.find_leaks(frame(spark, []), bench(spark, ITEMS)).collect() == []
    rows = decontaminate.find_leaks(frame(spark, TEXTS), bench(spark, [])).collect()
    assert len(rows) == len(TEXTS) and all(r.n_hit == 0 and r.items == [] for r in rows)


def test_remove_leaks(spark):
    df = frame(spark, TEXTS)
    out = decontaminate.remove_leaks(df, bench(spark, ITEMS), shard_words=40)
    assert out.columns == df.columns and out.count() == len(TEXTS)
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[50] == "Zero  thirteen" and texts[54] == dict(TEXTS)[54] and texts[1] is None
    left = [(r.doc_id, r.text) for r in out.collect()]
    assert all(n == 0 for _, _, n, _ in brute(left, ITEMS))
    # a cut that joins the parts of another occurrence is cut again
    again = frame(spark, [(1, "short short item item end")])
    assert decontaminate.remove_leaks(again, bench(spark, ITEMS)).first().text.split() == ["end"]


def test_fm_index_counts_and_places():
    rng = np.random.default_rng(4)
    s = np.concatenate([np.append(rng.integers(1, 4, n), 0) for n in rng.integers(1, 60, 40)])
    index = decontaminate.FmIndex(s, 4)
    for n in (1, 2, 3, 5):
        w = rng.integers(1, 4, (30, n))
        lo, hi = index.search(w, np.full(30, n))
        for k in range(30):
            want = [i for i in range(len(s) - n + 1) if (s[i:i + n] == w[k]).all()]
            assert hi[k] - lo[k] == len(want) if want else hi[k] <= lo[k]
            assert sorted(index.locate(np.arange(lo[k], max(lo[k], hi[k]))).tolist()) == want


# ---- op5 -------------------------------------------------------------------------

def test_shards_equal_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_MID}/documents.parquet')")
    want = sorted(con.execute(sharding.ORACLE).fetchall())
    got = sharding.assign_shards(table(spark, SF_MID, "documents"))
    assert sorted((r.doc_id, r.n_bytes, r.depth, r.shard) for r in got.collect()) == want


@pytest.mark.parametrize("limit", [200, 5000, 100_000_000])
def test_shards_fit_and_split_only_where_needed(spark, monkeypatch, limit):
    monkeypatch.setattr(sharding, "MORE_BITS", 2)
    rows = AWKWARD + [(k, "t" * (k % 90)) for k in range(100, 400)] + [(None, "same null id")] * 60 + [(77, "same id again")] * 50
    df = frame(spark, rows, 3)
    got = sharding.assign_shards(df, max_bytes=limit).collect()
    assert len(got) == len(rows)
    size, count, depth = defaultdict(int), defaultdict(int), {}
    for r in got:
        size[r.shard] += r.n_bytes
        count[r.shard] += 1
        depth[r.shard] = r.depth
    assert all(size[s] <= limit or count[s] == 1 for s in size)
    plain = [s for s in size if "." not in s]
    for s in plain:  # no shard's prefix is a prefix of another, and every parent was over the limit
        assert not any(o != s and o.startswith(s) for o in plain)
        if s:
            assert sum(size[o] for o in size if o.startswith(s[:-1])) > limit


def test_shards_empty(spark):
    assert sharding.assign_shards(frame(spark, [])).collect() == []


def test_write_shards(spark, tmp_root):
    df = frame(spark, [(k, "x" * 50) for k in range(60)])
    sharding.write_shards(df, tmp_root + "/out", max_bytes=500)
    back = spark.read.parquet(tmp_root + "/out")
    assert back.count() == 60 and set(df.columns) <= set(back.columns)
    assert back.groupBy("shard").agg(F.sum(F.length("text")).alias("n")).filter("n > 500").count() == 0


# ---- op8 -------------------------------------------------------------------------

def test_quality_held_out(spark):
    docs, labels = table(spark, SF_MID, "documents"), table(spark, SF_MID, "labels")
    model = quality.fit_quality(docs, labels)
    assert 0.6 < model.prior < 0.97
    got = {r.doc_id: r.score for r in quality.score_quality(docs, model).collect()}
    truth = {r.doc_id: r.quality for r in labels.collect() if remainder(r.doc_id, 4) == 2}
    good, bad = [got[i] for i in truth if truth[i] == 1], [got[i] for i in truth if truth[i] == 0]
    assert np.mean([a > b for a in good for b in bad]) > 0.95
    assert np.mean([s >= quality.THRESHOLD for s in good]) > 0.95
    assert np.mean([s < quality.THRESHOLD for s in bad]) > 0.8
    kept = quality.keep_quality(docs, model)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, s in got.items() if s >= quality.THRESHOLD)


def test_quality_reads_no_held_out_label_and_no_negative(spark):
    docs, labels = table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "labels")
    model = quality.fit_quality(docs, labels)
    other = labels.withColumn("quality", F.when(fold(F.col("doc_id"), 4) == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality.fit_quality(docs, other) == model
    assert quality.fit_quality(docs, labels.filter("quality = 1")) == model
    assert quality.fit_quality(docs.repartition(3).withColumn("lang", F.lit("zz")), labels) == model


def test_quality_awkward(spark):
    labels = spark.createDataFrame([(4, 1, 0), (5, None, 0), (None, 1, 1), (6, 1, 0), (10, 1, 0), (6, 1, 0)], "doc_id long, quality int, toxic int")
    df = frame(spark, AWKWARD)
    rows = quality.score_quality(df, quality.fit_quality(df, labels)).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    none = quality.fit_quality(df, labels.limit(0))
    assert {r.score for r in quality.score_quality(df, none).collect()} == {0.5}
    assert quality.score_quality(frame(spark, []), none).collect() == []


def test_quality_fit_takes_one_row_an_id(spark):
    docs, labels = table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "labels")
    some = docs.filter("doc_id < 5")
    assert quality.fit_quality(docs.union(some).union(some), labels) == quality.fit_quality(docs, labels)


def test_keep_quality_awkward(spark):
    labels = spark.createDataFrame([(4, 1, 0), (5, None, 0), (None, 1, 1), (6, 1, 0), (10, 1, 0), (6, 1, 0)], "doc_id long, quality int, toxic int")
    df = frame(spark, AWKWARD)
    model = quality.fit_quality(df, labels)
    kept = quality.keep_quality(df, model)
    scored = quality.score_quality(df, model).collect()
    assert kept.schema == df.schema
    assert rows_of(kept, "doc_id") == sorted(((r.doc_id,) for r in scored if r.score >= quality.THRESHOLD), key=repr)
    assert quality.keep_quality(frame(spark, []), model).collect() == []


def test_nonnegative_risk_recovers_the_class():
    rng = np.random.default_rng(7)
    p = rng.normal(1.5, 1, (600, 2))
    u = np.vstack([rng.normal(1.5, 1, (700, 2)), rng.normal(-1.5, 1, (700, 2))])
    zp, zu = quality.expand(p), quality.expand(u)
    prior = quality.estimate_prior(zp, zu)
    assert 0.4 < prior < 0.62
    s = zu @ quality.fit_weights(zp, zu, prior)
    assert np.mean(s[:700] > 0) > 0.9 and np.mean(s[700:] < 0) > 0.9


# ---- pipeline ----------------------------------------------------------------------

def test_pipeline_stages(spark):
    docs = table(spark, SF_SMALL, "documents")
    items = [(r.item_id, r.text) for r in table(spark, SF_SMALL, "benchmark").collect()]
    frames = {}
    for name, stage in corpus_pipeline.STAGES:
        frames[name] = docs
        out = stage(spark, docs, SF_SMALL)
        if name != "tokens":
            assert out.columns == frames["quality"].columns and out.schema.simpleString() == docs.schema.simpleString()
        path = f"{corpus_pipeline.scratch(spark, 'test')}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    frames["end"] = docs
    ids = {k: {r.doc_id for r in v.select("doc_id").collect()} for k, v in frames.items()}
    model = quality.fit_quality(frames["quality"], table(spark, SF_SMALL, "labels"))
    scores = {r.doc_id: r.score for r in quality.score_quality(frames["quality"], model).collect()}
    assert ids["near_duplicates"] == {i for i, s in scores.items() if s >= quality.THRESHOLD}
    classes = jaccard.jaccard_classes(frames["near_duplicates"]).collect()
    assert ids["decontamination"] == {r.doc_id for r in classes if r.component_id == r.doc_id}
    assert ids["decontamination"] == ids["personal_data"] == ids["tokens"] == ids["end"]
    before = [(r.doc_id, r.text) for r in frames["decontamination"].collect()]
    after = {r.doc_id: r.text for r in frames["personal_data"].collect()}
    leaks = {i: n for i, _, n, _ in brute(before, items)}
    assert any(leaks.values())
    assert all((after[i] == t) == (leaks[i] == 0) for i, t in before)
    assert all(n == 0 for _, _, n, _ in brute(list(after.items()), items))
    left = pii.find_pii(frames["tokens"], pii.SpanModel())
    assert left.agg(F.sum(F.col("n_email") + F.col("n_ip") + F.col("n_phone"))).first()[0] == 0
    texts = {r.doc_id: r.text for r in frames["tokens"].collect()}
    for r in docs.collect():
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
        assert r.ids_sha256 == hashlib.sha256(np.array(r.ids, "<u4").tobytes()).hexdigest() and len(r.ids) == r.n_tokens


def test_pipeline_run(spark):
    rows = corpus_pipeline.run(spark, SF_SMALL)
    assert rows.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"] and rows.count() > 50


@pytest.mark.parametrize("rows", [AWKWARD, []], ids=["awkward", "empty"])
def test_pipeline_awkward(spark, tmp_root, rows):
    frame(spark, rows).write.parquet(f"{tmp_root}/documents.parquet")
    spark.createDataFrame([(4, 1, 0), (5, None, 0), (None, 1, 1), (6, 1, 0), (6, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_root}/labels.parquet")
    bench(spark, ITEMS).write.parquet(f"{tmp_root}/benchmark.parquet")
    docs, names = table(spark, tmp_root, "documents"), frame(spark, []).columns
    for name, stage in corpus_pipeline.STAGES:
        path = f"{tmp_root}/out-{name}"
        stage(spark, docs, tmp_root).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        assert name == "tokens" or docs.columns == names
        if name not in ("quality", "near_duplicates"):
            assert docs.count() == before.count()
    got = [(r.doc_id, r.n_tokens) for r in docs.collect()]
    assert {i for i, _ in got} <= {i for i, _ in rows}
    assert len({i for i, _ in got if i is not None}) == sum(i is not None for i, _ in got)
