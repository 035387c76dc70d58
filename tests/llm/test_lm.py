import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from barline.llm import elias_fano as ef
from barline.llm import lm
from barline.llm.common import table
from tests.conftest import SF_SMALL
from tests.llm.helpers import AWKWARD, blank_words, frame, lower, remainder

END = " "


def brute(rows, order, discount=0.5, min_count=2):
    """(held_out, n, known, N, base, score) per row by plain dictionaries."""
    docs = [blank_words(lower(t)) + [END] for _, t in rows]
    held = [remainder(i, 5) == 1 for i, _ in rows]
    train = [d for d, h in zip(docs, held) if not h]
    one = Counter(w for d in train for w in d)
    total, v = sum(one.values()), len(one)
    kept, mass = {(): None}, {}
    levels = [{(w,): c for w, c in one.items()}]
    for k in range(2, order + 1):
        c = Counter()
        for d in train:
            s = [END, *d]
            for t in range(k - 1, len(s)):
                g = tuple(s[t - k + 1:t + 1])
                if k == 2 or g[:-1] in levels[-1]:
                    c[g] += 1
        kept = {g: n for g, n in c.items() if n >= min_count}
        levels.append(kept)
        m = defaultdict(float)
        for g, n in kept.items():
            m[g[:-1]] += (n - discount) / levels[-2][g[:-1]]
        mass[k] = m
    out = []
    for (i, _), d, h in zip(rows, docs, held):
        s, base, score = [END, *d], 0.0, 0.0
        for t in range(1, len(s)):
            p = (one.get(s[t], 0) + 0.5) / (total + 0.5 * (v + 1))
            base += math.log10(p)
            for k in range(2, order + 1):
                c = tuple(s[t - k + 1:t]) if t >= k - 1 else None
                if c and c in levels[k - 2]:
                    n = levels[k - 1].get((*c, s[t]), 0)
                    p = max(0, n - discount) / levels[k - 2][c] + (1 - mass[k][c]) * p
                else:
                    break
            score += math.log10(p)
        out.append((i, h, len(d), sum(w in one for w in d), total, base, score))
    return sorted(out, key=repr)


def compare(df, rows, order):
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score)
                  for r in lm.score_with_held_out(df, order=order, min_count=2).collect()), key=lambda r: repr(r[:3]))
    want = sorted(brute(rows, order), key=lambda r: repr(r[:3]))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for g, w in zip(got, want):
        assert g[5] == pytest.approx(w[5], rel=1e-9, abs=1e-9)
        assert g[6] == pytest.approx(w[6], rel=5e-3, abs=1e-3 * g[2])


@pytest.mark.parametrize("order", [2, 3])
def test_documents(spark, order):
    docs = table(spark, SF_SMALL, "documents")
    compare(docs, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], order)


def test_query_keeps_ngrams_seen_once(spark):
    from barline.llm.queries import op2_language_model
    rows = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]
    got = {r.doc_id: r for r in op2_language_model(spark, SF_SMALL).collect()}
    for i, held, n, _, _, base, s in brute(rows, 3, min_count=1):
        assert got[i].held_out == held and got[i].base_score == pytest.approx(base, rel=1e-9)
        assert got[i].score == pytest.approx(s, rel=5e-3, abs=1e-3 * n)


def test_many_buckets_and_hot_contexts(spark, monkeypatch):
    monkeypatch.setattr(lm, "CHUNK_TOKENS", 3000)
    docs = table(spark, SF_SMALL, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    model = lm.fit_model(docs.filter("crc32(CAST(CAST(doc_id AS string) AS binary)) % 5 <> 1"), bucket_bytes=40_000, min_count=2)
    assert len(model.levels[0].files) > 8 and len(model.levels[1].bounds) > 8
    got = {r.doc_id: r.score for r in lm.score(docs, model).collect()}
    for i, _, n, _, _, _, s in brute(rows, 3):
        assert got[i] == pytest.approx(s, rel=5e-3, abs=1e-3 * n)


def test_awkward_rows(spark):
    compare(frame(spark, AWKWARD), AWKWARD, 3)


def test_no_rows_and_no_training_rows(spark):
    assert lm.score_with_held_out(frame(spark, [])).collect() == []
    held = [i for i in range(40) if remainder(i, 5) == 1][:2]
    rows = lm.score_with_held_out(frame(spark, [(i, "a b") for i in held])).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens) for r in rows] == [(3, 0, 0)] * 2


def test_held_out_rows_of_unknown_words(spark):
    held = [i for i in range(40) if remainder(i, 5) == 1][:2]
    train = [i for i in range(40) if remainder(i, 5) != 1][:6]
    rows = [(i, "a b c a b") for i in train] + [(held[0], "zz yy"), (held[1], "qq")]
    compare(frame(spark, rows), rows, 3)


def test_small_chunks_and_few_keys_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(lm, "CHUNK_TOKENS", 2000)
    monkeypatch.setattr(lm, "ASKED_TOGETHER", 500)
    docs = table(spark, SF_SMALL, "documents")
    compare(docs, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], 3)


def test_counts_above_a_byte():
    counts = np.array([1, 254, 255, 256, 70_000, 3, 1 << 40])
    assert lm.counts_at(lm.packed_counts(counts), np.array([6, 0, 2, 2, 4, 1])).tolist() == [1 << 40, 1, 255, 255, 70_000, 254]


def test_successors_by_pointers(spark):
    model = lm.fit_model(frame(spark, [(k, "a b a c a b") for k in range(4)]), order=2)
    import xxhash
    ids = model.word_ids(np.array([xxhash.xxh3_64_intdigest(w) for w in (b"a", b"b", b"c", b" ")], np.uint64)).tolist()
    assert sorted(model.successors(2, ids[0])) == sorted([(ids[1], 8), (ids[2], 4)])


@pytest.mark.parametrize("n,universe", [(1, 5), (40, 41), (3000, 1 << 20), (20_000, 1 << 64), (500, 500)])
def test_elias_fano(n, universe, monkeypatch):
    rng = np.random.default_rng(n)
    v = np.unique(rng.integers(0, universe - 1, n, dtype=np.uint64, endpoint=True)) if n < universe else np.arange(n)
    seq = ef.EliasFano(*ef.view_arrays(np.frombuffer(ef.pack_arrays(*ef.build(v, universe, "x")), np.uint8)), "x")
    assert (seq.decode() == v).all()
    q = np.concatenate([v[:: max(1, len(v) // 50)], rng.integers(0, universe - 1, 50, dtype=np.uint64, endpoint=True)])
    want = [int(np.searchsorted(v, x)) if x in v else -1 for x in q.astype(v.dtype)]
    for ratio in (0, 10**9):  # random access, then merging
        monkeypatch.setattr(ef, "MERGE_RATIO", ratio)
        assert seq.find(q).tolist() == want
        i = rng.integers(0, len(v), 30)
        assert (seq.access(i) == v[i].astype(np.uint64)).all()
