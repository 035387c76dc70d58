import random

import pytest

from barline.llm import jaccard
from barline.llm.common import table
from tests.conftest import SF_SMALL
from tests.llm.helpers import AWKWARD, blank_words, frame, lower, rows_of


def brute(rows, width=5, percent=75):
    """(doc_id, n, class) by comparing all pairs of rows."""
    sets = []
    for _, t in rows:
        w = blank_words(lower(t))
        sets.append({tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))} if w else set())
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            i = len(sets[a] & sets[b])
            if i and 100 * i >= percent * (len(sets[a]) + len(sets[b]) - i):
                root[top(a)] = top(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[top(k)] = min(i, least.get(top(k), i))
    return sorted([(i, len(sets[k]), i if not sets[k] else least.get(top(k))) for k, (i, _) in enumerate(rows)], key=repr)


def classes(df):
    return rows_of(jaccard.jaccard_classes(df), "doc_id", "n_shingles", "component_id")


def copies(seed, n=120, size=60, edits=6):
    """A hub with near copies (each a few words changed, so many only link through it),
    chains of copies of copies, exact copies, and unrelated texts that share a passage."""
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = [r.choice(vocabulary) for _ in range(15)]
    hub = [r.choice(vocabulary) for _ in range(size)]
    rows, last = [], hub
    for k in range(n):
        base = {0: hub, 1: hub, 2: last}.get(k % 5, [r.choice(vocabulary) for _ in range(r.randint(1, size))] + passage)
        text = list(base)
        for _ in range(r.randint(0, edits)):
            text[r.randrange(len(text))] = r.choice(vocabulary)
        last = text
        rows.append((1000 - k, " ".join(text)))
    return rows + [(5000 + k, rows[k][1].upper()) for k in range(0, n, 7)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_pairs(spark, seed):
    rows = copies(seed)
    assert classes(frame(spark, rows, 3)) == brute(rows)


def test_hot_shingles_chains_and_blocks(spark, monkeypatch):
    for name, value in (("PAIRED", 3), ("HOT_LOCAL", 2), ("HOT_TOTAL", 3), ("BLOCK_SETS", 7)):
        monkeypatch.setattr(jaccard, name, value)
    rows = copies(3)
    assert classes(frame(spark, rows, 3)) == brute(rows)


def test_awkward_rows(spark):
    assert classes(frame(spark, AWKWARD)) == brute(AWKWARD)


def test_threshold_is_exact(spark):
    # 16 words: 12 shingles; sets of 15 and 12 shingles with 12 common: 12/15 = 0.8; 16 and 12: 0.75; 17 and 12: below
    w = [f"t{k}" for k in range(40)]
    for extra, linked in ((3, True), (4, True), (5, False)):
        rows = [(1, " ".join(w[:16])), (2, " ".join(w[:16 + extra]))]
        assert classes(frame(spark, rows)) == brute(rows)
        assert (classes(frame(spark, rows))[1][2] == 1) is linked


def test_empty_table(spark):
    assert jaccard.jaccard_classes(frame(spark, [])).collect() == []


def test_documents(spark):
    docs = table(spark, SF_SMALL, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert classes(docs) == brute(rows)


def test_keep_one(spark):
    rows = AWKWARD + [(30, "p q r s t u v w"), (29, "P q r s t u v w"), (31, "p q r s t u v w")]
    df = frame(spark, rows)
    kept = jaccard.keep_one(df)
    assert kept.columns == df.columns
    expect = sorted({i for i, _, c in brute(rows) if i is not None and (c == i)} | {1, 2, 3})
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == expect
    assert kept.filter("doc_id IS NULL").count() == 2


def test_trie_finds_every_link():
    import numpy as np
    r = random.Random(5)
    base = [r.randrange(10**6) for _ in range(40)]
    sets = []
    for _ in range(60):
        s = set(base) - set(r.sample(base, r.randint(0, 8))) | {r.randrange(10**6) for _ in range(r.randint(0, 6))}
        sets.append(np.array(sorted(s), np.uint64))
    trie = jaccard.Trie(sets)
    for i, a in enumerate(sets):
        want = [j for j, b in enumerate(sets) if j != i and 100 * len(np.intersect1d(a, b)) >= 75 * len(np.union1d(a, b))]
        assert sorted(trie.linked(i, 75)) == want


def all_pairs(sets, percent=75):
    root = list(range(len(sets)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            i = len(sets[a] & sets[b])
            if 100 * i >= percent * len(sets[a] | sets[b]):
                root[top(a)] = top(b)
    return [top(x) for x in range(len(sets))]


def same_classes(a, b):
    return len(set(zip(a, b))) == len(set(a)) == len(set(b))


def test_excerpts_stay_linked_when_another_class_becomes_the_largest(spark):
    # excerpts of one text: 1-2, 2-3, 3-5 and 4-5 link
    cuts = [(0, 134), (27, 137), (48, 141), (48, 176), (52, 150)]
    rows = [(k, " ".join(f"w{x}" for x in range(*c))) for k, c in enumerate(cuts, 1)]
    assert {c for *_, c in brute(rows)} == {1}
    assert classes(frame(spark, rows)) == brute(rows)


@pytest.mark.parametrize("seed", range(3))
def test_interval_sets_equal_all_pairs(seed):
    import numpy as np
    r = random.Random(seed)
    for _ in range(700):
        lows = [r.randrange(100) for _ in range(r.randint(2, 14))]
        sets = [set(range(lo, lo + r.randint(60, 130))) for lo in lows]
        got = jaccard.linked_classes([np.array(sorted(s), np.uint64) for s in sets], 75)
        assert same_classes(got, all_pairs(sets))


def test_links_run_through_rows_without_id(spark):
    # of three excerpts only the middle one links with both others
    texts = [" ".join(f"w{x}" for x in range(*c)) for c in ((0, 100), (12, 112), (24, 124))]
    alone = " ".join(f"v{x}" for x in range(50))
    for middle in (None, 3):
        rows = [(1, texts[0]), (middle, texts[1]), (middle, texts[1]), (2, texts[2]), (None, alone), (None, alone + " end"), (None, "")]
        got = {(r.doc_id, r.n_shingles): r.component_id for r in jaccard.jaccard_classes(frame(spark, rows)).collect()}
        assert got[1, 96] == got[2, 96] == got[middle, 96] == 1
        assert got[None, 46] is None and got[None, 47] is None and got[None, 0] is None


def test_keep_one_judges_rows_of_a_repeated_id_by_their_sets(spark):
    x, y = " ".join(f"x{k}" for k in range(30)), " ".join(f"y{k}" for k in range(30))
    kept = lambda rows: sorted((r.doc_id, r.text) for r in jaccard.keep_one(frame(spark, rows)).collect())
    assert kept([(1, x), (5, x), (5, y)]) == [(1, x), (5, y)]
    assert kept([(5, x), (5, y), (5, y), (6, y)]) == [(5, x), (5, y)]
    assert kept([(5, x), (5, x + " end"), (5, ""), (5, ""), (4, y)]) in ([(4, y), (5, ""), (5, x)], [(4, y), (5, ""), (5, x + " end")])


def test_keep_one_leaves_one_row_of_each_class(spark):
    docs = table(spark, SF_SMALL, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted(r.doc_id for r in jaccard.keep_one(docs).collect()) == sorted(i for i, n, c in brute(rows) if i == c or n == 0)
