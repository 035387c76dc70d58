"""op7 and op9: ids equal to the libraries', files and bytes read back."""

import hashlib
import zlib

import numpy as np
import public_tokenizers as P
import tiktoken
from tokenizers import Tokenizer

from barline.llm import bpe, token_files
from barline.llm.common import map_file, table
from tests.conftest import SF_SMALL
from tests.llm.helpers import AWKWARD, frame, rows_of

RANKS, WORDS = P.path("byte_bpe_multi_50k.tiktoken"), P.path("word_bpe_49k.json")
ODD = AWKWARD + [(40, "<|endoftext|>don't <|startoftext|>x  Σς İ ﬁ '''s"), (41, "É J̌ İ"), (42, "z" * 70 + " " * 70 + "!?" * 40),
                 (43, "a  b\n\n c\t\n"), (44, "".join(chr(97 + (k * k * 7 + k // 3) % 26) for k in range(3000)))]


def tables(spark):
    docs = table(spark, SF_SMALL, "documents")
    return [(docs, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]), (frame(spark, ODD), ODD), (frame(spark, []), [])]


def test_bpe_equals_the_library(spark):
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    for df, rows in tables(spark):
        want = []
        for i, t in rows:
            ids = lib.encode_ordinary(t or "")
            data = np.array(ids, "<u4").tobytes()
            want.append((i, len(ids), hashlib.sha256(data).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
        got = bpe.encode_decode(df, RANKS, P.PATTERN)
        assert rows_of(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)


def test_bpe_round_trip_with_ids(spark):
    rows = bpe.encode_decode(frame(spark, ODD), RANKS, P.PATTERN, keep_ids=True, keep_decoded=True, keep_coder=False).collect()
    assert sorted(r.decoded for r in rows) == sorted(t or "" for _, t in ODD)
    duck = bpe.DuckBpe(bpe.read_ranks(RANKS))
    whole = duck.decode([np.array(r.ids, "<u4").tobytes() for r in rows])  # whole texts, not by piece
    assert whole == [r.decoded.encode() for r in rows]


def test_bpe_small_cache_and_batches(spark, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 5)
    monkeypatch.setattr(bpe, "ENCODE_BYTES", 50)
    monkeypatch.setattr(bpe, "DECODE_TOKENS", 20)
    coder = bpe.PieceCoder(bpe.read_ranks(RANKS), P.PATTERN, 5)
    texts = [t for _, t in ODD if t is None or len(t) < 200]
    for t in texts:
        assert coder.code([t])[1][0] == (t or "").encode()
    assert [bytes(b) for b in coder.code(texts)[1]] == [(t or "").encode() for t in texts] and coder.code([]) == ([], [])


def test_small_word_cache(monkeypatch):
    lib = Tokenizer.from_file(WORDS)
    encoder = token_files.WordEncoder(WORDS, "<u2", True, cache_words=3)
    for k in range(4):
        texts = ["a b c d", None, f"word{k} a", "", "\t x  b "]
        data, ends = encoder.encode(texts, b"\2\0")
        want = [i for t in texts for i in (*lib.encode(t or "", add_special_tokens=False).ids, 2)]
        assert np.frombuffer(data, "<u2").tolist() == want and ends[-1] == len(data)


def test_files_equal_the_library(spark):
    lib = Tokenizer.from_file(WORDS)
    lib.encode_special_tokens = True
    for df, rows in tables(spark):
        url, manifest = token_files.write_token_files(df, WORDS, end_id=2, lower=True)
        got = token_files.read_token_files(spark, url, manifest).collect()
        start, want = 0, {}
        for i, t in rows:
            ids = [*lib.encode(t or "", add_special_tokens=False).ids, 2]
            want.setdefault(i, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        have = {}
        for r in sorted(got, key=lambda r: r.start):  # ascending ids, no gap between documents
            assert r.start == start
            start += r.n_tokens
            have.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_crc32))
        ids = [r.doc_id for r in sorted(got, key=lambda r: r.start) if r.doc_id is not None]
        assert ids == sorted(ids)
        assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in want.items()}


def test_file_format(spark):
    url, manifest = token_files.write_token_files(frame(spark, [(7, "a b"), (5, None)]), WORDS, end_id=2)
    r = manifest.orderBy("part").collect()
    assert [x.base for x in r] == list(np.cumsum([0, *[x.n_tokens for x in r[:-1]]]))
    assert sum(x.n_docs for x in r) == 2
    name = f"{url}/part-{r[0].part:06d}"
    tokens, at, doc = map_file(name + ".bin").view("<u2"), map_file(name + ".idx").view("<u8"), map_file(name + ".doc")
    assert at.tolist()[:2] == [0, 1] and tokens[0] == 2 and doc[:8].view("<i8")[0] == 5
