"""Byte-level BPE by DuckDB recursive queries inside Spark tasks.

Each task splits its texts by the pre-tokenisation pattern and encodes every distinct
piece once: a recursive query joins (piece, position, token) rows with the merge
table and contracts each piece's leftmost pair of lowest rank until none is left.
Ordered aggregation over (document, position) rows turns ids back into bytes.

A pair may merge whenever its joined bytes are in the vocabulary, as in tiktoken, so
the merge table holds every split of every token into two tokens.  In pieces over
``SHORT_BYTES``, all separate places of the lowest pair contract in one step where no
table row with the contracted token ranks lower than it (checked when the table is
built); the outcome is the same, and long pieces need few steps.  Their recursion runs
in rounds of ``STEPS``, so the rows it keeps are bounded for pieces of any length.

Defined cases: null and empty texts have no ids and decode to no bytes; repeated rows
give repeated results; a null id stays null; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame

from barline.llm.common import Codes, Numbers, per_worker, text_rows

#: Pieces remembered by one worker before it starts afresh, and characters of text taken at
#: a time (a longer text goes alone).
CACHE_PIECES = 500_000
TEXT_CHARS = 4_000_000
#: Pieces up to so many bytes take the plain query.
SHORT_BYTES = 64
STEPS = 32
#: Rows given to one DuckDB query (a single longer piece or text goes alone).
ENCODE_BYTES = 400_000
DECODE_TOKENS = 400_000

#: One contraction per piece and step: the leftmost pair of the lowest rank.
SHORT_SQL = """
WITH RECURSIVE bpe(pos, piece, tok, step) AS (
    SELECT pos, piece, tok, 0 FROM round_start
    UNION ALL
    (WITH pairs AS MATERIALIZED (
        SELECT b.*, (m.rank::BIGINT << 32) + b.pos AS pair
        FROM (SELECT *, CASE WHEN lead(piece) OVER w = piece THEN lead(tok) OVER w END AS nxt, lead(pos) OVER w AS after
              FROM bpe WINDOW w AS (ORDER BY pos)) b
        LEFT JOIN merges m ON m.l = b.tok AND m.r = b.nxt),
    lowest AS (
        SELECT piece, min(pair) AS best, arg_min(after, pair) AS gone FROM pairs WHERE pair IS NOT NULL GROUP BY piece)
    SELECT pos, piece, CASE WHEN pair = best THEN (pair >> 32)::INT ELSE tok END, step + 1
    FROM pairs JOIN lowest USING (piece) WHERE pos <> gone)
)
SELECT piece, tok FROM bpe JOIN (SELECT piece, max(step) AS step FROM bpe GROUP BY piece) USING (piece, step)
ORDER BY pos
"""

#: All separate places of the lowest pair in one step, in rounds of {steps} steps.
LONG_SQL = """
WITH RECURSIVE bpe(piece, pos, tok, step) AS (
    SELECT piece, pos, tok, 0 FROM round_start
    UNION ALL
    SELECT piece, pos, CASE WHEN merged THEN best ELSE tok END, step + 1
    FROM (
        SELECT *, lag(merged, 1, false) OVER (PARTITION BY piece ORDER BY pos) AS eaten
        FROM (
            SELECT *, coalesce(hit AND (n - last_miss) % 2 = 1 AND (s.token IS NULL OR n = first_hit), false) AS merged
            FROM (
                SELECT *, rank = best AS hit,
                       min(CASE WHEN rank = best THEN n END) OVER (PARTITION BY piece) AS first_hit,
                       coalesce(max(CASE WHEN rank = best THEN NULL ELSE n END)
                                OVER (PARTITION BY piece ORDER BY n ROWS UNBOUNDED PRECEDING), 0) AS last_miss
                FROM (
                    SELECT p.piece, p.pos, p.tok, p.step, p.n, m.rank, min(m.rank) OVER (PARTITION BY p.piece) AS best
                    FROM (SELECT piece, pos, tok, step, row_number() OVER w AS n, lead(tok) OVER w AS nxt
                          FROM bpe WHERE step < {steps} WINDOW w AS (PARTITION BY piece ORDER BY pos)) p
                    LEFT JOIN merges m ON m.l = p.tok AND m.r = p.nxt
                ) WHERE best IS NOT NULL
            ) LEFT JOIN single_only s ON s.token = best
        )
    ) WHERE NOT eaten
)
SELECT piece, pos, tok, last_step FROM (
    SELECT *, max(step) OVER (PARTITION BY piece) AS last_step FROM bpe
) WHERE step = last_step ORDER BY piece, pos
"""

DECODE_SQL = """
SELECT doc, list(v.bytes ORDER BY t.pos) AS parts
FROM doc_tokens t JOIN vocabulary v ON v.token = t.tok GROUP BY doc
"""


def read_ranks(path: str) -> dict[bytes, int]:
    import base64
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class DuckBpe:
    """The merge table and vocabulary in a DuckDB of its own, with bounded memory."""

    def __init__(self, ranks: dict[bytes, int], memory: str = "256MB"):
        import duckdb
        import numpy as np
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": memory, "preserve_insertion_order": False})
        rows = [(ranks[t[:k]], ranks[t[k:]], r) for t, r in ranks.items() for k in range(1, len(t))
                if t[:k] in ranks and t[k:] in ranks]
        m = np.array(rows, np.int32).reshape(-1, 3)
        merges = pa.table({"l": m[:, 0], "r": m[:, 1], "rank": m[:, 2]})  # noqa: F841 (read by name below)
        low = np.unique(np.concatenate([m[m[:, 2] < m[:, 0], 0], m[m[:, 2] < m[:, 1], 1]]))
        single = pa.table({"token": low.astype(np.int32)})  # noqa: F841
        vocab = pa.table({"token": pa.array(ranks.values(), pa.int32()),  # noqa: F841
                          "bytes": pa.array(ranks.keys(), pa.binary())})
        self.con.execute("CREATE TABLE merges AS SELECT * FROM merges")
        self.con.execute("CREATE TABLE single_only AS SELECT * FROM single")
        self.con.execute("CREATE TABLE vocabulary AS SELECT * FROM vocab")
        self.byte_rank = np.full(256, -1, np.int32)
        for b in range(256):
            self.byte_rank[b] = ranks.get(bytes([b]), -1)
        self.whole = {t: r.to_bytes(4, "little") for t, r in ranks.items()}

    def rows(self, query: str, **inputs) -> pa.Table:
        for name, data in inputs.items():
            self.con.register(name, data)
        return self.con.execute(query).to_arrow_table()

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece as little-endian unsigned 32-bit integers.  A piece that is
        a token itself is that token, as in tiktoken."""
        import numpy as np
        out: list = [self.whole.get(p) for p in pieces]
        for long in (False, True):
            at = [k for k, p in enumerate(pieces) if out[k] is None and (len(p) > SHORT_BYTES) == long]
            lens = np.array([len(pieces[k]) for k in at], np.int64)
            piece = np.repeat(np.arange(len(at), dtype=np.int32), lens)
            tok = self.byte_rank[np.frombuffer(b"".join(pieces[k] for k in at), np.uint8)]
            pos = np.arange(len(tok), dtype=np.int32)
            done: list[tuple] = [(piece[:0], tok[:0])]
            while long and len(piece):
                got = self.rows(LONG_SQL.format(steps=STEPS), round_start=pa.table({"piece": piece, "pos": pos, "tok": tok}))
                piece, pos, tok, last = (got.column(c).to_numpy() for c in range(4))
                more = last >= STEPS
                done.append((piece[~more], tok[~more]))
                piece, pos, tok = piece[more], pos[more], tok[more]
            if len(piece):
                got = self.rows(SHORT_SQL, round_start=pa.table({"piece": piece, "pos": pos, "tok": tok}))
                done.append((got.column(0).to_numpy(), got.column(1).to_numpy()))
            piece, tok = (np.concatenate(x) for x in zip(*done))
            data = tok[np.argsort(piece, kind="stable")].astype("<u4").tobytes()
            ends = 4 * np.cumsum(np.bincount(piece, minlength=len(at)))
            for k, a, b in zip(at, [0, *ends[:-1]], ends):
                out[k] = data[a:b]
        return out

    def decode(self, docs: list[bytes]) -> list[bytes]:
        """Bytes of each id sequence."""
        import numpy as np
        n = np.array([len(d) // 4 for d in docs], np.int64)
        tok = np.frombuffer(b"".join(docs), "<u4").astype(np.int32)
        if not len(tok):
            return [b""] * len(docs)
        rows = self.rows(DECODE_SQL, doc_tokens=pa.table({"doc": np.repeat(np.arange(len(docs), dtype=np.int32), n),
                                                          "pos": np.arange(len(tok), dtype=np.int64), "tok": tok}))
        out = [b""] * len(docs)
        parts = rows.column(1).combine_chunks()
        values = parts.values.cast(pa.large_binary())  # all parts lie in one buffer, in order
        cuts = np.frombuffer(values.buffers()[1], np.int64)[values.offset:][parts.offsets.to_numpy()]
        data = values.buffers()[2].to_pybytes()
        for doc, a, b in zip(rows.column(0).to_pylist(), cuts[:-1].tolist(), cuts[1:].tolist()):
            out[doc] = data[a:b]
        return out


def batches_of(items: list, size: Callable, limit: int):
    """Runs of items whose sizes sum to at most ``limit``; a larger item goes alone."""
    lo, total = 0, 0
    for k, item in enumerate(items):
        n = size(item)
        if total + n > limit and k > lo:
            yield items[lo:k]
            lo, total = k, 0
        total += n
    if lo < len(items):
        yield items[lo:]


class PieceCoder:
    """Codes texts piece by piece.  Each new piece goes through the recursive query once, and its ids
    through the decoding query once; a text's ids and bytes are those of its pieces in order."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, cache: int = CACHE_PIECES):
        import regex
        self.find, self.duck, self.cache = regex.compile(pattern).findall, DuckBpe(ranks), cache
        self.clear()

    def clear(self) -> None:
        self.numbers, self.ids, self.decoded = Numbers(), Codes(), Codes()

    def learn(self) -> None:
        """Codes the pieces met for the first time."""
        new, self.numbers.new = self.numbers.new, []
        ids: list[bytes] = []
        for part in batches_of(new, len, ENCODE_BYTES):
            ids += self.duck.encode([p.encode("utf-8", "surrogatepass") for p in part])
        distinct, bytes_of = list(set(ids)), {}
        for part in batches_of(distinct, lambda d: len(d) // 4, DECODE_TOKENS):
            bytes_of.update(zip(part, self.duck.decode(part)))
        self.ids.extend(ids)
        self.decoded.extend([bytes_of[d] for d in ids])

    def code(self, texts: list[str | None]) -> tuple[list[memoryview], list[memoryview]]:
        """Ids (little-endian unsigned 32-bit) and decoded bytes of each text."""
        import itertools

        import numpy as np
        if len(self.numbers) > self.cache:
            self.clear()
        split = [self.find(t) if t else [] for t in texts]
        try:
            numbers = np.fromiter(map(self.numbers.__getitem__, itertools.chain.from_iterable(split)), np.int64)
            self.learn()
        except BaseException:
            self.clear()  # numbers without codes must not stay for the next task
            raise
        ends = np.cumsum([0, *map(len, split)])
        out = []
        for codes in (self.ids, self.decoded):
            data, cuts = codes.joined(numbers, ends)
            out.append([data[a:b] for a, b in zip(cuts, cuts[1:])])
        return tuple(out)


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text",
                  keep_ids: bool = False, keep_decoded: bool = False, keep_coder: bool = True) -> DataFrame:
    """Per document: ``n_tokens``, digests of the ids and of the bytes decoded from
    them; on demand also ``ids`` and the ``decoded`` text.  ``keep_coder``: the merge table and the pieces already coded
    serve the worker's later tasks; without it each task makes its own, and no memory stays taken after it."""
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * keep_ids + ["decoded"] * keep_decoded
    types = ([pa.int64(), pa.int64(), pa.string(), pa.string()] + [pa.list_(pa.int32())] * keep_ids
             + [pa.string()] * keep_decoded)
    schema = pa.schema(list(zip(names, types)))

    def run(batches):
        import numpy as np
        make = lambda: PieceCoder(read_ranks(ranks_path), pattern)
        coder = per_worker(("bpe", ranks_path, pattern), make) if keep_coder else make()
        for batch in batches:
            rows = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            for part in batches_of(rows, lambda r: len(r[1] or ""), TEXT_CHARS):
                ids, texts = zip(*part)
                coded, decoded = coder.code(texts)
                cols = [ids, [len(c) // 4 for c in coded], [hashlib.sha256(c).hexdigest() for c in coded],
                        [hashlib.sha256(b).hexdigest() for b in decoded]]
                if keep_ids:
                    cols.append([np.frombuffer(c, "<u4").astype(np.int32) for c in coded])
                if keep_decoded:
                    cols.append([str(b, "utf-8", "replace") for b in decoded])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], schema=schema)

    ddl = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return text_rows(docs, id_col, text_col).mapInArrow(run, ddl + ", ids array<int>" * keep_ids + ", decoded string" * keep_decoded)
