"""Benchmark decontamination with one FM-index per training shard.

A task cuts its documents into shards of about ``SHARD_WORDS`` words.  Words outside the
test vocabulary become separators and runs shorter than the shortest phrase are left
out; the rest of the shard gets a suffix order (prefix doubling), its Burrows-Wheeler
transform in a wavelet matrix with block ranks, and sampled suffix positions.  All test
windows are searched backward at once, their occurrences located by walking to the next
sample, and the hit words merged into removal spans.

Test phrases are prepared by Spark tasks in blocks of bounded size, written to the
shared folder and read block by block, so neither the driver nor a task ever holds a
benchmark that has grown.

Defined cases: null and empty texts have no words; items without words have no windows;
an item with a null id counts for hits and is listed as empty text; repeated rows give
repeated results; a null document id stays null; extra columns are ignored by ``find_leaks``
and kept by ``remove_leaks``.  Texts are read whole.
"""

from __future__ import annotations

import pickle
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.llm.common import ALNUM_TABLE, alnum_words, map_file, scratch, text_rows, write_file

WINDOW = 10
SHARD_WORDS = 2_000_000
SAMPLE_EVERY = 8
#: Bytes of benchmark text in one block of phrases.
BLOCK_BYTES = 8 << 20


# ---- the index -----------------------------------------------------------------

def suffix_order(s):
    """Suffix array of integer sequence ``s`` whose zeros are separators, each ordered
    by its place (so no comparison goes past one)."""
    import numpy as np
    n = len(s)
    zero = s == 0
    n0 = int(zero.sum())
    rank = s.astype(np.int64) + n0
    rank[zero] = np.arange(n0)
    order = np.argsort(rank, kind="stable")
    step = 1
    while True:
        r = rank[order]
        new = np.concatenate([[0], np.cumsum(r[1:] != r[:-1])]) if n else r
        rank = np.empty(n, np.int64)
        rank[order] = new
        if n == 0 or new[-1] == n - 1:
            return order
        nxt = np.zeros(n, np.int64)
        nxt[:n - step] = rank[step:] + 1
        rank = rank * (n + 1) + nxt
        order = np.argsort(rank, kind="stable")
        step *= 2


class Bits:
    """Bit vector with rank: 64-bit words and a running count per word."""

    def __init__(self, bits):
        import numpy as np
        n = len(bits)
        padded = np.zeros((n // 64 + 1) * 64, np.uint8)
        padded[:n] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words).astype(np.int64))])
        self.total = int(self.before[-1])

    def rank(self, i):
        """Ones before position ``i``."""
        import numpy as np
        w = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & mask)

    def get(self, i):
        import numpy as np
        return ((self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64)


class FmIndex:
    """Backward search and locate over one shard."""

    def __init__(self, s, sigma: int, every: int = SAMPLE_EVERY):
        import numpy as np
        n = len(s)
        order = suffix_order(s)
        bwt = s[order - 1]  # the symbol before each suffix; row of suffix 0 wraps to the last separator
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(s, minlength=sigma))])
        self.levels, self.zeros, x = [], [], bwt
        self.depth = max(1, int(sigma - 1).bit_length())
        for level in range(self.depth - 1, -1, -1):
            bit = (x >> level) & 1
            self.levels.append(Bits(bit))
            self.zeros.append(n - self.levels[-1].total)
            x = np.concatenate([x[bit == 0], x[bit == 1]])
        first = np.zeros(n, bool)  # places without a symbol before them in their run are always sampled
        first[1:] = s[:-1] == 0
        first[:1] = True
        marked = (order % every == 0) | first[order]
        self.marked, self.samples = Bits(marked), order[marked]

    def rank(self, c, i):
        """Occurrences of symbols ``c`` before rows ``i`` of the transform."""
        import numpy as np
        lo = np.zeros_like(i)
        for k, (bits, zero) in enumerate(zip(self.levels, self.zeros)):
            one = ((c >> (self.depth - 1 - k)) & 1).astype(bool)
            a, b = bits.rank(lo), bits.rank(i)
            lo, i = np.where(one, zero + a, lo - a), np.where(one, zero + b, i - b)
        return i - lo

    def symbol(self, i):
        import numpy as np
        c = np.zeros_like(i)
        for bits, zero in zip(self.levels, self.zeros):
            bit, ones = bits.get(i), bits.rank(i)
            c = 2 * c + bit
            i = np.where(bit == 1, zero + ones, i - ones)
        return c

    def search(self, windows, lens):
        """Row ranges ``[lo, hi)`` of the windows (rows of symbols, padded at the end)."""
        import numpy as np
        lo = np.zeros(len(windows), np.int64)
        hi = np.full(len(windows), len(self.marked.words) and int(self.starts[-1]), np.int64)
        for j in range(windows.shape[1] - 1, -1, -1):
            at = np.flatnonzero((lens > j) & (lo < hi))
            c = windows[at, j]
            lo[at], hi[at] = self.starts[c] + self.rank(c, lo[at]), self.starts[c] + self.rank(c, hi[at])
        return lo, hi

    def locate(self, rows):
        """Places of the suffixes in ``rows``."""
        import numpy as np
        place = np.empty(len(rows), np.int64)
        todo, steps = np.arange(len(rows)), 0
        while len(todo):
            hit = self.marked.get(rows) == 1
            place[todo[hit]] = self.samples[self.marked.rank(rows[hit])] + steps
            todo, rows = todo[~hit], rows[~hit]
            c = self.symbol(rows)
            rows = self.starts[c] + self.rank(c, rows)
            steps += 1
        return place


# ---- phrases -------------------------------------------------------------------

def phrase_block(items: list[tuple[str, list[bytes]]], window: int) -> dict:
    """Vocabulary, distinct windows and the items of each window."""
    vocabulary: dict[bytes, int] = {}
    owners: dict[tuple[int, ...], set[int]] = {}
    names = sorted({i for i, _ in items})
    number = {i: k for k, i in enumerate(names)}
    for item, words in items:
        s = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words]
        for k in range(max(1, len(s) - window + 1) if s else 0):
            owners.setdefault(tuple(s[k:k + window]), set()).add(number[item])
    return {"vocabulary": vocabulary, "windows": list(owners), "owners": [sorted(o) for o in owners.values()], "items": names}


def write_phrases(benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
                  id_col: str = "item_id", text_col: str = "text") -> list[str]:
    """Prepares the benchmark in Spark tasks; returns the addresses of its blocks."""
    url = scratch(benchmark.sparkSession, "phrases")
    rows = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
                            F.col(text_col).cast("string").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-int(total) // block_bytes))

    def write(batches):
        from pyspark import TaskContext
        items = [(i, w) for b in batches for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist())
                 if (w := alnum_words(t))]
        if items:
            name = f"{url}/block-{TaskContext.get().partitionId():06d}"
            write_file(name, [pickle.dumps(phrase_block(items, window))])
            yield pa.RecordBatch.from_pydict({"name": [name]})

    return [r[0] for r in rows.repartition(blocks, F.xxhash64("item", "text")).mapInArrow(write, "name string").collect()]


def load_block(url: str) -> dict:
    import numpy as np
    block = pickle.loads(map_file(url).tobytes())
    width = max(len(w) for w in block["windows"])
    windows = np.zeros((len(block["windows"]), width), np.int64)
    for k, w in enumerate(block["windows"]):
        windows[k, :len(w)] = w
    block["lens"] = np.array([len(w) for w in block["windows"]], np.int64)
    block["windows"] = windows
    return block


# ---- a shard -------------------------------------------------------------------

def long_runs(s, shortest: int):
    """Places of the symbols in runs of at least ``shortest`` non-zeros."""
    import numpy as np
    edges = np.flatnonzero(np.diff(np.concatenate([[0], (s != 0).astype(np.int8), [0]])))
    a, b = edges[::2], edges[1::2]
    keep = b - a >= shortest
    a, b = a[keep], b[keep]
    size = b - a
    return np.repeat(a - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(int(size.sum())), size


def merged(starts, ends):
    """Union of intervals as sorted, separate ones."""
    import numpy as np
    order = np.argsort(starts, kind="stable")
    a, b = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], a[1:] > b[:-1]])
    return a[new], b[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(a) - 1]])]


def shard_hits(words: list[list[bytes]], blocks: list[str]):
    """Per document of the shard: removal spans (in words) and the items found."""
    import numpy as np
    lens = np.array([len(w) for w in words], np.int64)
    base = np.concatenate([[0], np.cumsum(lens + 1)])  # one separator after each document
    starts, ends = [], []
    items: list[set[str]] = [set() for _ in words]
    for url in blocks:
        block = load_block(url)
        code = block["vocabulary"].get
        s = np.zeros(int(base[-1]), np.int64)
        for k, w in enumerate(words):
            s[base[k]:base[k] + lens[k]] = [code(x, 0) for x in w]
        place, size = long_runs(s, int(block["lens"].min()))
        if not len(place):
            continue
        ends_at = np.cumsum(size)
        text = np.insert(s[place], ends_at, 0)
        place = np.insert(place, ends_at, -1)
        index = FmIndex(text, len(block["vocabulary"]) + 1)
        lo, hi = index.search(block["windows"], block["lens"])
        count = hi - lo
        found = np.repeat(np.arange(len(count)), count)
        rows = np.repeat(lo - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(int(count.sum()))
        at = place[index.locate(rows)]
        starts.append(at)
        ends.append(at + block["lens"][found])
        doc = np.searchsorted(base, at, "right") - 1
        pairs = np.unique(doc * len(count) + found)
        for d, w in zip((pairs // len(count)).tolist(), (pairs % len(count)).tolist()):
            items[d].update(block["items"][o] for o in block["owners"][w])
    spans: list[list[tuple[int, int]]] = [[] for _ in words]
    if starts and len(a := np.concatenate(starts)):
        a, b = merged(a, np.concatenate(ends))
        doc = np.searchsorted(base, a, "right") - 1
        for d, x, y in zip(doc.tolist(), (a - base[doc]).tolist(), (b - base[doc]).tolist()):
            spans[d].append((x, y))
    return spans, items


def shards(batches, column: int, shard_words: int):
    """Runs of rows ``(batch, row, words)`` with about ``shard_words`` words."""
    rows, total = [], 0
    for batch in batches:
        texts = batch.column(column)
        for lo in range(0, batch.num_rows, 512):
            for k, t in enumerate(texts.slice(lo, 512).to_pylist()):
                w = alnum_words(t)
                rows.append((batch, lo + k, w))
                total += len(w) + 1
                if total >= shard_words:
                    yield rows
                    rows, total = [], 0
    if rows:
        yield rows


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def find_leaks(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
               window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Per document: ``n_words``, ``spans`` to remove (in words), ``n_hit`` and ``items``."""
    blocks = write_phrases(benchmark, window)
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()),
                        ("items", pa.list_(pa.string())), ("spans", SPANS)])

    def run(batches):
        for rows in shards(batches, 1, shard_words):
            words = [w for _, _, w in rows]
            spans, items = shard_hits(words, blocks)
            yield pa.RecordBatch.from_arrays([
                pa.array([b.column(0)[k].as_py() for b, k, _ in rows], pa.int64()),
                pa.array([len(w) for w in words], pa.int64()),
                pa.array([sum(y - x for x, y in s) for s in spans], pa.int64()),
                pa.array([sorted(i) for i in items], pa.list_(pa.string())),
                pa.array([[{"start": x, "end": y} for x, y in s] for s in spans], SPANS)], schema=schema)

    return text_rows(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_words long, n_hit long, items array<string>, spans array<struct<start:long,end:long>>")


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and what stands between them."""
    data = text.encode("utf-8", "surrogatepass")
    at = [m.span() for m in re.finditer(rb"[^ ]+", data.lower().translate(ALNUM_TABLE))]
    out, done = [], 0
    for x, y in spans:
        out.append(data[done:at[x][0]])
        done = at[y - 1][1]
    return b"".join([*out, data[done:]]).decode("utf-8", "surrogatepass")


def remove_leaks(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", window: int = WINDOW,
                 shard_words: int = SHARD_WORDS) -> DataFrame:
    """The documents with every span removed from the text, again and again until no
    window is left (a cut can join the parts of another); all columns and rows stay."""
    blocks = write_phrases(benchmark, window)
    column = docs.columns.index(text_col)

    def run(batches):
        for rows in shards(batches, column, shard_words):
            text: dict[int, str] = {}
            todo, words = list(range(len(rows))), [w for _, _, w in rows]
            while todo:
                spans, _ = shard_hits(words, blocks)
                hit = [(i, s) for i, s in zip(todo, spans) if s]
                for i, s in hit:
                    batch, k, _ = rows[i]
                    text[i] = cut(text.get(i) or batch.column(column)[k].as_py(), s)
                todo = [i for i, _ in hit]
                words = [alnum_words(text[i]) for i in todo]
            # rows of one batch follow each other
            lo = 0
            while lo < len(rows):
                batch, first, _ = rows[lo]
                hi = lo
                while hi < len(rows) and rows[hi][0] is batch:
                    hi += 1
                part = batch.slice(first, hi - lo)
                texts = part.column(column).to_pylist()
                for i in range(lo, hi):
                    if i in text:
                        texts[i - lo] = text[i]
                yield part.set_column(column, part.schema.field(column), pa.array(texts, part.schema.field(column).type))
                lo = hi

    return docs.mapInArrow(run, docs.schema)
