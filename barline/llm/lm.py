"""N-gram language model in an Elias-Fano trie, built and queried by Spark tasks.

Words are ASCII-lower-cased, cut at blanks, and known by their 64-bit hash; every text ends
with an end token, which is also the context of the next text's first word.

Level 1 holds the sorted word hashes (a word's id is its rank), exact counts, and serves
the add-half base.  Level k holds, for every context (an entry of level k - 1), monotone
pointers to its successors, the successors' ids relative to their context, exact counts,
and quantised probabilities: discounted shares of the successors and the weight left for
the lower order.  Entries seen fewer than ``MIN_COUNT`` times above level 1 give their
share to the lower order (interpolated absolute discounting).

    p_k(w | c) = (n(c, w) - D) / n(c)  [kept entries]  +  left(c) * p_{k-1}(w | shorter c)

Counting: each task counts its n-grams in chunks, cuts the sorted keys at bounds known
beforehand and sends one compressed block per bucket; a bucket is merged by one task into
one file of the shared folder.  Bounds follow the counts of the level below, and a hot
context is cut by its successors, so buckets are even.  The model grows with the corpus.

Looking up: a chunk sends its distinct keys, cut at the same bounds, to the tasks that own
the buckets.  An owner memory-maps its bucket's file only and searches the keys of many
chunks at once, so every file is read once a level however many chunks there are.  The
answers of a chunk go to one file of the shared folder; level k + 1 is counted from the
answers of level k.  Those of the highest level go to the task that scores the chunk.

Defined cases: null and empty texts are one end token; unknown words take the base's
share of an unseen word and break the context; repeated rows count and score each; a null
id stays null (its fold is that of an empty text); extra columns are ignored; without
training rows all words are unknown.  Texts are read whole.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import TYPE_CHECKING

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.llm import elias_fano as ef
from barline.llm.common import Numbers, discard, map_file, remainder, scratch, shuffles_end_with_query, staged, text_rows, write_file

if TYPE_CHECKING:
    import numpy as np

ORDER = 3
DISCOUNT = 0.5
MIN_COUNT = 1
#: Tokens counted or scored together in a task, and bytes of training text per bucket.
CHUNK_TOKENS = 1_200_000
BUCKET_BYTES = 24 << 20
END = b" "
#: Codes of -log10 p; 65535 codes reach 10^-16.
STEP = 1 / 4096
HASH_SPACE = 1 << 64


def quantise(p):
    import numpy as np
    return np.clip(np.rint(-np.log10(np.maximum(p, 1e-16)) / STEP), 0, 65535).astype(np.uint16)


def probability(code):
    import numpy as np
    return 10.0 ** (-STEP * code.astype(np.float64))


# ---- tokens ----------------------------------------------------------------------

def numbered() -> Numbers:
    """Word numbers; number 0 is the end token."""
    known = Numbers()
    known[END] = 0
    return known


def token_chunks(batches, limit: int = CHUNK_TOKENS):
    """Chunks of whole texts: their ids, token numbers, word hashes (entry 0: the end token)
    and the tokens as entry numbers."""
    import numpy as np
    import xxhash

    def chunk():
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, known), np.uint64, len(known))
        return ids, np.array(lens, np.int64), hashes, np.concatenate(seq) if seq else np.zeros(0, np.int32)

    ids, lens, seq, known, total = [], [], [], numbered(), 0
    for batch in batches:
        for lo in range(0, batch.num_rows, 512):
            rows = batch.slice(lo, 512)
            for i, t in zip(rows.column(0).to_pylist(), rows.column(1).cast(pa.binary()).to_pylist()):
                words = (t or b"").lower().split()
                words.append(END)
                seq.append(np.fromiter(map(known.__getitem__, words), np.int32, len(words)))
                ids.append(i)
                lens.append(len(words))
                total += len(words)
                if total >= limit:
                    yield chunk()
                    ids, lens, seq, known, total = [], [], [], numbered(), 0
    if ids:
        yield chunk()


def press(array) -> bytes:
    """An array, bytes of equal weight together and compressed."""
    import numpy as np
    import zstandard
    a = np.ascontiguousarray(array)
    return zstandard.ZstdCompressor(level=1).compress(a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes())


def unpress(data: bytes, dtype):
    import numpy as np
    import zstandard
    data, size = zstandard.ZstdDecompressor().decompress(data), np.dtype(dtype).itemsize
    if not data:
        return np.zeros(0, dtype)
    planes = np.frombuffer(data, np.uint8)
    return np.ascontiguousarray(planes.reshape(size, -1).T).view(dtype).ravel()


def write_parts(url: str, parts: list[bytes]) -> None:
    write_file(url, [len(parts).to_bytes(8, "little"), *(len(x).to_bytes(8, "little") for x in parts), *parts])


def read_parts(url: str) -> list[bytes]:
    image = map_file(url)
    n = int(image[:8].view("<i8")[0])
    at, parts = 8 * (n + 1), []
    for size in image[8:at].view("<i8").tolist():
        parts.append(image[at:at + size].tobytes())
        at += size
    return parts


def tokenise(docs: DataFrame, url: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the chunks of ``token_chunks`` as files of the folder ``url``: words are cut and numbered once, counting
    and scoring read numbers.  Returns the chunks' names and numbers of tokens."""
    def run(batches):
        import uuid

        import numpy as np
        for ids, lens, hashes, seq in token_chunks(batches):
            chunk = uuid.uuid4().hex
            write_parts(f"{url}/hashes/{chunk}", [press(hashes.astype("<u8"))])
            write_parts(f"{url}/tokens/{chunk}", [
                press(x) for x in (np.array([i or 0 for i in ids], "<i8"), np.array([i is not None for i in ids], "u1"),
                                   lens.astype("<i8"), seq.astype("<i4"))])
            yield pa.RecordBatch.from_pydict({"chunk": pa.array([chunk]), "n": pa.array([len(seq)], pa.int64())})

    return staged(text_rows(docs, id_col, text_col).mapInArrow(run, "chunk string, n long"), "chunks")


def names(batches):
    for batch in batches:
        yield from batch.column(0).to_pylist()


def read_hashes(url: str, chunk: str):
    return unpress(read_parts(f"{url}/hashes/{chunk}")[0], "<u8")


def read_tokens(url: str, chunk: str):
    """``(ids, valid, lens, seq)`` of a chunk."""
    return tuple(unpress(x, t) for x, t in zip(read_parts(f"{url}/tokens/{chunk}"), ("<i8", "u1", "<i8", "<i4")))


# ---- blocks between tasks -----------------------------------------------------------

BLOCK = "bucket long, keys binary, counts binary"
BLOCK_SCHEMA = pa.schema([("bucket", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])


def cut(keys, bounds):
    """``(bucket, lo, hi)`` of the sorted keys of each bucket that has some."""
    import numpy as np
    cuts = np.searchsorted(keys, np.asarray(bounds[1:], np.uint64)).tolist()
    for b, (lo, hi) in enumerate(zip([0, *cuts], [*cuts, len(keys)])):
        if hi > lo:
            yield b, lo, hi


def press_keys(keys) -> bytes:
    """Sorted keys as gaps."""
    import numpy as np
    return press(np.diff(keys, prepend=np.uint64(0)).astype("<u8"))


def unpress_keys(data: bytes):
    import numpy as np
    return np.cumsum(unpress(data, "<u8"), dtype=np.uint64)


def blocks(keys, counts, bounds):
    """Sorted keys with counts, cut at the bounds, as compressed rows."""
    rows = [(b, press_keys(keys[lo:hi]), press(counts[lo:hi].astype("<u4"))) for b, lo, hi in cut(keys, bounds)]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), BLOCK_SCHEMA)], schema=BLOCK_SCHEMA)


def merge_blocks(t: pa.Table):
    """Sorted distinct keys of a bucket with their summed counts."""
    import numpy as np
    k = np.concatenate([unpress_keys(x) for x in t.column("keys").to_pylist()])
    c = np.concatenate([unpress(x, "<u4") for x in t.column("counts").to_pylist()])
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    return k[first], np.add.reduceat(c, first, dtype=np.int64)


def distinct(keys):
    """Sorted distinct keys, and the place of every key among them.  Hashing first leaves only
    the distinct keys to sort."""
    import numpy as np
    import pandas as pd
    codes, seen = pd.factorize(keys)
    order = np.argsort(seen)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return seen[order], rank[codes]


def packed_counts(counts) -> dict:
    """Counts as bytes, with the places and values of those above 254."""
    import numpy as np
    large = np.flatnonzero(counts > 254)
    return {"counts": np.minimum(counts, 255).astype(np.uint8), "large.at": large.astype("<i8"), "large": counts[large].astype("<i8")}


def counts_at(arrays: dict, places):
    """Counts of ``packed_counts`` at these places."""
    import numpy as np
    out = arrays["counts"][places].astype(np.int64)
    over = np.flatnonzero(out == 255)
    out[over] = arrays["large"][np.searchsorted(arrays["large.at"], places[over])]
    return out


# ---- the model -----------------------------------------------------------------------

@dataclass
class Level:
    """One level: bucket bounds over its keys, the buckets that have a file, their first positions."""

    name: str
    bounds: np.ndarray
    filled: np.ndarray
    bases: np.ndarray
    n: int
    total: int
    #: Weight of contexts that buckets share, by context.
    shared: dict[int, float] = field(default_factory=dict)

    @property
    def files(self) -> list[str | None]:
        return [file_name(self.name, b) if f else None for b, f in enumerate(self.filled.tolist())]

    def open(self, b: int):
        """Arrays and sequences of a bucket's file; the one opened last stays open."""
        last = self.__dict__.get("_open")
        if last is None or last[0] != b:
            arrays, head = view_file(file_name(self.name, b))
            last = b, arrays, {k: ef.EliasFano(arrays, head, k) for k in ("keys", "contexts", "pointers") if k in head}
            self.__dict__["_open"] = last
        return last[1:]

    def counts(self, places):
        """Counts of the entries at these sorted global positions (0 or more)."""
        import numpy as np
        out = np.zeros(len(places), np.int64)
        cuts = np.searchsorted(places, [*self.bases, self.n])
        for b in np.flatnonzero((cuts[1:] > cuts[:-1]) & self.filled).tolist():
            lo, hi = int(cuts[b]), int(cuts[b + 1])
            out[lo:hi] = counts_at(self.open(b)[0], places[lo:hi] - self.bases[b])
        return out

    def words(self, b: int, hashes):
        """Of sorted word hashes of bucket ``b``: ids (-1 for unknown words) and counts."""
        import numpy as np
        ids, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        if self.filled[b]:
            arrays, seqs = self.open(b)
            got = seqs["keys"].find(hashes)
            some = np.flatnonzero(got >= 0)
            ids[some], counts[some] = got[some] + self.bases[b], counts_at(arrays, got[some])
        return ids, counts

    def successors(self, b: int, keys, v: int):
        """Of sorted keys ``context * v + word`` of bucket ``b``: positions (-1 where not kept), codes of
        the shares, and codes of the weight left to the lower order."""
        import numpy as np
        v = np.uint64(v)
        if not len(keys):
            return np.zeros(0, np.int64), np.zeros(0, np.uint16), np.zeros(0, np.uint16)
        place, share, left = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.uint16), np.zeros(len(keys), np.uint16)
        owner, word = (keys // v).astype(np.int64), keys % v
        first = np.concatenate([[True], owner[1:] != owner[:-1]])
        c, inv = owner[first], np.cumsum(first) - 1
        left_of = np.zeros(len(c), np.uint16)  # code 0: all of it
        if self.filled[b]:
            arrays, seqs = self.open(b)
            local = seqs["contexts"].find(c)
            known = np.flatnonzero(local >= 0)
            left_of[known] = arrays["left"][local[known]]
            local = local[inv]
            some = np.flatnonzero(local >= 0)
            got = seqs["keys"].find(local[some].astype(np.uint64) * v + word[some])
            some, got = some[got >= 0], got[got >= 0]
            place[some], share[some] = got + self.bases[b], arrays["probs"][got]
        if self.shared:
            for i in np.flatnonzero(np.isin(c, np.fromiter(self.shared, np.int64, len(self.shared)))).tolist():
                left_of[i] = quantise(np.array([1 - self.shared[int(c[i])]]))[0]
        left[:] = left_of[inv]
        return place, share, left

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_open"}


def file_name(name: str, bucket: int) -> str:
    return f"{name}-{bucket:06d}"


def view_file(url: str):
    return ef.view_arrays(map_file(url))


@dataclass
class Model:
    levels: list[Level]
    order: int
    end: int

    @property
    def n_words(self) -> int:
        return self.levels[0].n

    @property
    def n_tokens(self) -> int:
        return self.levels[0].total

    def word_ids(self, hashes):
        """Ids of word hashes, -1 for unknown words."""
        import numpy as np
        order = np.argsort(hashes)
        out = np.full(len(hashes), -1, np.int64)
        for b, lo, hi in cut(hashes[order], self.levels[0].bounds):
            out[order[lo:hi]] = self.levels[0].words(b, hashes[order[lo:hi]])[0]
        return out

    def successors(self, k: int, ctx: int) -> list[tuple[int, int]]:
        """``(word id, count)`` of a context's kept successors, by its pointers."""
        import numpy as np
        level, v, out = self.levels[k - 1], self.n_words, []
        for b in np.flatnonzero(level.filled).tolist():
            if int(level.bounds[b]) < (ctx + 1) * v and (b + 1 == len(level.bounds) or int(level.bounds[b + 1]) > ctx * v):
                arrays, seqs = level.open(b)
                c = seqs["contexts"].find(np.array([ctx]))
                if c[0] >= 0:
                    lo, hi = seqs["pointers"].access(np.array([c[0], c[0] + 1])).astype(int)
                    words = seqs["keys"].access(np.arange(lo, hi)) - np.uint64(c[0]) * np.uint64(v)
                    out += zip(words.astype(int).tolist(), counts_at(arrays, np.arange(lo, hi)).tolist())
        return out


def even_bounds(points: list[tuple[int, int]], hot: list[tuple[int, int]], total: int, buckets: int, v: int) -> list[int]:
    """Key bounds of about equal counts; ``points`` are (position, count before it) in order.
    A context with more than one share is cut by its successors."""
    share = max(1, total // buckets)
    out, mass = {0}, share
    for place, before in points:
        if before >= mass:
            out.add(place * v)
            mass = before + share
    for place, count in hot:
        pieces = count // share
        if pieces:
            out.update({place * v, (place + 1) * v}, {place * v + v * j // (pieces + 1) for j in range(1, pieces + 1)})
    return sorted(out)


SUMMARY = ("bucket long, filled boolean, n long, total long, first long, last long, first_mass double, last_mass double, "
           "points array<long>, hot array<long>")
SUMMARY_SCHEMA = pa.schema([("bucket", pa.int64()), ("filled", pa.bool_()), ("n", pa.int64()), ("total", pa.int64()),
                            ("first", pa.int64()), ("last", pa.int64()), ("first_mass", pa.float64()),
                            ("last_mass", pa.float64()), ("points", pa.list_(pa.int64())), ("hot", pa.list_(pa.int64()))])


def summary(bucket: int, filled: bool, counts, first=-1, last=-1, first_mass=0.0, last_mass=0.0) -> pa.Table:
    """A bucket's row: sizes, positions and counts at 16 even steps, and the entries that hold more than such a step."""
    import numpy as np
    run = np.concatenate([[0], np.cumsum(counts)])
    at = np.unique(np.searchsorted(run, np.linspace(0, run[-1], 17)[:-1], "right") - 1) if len(counts) else np.zeros(0, int)
    top = np.flatnonzero(np.asarray(counts) * 16 > run[-1]) if len(counts) else np.zeros(0, int)
    points = np.stack([at, run[at]], 1).ravel() if len(at) else []
    hot = np.stack([top, np.asarray(counts)[top]], 1).ravel() if len(top) else []
    row = [bucket, filled, len(counts), int(run[-1]), first, last, first_mass, last_mass, [int(x) for x in points], [int(x) for x in hot]]
    return pa.Table.from_arrays([pa.array([x], f.type) for x, f in zip(row, SUMMARY_SCHEMA)], schema=SUMMARY_SCHEMA)


def build_words(t: pa.Table, url: str) -> pa.Table:
    """Merges a bucket of word counts into a file of level 1."""
    bucket = t.column("bucket")[0].as_py()
    keys, counts = merge_blocks(t)
    arrays, head = ef.build(keys, HASH_SPACE, "keys")
    arrays.update(packed_counts(counts))
    write_file(file_name(url, bucket), [ef.pack_arrays(arrays, head)])
    return summary(bucket, True, counts)


def build_level(t: pa.Table, url: str, k: int, model: Model, min_count: int, discount: float) -> pa.Table:
    """Merges a bucket of n-gram counts into a file of level ``k``."""
    import numpy as np
    bucket = t.column("bucket")[0].as_py()
    keys, counts = merge_blocks(t)
    keep = counts >= min_count
    keys, counts, v = keys[keep], counts[keep], np.uint64(model.n_words)
    if not len(keys):
        return summary(bucket, False, counts)
    ctx, word = (keys // v).astype(np.int64), keys % v
    first = np.flatnonzero(np.concatenate([[True], ctx[1:] != ctx[:-1]]))
    owners = ctx[first]
    seen = model.levels[k - 2].counts(owners)
    local = np.repeat(np.arange(len(first)), np.diff([*first, len(ctx)]))
    share = (counts - discount) / seen[local]
    mass = np.add.reduceat(share, first)
    arrays, head = {}, {}
    for name, values, universe in (("contexts", owners, model.levels[k - 2].n),
                                   ("pointers", np.concatenate([first, [len(ctx)]]), len(ctx) + 1),
                                   ("keys", local.astype(np.uint64) * v + word, len(first) * int(v))):
        a, h = ef.build(values, universe, name)
        arrays.update(a)
        head.update(h)
    arrays.update(packed_counts(counts))
    arrays["probs"], arrays["left"] = quantise(share), quantise(1 - mass)
    write_file(file_name(url, bucket), [ef.pack_arrays(arrays, head)])
    return summary(bucket, True, counts, int(owners[0]), int(owners[-1]), float(mass[0]), float(mass[-1]))


def _level(name: str, rows: list, bounds: list[int]) -> tuple[Level, list[tuple[int, int]], list[tuple[int, int]]]:
    """The level from its buckets' rows, with points and hot entries at global positions."""
    import numpy as np
    by = {r["bucket"]: r for r in rows}
    filled, bases = np.zeros(len(bounds), bool), np.zeros(len(bounds), np.int64)
    points, hot, n, total, mass, times = [], [], 0, 0, {}, {}
    for b in range(len(bounds)):
        r = by.get(b)
        bases[b] = n
        if not r or not r["n"]:
            continue
        filled[b] = r["filled"]
        points += [(n + p, total + c) for p, c in zip(r["points"][::2], r["points"][1::2])]
        hot += [(n + p, c) for p, c in zip(r["hot"][::2], r["hot"][1::2])]
        for c, m in {r["first"]: r["first_mass"], r["last"]: r["last_mass"]}.items():
            mass[c], times[c] = mass.get(c, 0.0) + m, times.get(c, 0) + 1
        n, total = n + r["n"], total + r["total"]
    shared = {c: m for c, m in mass.items() if c >= 0 and times[c] > 1}
    return Level(name, np.array(bounds, np.uint64), filled, bases, n, total, shared), points, hot


# ---- answers: what the levels hold of a chunk's keys -----------------------------------

#: Keys that an owner looks up together.
ASKED_TOGETHER = 1 << 21


def asked(ctx, w, v: int):
    """Tokens with a context, the sorted distinct keys they ask for, and each token's place among these.
    An unknown word asks for word 0: its context's weight is wanted."""
    import numpy as np
    ok = np.flatnonzero(ctx >= 0)
    return ok, *distinct(ctx[ok].astype(np.uint64) * np.uint64(v) + np.maximum(w[ok], 0).astype(np.uint64))


ANSWER = "chunk string, bucket long, found binary, places binary, one binary, two binary"
ANSWER_SCHEMA = pa.schema([("chunk", pa.string()), ("bucket", pa.int64()),
                           *[(c, pa.binary()) for c in ("found", "places", "one", "two")]])


def code_types(k: int):
    """Above level 1 codes of share and weight left come with a position; at level 1 counts."""
    return ("<i8",) if k == 1 else ("<u2", "<u2")


def press_answer(places, codes, top: bool) -> list[bytes]:
    """Positions (rising but for the -1 of absent keys) and codes, compressed.  Nothing follows the
    highest level, so only whether a key was found is kept of its position."""
    import numpy as np
    found = places >= 0
    return [press(found.astype("u1")), b"" if top else press(np.diff(places[found], prepend=0).astype("<i8")), *map(press, codes)]


def unpress_answer(found: bytes, places: bytes, *codes, k: int):
    import numpy as np
    found = unpress(found, "u1") > 0
    out = np.full(len(found), -1, np.int64)
    out[found] = np.cumsum(unpress(places, "<i8")) if places else 0
    return out, *(unpress(c, t) for c, t in zip(codes, code_types(k)))


def _ask(model: Model, k: int, url: str):
    """Sends every chunk's keys of level ``k`` to the owners of the buckets; a chunk without keys asks the first for none."""
    bounds = model.levels[k - 1].bounds

    def run(batches):
        import numpy as np
        for chunk in names(batches):
            if k == 1:
                keys = np.sort(read_hashes(url, chunk))
            else:
                keys = walk(model, url, chunk, read_words(url, chunk)[0][read_tokens(url, chunk)[3]], k)[1][1]
            for b, lo, hi in cut(keys, bounds) if len(keys) else [(0, 0, 0)]:
                yield pa.RecordBatch.from_pydict({"bucket": pa.array([b], pa.int64()), "chunk": pa.array([chunk]),
                                                  "keys": pa.array([press_keys(keys[lo:hi])], pa.binary())})
    return run


def _own(model: Model, k: int):
    """Answers the keys of each bucket, many chunks at a time; rows come sorted by bucket."""
    level, top = model.levels[k - 1], k == model.order

    def answer(bucket, chunks, keys):
        import numpy as np
        ends = np.cumsum([len(x) for x in keys]).tolist()
        merged, back = distinct(np.concatenate(keys))
        place, *codes = level.words(bucket, merged) if k == 1 else level.successors(bucket, merged, model.n_words)
        for chunk, lo, hi in zip(chunks, [0, *ends], ends):
            at = back[lo:hi]
            data = press_answer(place[at], [x[at].astype(t) for x, t in zip(codes, code_types(k))], top and k > 1)
            row = [chunk, bucket, *data, *[b""] * (4 - len(data))]
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, ANSWER_SCHEMA)], schema=ANSWER_SCHEMA)

    def run(batches):
        at, chunks, keys, size = -1, [], [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                bucket = batch.column(0)[i].as_py()
                if chunks and (bucket != at or size >= ASKED_TOGETHER):
                    yield from answer(at, chunks, keys)
                    chunks, keys, size = [], [], 0
                at = bucket
                chunks.append(batch.column(1)[i].as_py())
                keys.append(unpress_keys(batch.column(2)[i].as_buffer()))
                size += len(keys[-1])
        if chunks:
            yield from answer(at, chunks, keys)
    return run


def whole_answer(t: pa.Table, k: int):
    """A chunk's answers from all buckets, in the order of its keys."""
    import numpy as np
    t = t.sort_by("bucket")
    columns = [t.column(c).to_pylist() for c in ANSWER_SCHEMA.names[2:4 + len(code_types(k))]]
    return [np.concatenate(x) for x in zip(*(unpress_answer(*row, k=k) for row in zip(*columns)))]


def answers_by_chunk(rows: DataFrame, model: Model, k: int, url: str):
    return (rows.mapInArrow(_ask(model, k, url), "bucket long, chunk string, keys binary")
            .repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_own(model, k), ANSWER).groupBy("chunk"))


def _keep(url: str, k: int):
    """Writes a chunk's answers as one file; those of words in the order of their numbers."""
    def run(t: pa.Table) -> pa.Table:
        import numpy as np
        chunk, (place, *codes) = t.column("chunk")[0].as_py(), whole_answer(t, k)
        if k == 1:
            rank = np.argsort(np.argsort(read_hashes(url, chunk)))
            parts = [press(x[rank]) for x in (place, *codes)]
        else:
            parts = press_answer(place, codes, False)
        write_parts(f"{url}/answers{k}/{chunk}", parts)
        return pa.table({"chunk": [chunk]})
    return run


def look_up(rows: DataFrame, model: Model, k: int, url: str) -> None:
    """Writes the answers of level ``k`` for every chunk."""
    with shuffles_end_with_query(rows.sparkSession):
        answers_by_chunk(rows, model, k, url).applyInArrow(_keep(url, k), "chunk string").agg(F.count("chunk")).collect()
    if k == 1:
        discard(rows.sparkSession, f"{url}/hashes")


def read_words(url: str, chunk: str):
    """Ids (-1 for unknown words) and counts of a chunk's words, by their numbers in the chunk."""
    return tuple(unpress(x, "<i8") for x in read_parts(f"{url}/answers1/{chunk}"))


def read_answer(url: str, k: int, chunk: str):
    """Positions and codes of a chunk's keys."""
    return unpress_answer(*read_parts(f"{url}/answers{k}/{chunk}"), k=k)


def following(place, w, end: int):
    """Contexts of the next order: the position of the token before, none across texts."""
    import numpy as np
    return np.concatenate([[-1], np.where(w[:-1] == end, -1, place[:-1])])


def walk(model: Model, url: str, chunk: str, w, upto: int):
    """``(ctx, (ok, keys, back))`` of order ``upto`` for tokens ``w`` (word ids), by the answers of the orders below."""
    import numpy as np
    ctx = np.concatenate([[model.end], w[:-1]])
    for k in range(2, upto):
        ok, _, back = asked(ctx, w, model.n_words)
        place = np.full(len(w), -1, np.int64)
        place[ok] = read_answer(url, k, chunk)[0][back]
        ctx = following(np.where(w < 0, -1, place), w, model.end)
    return ctx, asked(ctx, w, model.n_words)


def fit_model(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER,
              min_count: int = MIN_COUNT, discount: float = DISCOUNT, bucket_bytes: int = BUCKET_BYTES) -> Model:
    """Builds the trie from all rows of ``docs``; its files lie in the shared folder."""
    url = scratch(docs.sparkSession, "lm")
    return fit_chunks(tokenise(docs, url, id_col, text_col), url, order=order, min_count=min_count, discount=discount,
                      bucket_bytes=bucket_bytes)


def fit_chunks(train: DataFrame, url: str, others: DataFrame | None = None, *, order: int = ORDER, min_count: int = MIN_COUNT,
               discount: float = DISCOUNT, bucket_bytes: int = BUCKET_BYTES, keep: bool = True) -> Model:
    """Builds the trie from all chunks ``train`` of ``tokenise``.  The folder ``url`` then holds what the levels below
    the highest say of these chunks and of ``others``.  Unless ``keep``, a level is removed when the next one is built:
    only the highest stays."""
    import xxhash
    spark = train.sparkSession
    rows = train if others is None else train.unionByName(others)
    size = 6 * (train.agg(F.sum("n")).first()[0] or 0)  # about six bytes of text a word
    buckets = int(size) // bucket_bytes + 1
    bounds, points, hot, model = [HASH_SPACE * b // buckets for b in range(buckets)], [], [], Model([], order, -1)
    for k in range(1, order + 1):
        if k > 1:
            if model.levels[-1].n * model.n_words >= 1 << 64:
                raise ValueError("n-gram keys exceed 64 bits")
            bounds = even_bounds(points, hot, model.levels[-1].total, buckets * (2 if k > 2 else 1), model.n_words)
        name = f"{url}/level{k}/bucket"
        with shuffles_end_with_query(spark):
            got = (train.mapInArrow(_count(model, k, bounds, url), BLOCK).groupBy("bucket")
                   .applyInArrow(_builder(name, k, model, min_count, discount), SUMMARY).collect())
        level, points, hot = _level(name, got, bounds)
        model = Model([*model.levels, level], order, model.end)
        if k > 1 and not keep:
            discard(spark, f"{url}/level{k - 1}")
        if not model.n_words:
            break
        if k == 1:
            find = _finder(model, xxhash.xxh3_64_intdigest(END))
            model.end = spark.range(1, numPartitions=1).mapInArrow(find, "id long").collect()[0][0]
        if k < order:
            look_up(rows, model, k, url)
    return model


def _finder(model: Model, value: int):
    def run(batches):
        import numpy as np
        for _ in batches:
            yield pa.RecordBatch.from_pydict({"id": pa.array(model.word_ids(np.array([value], np.uint64)))})
    return run


def _count(model: Model, k: int, bounds: list[int], url: str):
    """Counts the chunks' keys of level ``k``."""
    def run(batches):
        import numpy as np
        for chunk in names(batches):
            seq = read_tokens(url, chunk)[3]
            if k == 1:
                hashes = read_hashes(url, chunk)
                order = np.argsort(hashes)
                yield blocks(hashes[order], np.bincount(seq, minlength=len(hashes))[order], bounds)
                continue
            _, (_, keys, back) = walk(model, url, chunk, read_words(url, chunk)[0][seq], k)
            if len(keys):
                yield blocks(keys, np.bincount(back), bounds)
    return run


def _builder(name: str, k: int, model: Model, min_count: int, discount: float):
    if k == 1:
        return lambda t: build_words(t, name)
    return lambda t: build_level(t, name, k, model, min_count, discount)


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: token counts, the add-half base and the model's log10 probability."""
    url = scratch(docs.sparkSession, "lm-score")
    return score_chunks(tokenise(docs, url, id_col, text_col), model, url)


SCORES = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"
SCORES_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()),
                           ("base_score", pa.float64()), ("score", pa.float64())])


def score_chunk(model: Model, url: str, chunk: str, highest=None) -> pa.Table:
    """Scores of a chunk's texts; ``highest`` are its answers of the highest level, the others are in files."""
    import numpy as np
    total, v = model.n_tokens, model.n_words
    ids, valid, lens, seq = read_tokens(url, chunk)
    found, counts = read_words(url, chunk)
    base = (counts + 0.5) / (total + 0.5 * (v + 1))
    starts = np.concatenate([[0], np.cumsum(lens)[:-1]])
    w, p = found[seq], base[seq]
    top = len(model.levels) if highest else 1
    ctx = np.concatenate([[model.end], w[:-1]])
    for k in range(2, top + 1):
        ok, _, back = asked(ctx, w, v)
        at, share, left = (x[back] for x in (highest if k == top else read_answer(url, k, chunk)))
        at[w[ok] < 0] = -1
        p[ok] = np.where(at >= 0, probability(share), 0.0) + probability(left) * p[ok]
        place = np.full(len(w), -1, np.int64)
        place[ok] = at
        ctx = following(place, w, model.end)
    return pa.Table.from_arrays([
        pa.array(ids, pa.int64(), mask=valid == 0), pa.array(lens), pa.array(np.add.reduceat((w >= 0).astype(np.int64), starts)),
        pa.array(np.full(len(ids), total, np.int64)), pa.array(np.add.reduceat(np.log10(base)[seq], starts)),
        pa.array(np.add.reduceat(np.log10(p), starts))], schema=SCORES_SCHEMA)


def score_chunks(rows: DataFrame, model: Model, url: str, known: int = 0) -> DataFrame:
    """``score`` over the chunks of ``tokenise``; the folder ``url`` holds the answers of the first ``known`` levels."""
    top = len(model.levels) if model.n_words else 1
    for k in range(known + 1, max(2, top)):
        look_up(rows, model, k, url)

    if top == 1:
        def words_only(batches):
            for chunk in names(batches):
                yield from score_chunk(model, url, chunk).to_batches()

        return rows.mapInArrow(words_only, SCORES)

    def with_highest(t: pa.Table) -> pa.Table:
        return score_chunk(model, url, t.column("chunk")[0].as_py(), whole_answer(t, top))

    return answers_by_chunk(rows, model, top, url).applyInArrow(with_highest, SCORES)


def score_with_held_out(docs: DataFrame, *, fold: int = 5, held_out: int = 1, order: int = ORDER,
                        min_count: int = MIN_COUNT) -> DataFrame:
    """Fits on the rows outside the held-out fold and scores all rows."""
    out, url = remainder(F.col("doc_id"), fold) == held_out, scratch(docs.sparkSession, "lm")
    train, others = tokenise(docs.filter(~out), url), tokenise(docs.filter(out), url)
    model = fit_chunks(train, url, others, order=order, min_count=min_count, keep=False)
    known = len(model.levels) - 1 if model.n_words else 0
    return score_chunks(train.unionByName(others), model, url, known).withColumn("held_out", out)
