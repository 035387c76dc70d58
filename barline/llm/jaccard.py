"""N-gram Jaccard join: prefix filtering, then tries of globally ordered sets.

A document's set holds the 64-bit hashes of its distinct n-word shingles.  Two documents
link when ``100 * intersection >= percent * union``.  The steps, all in Spark tasks:

1. Shingles that many documents share are counted (local counts first, then one
   aggregation); at most ``HOT_TOKENS`` of them come last in the global order, the others
   are ordered by hash.  The order steers cost only, never the result.
2. A set's prefix, its first ``n - ceil(percent * n) + 1`` shingles in that order, shares a
   shingle with the prefix of every set it links with.  Equal sets are one from here on.
3. Shingles of a few sets give pairs with the number of prefix shingles they share, which
   bounds the intersection (so do the shingles both post below a common bound): pairs that
   cannot link fall away.  Hot shingles chain
   their sets by size instead of pairing them, already inside the tasks.
4. The components of these candidates are joined exactly.  A large one is cut into blocks
   by hash, and every two blocks meet in one task, so no task holds more than two blocks.
   There the sets, in one order, form a trie; a set's walk sums the overlap once per shared
   path and leaves subtrees whose remaining length cannot reach the threshold.  Links are
   kept as stars, and sets already connected are not compared again.
5. Components of the links, spread to equal sets, give each row its class.

Defined cases: null and empty texts have an empty set, link with nothing and are their own
class; with fewer than n words the whole sequence is the one shingle; repeated rows fall in
one class (the id itself); rows with a null id link like any other, and their class is the smallest
id they reach, null where there is none; extra columns are ignored.  Texts are read whole.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barline.llm.common import release, staged, text_rows
from barline.llm.components import components

SHINGLE = 5
PERCENT = 75
#: Shingles known to be shared by many sets (an order key each, 16 bytes on every executor).
HOT_TOKENS = 500_000
#: A shingle counts as shared where a chunk of a task holds it so often.
HOT_LOCAL, HOT_TOTAL = 2, 16
#: Sets of one shingle that are paired; more are chained.
PAIRED = 256
#: Sets and shingles in one block of a large candidate component.
BLOCK_SETS, BLOCK_SHINGLES = 512, 1_000_000
CHUNK_WORDS = 2_000_000
#: Postings in one task (it sorts them and reads them as a stream).
POSTINGS = 2_500_000
#: Order keys: hashes below, hot ranks from here on.
HOT_BASE = 1 << 62


# ---- sets -----------------------------------------------------------------------------

def mix(h):
    import numpy as np
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class WordHashes(dict):
    """Hash of each word, remembered."""

    def __missing__(self, word: bytes) -> int:
        import xxhash
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


class Shingler:
    """Sorted distinct shingle hashes of texts."""

    def __init__(self, width: int, cache: int = 500_000):
        self.width, self.cache, self.known = width, cache, WordHashes()

    def __call__(self, text: str | None):
        import numpy as np
        import xxhash
        words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
        n, k = len(words), self.width
        if not n:
            return np.zeros(0, np.uint64)
        if n < k:
            return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=n)], np.uint64)
        if len(self.known) > self.cache:
            self.known.clear()
        h = np.fromiter(map(self.known.__getitem__, words), np.uint64, n)
        out = np.zeros(n - k + 1, np.uint64)
        for j in range(k):
            out = out * np.uint64(0x9E3779B97F4A7C15) + h[j:n - k + 1 + j]
        return np.unique(mix(out))


def fingerprint(s) -> int:
    """64-bit name of a set, as a signed integer."""
    import xxhash
    x = xxhash.xxh3_64_intdigest(s.tobytes())
    return x - (1 << 64) if x >> 63 else x


def rows_of(batches):
    for batch in batches:
        for lo in range(0, batch.num_rows, 512):
            part = batch.slice(lo, 512)
            yield from zip(part.column(0).to_pylist(), part.column(1).to_pylist())


def at_least(n, percent: int):
    """Least intersection of two linked sets whose sizes sum to ``n``."""
    return -(-percent * n // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def low_keys(percent: int) -> int:
    """Order keys below this bound (about the share of a prefix) are posted by every set, so
    the shingles that two sets share there are counted in full."""
    return HOT_BASE * (100 - percent) // 100


# ---- step 1: shared shingles -------------------------------------------------------------

def shared_shingles(rows: DataFrame, width: int, limit: int = HOT_TOKENS):
    """Hashes of shared shingles (sorted) and their ranks, rarest first."""
    import numpy as np

    def count(batches):
        make = Shingler(width)
        sets, seen, size = [], set(), 0

        def flush():
            h, c = np.unique(np.concatenate(sets), return_counts=True)
            h, c = h[c >= HOT_LOCAL], c[c >= HOT_LOCAL]
            return pa.RecordBatch.from_pydict({"token": pa.array(h.view(np.int64)), "n": pa.array(c.astype(np.int64))})

        for _, text in rows_of(batches):
            s = make(text)
            f = fingerprint(s)
            if f in seen:
                continue
            seen.add(f)
            sets.append(s)
            size += len(s)
            if size >= CHUNK_WORDS:
                yield flush()
                sets, seen, size = [], set(), 0
        if sets:
            yield flush()

    hot = (rows.mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
           .filter(F.col("n") >= HOT_TOTAL).orderBy(F.desc("n"), "token").limit(limit).toArrow())
    token, n = (hot.column(c).to_numpy() for c in ("token", "n"))
    token = token.view(np.uint64) if len(token) else np.zeros(0, np.uint64)
    rank = np.empty(len(token), np.int64)
    rank[np.lexsort((token, n))] = np.arange(len(token))
    order = np.argsort(token)
    return token[order], rank[order]


def order_keys(s, hot, rank):
    """The set as sorted order keys: rare shingles by hash, then the hot ones by rank."""
    import numpy as np
    keys = (s >> np.uint64(2)).astype(np.int64)
    if len(hot):
        i = np.minimum(np.searchsorted(hot, s), len(hot) - 1)
        keys = np.where(hot[i] == s, HOT_BASE + rank[i], keys)
    return np.sort(keys)


# ---- step 2: prefixes --------------------------------------------------------------------

SETS = "doc_id long, name long, n int, last long, low int, prefix array<long>, links array<long>"
SETS_SCHEMA = pa.schema([("doc_id", pa.int64()), ("name", pa.int64()), ("n", pa.int32()), ("last", pa.int64()),
                         ("low", pa.int32()), ("prefix", pa.list_(pa.int64())), ("links", pa.list_(pa.int64()))])


def prefixes(rows: DataFrame, width: int, percent: int, hot, rank) -> DataFrame:
    """A row per document: name and size of its set.  The first row of a set in a task
    carries its prefix (with all low keys, ``low`` of them).  Of the sets of one size that a hot shingle's postings would hold,
    a task posts the first and links the others to it."""
    table = rows.sparkSession.sparkContext.broadcast((hot, rank))

    def run(batches):
        hot_, rank_ = table.value
        make, seen, first, out, bound = Shingler(width), set(), {}, [], low_keys(percent)

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), SETS_SCHEMA)], schema=SETS_SCHEMA)

        for doc_id, text in rows_of(batches):
            s = make(text)
            n = len(s)
            if not n:
                out.append((doc_id, None, 0, None, None, None, None))
            else:
                name = fingerprint(s)
                if name in seen:
                    out.append((doc_id, name, n, None, None, None, None))
                else:
                    seen.add(name)
                    keys = order_keys(s, hot_, rank_)
                    low = int(keys.searchsorted(bound))
                    keys = keys[:max(low, prefix_length(n, percent))]
                    last, links = int(keys[-1]), None
                    if last >= HOT_BASE:
                        cut = keys.searchsorted(HOT_BASE)
                        mine = [(k, first.setdefault((k, n), name)) for k in keys[cut:].tolist()]
                        links = sorted({f for _, f in mine if f != name})
                        keys = [*keys[:cut].tolist(), *(k for k, f in mine if f == name)]
                    out.append((doc_id, name, n, last, low, keys, links))
            if len(out) >= 512:
                yield flush()
                out = []
        if out:
            yield flush()

    return rows.mapInArrow(run, SETS)


# ---- step 3: candidates -------------------------------------------------------------------

PAIRS = "a long, b long, shared long, shared_low long, na int, nb int, la long, lb long, xa int, xb int"
PAIRS_SCHEMA = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("shared", pa.int64()), ("shared_low", pa.int64()),
                          ("na", pa.int32()), ("nb", pa.int32()), ("la", pa.int64()), ("lb", pa.int64()),
                          ("xa", pa.int32()), ("xb", pa.int32())])
#: Shared count of chained sets: always candidates.
CHAINED = 1 << 40


def pair_postings(percent: int):
    """Pairs of the sets that share a shingle; rows come sorted by shingle, size and name."""
    def run(batches):
        import numpy as np
        bound = low_keys(percent)

        def reduce(rows):
            """Rows ``(a, b, shared, shared_low, ...)`` summed by pair."""
            order = np.lexsort((rows[1], rows[0]))
            rows = [c[order] for c in rows]
            first = np.flatnonzero(np.concatenate([[True], (rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])]))
            shared = np.minimum(np.add.reduceat(rows[2], first), CHAINED)
            return [rows[0][first], rows[1][first], shared, np.add.reduceat(rows[3], first), *(c[first] for c in rows[4:])]

        def pairs(token, name, n, last, low, chain):
            """All pairs within small groups, neighbours within others."""
            change = np.concatenate([[True], token[1:] != token[:-1]])
            start = np.flatnonzero(change)
            size = np.diff([*start, len(token)])
            group = np.cumsum(change) - 1
            hot = (token >= HOT_BASE) | (size[group] > PAIRED) | (token == chain)
            left = np.diff([*start, len(token)])[group] - (np.arange(len(token)) - start[group]) - 1  # rows after it
            reach = np.where(hot, np.minimum(left, 1), left)
            i = np.repeat(np.arange(len(token)), reach)
            j = i + 1 + np.arange(len(i)) - np.repeat(np.concatenate([[0], np.cumsum(reach)[:-1]]), reach)
            ok = (100 * n[i].astype(np.int64) >= percent * n[j].astype(np.int64)) & (name[i] != name[j])
            i, j = i[ok], j[ok]
            swap = name[i] > name[j]
            i, j = np.where(swap, j, i), np.where(swap, i, j)
            shared = np.where(hot[i], CHAINED, 1).astype(np.int64)
            return [name[i], name[j], shared, (token[i] < bound).astype(np.int64), n[i], n[j], last[i], last[j], low[i], low[j]]

        held, kept, rows_held, chain = None, [], 0, -1
        empty = [np.zeros(0, t) for t in ("i8", "i8", "i8", "i8", "i4", "i4", "i8", "i8", "i4", "i4")]

        def emit():
            rows = reduce([np.concatenate(c) for c in zip(*kept)])
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, PAIRS_SCHEMA)], schema=PAIRS_SCHEMA)

        def work(cols, last_part):
            """Pairs of the whole groups; the unfinished group is returned to wait."""
            nonlocal chain
            token = cols[0]
            cut = len(token) if last_part else int(np.searchsorted(token, token[-1]))
            if cut == 0 and len(token) > PAIRED:  # one group fills the whole part: chain it, keep its last row
                chain = int(token[0])
                return pairs(*cols, chain), [c[-1:] for c in cols]
            done = pairs(*(c[:cut] for c in cols), chain) if cut else empty
            return done, [c[cut:] for c in cols]

        for batch in batches:
            cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(5)]
            held = cols if held is None else [np.concatenate(c) for c in zip(held, cols)]
            if len(held[0]) >= 200_000:
                done, held = work(held, False)
                kept.append(done)
                rows_held += len(done[0])
                if rows_held > 1_000_000:
                    yield emit()
                    kept, rows_held = [], 0
        if held is not None and len(held[0]):
            kept.append(work(held, True)[0])
        if kept and sum(len(k[0]) for k in kept):
            yield emit()

    return run


def candidates(sets: DataFrame, percent: int) -> DataFrame:
    """Edges ``a, b`` between sets that may link, directly or through others."""
    postings = (sets.filter("prefix IS NOT NULL").select(F.explode("prefix").alias("token"), "name", "n", "last", "low"))
    # A pair comes out of a task once for all the shingles it shares there: few large tasks, read as streams
    total = sets.agg(F.sum(F.size("prefix"))).first()[0] or 0
    pairs = (postings.repartition(int(total) // POSTINGS + 1, "token").sortWithinPartitions("token", "n", "name")
             .mapInArrow(pair_postings(percent), PAIRS))
    pairs = pairs.groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in ("shared", "shared_low")],
                                        *[F.min(c).alias(c) for c in ("na", "nb", "la", "lb", "xa", "xb")])
    # What two sets share at most: among the low keys what was counted, beyond them the rest of either;
    # likewise up to the end of the prefix that ends first, beyond it the rest of that set.
    rest = "({n} - greatest({x}, {n} - CAST(ceil({p} * {n} / 100D) AS int) + 1))"
    end = f"shared + IF(la <= lb, {rest.format(p=percent, n='na', x='xa')}, {rest.format(p=percent, n='nb', x='xb')})"
    most = F.expr(f"IF(shared >= {CHAINED}L, {CHAINED}L, least({end}, shared_low + na - xa, shared_low + nb - xb))")
    need = F.expr(f"ceil({percent}L * (na + nb) / {100 + percent}D)")
    pairs = pairs.filter(most >= need).select("a", "b")
    links = sets.filter("links IS NOT NULL").select(F.col("name").alias("a"), F.explode("links").alias("b"))
    return pairs.unionByName(links)


# ---- step 4: exact join of a candidate component ---------------------------------------------

class Trie:
    """Path-compressed trie of sets in one order (most frequent shingle first).

    Shingles that only one of the sets holds stay out of the paths; sizes count them."""

    def __init__(self, sets: list):
        import numpy as np
        self.n = np.array([len(s) for s in sets], np.int64)
        vocabulary, local, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        order = np.lexsort((np.arange(len(df)), -df))
        rank = np.empty(len(df), np.int64)
        rank[order] = np.arange(len(df))
        self.vocabulary = int((df > 1).sum())  # ranks below are shared
        self.weight = np.add.reduceat(df[local], np.concatenate([[0], np.cumsum(self.n)[:-1]]))
        local = rank[local]
        cuts = np.cumsum(self.n)
        self.paths = []
        for lo, hi in zip([0, *cuts[:-1]], cuts):
            r = np.sort(local[lo:hi])
            self.paths.append(r[:np.searchsorted(r, self.vocabulary)])
        self._build(sorted(range(len(sets)), key=lambda i: self.paths[i].tolist()))

    def _build(self, order: list[int]) -> None:
        import numpy as np
        start, end, parent, leaf = [0], [0], [-1], [[]]  # node 0 is the root
        stack, tokens, at = [(0, 0)], [], 0              # (node, depth) down to the last path
        previous = np.zeros(0, np.int64)
        for i in order:
            p = self.paths[i]
            m = min(len(p), len(previous))
            differ = np.flatnonzero(p[:m] != previous[:m])
            common = int(differ[0]) if len(differ) else m
            below = None
            while stack[-1][1] > common:
                below = stack.pop()
            if stack[-1][1] < common:  # split the edge to ``below`` at depth ``common``
                node, up = below[0], stack[-1]
                middle = len(start)
                cut = start[node] + common - up[1]
                start.append(start[node])
                end.append(cut)
                parent.append(up[0])
                leaf.append([])
                start[node], parent[node] = cut, middle
                stack.append((middle, common))
            if len(p) > common:
                node = len(start)
                tokens.append(p[common:])
                start.append(at)
                at += len(p) - common
                end.append(at)
                parent.append(stack[-1][0])
                leaf.append([])
                stack.append((node, len(p)))
            leaf[stack[-1][0]].append(i)
            previous = p
        self.tokens = np.concatenate(tokens) if tokens else np.zeros(0, np.int64)
        self.start, self.end, self.parent = (np.array(x, np.int64) for x in (start, end, parent))
        self.leaf = leaf
        k = len(start)
        depth = self._depths(k)
        self.children = [[] for _ in range(k)]
        low = np.full(k, 1 << 40, np.int64)     # least set size in the subtree
        rest = np.zeros(k, np.int64)            # longest path below the node
        for x in range(k):
            if leaf[x]:
                low[x] = self.n[leaf[x]].min()
        for x in sorted(range(1, k), key=lambda x: -depth[x]):
            up = parent[x]
            self.children[up].append(x)
            low[up] = min(low[up], low[x])
            rest[up] = max(rest[up], rest[x] + end[x] - start[x])
        self.low, self.rest = low, rest
        self.children = [np.array(c, np.int64) for c in self.children]

    def _depths(self, k: int):
        """Depth of every node, level by level."""
        import numpy as np
        depth, level, d = np.zeros(k, np.int64), np.zeros(1, np.int64), 0
        below = np.argsort(self.parent, kind="stable")
        sorted_parent = self.parent[below]
        while len(level):
            depth[level] = d
            lo, hi = np.searchsorted(sorted_parent, level), np.searchsorted(sorted_parent, level, "right")
            level = np.concatenate([below[a:b] for a, b in zip(lo, hi)]) if (hi > lo).any() else level[:0]
            d += 1
        return depth

    def linked(self, i: int, percent: int):
        """Other sets that link with set ``i``, by one walk from the root."""
        import numpy as np
        mine = np.zeros(self.vocabulary, np.int64)
        mine[self.paths[i]] = 1
        run = np.concatenate([[0], np.cumsum(mine[self.tokens])])
        n, left = int(self.n[i]), len(self.paths[i])
        nodes, overlap, found = np.zeros(1, np.int64), np.zeros(1, np.int64), []
        while len(nodes):
            overlap = overlap + run[self.end[nodes]] - run[self.start[nodes]]
            most = np.minimum(overlap + self.rest[nodes], left)
            alive = most >= at_least(n + self.low[nodes], percent)
            nodes, overlap = nodes[alive], overlap[alive]
            for x, o in zip(nodes.tolist(), overlap.tolist()):
                found += [j for j in self.leaf[x] if j != i and 100 * o >= percent * (n + int(self.n[j]) - o)]
            below = [self.children[x] for x in nodes.tolist()]
            overlap = np.repeat(overlap, [len(c) for c in below])
            nodes = np.concatenate(below) if below else np.zeros(0, np.int64)
        return found


def linked_classes(sets: list, percent: int) -> list[int]:
    """A number per set, the same for exactly the sets that links connect.  Walks start at the
    set with the most shared shingles; sets inside the class that is the largest by then wait.
    When another class has become the largest, those left outside it walk after all: a link is
    found from either end, so only sets of one class may end without a walk."""
    trie = Trie(sets)
    root = list(range(len(sets)))
    size = [1] * len(sets)

    def top(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    largest = 0

    def inside(i):
        return size[top(largest)] > 1 and top(i) == top(largest)

    waiting = sorted(range(len(sets)), key=lambda i: -trie.weight[i])
    while not all(map(inside, waiting)):
        held = []
        for i in waiting:
            if inside(i):
                held.append(i)
                continue
            for j in trie.linked(i, percent):
                a, b = top(i), top(j)
                if a != b:
                    if size[a] < size[b]:
                        a, b = b, a
                    root[b] = a
                    size[a] += size[b]
                    if size[a] > size[top(largest)]:
                        largest = a
        waiting = held
    return [top(i) for i in range(len(sets))]


def join_groups(percent: int):
    def run(t: pa.Table) -> pa.Table:
        import numpy as np
        names = t.column("name").to_pylist()
        sets = [np.frombuffer(b, np.uint64) for b in t.column("items").to_pylist()]
        least: dict[int, int] = {}
        classes = linked_classes(sets, percent)
        for c, name in zip(classes, names):
            least[c] = min(name, least.get(c, name))
        edges = [(name, least[c]) for c, name in zip(classes, names) if name != least[c]]
        return pa.table({"a": pa.array([a for a, _ in edges], pa.int64()), "b": pa.array([b for _, b in edges], pa.int64())})
    return run


MEMBERS = "name long, cluster long, blocks int, items binary"


def _made(width: int, schema: pa.Schema):
    """Makes the set of each text (column ``text``) and keeps the rows whose set has the ``name`` asked for, if any
    is; the other columns of ``schema`` pass."""
    def run(batches):
        make = Shingler(width)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                sets = [make(t) for t in part.column("text").to_pylist()]
                names = pa.array([fingerprint(s) if len(s) else None for s in sets], pa.int64())
                made = {"name": names, "items": pa.array([s.tobytes() for s in sets], pa.binary())}
                rows = pa.RecordBatch.from_arrays([made[f.name] if f.name in made else part.column(f.name) for f in schema], schema=schema)
                if "name" in part.schema.names:  # repeated ids
                    rows = rows.filter(pa.array([a == b for a, b in zip(names.to_pylist(), part.column("name").to_pylist())]))
                yield rows
    return run


def with_sets(members: DataFrame, rows: DataFrame, width: int) -> DataFrame:
    """Adds the sets, as bytes, made again from the texts of the members alone.  A member whose rows all have a
    null id is found by its name among the sets of those rows."""
    # the texts are far larger than the members; both sides are dealt by id at every size
    joined = rows.hint("merge").join(members.withColumnRenamed("rep", "doc_id"), "doc_id")
    schema = pa.schema([("name", pa.int64()), ("cluster", pa.int64()), ("blocks", pa.int32()), ("items", pa.binary())])
    known = joined.select("text", "name", "cluster", "blocks").mapInArrow(_made(width, schema), MEMBERS)
    schema = pa.schema([("name", pa.int64()), ("items", pa.binary())])
    without = rows.filter("doc_id IS NULL").select("text").mapInArrow(_made(width, schema), "name long, items binary")
    without = without.groupBy("name").agg(F.first("items").alias("items"))
    return known.unionByName(members.filter("rep IS NULL").join(without, "name").select(known.columns))


def links_within(found: DataFrame, names: DataFrame, rows: DataFrame, width: int, percent: int) -> DataFrame:
    """Edges ``a, b`` that connect the linked sets of every candidate component ``cluster``."""
    members = staged(found.join(names, "name"), "members")
    size = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("items"))
    blocks = F.greatest(F.ceil(F.col("sets") / BLOCK_SETS), F.ceil(F.col("items") / BLOCK_SHINGLES)).cast("int")
    members = members.join(size.select("cluster", blocks.alias("blocks")), "cluster")
    full = with_sets(members.select("rep", "name", "cluster", "blocks"), rows, width)
    mine = F.expr("CAST(pmod(xxhash64(name), blocks) AS int)")
    full = full.withColumn("mine", mine).withColumn("other", F.explode(F.expr(
        "IF(blocks = 1, array(0), filter(sequence(0, blocks - 1), x -> x <> mine))")))
    return (full.withColumns({"i": F.least("mine", "other"), "j": F.greatest("mine", "other")})
             .groupBy("cluster", "i", "j").applyInArrow(join_groups(percent), "a long, b long"))


def _classes(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> DataFrame:
    """Per document: ``doc_id, name`` (of its set, null without words), ``n, root`` (the set's name for its class) and
    ``class`` (its smallest id)."""
    rows = text_rows(docs, id_col, text_col)
    hot, rank = shared_shingles(rows, width)
    sets = staged(prefixes(rows, width, percent, hot, rank), "sets")
    names = (sets.filter("name IS NOT NULL").groupBy("name")
             .agg(F.min("doc_id").alias("rep"), F.min("n").alias("n")))
    found = components(candidates(sets, percent)).select(F.col("node").alias("name"), F.col("root").alias("cluster"))
    linked = components(links_within(found, names, rows, width, percent))
    ids = (linked.join(names, linked.node == names.name).groupBy("root").agg(F.min("rep").alias("class")))
    classes = linked.join(ids, "root").select(F.col("node").alias("name"), "root", "class")
    classes = names.join(classes, "name", "left").select("name", F.coalesce("root", "name").alias("root"),
                                                         F.when(F.col("root").isNull(), F.col("rep")).otherwise(F.col("class")).alias("class"))
    return sets.select("doc_id", "name", F.col("n").cast("bigint").alias("n")).join(classes, "name", "left")


def jaccard_classes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE,
                    percent: int = PERCENT) -> DataFrame:
    """Per document: ``doc_id, n_shingles, component_id``."""
    return _classes(docs, id_col, text_col, width, percent).select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("name").isNull(), F.col("doc_id")).otherwise(F.col("class")).alias("component_id"))


def _by_set(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """``_row`` (all columns), ``_id`` and ``_name`` of the set of each row."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{id_col}`").cast("bigint").alias("_id"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches):
        make = Shingler(width)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                sets = [make(t) for t in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([fingerprint(s) if len(s) else None for s in sets], pa.int64())],
                                                 names=["_row", "_id", "_name"])

    return rows.mapInArrow(run, T.StructType([rows.schema["_row"], rows.schema["_id"], T.StructField("_name", T.LongType())]))


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE,
             percent: int = PERCENT) -> DataFrame:
    """One row of each class, that of the smallest id; all columns stay.  Rows of one id with different sets are
    different documents: each is judged by its own class.  Of rows that repeat id and set one stays, also
    where they have no words; rows with a null id have no place in the order and stay."""
    rows = _classes(docs, id_col, text_col, width, percent).filter("doc_id IS NOT NULL").select("doc_id", "name", "root")
    first = rows.filter("name IS NOT NULL").groupBy("root").agg(F.min(F.struct("doc_id", "name")).alias("s")).select("s.doc_id", "s.name")
    first = first.unionByName(rows.filter("name IS NULL").select("doc_id", "name").distinct())
    often = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))
    stay = staged(first.join(often, "doc_id").select("doc_id", "name", "rows"), "survivors")
    release(docs.sparkSession)
    key = F.col(id_col).cast("bigint") == F.col("_id")
    # as in with_sets: the texts are dealt by id at every size
    once = docs.hint("merge").join(stay.filter("rows = 1").select(F.col("doc_id").alias("_id")), key, "left_semi")
    more = docs.join(stay.filter("rows > 1").select(F.col("doc_id").alias("_id")), key, "left_semi")
    wanted = stay.filter("rows > 1").select(F.col("doc_id").alias("_d"), F.col("name").alias("_n"))
    more = _by_set(more, id_col, text_col, width).join(wanted, (F.col("_id") == F.col("_d")) & F.col("_name").eqNullSafe(F.col("_n")), "left_semi")
    more = more.groupBy("_id", "_name").agg(F.first("_row").alias("_row")).select("_row.*")
    return once.unionByName(more).unionByName(docs.filter(F.col(id_col).isNull()))
