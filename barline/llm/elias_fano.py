"""Elias-Fano sequences over memory-mapped arrays, with vectorised search.

A sorted sequence of n values below u keeps ``l = log2(u / n)`` low bits of each value in
a packed array and the high parts in unary in a bit vector, about ``2 + l`` bits a value.
A directory counts the zeros before every 512 bits.  ``find`` locates many values at once:
two selects give the values that share a high part, a search on the low bits the rest.
Where the queries are many against the length, the sequence is decoded front to back, in runs of
bounded size, and merged with them instead; the results are the same.
"""

from __future__ import annotations

import json

SUPER = 512
#: Decode and merge when the sequence is at most so many times as long as the queries.
MERGE_RATIO = 48
#: Blocks of ``SUPER`` bits decoded at a time (about half a million values).
RUN_BLOCKS = 1 << 11


def pack_arrays(arrays: dict, meta: dict) -> bytes:
    """One file image: a JSON header, then the arrays, each at a multiple of 8 bytes."""
    import numpy as np
    head, parts, at = dict(meta), [], 0
    head["arrays"] = {}
    for name, a in arrays.items():
        a = np.ascontiguousarray(a)
        data = a.tobytes()
        head["arrays"][name] = [a.dtype.str, at, len(a)]
        parts.append(data + b"\0" * (-len(data) % 8))
        at += len(parts[-1])
    text = json.dumps(head).encode()
    text += b" " * (-len(text) % 8)
    return len(text).to_bytes(8, "little") + text + b"".join(parts)


def view_arrays(image) -> tuple[dict, dict]:
    """Arrays and header of a mapped file image, without copying."""
    import numpy as np
    size = int(image[:8].view("<u8")[0])
    head = json.loads(image[8:8 + size].tobytes())
    arrays = {}
    for name, (dtype, at, n) in head["arrays"].items():
        lo = 8 + size + at
        arrays[name] = image[lo:lo + n * np.dtype(dtype).itemsize].view(dtype)
    return arrays, head


def build(values, universe: int, name: str) -> tuple[dict, dict]:
    """Arrays and header entries of a sorted sequence below ``universe``."""
    import numpy as np
    v = np.asarray(values, np.uint64)
    n = len(v)
    low_bits = max(0, (int(universe) // max(1, n)).bit_length() - 1)
    bits = np.unpackbits(v.astype("<u8").view(np.uint8).reshape(n, 8), axis=1, bitorder="little")[:, :low_bits]
    low = np.packbits(bits.ravel(), bitorder="little")
    low = np.concatenate([low, np.zeros(16 + -len(low) % 8, np.uint8)]).view("<u8")
    top = (int(universe) >> low_bits) + 1
    unary = np.zeros((n + top) // SUPER * SUPER + SUPER, np.uint8)
    unary[(v >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)] = 1
    high = np.packbits(unary, bitorder="little").view("<u8")
    zeros = 64 - np.bitwise_count(high).astype(np.int64)
    before = np.concatenate([[0], np.cumsum(zeros.reshape(-1, SUPER // 64).sum(axis=1))])
    return {f"{name}.low": low, f"{name}.high": high, f"{name}.zeros": before}, {name: [n, low_bits, int(universe)]}


class EliasFano:
    def __init__(self, arrays: dict, head: dict, name: str):
        self.n, self.low_bits, self.universe = head[name]
        self.low, self.high, self.zeros = (arrays[f"{name}.{k}"] for k in ("low", "high", "zeros"))

    def lows(self, i):
        import numpy as np
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        at = i.astype(np.uint64) * np.uint64(self.low_bits)
        w, off = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        left = (np.uint64(64) - off) & np.uint64(63)
        both = (self.low[w] >> off) | np.where(off > 0, self.low[w + 1] << left, np.uint64(0))
        return both & np.uint64((1 << self.low_bits) - 1)

    def select_zero(self, j):
        """Places of the ``j``-th zeros of the unary part."""
        import numpy as np
        out = np.empty(len(j), np.int64)
        for lo in range(0, len(j), 1 << 15):
            q = j[lo:lo + (1 << 15)]
            block = np.searchsorted(self.zeros, q, "right") - 1
            words = self.high[(block * (SUPER // 64))[:, None] + np.arange(SUPER // 64)]
            left = q - self.zeros[block]
            run = np.cumsum(64 - np.bitwise_count(words).astype(np.int64), axis=1)
            w = (run <= left[:, None]).sum(axis=1)
            left = left - np.where(w > 0, run[np.arange(len(q)), np.maximum(w - 1, 0)], 0)
            word = np.ascontiguousarray(~words[np.arange(len(q)), w])
            ones = np.cumsum(np.unpackbits(word.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"),
                             axis=1, dtype=np.uint8)
            out[lo:lo + len(q)] = block * SUPER + w * 64 + (ones <= left[:, None]).sum(axis=1)
        return out

    def bounds(self, high):
        """Index ranges of the values with these high parts."""
        import numpy as np
        hi = self.select_zero(high) - high
        lo = np.zeros(len(high), np.int64)
        some = high > 0
        lo[some] = self.select_zero(high[some] - 1) - (high[some] - 1)
        return lo, hi

    def runs(self, blocks: int = RUN_BLOCKS):
        """The values in order, in runs of bounded size: ``(index of the first, values)``."""
        import numpy as np
        last = len(self.zeros) - 1
        for b in range(0, last, blocks):
            words = self.high[b * (SUPER // 64):(b + blocks) * (SUPER // 64)]
            start = b * SUPER - int(self.zeros[b])  # ones before
            ones = np.flatnonzero(np.unpackbits(words.view(np.uint8), bitorder="little"))[:max(0, self.n - start)]
            if len(ones):
                i = np.arange(start, start + len(ones))
                yield start, ((ones + (b * SUPER - i)).astype(np.uint64) << np.uint64(self.low_bits)) | self.lows(i)

    def decode(self):
        """All values, in order."""
        import numpy as np
        return np.concatenate([np.zeros(0, np.uint64), *[v for _, v in self.runs()]])

    def access(self, i):
        """Values at positions ``i`` (of monotone pointers)."""
        import numpy as np
        if self.n <= MERGE_RATIO * len(i):
            return self.decode()[i]
        # the i-th one: the word is found by the count of ones before it
        ones_before = np.arange(len(self.zeros)) * SUPER - self.zeros
        block = np.searchsorted(ones_before, i, "right") - 1
        words = self.high[(block * (SUPER // 64))[:, None] + np.arange(SUPER // 64)]
        left = i - ones_before[block]
        run = np.cumsum(np.bitwise_count(words).astype(np.int64), axis=1)
        w = (run <= left[:, None]).sum(axis=1)
        left = left - np.where(w > 0, run[np.arange(len(i)), np.maximum(w - 1, 0)], 0)
        word = np.ascontiguousarray(words[np.arange(len(i)), w])
        ones = np.cumsum(np.unpackbits(word.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"), axis=1)
        place = block * SUPER + w * 64 + (ones <= left[:, None]).sum(axis=1)
        return ((place - i).astype(np.uint64) << np.uint64(self.low_bits)) | self.lows(i)

    def find(self, x):
        """Index of each value of ``x`` (sorted or not), -1 where it is absent."""
        import numpy as np
        x = np.asarray(x, np.uint64)
        if not self.n or not len(x):
            return np.full(len(x), -1, np.int64)
        if self.n <= MERGE_RATIO * len(x):
            if (x[1:] < x[:-1]).any():
                order = np.argsort(x)
                out = np.empty(len(x), np.int64)
                out[order] = self.find(x[order])
                return out
            out = np.full(len(x), -1, np.int64)
            for start, v in self.runs():
                lo, hi = np.searchsorted(x, v[0]), np.searchsorted(x, v[-1], "right")
                i = np.searchsorted(v, x[lo:hi])
                out[lo:hi] = np.where(v[i] == x[lo:hi], start + i, -1)
            return out
        out = np.full(len(x), -1, np.int64)
        at = np.flatnonzero(x < np.uint64(min(self.universe, 2**64 - 1))) if self.universe < 2**64 else np.arange(len(x))
        low = x[at] & np.uint64((1 << self.low_bits) - 1)
        lo, hi = self.bounds((x[at] >> np.uint64(self.low_bits)).astype(np.int64))
        end = hi.copy()
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                break
            mid = (lo[open_] + hi[open_]) >> 1
            less = self.lows(mid) < low[open_]
            lo[open_] = np.where(less, mid + 1, lo[open_])
            hi[open_] = np.where(less, hi[open_], mid)
        inside = np.flatnonzero(lo < end)
        hit = inside[self.lows(lo[inside]) == low[inside]]
        out[at[hit]] = lo[hit]
        return out
