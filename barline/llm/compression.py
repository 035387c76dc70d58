"""Quality rules by compression bands.

Whole documents and fixed chunks are compressed with zstandard.  A document
whose ratio (compressed / raw bytes) falls below the lower limit of its length
band is repetitive, above the upper limit incompressible.  The limits are per
length band, because short texts compress worse.

Defined cases: null and empty texts have ratio 1.0, no chunk, and fail the base
rule (no words); repeated rows give repeated results; a null id stays null; extra
columns are ignored.  Every text is read whole.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from barline.llm.common import per_row, text_rows

SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Band:
    """Limits for texts of at least ``min_bytes`` bytes."""

    min_bytes: int
    low: float
    high: float


#: Whole-document limits.  A lone frame costs about 20 bytes, hence the wide first band.
WHOLE = (Band(0, 0.38, 2.0), Band(128, 0.40, 1.20), Band(256, 0.42, 0.88), Band(512, 0.42, 0.80),
         Band(2048, 0.38, 0.72), Band(8192, 0.36, 0.68), Band(32768, 0.34, 0.66))
#: Chunk limits (chunks of ``CHUNK_BYTES``; a short rest joins the chunk before).
CHUNKS = (Band(0, 0.38, 0.78),)
CHUNK_BYTES = 2048
LEVEL = 3


def limits(bands: tuple[Band, ...], n_bytes: int) -> Band:
    return [b for b in bands if b.min_bytes <= n_bytes][-1]


def chunk_views(data: bytes, size: int) -> list[memoryview]:
    """Fixed chunks; a rest shorter than half a chunk is part of the last one."""
    n = len(data)
    count = max(1, (n + size // 2) // size)
    view = memoryview(data)
    return [view[i * size:(n if i == count - 1 else (i + 1) * size)] for i in range(count)] if n else []


def repeated_window_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found at least twice in the text."""
    import numpy as np
    n = len(words)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    a = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    v = len(ids)
    pairs = a[:-1] * v + a[1:]
    if v > 2_000_000:  # keeps the window key inside 64 bits
        pairs = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
    keys = pairs[:-1] * v + a[2:]
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    same = s[1:] == s[:-1]
    if not same.any():
        return 0
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    hit = np.zeros(n, bool)
    for k in range(3):
        hit[k:n - 2 + k] |= twice
    return int(hit.sum())


def duplicate_lines(data: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = Counter(x for x in data.split(b"\n") if x.strip())
    return sum(lines.values()) - len(lines)


def compression_rules(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                      whole: tuple[Band, ...] = WHOLE, chunks: tuple[Band, ...] = CHUNKS,
                      chunk_bytes: int = CHUNK_BYTES, level: int = LEVEL) -> DataFrame:
    """One row per document: base counts, ratios and the verdict of the bands
    (``ok``, ``repetitive`` or ``incompressible``)."""

    def make():
        import zstandard
        press = zstandard.ZstdCompressor(level=level).compress

        def one(doc_id, text):
            data = (text or "").encode("utf-8", "surrogatepass")
            words = data.split()
            n = len(words)
            blanks = len(data) - len(data.translate(None, BLANKS))
            rep = repeated_window_words(words)
            ratio = len(press(data)) / len(data) if data else 1.0
            parts = [len(press(c)) / len(c) for c in chunk_views(data, chunk_bytes)] if len(data) > chunk_bytes else []
            lo, hi = (min(parts), max(parts)) if parts else (ratio, ratio)
            w = limits(whole, len(data))
            c = limits(chunks, len(data)) if parts else w
            verdict = ("repetitive" if ratio < w.low or lo < c.low else
                       "incompressible" if ratio > w.high or hi > c.high else "ok")
            base = n < 50 or 100 * rep > 50 * n
            return (doc_id, n, len(text or "") - blanks, len(data) - len(data.translate(None, SYMBOLS)),
                    duplicate_lines(data), rep, base, not base and verdict == "ok", ratio, lo, hi, verdict)
        return one

    i, f, b, s = pa.int64(), pa.float64(), pa.bool_(), pa.string()
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
             "ratio", "min_chunk_ratio", "max_chunk_ratio", "band_verdict"]
    types = [i, i, i, i, i, i, b, b, f, f, f, s]
    return per_row(text_rows(docs, id_col, text_col), make,
                   "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
                   "base_failed boolean, kept boolean, ratio double, min_chunk_ratio double, max_chunk_ratio double, "
                   "band_verdict string", names=names, types=types)
