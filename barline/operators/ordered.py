"""Order-sensitive digests that combine.

A sequence of rows with hashes ``h_0 .. h_(n-1)`` has the digest ``sum(h_i * B^i) mod p``, in four
lanes (prime and base) over the four quarters of each row's MD5.  Swapping two different rows
changes it, and so does the place of any row.  Parts of a sequence combine by their lengths:
``H(xy) = H(x) + B^len(x) * H(y)``.  So every group of rows is summed wherever it lies
(partial aggregation, one row per group and task shuffled), the few group rows are put in
order, and no task ever holds the table's text, unlike one string over all rows.

The digest of a table is that of its rows in the order ``(day, keys, time, row hash)``; it does not
depend on files, partitions or splits, and the digests of unchanged days can be kept and
combined with those of changed ones.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from functools import cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barline.functions import cell_text
from barline.operators.features import before_second, with_second
from barline.schemas import DEFAULT_SPEC, SeriesSpec

# The largest four primes below 2^31 (products fit a signed long) and a base for each.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
BASES = (1000003, 998244353, 1234567891, 1597334677)
LANES = range(len(PRIMES))
#: Positions up to 256 ** 5 are enough for 10^12 rows.
BYTES = 5


@cache
def _powers(lane: int, inverse: bool, byte: int) -> str:
    p = PRIMES[lane]
    b = pow(BASES[lane], -1, p) if inverse else BASES[lane]
    return "array(" + ", ".join(f"{pow(b, d << (8 * byte), p)}L" for d in range(256)) + ")"


def power(lane: int, exponent: str, inverse: bool = False) -> str:
    """SQL of ``B^exponent mod p`` (or of its inverse): one table look-up per byte of the exponent."""
    out = ""
    for byte in range(BYTES):
        factor = f"{_powers(lane, inverse, byte)}[CAST(shiftright({exponent}, {8 * byte}) & 255L AS INT)]"
        out = f"({out} * {factor}) % {PRIMES[lane]}L" if out else factor
    return out


def _hash(lane: int, md5: str) -> str:
    """A quarter of a row's MD5; never 0, so that a row always counts."""
    return f"(CAST(conv(substring({md5}, {8 * lane + 1}, 8), 16, 10) AS BIGINT) % {PRIMES[lane] - 1}L + 1L)"


def _sums(terms: Sequence[str]) -> list[Column]:
    return [F.expr(f"coalesce(sum({t}), 0L) % {PRIMES[k]}L").alias(f"h{k}") for k, t in enumerate(terms)]


def part_digests(df: DataFrame, md5: str, position: str, by: Sequence[str]) -> DataFrame:
    """``(*by, n_rows, h0 .. h3)``: digest of each group, from each row's hash and place (from 0)."""
    terms = [f"({_hash(k, md5)} * {power(k, position)}) % {PRIMES[k]}L" for k in LANES]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), *_sums(terms))


def combine(parts: DataFrame, order: Sequence[str], by: Sequence[str] = (), also: Sequence[Column] = ()) -> DataFrame:
    """``(*by, n_rows, h0 .. h3)`` of the parts of each ``by``, one after the other in ``order``; ``also``:
    further aggregates over the parts."""
    before = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = parts.withColumn("_at", F.coalesce(F.sum("n_rows").over(before), F.lit(0).cast("bigint")))
    terms = [f"(h{k} * {power(k, '_at')}) % {PRIMES[k]}L" for k in LANES]
    return placed.groupBy(*by).agg(F.coalesce(F.sum("n_rows"), F.lit(0).cast("bigint")).alias("n_rows"), *_sums(terms), *also)


def digest_text() -> Column:
    return F.concat_ws("|", *[F.col(c).cast("string") for c in ("n_rows", *[f"h{k}" for k in LANES])])


def row_md5(df: DataFrame, spec: SeriesSpec, cols: Sequence[str]) -> Column:
    types = dict(df.dtypes)
    return F.md5(F.concat_ws("|", *[cell_text(c, types[c]) for c in (*spec.keys, spec.time, *cols)]))


def day_parts(df: DataFrame, spec: SeriesSpec = DEFAULT_SPEC, cols: Sequence[str] = (), split: bool = False) -> DataFrame:
    """Digest of each ``(day, keys)`` over its rows in order of time (ties by row hash; NULL first).
    ``split`` finds the places from row counts per second, so a large key-day is not sorted in one task."""
    rows = df.select(*spec.group, spec.time, row_md5(df, spec, cols).alias("_md5"))
    if split:
        rows = before_second(with_second(rows, spec), spec, {"_n": F.count(F.lit(1))}, {"_before": "coalesce(sum(_n) OVER {w}, 0L)"})
        w = Window.partitionBy(*spec.group, "_sec").orderBy(spec.time, "_md5")
        at = F.col("_before") + F.row_number().over(w) - 1
    else:
        at = F.row_number().over(Window.partitionBy(*spec.group).orderBy(spec.time, "_md5")).cast("bigint") - 1
    return part_digests(rows.withColumn("_at", at), "_md5", "_at", spec.group)


def combined_checksum(parts: DataFrame, spec: SeriesSpec = DEFAULT_SPEC) -> DataFrame:
    """``n_rows, checksum`` of a whole table from the digests of its key-days (kept or new)."""
    days = combine(parts, list(spec.keys), [spec.day]) if spec.keys else parts
    return combine(days, [spec.day]).select("n_rows", F.md5(digest_text()).alias("checksum"))


def ordered_checksum(df: DataFrame, spec: SeriesSpec = DEFAULT_SPEC, cols: Sequence[str] = ("close_price", "crash_index", "crash_alert_flag"),
                     split: bool = False) -> DataFrame:
    """Q8: one row ``n_rows, checksum`` of the table in its order."""
    return combined_checksum(day_parts(df, spec, cols, split), spec)


def file_digests(lines: DataFrame, also: dict[str, tuple[Column, Column]] | None = None) -> DataFrame:
    """``path, lines, digest`` of files read as text: the digest of the file's lines in their order and of
    its length, whatever the file size and the read splits.  ``also``: further aggregates over each file's lines, each with the one that unites its splits.

    ``lines``: ``value`` and ``_metadata`` of a text scan, as read.  Every split is summed with the places
    of its rows in the task; the first of these places is taken out of the power again, and the
    splits of a file combine by their start."""
    also = also or {}
    rows = lines.select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("_size"),
                        F.col("_metadata.file_block_start").alias("_start"), F.md5(F.col("value").cast("binary")).alias("_md5"),
                        F.expr("monotonically_increasing_id() & 8589934591L").alias("_row"))
    terms = [f"({_hash(k, '_md5')} * {power(k, '_row')}) % {PRIMES[k]}L" for k in LANES]
    splits = rows.groupBy("path", "_size", "_start").agg(F.count(F.lit(1)).alias("n_rows"), F.min("_row").alias("_first"), *_sums(terms),
                                                         *[c.alias(n) for n, (c, _) in also.items()])
    splits = splits.withColumns({f"h{k}": F.expr(f"(h{k} * {power(k, '_first', inverse=True)}) % {PRIMES[k]}L") for k in LANES})
    whole = combine(splits, ["_start"], ["path", "_size"], [c.alias(n) for n, (_, c) in also.items()])
    digest = F.sha2(F.concat_ws("|", F.col("_size").cast("string"), digest_text()), 256)
    return whole.select("path", F.col("n_rows").alias("lines"), digest.alias("digest"), *also)
