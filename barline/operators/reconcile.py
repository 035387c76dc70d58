"""What two tables of one key differ in, and how many keys a table has.

``differing_days`` compares the tables day by day by the digests of their keys, in one
aggregation of both (one row per day and task shuffled).  ``key_differences`` lists the keys
only of the days that differ: a table partitioned by day need not be read elsewhere.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.functions import cell_text, hex_slice_value, minute_floor
from barline.operators import clean, features
from barline.schemas import DEFAULT_SPEC, SeriesSpec

#: Where minutes are counted from, so that their numbers are positive.
EPOCH = "TIMESTAMP_NTZ'0001-01-01 00:00:00'"


def expected_keys(raw: DataFrame, spec: SeriesSpec = DEFAULT_SPEC) -> DataFrame:
    """Keys and day of the raw bars that have a feature row: one per key, valid, with a return.
    Copies of a key that differ in a price are resolved as ``analyze`` does (by their values)."""
    bars = clean.valid_bars(clean.with_trade_date(clean.deduplicate(raw, spec), spec), spec)
    return features.with_log_returns(bars, spec).select(*spec.group, spec.time)


def _signed(expected: DataFrame, found: DataFrame, spec: SeriesSpec) -> DataFrame:
    cols = [*spec.group, spec.time]
    return expected.select(*cols, F.lit(1).alias("_side")).unionByName(found.select(*cols, F.lit(-1).alias("_side")))


def differing_days(expected: DataFrame, found: DataFrame, spec: SeriesSpec = DEFAULT_SPEC) -> DataFrame:
    """Days on which the two tables do not hold the same keys as often.  Key hashes are added
    for one side and taken off for the other; a difference of digests shows as a rest."""
    types = dict(expected.dtypes)
    digest = F.md5(F.concat_ws("|", *[cell_text(c, types[c]) for c in (*spec.keys, spec.time)]))
    both = _signed(expected, found, spec).select(spec.day, "_side", digest.alias("_d"))
    rest = [F.sum(F.col("_side") * x) for x in (F.lit(1), hex_slice_value("_d", 1), hex_slice_value("_d", 16))]
    sums = both.groupBy(spec.day).agg(*[c.alias(f"_r{k}") for k, c in enumerate(rest)])
    return sums.filter("_r0 <> 0 OR _r1 <> 0 OR _r2 <> 0").select(spec.day)


def on_days(df: DataFrame, days: Sequence, spec: SeriesSpec = DEFAULT_SPEC) -> DataFrame:
    """Rows of the given days (NULL too); a table partitioned by day reads no other partition."""
    known = [d for d in days if d is not None]
    cond = F.col(spec.day).isin(known) if known else F.lit(False)
    return df.filter(cond | F.col(spec.day).isNull() if len(known) < len(days) else cond)


def key_differences(expected: DataFrame, found: DataFrame, spec: SeriesSpec = DEFAULT_SPEC, days: Sequence | None = None) -> DataFrame:
    """``(day, keys, time, finding, n)``: ``lost`` keys of ``expected`` and ``unexpected`` ones of ``found``,
    with the number of rows too few or too many.  ``days``: from ``differing_days``, as a list, so
    that other days are not read; without it they are left out by a join."""
    if days is None:
        differ = differing_days(expected, found, spec).withColumnRenamed(spec.day, "_day")
        both = _signed(expected, found, spec)
        both = both.join(differ, F.col(spec.day).eqNullSafe(F.col("_day")), "left_semi")
    else:
        both = _signed(on_days(expected, days, spec), on_days(found, days, spec), spec)
    rest = both.groupBy(*spec.group, spec.time).agg(F.sum("_side").alias("_rest")).filter("_rest <> 0")
    return rest.select(*spec.group, spec.time, F.when(F.col("_rest") > 0, "lost").otherwise("unexpected").alias("finding"), F.abs("_rest").alias("n"))


# ---- distinct keys by bitmaps ------------------------------------------------------------

def minute_number(time: Column | str) -> Column:
    return F.expr(f"timestampdiff(MINUTE, {EPOCH}, `{time}`)")


def minute_bitmaps(df: DataFrame, spec: SeriesSpec = DEFAULT_SPEC, by: Sequence[str] = ()) -> DataFrame:
    """``(*by, keys, bucket, bits)``: the minutes of each series as bitmaps of 32,768 minutes (some 23
    days) in 4 KB, for times on the minute.  States of several parts merge by ``bitmap_or_agg``.

    A task sends a bitmap for each series and bucket it holds instead of one row per key: less
    from some 500 bars on."""
    rows = df.filter(minute_floor(spec.time) == F.col(spec.time)).select(*by, *[c for c in spec.keys if c not in by], minute_number(spec.time).alias("_m"))
    return rows.groupBy(*by, *[c for c in spec.keys if c not in by], F.bitmap_bucket_number("_m").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_m")).alias("bits"))


def merged_bitmaps(states: DataFrame, spec: SeriesSpec = DEFAULT_SPEC) -> DataFrame:
    return states.groupBy(*spec.keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_keys(df: DataFrame, spec: SeriesSpec = DEFAULT_SPEC) -> DataFrame:
    """A3: one row ``distinct_keys``, exact: bits of the bitmaps, plus the distinct keys among rows off the
    minute.  A NULL time is no key, as in ``COUNT(DISTINCT)``."""
    on = merged_bitmaps(minute_bitmaps(df, spec), spec).select(F.bitmap_count("bits").alias("n"))
    off = df.filter(minute_floor(spec.time) != F.col(spec.time)).select(*spec.keys, spec.time).distinct().select(F.lit(1).cast("bigint").alias("n"))
    return on.unionByName(off).agg(F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("distinct_keys"))
