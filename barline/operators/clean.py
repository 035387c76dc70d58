"""Row hygiene: missing values, validity, deduplication, duplicate reports.

Deduplication is an aggregation, not a window: ``groupBy(keys, time)`` with
one ``min_by`` per column.  Partial aggregation runs before the shuffle, so a
key that holds a large share of all copies is collapsed on the map side and
never lands whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.functions import cell_text, hex_slice_value, is_missing
from barline.schemas import DEFAULT_SPEC, SeriesSpec


def normalise_columns(df: DataFrame) -> DataFrame:
    """Strip and lower every column name (source header normalisation)."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


def require_names(have: Sequence[str], names: Sequence[str]) -> None:
    missing = [n for n in names if n not in have]
    if missing:
        raise ValueError(f"source schema does not match: missing columns {missing}")


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    require_names(df.columns, names)
    return df


def drop_missing(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a missing value in any of ``cols`` (default: all).
    Floating NaN counts as missing, as in pandas."""
    cols = list(cols or df.columns)
    types = dict(df.dtypes)
    cond = None
    for c in cols:
        bad = is_missing(c, types[c])
        cond = bad if cond is None else cond | bad
    return df if cond is None else df.filter(~cond)


def with_trade_date(df: DataFrame, spec: SeriesSpec = DEFAULT_SPEC) -> DataFrame:
    return df.withColumn(spec.day, F.to_date(spec.time))


def valid_bars(df: DataFrame, spec: SeriesSpec = DEFAULT_SPEC) -> DataFrame:
    """Keep rows with a day and non-negative prices (NULL and NaN fail, 0 passes)."""
    types = dict(df.dtypes)
    cond = F.col(spec.day).isNotNull()
    for c in (spec.open, spec.high, spec.low, spec.close):
        cond = cond & (F.col(c) >= 0)
        if types[c] in ("double", "float"):
            cond = cond & ~F.isnan(c)  # NaN counts as larger than any number
    return df.filter(cond)


def _key_cols(spec: SeriesSpec) -> list[str]:
    return [*spec.keys, spec.time]


def duplicate_keys(df: DataFrame, spec: SeriesSpec = DEFAULT_SPEC, count_col: str = "n_rows") -> DataFrame:
    """Keys (series keys + timestamp) seen more than once, with their count."""
    return (df.groupBy(*_key_cols(spec)).agg(F.count(F.lit(1)).alias(count_col))
              .filter(F.col(count_col) > 1))


def top_duplicate_keys(df: DataFrame, spec: SeriesSpec = DEFAULT_SPEC, n: int = 20,
                       count_col: str = "n_rows") -> DataFrame:
    """The ``n`` most repeated keys, ties broken by key (a top-k report)."""
    return (duplicate_keys(df, spec, count_col)
            .orderBy(F.col(count_col).desc(), *[F.col(c).asc() for c in _key_cols(spec)])
            .limit(n))


#: Order values of rows without a tie-break start here (above any bigint).
_NO_ID = "10000000000000000000"


def survivor_order(df: DataFrame, tiebreak: Sequence[str] | None, values: Sequence[str]) -> Column:
    """One decimal that orders the copies of a key, so that ``min_by`` stays in a hash
    aggregation.  With one integer column: its value, rows where it is NULL last.  Otherwise, and
    among those rows: 60 bits of the MD5 of the tie-break columns (default: of all values).
    Copies that differ but share these bits are taken as equal; one of them stays whole."""
    types = dict(df.dtypes)
    one = tiebreak[0] if tiebreak and len(tiebreak) == 1 and types[tiebreak[0]] in ("bigint", "int", "smallint", "tinyint") else None
    cols = [c for c in values if c != one] if one or not tiebreak else tiebreak
    digest = F.md5(F.concat_ws("|", *[cell_text(c, types[c]) for c in cols]))
    by_value = hex_slice_value(digest, 1) + F.lit(_NO_ID).cast("decimal(20,0)")
    order = F.coalesce(F.col(one).cast("decimal(38,0)"), by_value) if one else by_value
    return order.cast("decimal(38,0)")


def deduplicate(df: DataFrame, spec: SeriesSpec = DEFAULT_SPEC,
                tiebreak: Sequence[str] | None = None, keep_count: str | None = None) -> DataFrame:
    """One row per ``(keys, time)``: the row that comes first by ``survivor_order`` of
    ``tiebreak`` (e.g. an event id).  ``keep_count`` adds the number of copies per key."""
    keys = _key_cols(spec)
    values = [c for c in df.columns if c not in keys]
    ordered = df.withColumn("_order", survivor_order(df, tiebreak, values))
    aggs = [F.min_by(c, "_order").alias(c) for c in values]
    if keep_count:
        aggs.append(F.count(F.lit(1)).alias(keep_count))
    return ordered.groupBy(*keys).agg(*aggs).select(*df.columns, *([keep_count] if keep_count else []))


def input_profile(df: DataFrame, spec: SeriesSpec = DEFAULT_SPEC) -> DataFrame:
    """Rows and date range of the deduplicated input, one row."""
    return df.agg(
        F.count(F.lit(1)).alias("input_rows"),
        F.min(spec.day).alias("min_date"),
        F.max(spec.day).alias("max_date"),
    )
