"""Scalar column expressions (all JVM-side built-ins, no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num: ColumnOrName, den: ColumnOrName) -> Column:
    """Division that yields NULL on a zero divisor (ANSI mode would raise)."""
    return F.try_divide(col(num), col(den))


def log_return(close: ColumnOrName, prev_close: ColumnOrName) -> Column:
    """``ln(close / prev)`` when ``prev > 0``; NULL otherwise and when the
    ratio is not positive (``ln`` of 0 is NULL)."""
    return F.when(col(prev_close) > 0, F.log(safe_div(close, prev_close)))


def ratio_or_zero(num: ColumnOrName, den: ColumnOrName) -> Column:
    """``num / den`` when ``den > 0``, else 0."""
    return F.when(col(den) > 0, col(num) / col(den)).otherwise(F.lit(0.0))


def zscore_or_zero(x: ColumnOrName, mean: ColumnOrName, std: ColumnOrName) -> Column:
    """``(x - mean) / std`` when ``std != 0``; 0 when std is 0 or NULL."""
    return F.when(col(std) != 0, (col(x) - col(mean)) / col(std)).otherwise(F.lit(0.0))


def flag(cond: Column) -> Column:
    """1 when ``cond`` is true, else 0 (NULL counts as false)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def count_where(cond: Column) -> Column:
    """Number of rows where ``cond`` is true; 0 on an empty input."""
    return F.coalesce(F.count_if(cond), F.lit(0).cast("bigint"))


def round_places(c: ColumnOrName, digits: int) -> Column:
    """Round a double to ``digits`` places as ``round(x * 10^d) / 10^d``, with
    half away from zero on the scaled value.  Every engine computes this
    formula the same way (for |x * 10^d| < 2^52), unlike ``round(x, d)``,
    which engines apply to the decimal text or to the binary value."""
    scale = F.lit(float(10 ** digits))
    return F.round(col(c) * scale, 0) / scale


def minute_floor(ts: ColumnOrName) -> Column:
    """Truncate a timestamp_ntz to the minute from its fields, with no time
    zone involved (a cast through a zoned timestamp would move wall-clock
    times inside a daylight-saving gap)."""
    t = col(ts)
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.minute(t), F.lit(0))


def parse_bar_time(text: ColumnOrName, fmt: str = "yyyyMMdd HH:mm:ss", strict: bool = True) -> Column:
    """Parse source text such as ``20080102 09:30:00`` into timestamp_ntz.
    Runs of blanks are collapsed first.  ``strict`` raises on a bad value
    (ANSI); otherwise a bad value gives NULL.  No time zone is involved."""
    cleaned = F.regexp_replace(F.trim(col(text)), r"\s+", " ")
    value = F.to_timestamp_ntz(cleaned, F.lit(fmt))
    if strict:
        return value
    # validity is checked at a fixed offset, so no daylight-saving gap applies
    ok = F.try_to_timestamp(F.concat(cleaned, F.lit(" +0000")), F.lit(fmt + " Z")).isNotNull()
    return F.when(ok, value)


def is_missing(c: ColumnOrName, dtype: str) -> Column:
    """NULL, or NaN in a floating column."""
    bad = col(c).isNull()
    return bad | F.isnan(col(c)) if dtype in ("double", "float") else bad


def cell_text(c: ColumnOrName, dtype: str, scale: int = 8, missing: str = "\\N") -> Column:
    """Engine-neutral text of a cell: doubles through ``decimal(38, scale)``, a missing
    value (NULL or NaN) as ``missing``."""
    text = decimal_text(c, scale) if dtype in ("double", "float") else col(c).cast("string")
    return F.when(is_missing(c, dtype), F.lit(missing)).otherwise(text)


def decimal_text(c: ColumnOrName, scale: int = 8) -> Column:
    """Engine-neutral text of a double: through ``decimal(38, scale)``; NULL beyond it."""
    return col(c).try_cast(f"decimal(38,{scale})").cast("string")


def hex_slice_value(hex_col: ColumnOrName, start: int, length: int = 15) -> Column:
    """Integer value of ``length`` hex digits (<= 15 fit a signed long)."""
    return F.conv(F.substring(col(hex_col), start, length), 16, 10).cast("decimal(38,0)")


def row_text(*cols: ColumnOrName, sep: str = "|") -> Column:
    """``a|b|c`` with SQL ``||`` semantics: NULL if any part is NULL."""
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(col(c).cast("string"))
    return F.concat(*parts)
