"""Per-day rolling features over an ordered series.

All windows share one partitioning ``(day, *keys)`` and one order (time), so
the whole chain plans as one Exchange, one Sort and three Window nodes (lag,
level 1, level 2).  Frames are ROWS frames: "15min" means 15 rows.  Each
``(keys, day)`` group holds at most one day of bars, so window state per group
is bounded whatever the table size.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barline.functions import log_return, ratio_or_zero, safe_div, zscore_or_zero
from barline.schemas import DEFAULT_SPEC, SeriesSpec

_AGGS = {"avg": "avg", "stddev": "stddev_samp", "sum": "sum", "max": "max", "min": "min"}


@dataclass(frozen=True)
class Rolling:
    """``agg(source)`` over the trailing ``rows`` rows of the day (None = day to date)."""

    name: str
    agg: str
    source: str          # SQL expression over the frame's columns
    rows: int | None

    def column(self, spec: SeriesSpec) -> Column:
        frame = spec.rows_sql(None if self.rows is None else self.rows - 1)
        return F.expr(f"{_AGGS[self.agg]}({self.source}) OVER {frame}")


def level1(spec: SeriesSpec = DEFAULT_SPEC) -> list[Rolling]:
    """First-level windows.  Frame sizes are fixed values of the feature set."""
    c, v, h, lo = spec.close, spec.volume, spec.high, spec.low
    return [
        Rolling("momentum_5min", "avg", "log_return", 5),
        Rolling("momentum_15min", "avg", "log_return", 15),
        Rolling("volatility_15min", "stddev", "log_return", 15),
        Rolling("volatility_30min", "stddev", "log_return", 30),
        Rolling("volatility_60min", "stddev", "log_return", 60),
        Rolling("avg_volume_30min", "avg", v, 30),
        Rolling("_pv_15", "sum", f"{c} * {v}", 15),
        Rolling("_v_15", "sum", v, 15),
        Rolling("_pv_30", "sum", f"{c} * {v}", 30),
        Rolling("_v_30", "sum", v, 30),
        Rolling("avg_range_15min", "avg", f"{h} - {lo}", 15),
        Rolling("rolling_peak", "max", c, None),
    ]


def level2() -> list[Rolling]:
    """Windows over level-1 outputs."""
    return [
        Rolling("volatility_mean_60", "avg", "volatility_30min", 60),
        Rolling("volatility_std_60", "stddev", "volatility_30min", 60),
    ]


def with_rolling(df: DataFrame, rollings: Sequence[Rolling], spec: SeriesSpec = DEFAULT_SPEC) -> DataFrame:
    return df.withColumns({r.name: r.column(spec) for r in rollings})


def with_log_returns(df: DataFrame, spec: SeriesSpec = DEFAULT_SPEC, drop_undefined: bool = True) -> DataFrame:
    """Previous close of the day, log return, and (by default) removal
    of rows without a return -- before any rolling window sees them."""
    prev = F.lag(spec.close, 1).over(spec.window())
    out = df.withColumn("log_return", log_return(spec.close, prev))
    return out.filter(F.col("log_return").isNotNull()) if drop_undefined else out


def derived(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Row-local features over the window outputs."""
    df = df.withColumns({
        "volume_ratio": ratio_or_zero(spec.volume, "avg_volume_30min"),
        "vwap_15min": safe_div("_pv_15", "_v_15"),
        "vwap_30min": safe_div("_pv_30", "_v_30"),
        "volatility_zscore": zscore_or_zero("volatility_30min", "volatility_mean_60", "volatility_std_60"),
        "drawdown": safe_div(F.col(spec.close) - F.col("rolling_peak"), "rolling_peak"),
    })
    return df.drop("_pv_15", "_v_15", "_pv_30", "_v_30")


def with_features(bars: DataFrame, spec: SeriesSpec = DEFAULT_SPEC, split_rows: int | None = None) -> DataFrame:
    """Valid, deduplicated bars with ``trade_date`` -> all rolling features.

    ``split_rows`` asks for the split evaluation (``with_features_split``), for tables
    whose key-days are too large for one task (tick data); the result is the same.
    """
    if split_rows:
        return with_features_split(bars, spec, split_rows)
    df = with_log_returns(bars, spec)
    df = with_rolling(df, level1(spec), spec)
    df = with_rolling(df, level2(), spec)
    return derived(df, spec)


# ---- split evaluation for very large key-days ---------------------------------------

# Rows of overlap a chunk needs from the one before: the level-2 frame (60 rows)
# over level-1 frames (30 rows) reaches 88 rows back; two rows of margin.
SPLIT_HALO = 90


def with_second(df: DataFrame, spec: SeriesSpec = DEFAULT_SPEC) -> DataFrame:
    """Adds ``_sec``, the second of the day.  One second of a series holds at most one
    million different times (microsecond resolution), and a day 86,400 seconds."""
    t = F.col(spec.time)
    return df.withColumn("_sec", F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t))


def before_second(df: DataFrame, spec: SeriesSpec, here: dict[str, Column], carried: dict[str, str]) -> DataFrame:
    """Joins to every row of ``df`` (with ``_sec``) what its key-day held in the earlier seconds.
    ``here``: aggregates per second; ``carried``: SQL over them, evaluated over all earlier
    seconds in order (``{w}`` stands for that window).  NULL keys match each other."""
    group = [*spec.group, "_sec"]
    part = ", ".join(f"`{c}`" for c in spec.group)
    w = f"(PARTITION BY {part} ORDER BY _sec ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    seconds = df.groupBy(*group).agg(*[c.alias(n) for n, c in here.items()])
    seconds = seconds.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(group)],
                             *[F.expr(sql.format(w=w)).alias(n) for n, sql in carried.items()])
    on = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(group)]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return df.join(seconds, cond).drop(*[f"_k{i}" for i in range(len(group))])


def chunked(df: DataFrame, size: int, halo: int) -> DataFrame:
    """Rows with ``_pos`` (from 1) -> chunk id per ``size`` positions; the last ``halo`` rows of
    each chunk also stand in the next one, flagged ``_halo``."""
    if halo > size:
        raise ValueError("split_rows must be at least the overlap of the windows")
    tail = f"(_pos - 1) % {size} >= {size - halo}"
    own = f"CAST((_pos - 1) DIV {size} AS bigint)"
    both = F.expr(f"IF({tail}, array({own}, {own} + 1), array({own}))")
    return df.select("*", F.posexplode(both).alias("_copy", "_chunk")).withColumn("_halo", F.col("_copy") == 1).drop("_copy")


def with_features_split(bars: DataFrame, spec: SeriesSpec = DEFAULT_SPEC, split_rows: int = 1_000_000) -> DataFrame:
    """The same features with each key-day cut into chunks of ``split_rows`` rows, so no
    task holds more than one chunk plus its overlap, whatever the size of a key-day (the
    plain evaluation sorts a key-day in one task).  Every frame sees the same rows in the
    same order as there, NULL keys included.

    What reaches over chunks comes from aggregates per second: the last close before the
    second (lag), the rows before it (positions) and the highest close before it (peak)."""
    sec = replace(spec, keys=(*spec.keys, "_sec"))
    # lag: the row before in the same second, else the last close of the earlier seconds
    df = before_second(with_second(bars, spec), spec, {"_last": F.max_by(spec.close, spec.time)},
                       {"_earlier": "last(_last) OVER {w}"})
    first = F.row_number().over(sec.window()) == 1
    prev = F.when(first, F.col("_earlier")).otherwise(F.lag(spec.close, 1).over(sec.window()))
    df = (df.withColumn("log_return", log_return(spec.close, prev)).filter(F.col("log_return").isNotNull()).drop("_earlier"))
    # positions and running peak of the rows that have a return
    df = before_second(df, spec, {"_n": F.count(F.lit(1)), "_top": F.max(spec.close)},
                       {"_before": "coalesce(sum(_n) OVER {w}, 0L)", "_peak": "max(_top) OVER {w}"})
    in_second = F.max(spec.close).over(sec.window().rowsBetween(Window.unboundedPreceding, 0))
    df = df.withColumns({"_pos": F.col("_before") + F.row_number().over(sec.window()),
                         "rolling_peak": F.greatest("_peak", in_second)}).drop("_before", "_peak", "_sec")
    # rolling windows: SPLIT_HALO rows of overlap
    cs = replace(spec, keys=(*spec.keys, "_chunk"))
    out = chunked(df, split_rows, SPLIT_HALO)
    out = with_rolling(out, [x for x in level1(spec) if x.rows is not None], cs)
    out = with_rolling(out, level2(), cs).filter(~F.col("_halo")).drop("_pos", "_chunk", "_halo")
    return derived(out, spec)
