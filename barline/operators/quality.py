"""Data-quality rules, gaps, coverage and the table checksum (Q1-Q11).

Rules are data: ``Rule(name, predicate, level)``.  All rules of a set are counted in
one aggregation (partial + final, a single row out); the table rules (duplicate keys,
gaps) read the row before in the key-day, from one window pass of the same query.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.functions import cell_text, count_where, hex_slice_value
from barline.operators.clean import duplicate_keys
from barline.operators.features import before_second, with_second
from barline.schemas import DEFAULT_SPEC, SeriesSpec


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: str      # SQL predicate that marks a violating row; "" = table rule
    level: str          # "error" fails the run, "warn" logs, "info" is reported only


# Rule set of the analytics job (checked before the write).
JOB_RULES = (
    Rule("null_timestamp", "trade_timestamp IS NULL", "error"),
    Rule("negative_volatility", "volatility_30min < 0", "error"),
    Rule("null_crash_index", "crash_index IS NULL OR isnan(crash_index)", "error"),
    Rule("negative_volume_ratio", "volume_ratio < 0", "info"),
    Rule("extreme_zscore", "abs(volatility_zscore) > 10", "warn"),
    Rule("extreme_crash_index", "abs(crash_index) > 50", "warn"),
    Rule("severity_mismatch", "crash_alert_flag = 1 AND crash_severity = 'LOW'", "error"),
    Rule("invalid_drawdown", "drawdown > 0", "warn"),
    Rule("null_returns", "log_return IS NULL OR isnan(log_return)", "error"),
    Rule("null_momentum_5min", "momentum_5min IS NULL OR isnan(momentum_5min)", "info"),
    Rule("null_momentum_15min", "momentum_15min IS NULL OR isnan(momentum_15min)", "info"),
)

# Rule set of the verification step (checked on the written table).
VERIFY_RULES = (
    Rule("null_crash_index", "crash_index IS NULL OR isnan(crash_index)", "error"),
    Rule("alert_mismatch", "crash_alert_flag = 1 AND crash_severity = 'LOW'", "error"),
    Rule("positive_drawdown", "drawdown > 0", "error"),
    Rule("negative_volatility", "volatility_30min < 0", "error"),
    Rule("negative_volume_ratio", "volume_ratio < 0", "error"),
    Rule("duplicate_keys", "", "error"),
    Rule("gaps", "", "error"),
    Rule("extreme_zscore", "abs(volatility_zscore) > 10", "warn"),
    Rule("extreme_crash_index", "abs(crash_index) > 50", "warn"),
)

#: Counts of the verification record that must be 0.
VERIFY_ERRORS = tuple({"duplicate_keys": "duplicate_count", "gaps": "gap_count"}.get(r.name, r.name)
                      for r in VERIFY_RULES if r.level == "error")

# Fixed value: largest allowed step between consecutive bars of a day.
MAX_GAP = "1 minute"


def _counts(rules: Sequence[Rule]) -> list[Column]:
    return [count_where(F.expr(r.predicate)).alias(r.name) for r in rules if r.predicate]


def null_checks(df: DataFrame) -> DataFrame:
    """Q3: missing returns and momentum, one row."""
    return df.agg(*_counts([r for r in JOB_RULES if r.name.startswith(("null_returns", "null_momentum"))]))


def validation_summary(df: DataFrame) -> DataFrame:
    """Q4: the job's other eight counts in one pass."""
    return df.agg(*_counts([r for r in JOB_RULES if not r.name.startswith(("null_returns", "null_momentum"))]))


# ---- neighbours in time: gaps and duplicate keys in one window pass ------------------------

def with_previous(df: DataFrame, spec: SeriesSpec = DEFAULT_SPEC, split: bool = False) -> DataFrame:
    """One row per row of ``df``: keys, day, time, ``prev_timestamp`` (the row before in the
    key-day) and ``_copy`` (0 for the first row of a key, then 1, 2 ...).

    ``split`` looks up the row before within its second and, for the first row of a second,
    in the aggregate of the earlier seconds, so a large key-day is not sorted in one task."""
    rows = df.select(*spec.keys, spec.day, spec.time)
    if not split:
        w = spec.window()
        return rows.withColumns({"prev_timestamp": F.lag(spec.time).over(w),
                                 "_copy": F.row_number().over(w) - F.rank().over(w)})
    # copies collapse before the shuffle; their number stays
    rows = with_second(rows.groupBy(*spec.keys, spec.day, spec.time).agg(F.count(F.lit(1)).alias("_copies")), spec)
    sec = replace(spec, keys=(*spec.keys, "_sec")).window()
    rows = before_second(rows, spec, {"_last": F.max(spec.time)}, {"_earlier": "max(_last) OVER {w}"})
    prev = F.when(F.row_number().over(sec) == 1, F.col("_earlier")).otherwise(F.lag(spec.time).over(sec))
    rows = rows.select(*spec.keys, spec.day, spec.time, prev.alias("prev_timestamp"), "_copies")
    rows = rows.withColumn("_copy", F.explode(F.expr("sequence(0L, _copies - 1)")))
    return rows.withColumn("prev_timestamp", F.when(F.col("_copy") == 0, F.col("prev_timestamp"))
                           .otherwise(F.col(spec.time))).drop("_copies")


def _is_gap(spec: SeriesSpec, max_gap: str) -> Column:
    return (F.col(spec.time) - F.col("prev_timestamp")) > F.expr(f"INTERVAL '{max_gap}'")


def gap_rows(df: DataFrame, spec: SeriesSpec = DEFAULT_SPEC, max_gap: str = MAX_GAP, split: bool = False) -> DataFrame:
    """Q2: rows more than ``max_gap`` after the previous row of the same day."""
    return with_previous(df, spec, split).drop("_copy").filter(_is_gap(spec, max_gap))


def gap_count(df: DataFrame, spec: SeriesSpec = DEFAULT_SPEC, max_gap: str = MAX_GAP, split: bool = False) -> DataFrame:
    return gap_rows(df, spec, max_gap, split).agg(F.count(F.lit(1)).alias("gap_count"))


def duplicate_count(df: DataFrame, spec: SeriesSpec = DEFAULT_SPEC) -> DataFrame:
    return duplicate_keys(df, spec).agg(F.count(F.lit(1)).alias("duplicate_count"))


def _neighbour_counts(spec: SeriesSpec, max_gap: str = MAX_GAP) -> dict[str, Column]:
    """Table rules over ``with_previous``: a key with copies counts once, at its second row."""
    return {"duplicate_keys": count_where(F.col("_copy") == 1), "gaps": count_where(_is_gap(spec, max_gap)),
            "distinct_keys": count_where(F.col("_copy") == 0)}


def checked(df: DataFrame, aggregates: Sequence[Column], spec: SeriesSpec = DEFAULT_SPEC, split: bool = False) -> DataFrame:
    """One row: ``aggregates`` over ``df``, with ``duplicate_keys``, ``gaps`` and
    ``distinct_keys``, from one scan and one shuffle.  With ``split`` the neighbours come from a second scan that collapses
    copies and cuts the key-days."""
    if split:
        steps = with_previous(df, spec, True).agg(*[c.alias(n) for n, c in _neighbour_counts(spec).items()])
        out = df.agg(*aggregates).withColumn("_n", steps.select(F.struct("*")).scalar())
        return out.withColumns({n: F.col(f"_n.{n}") for n in _neighbour_counts(spec)}).drop("_n")
    w = spec.window()
    seen = df.withColumns({"prev_timestamp": F.lag(spec.time).over(w), "_copy": F.row_number().over(w) - F.rank().over(w)})
    return seen.agg(*aggregates, *[c.alias(n) for n, c in _neighbour_counts(spec).items()])


def rule_counts(df: DataFrame, rules: Sequence[Rule], spec: SeriesSpec = DEFAULT_SPEC, split: bool = False) -> DataFrame:
    """One row, one column per rule: number of violations."""
    if all(r.predicate for r in rules):
        return df.agg(*_counts(rules))
    return checked(df, _counts(rules), spec, split).select(*[r.name for r in rules])


def rule_violations(df: DataFrame, rules: Sequence[Rule], spec: SeriesSpec = DEFAULT_SPEC,
                    rule_set: str = "rules", split: bool = False) -> DataFrame:
    """Q5-Q7: ``(rule_set, rule, level, violations, failed)``, one row per rule;
    ``failed`` is true for an error-level rule with any violation."""
    counts = rule_counts(df, rules, spec, split)
    rows = F.array(*[
        F.struct(F.lit(rule_set).alias("rule_set"), F.lit(r.name).alias("rule"),
                 F.lit(r.level).alias("level"),
                 F.col(r.name).cast("bigint").alias("violations"),
                 ((F.lit(r.level) == "error") & (F.col(r.name) > 0)).alias("failed"))
        for r in rules])
    return counts.select(F.inline(rows))


def alert_counts() -> list[Column]:
    """The job's rules that need the alert columns."""
    return _counts([r for r in JOB_RULES if "crash_alert_flag" in r.predicate])


def _named(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({"duplicate_keys": "duplicate_count", "gaps": "gap_count"}).drop("distinct_keys")


def verification_row(df: DataFrame, spec: SeriesSpec = DEFAULT_SPEC, split: bool = False) -> DataFrame:
    """Date range, rule counts, duplicate and gap counts in one row."""
    return _named(checked(df, [F.min(spec.day).alias("min_date"), F.max(spec.day).alias("max_date"), *_counts(VERIFY_RULES)],
                          spec, split))


# ---- feature table against raw table -------------------------------------------------------

def raw_stats(raw: DataFrame, spec: SeriesSpec = DEFAULT_SPEC) -> DataFrame:
    """One row: distinct keys and first and last day of the raw table."""
    day = F.to_date(spec.time)
    return raw.agg(F.count_distinct(*[F.col(k) for k in (*spec.keys, spec.time)]).alias("raw_rows_distinct"),
                   F.min(day).alias("min_raw"), F.max(day).alias("max_raw"))


def feature_stats(spec: SeriesSpec = DEFAULT_SPEC) -> list[Column]:
    return [F.count(F.lit(1)).alias("analytics_rows"), F.min(spec.day).alias("min_analytics"),
            F.max(spec.day).alias("max_analytics")]


def against_raw(stats: DataFrame, raw: DataFrame, spec: SeriesSpec = DEFAULT_SPEC, min_ratio: float = 0.95) -> DataFrame:
    """Adds to the one row of ``stats`` (with ``feature_stats``) the raw statistics, as one
    scalar subquery, and the verdicts on coverage (Q9/J3: some rows, not more than distinct raw
    keys, ratio at least ``min_ratio``) and date range (Q10: same first and last day)."""
    r = raw_stats(raw, spec)
    out = stats.withColumn("_raw", r.select(F.struct(*r.columns)).scalar())
    out = out.withColumns({c: F.col(f"_raw.{c}") for c in r.columns}).drop("_raw")
    return out.withColumns({
        "coverage_ratio": F.expr("IF(raw_rows_distinct > 0, analytics_rows / raw_rows_distinct, 0.0D)"),
    }).withColumns({
        "coverage_ok": F.expr(f"analytics_rows > 0 AND analytics_rows <= raw_rows_distinct AND coverage_ratio >= {min_ratio}D"),
        "date_range_ok": F.expr("coalesce(min_raw = min_analytics AND max_raw = max_analytics, false)"),
    })


def row_coverage(raw: DataFrame, features: DataFrame, spec: SeriesSpec = DEFAULT_SPEC, min_ratio: float = 0.95) -> DataFrame:
    """Q9/J3 alone."""
    return against_raw(features.agg(*feature_stats(spec)), raw, spec, min_ratio).select(
        "raw_rows_distinct", "analytics_rows", "coverage_ratio", "coverage_ok")


def date_range_match(raw: DataFrame, features: DataFrame, spec: SeriesSpec = DEFAULT_SPEC) -> DataFrame:
    """Q10 alone."""
    return against_raw(features.agg(*feature_stats(spec)), raw, spec).select(
        "min_raw", "max_raw", "min_analytics", "max_analytics", "date_range_ok")


def latest_rows(df: DataFrame, spec: SeriesSpec = DEFAULT_SPEC, n: int = 10,
                cols: Sequence[str] = ("close_price", "crash_index", "crash_alert_flag", "crash_severity")) -> DataFrame:
    """Q11: the ``n`` most recent rows (a top-k read, not a scan of everything)."""
    return df.select(*spec.keys, spec.time, *cols).orderBy(
        F.col(spec.time).desc(), *[F.col(k).asc() for k in spec.keys]).limit(n)


# Fixed values of the checksum row format: columns joined by "|".
CHECKSUM_COLS = ("close_price", "crash_index", "crash_alert_flag")
CHECKSUM_SCALE = 8


def checksum_text(df: DataFrame, spec: SeriesSpec = DEFAULT_SPEC, cols: Sequence[str] = CHECKSUM_COLS) -> Column:
    """``keys|timestamp|close|index|flag`` with doubles through decimal(38,8) and missing
    parts (NULL, NaN) marked, so every row takes part."""
    types = dict(df.dtypes)
    return F.concat_ws("|", *[cell_text(c, types[c], CHECKSUM_SCALE) for c in (*spec.keys, spec.time, *cols)])


def _digest_aggs(text: Column) -> list[Column]:
    d = F.md5(text)
    return [F.count(text).alias("n_rows"),
            F.coalesce(F.sum(hex_slice_value(d, 1)), F.lit(0).cast("decimal(38,0)")).alias("_s1"),
            F.coalesce(F.sum(hex_slice_value(d, 16)), F.lit(0).cast("decimal(38,0)")).alias("_s2")]


def _digest() -> Column:
    text = F.concat_ws("|", F.col("n_rows").cast("string"), F.col("_s1").cast("string"),
                       F.col("_s2").cast("string"))
    return F.md5(text)


def day_digests(df: DataFrame, spec: SeriesSpec = DEFAULT_SPEC, cols: Sequence[str] = CHECKSUM_COLS) -> DataFrame:
    """Digest per ``(day, keys)``, same scheme as ``table_checksum``."""
    agg = df.groupBy(*spec.group).agg(*_digest_aggs(checksum_text(df, spec, cols)))
    return agg.select(*spec.group, "n_rows", _digest().alias("digest"))


def table_checksum(df: DataFrame, spec: SeriesSpec = DEFAULT_SPEC, cols: Sequence[str] = CHECKSUM_COLS) -> DataFrame:
    """Q8: table checksum that scales to any table and any group size.

    Every row text carries its own key and timestamp, so the table content
    fixes the time order and the checksum can be order-free: MD5 of the row
    count and of two summed 60-bit slices of the per-row MD5s.  The sums are
    associative (partial aggregation on every executor, one row shuffled per
    task), nothing is collected, and the result does not depend on partitioning
    or input order.  It changes with every row and with every checked cell that
    differs within the eight places kept; a missing cell counts as such.
    """
    agg = df.agg(*_digest_aggs(checksum_text(df, spec, cols)))
    return agg.select("n_rows", _digest().alias("checksum"))


def verification_record(raw: DataFrame, features: DataFrame, spec: SeriesSpec = DEFAULT_SPEC,
                        min_ratio: float = 0.95, split: bool = False) -> DataFrame:
    """Everything the verification step checks, as ONE row: coverage, date ranges, the rules of
    ``VERIFY_RULES`` and the checksum, from one scan and one shuffle of the feature table
    and one pass over the raw one."""
    stats = checked(features, [*feature_stats(spec), *_counts(VERIFY_RULES), *_digest_aggs(checksum_text(features, spec))],
                    spec, split)
    return _named(against_raw(stats, raw, spec, min_ratio).withColumn("checksum", _digest())).drop("_s1", "_s2")
