"""DuckDB SQL for every catalog query: plain window/aggregate SQL over the
pre-registered ``events`` view, sharing no code or constant with the Spark side.

The shared CTE chain below mirrors the stages: adapter -> dedup -> valid ->
returns -> level-1 windows -> level-2 windows -> scores -> sweep -> final.
Brute force where that is simplest (the sweep cross-joins the ten
thresholds with the rows).
"""

from __future__ import annotations

D = 6  # rounding of float outputs, as in the catalog

# The threshold grid and the two rule sets (rule, level, violating rows).
_GRID = "(0.5), (1.0), (1.5), (2.0), (2.5), (3.0), (3.5), (4.0), (4.5), (5.0)"
_JOB_RULES = [
    ("null_timestamp", "error", "trade_timestamp IS NULL"),
    ("negative_volatility", "error", "volatility_30min < 0"),
    ("null_crash_index", "error", "crash_index IS NULL OR isnan(crash_index)"),
    ("negative_volume_ratio", "info", "volume_ratio < 0"),
    ("extreme_zscore", "warn", "abs(volatility_zscore) > 10"),
    ("extreme_crash_index", "warn", "abs(crash_index) > 50"),
    ("severity_mismatch", "error", "crash_alert_flag = 1 AND crash_severity = 'LOW'"),
    ("invalid_drawdown", "warn", "drawdown > 0"),
    ("null_returns", "error", "log_return IS NULL OR isnan(log_return)"),
    ("null_momentum_5min", "info", "momentum_5min IS NULL OR isnan(momentum_5min)"),
    ("null_momentum_15min", "info", "momentum_15min IS NULL OR isnan(momentum_15min)"),
]
_VERIFY_RULES = [
    ("null_crash_index", "error", "crash_index IS NULL OR isnan(crash_index)"),
    ("alert_mismatch", "error", "crash_alert_flag = 1 AND crash_severity = 'LOW'"),
    ("positive_drawdown", "error", "drawdown > 0"),
    ("negative_volatility", "error", "volatility_30min < 0"),
    ("negative_volume_ratio", "error", "volume_ratio < 0"),
    ("duplicate_keys", "error", None),
    ("gaps", "error", None),
    ("extreme_zscore", "warn", "abs(volatility_zscore) > 10"),
    ("extreme_crash_index", "warn", "abs(crash_index) > 50"),
]


def _round(expr: str, d: int) -> str:
    """``round(x * 10^d) / 10^d``: the same formula the Spark side uses."""
    scale = f"CAST({10 ** d} AS DOUBLE)"
    return f"(round(({expr}) * {scale}) / {scale})"


def _w(rows: int | None, keys: tuple[str, ...] = ()) -> str:
    start = "UNBOUNDED PRECEDING" if rows is None else f"{rows - 1} PRECEDING"
    part = ", ".join(("trade_date", *keys))
    return f"(PARTITION BY {part} ORDER BY trade_timestamp ROWS BETWEEN {start} AND CURRENT ROW)"


def base_sql(keys: tuple[str, ...] = ()) -> str:
    """The CTE chain; ``keys`` are event columns that identify a series."""
    ks = "".join(f", {k}" for k in keys)                 # ", k1, k2" after a column list
    kp = "".join(f"{k}, " for k in keys)                 # "k1, k2, " before a column
    sk = "".join(f", s.{k}" for k in keys)
    on = "".join(f" AND s.{k} = b.{k}" for k in keys)
    day = "trade_date" + ks
    return f"""
ev AS (
  SELECT event_id, ts, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k{ks}
  FROM (SELECT *, CASE WHEN user_id % 7 = 0 THEN NULL ELSE event_type END AS series FROM events) e
),
bars_raw AS (
  SELECT event_id{ks}, trade_timestamp, open_price,
         greatest(open_price, close_price) + (k % 3) * CAST(0.01 AS DOUBLE) AS high_price,
         least(open_price, close_price) - (k % 3) * CAST(0.01 AS DOUBLE) AS low_price,
         close_price, k AS volume, CAST(event_id % 100 AS INTEGER) AS bar_count,
         (open_price + close_price) / 2 AS average_price
  FROM (SELECT event_id, CAST(date_trunc('minute', ts) AS TIMESTAMP) AS trade_timestamp,
               value - (k % 5) * CAST(0.01 AS DOUBLE) AS open_price, value AS close_price, k{ks}
        FROM ev) s
),
bars AS (
  SELECT {kp}trade_timestamp, open_price, high_price, low_price, close_price, volume, bar_count,
         average_price, CAST(trade_timestamp AS DATE) AS trade_date
  FROM bars_raw
  QUALIFY row_number() OVER (PARTITION BY {kp}trade_timestamp ORDER BY event_id) = 1
),
valid AS (
  SELECT * FROM bars
  WHERE trade_date IS NOT NULL AND open_price >= 0 AND high_price >= 0
    AND low_price >= 0 AND close_price >= 0
),
lagged AS (
  SELECT *, lag(close_price) OVER (PARTITION BY {day} ORDER BY trade_timestamp) AS prev_close
  FROM valid
),
ret AS (
  SELECT * EXCLUDE (prev_close),
         CASE WHEN prev_close > 0 AND close_price / prev_close > 0
              THEN ln(close_price / prev_close) END AS log_return
  FROM lagged
),
r AS (SELECT * FROM ret WHERE log_return IS NOT NULL),
l1 AS (
  SELECT *,
    avg(log_return) OVER w5 AS momentum_5min,
    avg(log_return) OVER w15 AS momentum_15min,
    stddev_samp(log_return) OVER w15 AS volatility_15min,
    stddev_samp(log_return) OVER w30 AS volatility_30min,
    stddev_samp(log_return) OVER w60 AS volatility_60min,
    avg(volume) OVER w30 AS avg_volume_30min,
    -- frame sums taken in frame order (list_sum), as Spark evaluates sliding frames
    list_sum(list(close_price * volume) OVER w15) / NULLIF(sum(volume) OVER w15, 0) AS vwap_15min,
    list_sum(list(close_price * volume) OVER w30) / NULLIF(sum(volume) OVER w30, 0) AS vwap_30min,
    avg(high_price - low_price) OVER w15 AS avg_range_15min,
    max(close_price) OVER wc AS rolling_peak
  FROM r
  WINDOW w5 AS {_w(5, keys)}, w15 AS {_w(15, keys)}, w30 AS {_w(30, keys)}, w60 AS {_w(60, keys)},
         wc AS {_w(None, keys)}
),
l2 AS (
  SELECT *,
    avg(volatility_30min) OVER w60 AS volatility_mean_60,
    stddev_samp(volatility_30min) OVER w60 AS volatility_std_60
  FROM l1
  WINDOW w60 AS {_w(60, keys)}
),
d1 AS (
  SELECT *,
    CASE WHEN avg_volume_30min > 0 THEN volume / avg_volume_30min ELSE 0.0 END AS volume_ratio,
    CASE WHEN volatility_std_60 <> 0
         THEN (volatility_30min - volatility_mean_60) / volatility_std_60 ELSE 0.0 END AS volatility_zscore,
    (close_price - rolling_peak) / rolling_peak AS drawdown,
    volatility_30min * 1.65 AS var_95_proxy
  FROM l2
),
scored AS (
  SELECT *,
    0.35 * volatility_zscore + 0.25 * volume_ratio + 0.25 * abs(drawdown) + 0.15 * abs(log_return)
      AS crash_index,
    CASE WHEN drawdown < -0.03 THEN 1 ELSE 0 END AS true_crash
  FROM d1
),
grid AS (SELECT CAST(t AS DOUBLE) AS threshold FROM (VALUES {_GRID}) g(t)),
sweep AS (
  SELECT g.threshold,
    CAST(count(*) FILTER (WHERE s.crash_index > g.threshold AND s.true_crash = 1) AS BIGINT) AS tp,
    CAST(count(*) FILTER (WHERE s.crash_index > g.threshold AND s.true_crash <> 1) AS BIGINT) AS fp,
    CAST(count(*) FILTER (WHERE coalesce(s.crash_index > g.threshold, false) = false
                           AND s.true_crash = 1) AS BIGINT) AS fn
  FROM grid g CROSS JOIN scored s
  GROUP BY g.threshold
),
sc AS (
  SELECT *,
    CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
    CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall
  FROM sweep
),
f1s AS (
  SELECT *, CASE WHEN precision + recall > 0
                 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1
  FROM sc
),
best AS (SELECT * FROM f1s ORDER BY f1 DESC, threshold ASC LIMIT 1),
final AS (
  SELECT s.*,
    CASE WHEN s.crash_index > b.threshold THEN 1 ELSE 0 END AS crash_alert_flag,
    CASE WHEN s.crash_index <= b.threshold THEN 'LOW'
         WHEN s.crash_index <= 1.5 * b.threshold THEN 'MEDIUM'
         WHEN s.crash_index <= 2.0 * b.threshold THEN 'HIGH'
         ELSE 'CRITICAL' END AS crash_severity
  FROM scored s, (SELECT threshold FROM best) b
),
gaps AS (
  SELECT {kp}trade_date, trade_timestamp, prev_timestamp FROM (
    SELECT {kp}trade_date, trade_timestamp,
           lag(trade_timestamp) OVER (PARTITION BY {day} ORDER BY trade_timestamp) AS prev_timestamp
    FROM final) t
  WHERE prev_timestamp IS NOT NULL AND trade_timestamp - prev_timestamp > INTERVAL '1 minute'
),
dups AS (
  SELECT {kp}trade_timestamp FROM final GROUP BY {kp}trade_timestamp HAVING count(*) > 1
),
day_grid AS (
  SELECT s.trade_date{sk}, g.threshold,
    CAST(count(*) FILTER (WHERE s.crash_index > g.threshold AND s.true_crash = 1) AS BIGINT) AS tp,
    CAST(count(*) FILTER (WHERE s.crash_index > g.threshold AND s.true_crash <> 1) AS BIGINT) AS fp,
    CAST(count(*) FILTER (WHERE coalesce(s.crash_index > g.threshold, false) = false
                           AND s.true_crash = 1) AS BIGINT) AS fn
  FROM grid g CROSS JOIN scored s
  GROUP BY s.trade_date{sk}, g.threshold
),
day_best AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY {day} ORDER BY f1 DESC, threshold ASC) AS rn
    FROM (SELECT *, CASE WHEN p + rc > 0 THEN 2 * p * rc / (p + rc) ELSE 0.0 END AS f1
          FROM (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS p,
                          CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS rc
                FROM day_grid) a) b) c
  WHERE rn = 1
),
daily AS (
  SELECT s.trade_date{sk}, s.analytics_rows,
    {_round('b.threshold', 4)} AS optimal_threshold,
    {_round('(b.tp + b.fp) / s.analytics_rows', 4)} AS alert_rate,
    {_round('s.m', 4)} AS crash_index_mean,
    {_round('s.sd', 4)} AS crash_index_std
  FROM (SELECT {day}, avg(crash_index) AS m, stddev_samp(crash_index) AS sd,
               count(*) AS analytics_rows FROM scored GROUP BY {day}) s
  JOIN day_best b ON s.trade_date = b.trade_date{on}
)
"""


BASE = base_sql()


def _q(select: str, keys: tuple[str, ...] = ()) -> str:
    return "WITH " + (BASE if not keys else base_sql(keys)).strip() + "\n" + select.strip()


def _rd(c: str, d: int = D) -> str:
    return f"{_round(c, d)} + 0.0 AS {c}"


def _feature(*cols: str) -> str:
    return _q(f"SELECT trade_timestamp, {', '.join(_rd(c) for c in cols)} FROM final")


def _count_if(pred: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {pred}) AS BIGINT)"


def _gaps_and_dups(table: str) -> tuple[str, str]:
    """Numbers of gaps and of repeated keys of a table, as scalar queries."""
    gaps = f"""(SELECT count(*) FROM (SELECT trade_timestamp, lag(trade_timestamp) OVER
               (PARTITION BY trade_date ORDER BY trade_timestamp NULLS FIRST) AS p FROM {table}) t
               WHERE trade_timestamp - p > INTERVAL '1 minute')"""
    dups = f"(SELECT count(*) FROM (SELECT 1 FROM {table} GROUP BY trade_date, trade_timestamp HAVING count(*) > 1) t)"
    return gaps, dups


def _rules_sql(rules, rule_set: str, table: str = "final") -> str:
    gaps, dups = _gaps_and_dups(table)
    parts = []
    for name, level, predicate in rules:
        v = f"(SELECT {_count_if(predicate)} FROM {table})" if predicate else dups if name == "duplicate_keys" else gaps
        parts.append(
            f"SELECT '{rule_set}' AS rule_set, '{name}' AS rule, '{level}' AS level, "
            f"CAST({v} AS BIGINT) AS violations, ('{level}' = 'error' AND {v} > 0) AS failed")
    return "\nUNION ALL\n".join(parts)


def _cell(c: str, double: bool = False) -> str:
    text = f"CAST(TRY_CAST(CASE WHEN isnan({c}) THEN NULL ELSE {c} END AS DECIMAL(38,8)) AS VARCHAR)" if double else f"CAST({c} AS VARCHAR)"
    return f"coalesce({text}, '\\N')"


_CHECK_PARTS = [_cell("trade_timestamp"), _cell("close_price", True), _cell("crash_index", True), _cell("crash_alert_flag")]
_CHECK_TEXT = "concat_ws('|', " + ", ".join(_CHECK_PARTS) + ")"


def _checksum_sql(table: str, text: str) -> str:
    return f"""
        SELECT count(*) AS n_rows,
               md5(CAST(count(*) AS VARCHAR) || '|' ||
                   CAST(coalesce(sum({_hex('d', 1)}), 0) AS VARCHAR) || '|' ||
                   CAST(coalesce(sum({_hex('d', 16)}), 0) AS VARCHAR)) AS checksum
        FROM (SELECT md5({text}) AS d FROM {table}) x"""


def _verification_row_sql(table: str) -> str:
    gaps, dups = _gaps_and_dups(table)
    return ("SELECT min(trade_date) AS min_date, max(trade_date) AS max_date, "
            + ", ".join(f"{_count_if(p)} AS {n}" for n, _, p in _VERIFY_RULES if p)
            + f", {dups} AS duplicate_count, {gaps} AS gap_count FROM {table}")


def _hex(col: str, start: int) -> str:
    return f"CAST(CAST(('0x' || substr({col}, {start}, 15)) AS BIGINT) AS DECIMAL(38,0))"


def _fp_text(cols_types: list[tuple[str, str]]) -> str:
    parts = []
    for c, t in cols_types:
        if t == "double":
            e = f"CAST(CAST({c} AS DECIMAL(38,8)) AS VARCHAR)"
        else:
            e = f"CAST({c} AS VARCHAR)"
        parts.append(f"coalesce({e}, '\\N')")
    return "concat_ws('|', " + ", ".join(parts) + ")"


def _fingerprint(source: str, cols_types, group: str | None = None) -> str:
    g_sel = f"{group}, " if group else ""
    g_by = f"GROUP BY {group}" if group else ""
    return f"""
      SELECT {g_sel}count(*) AS n_rows,
             md5(CAST(count(*) AS VARCHAR) || '|' || CAST(sum({_hex('d', 1)}) AS VARCHAR) || '|' ||
                 CAST(sum({_hex('d', 16)}) AS VARCHAR)) AS fingerprint
      FROM (SELECT {g_sel}md5({_fp_text(cols_types)}) AS d FROM {source}) x
      {g_by}"""


_BAR_COLS = [("trade_timestamp", "ts"), ("open_price", "double"), ("high_price", "double"),
             ("low_price", "double"), ("close_price", "double"), ("volume", "bigint"),
             ("bar_count", "int"), ("average_price", "double")]
_EVENT_COLS = [("event_id", "bigint"), ("ts", "ts"), ("user_id", "bigint"), ("event_type", "string"),
               ("value", "double"), ("props", "string")]

_FEATURE_COLS = ["trade_timestamp", "trade_date", "open_price", "high_price", "low_price", "close_price",
                 "volume", "log_return", "momentum_5min", "momentum_15min", "volatility_15min",
                 "volatility_30min", "volatility_60min", "volume_ratio", "vwap_15min", "vwap_30min",
                 "avg_range_15min", "rolling_peak", "drawdown", "var_95_proxy", "volatility_mean_60",
                 "volatility_std_60", "volatility_zscore", "crash_index", "true_crash", "crash_alert_flag",
                 "crash_severity"]
_INT_OR_TEXT = {"trade_timestamp", "trade_date", "volume", "true_crash", "crash_alert_flag", "crash_severity"}

_DRIFT = ", ".join(
    f"""CASE WHEN {m} IS NOT NULL AND count({m}) OVER h >= 2 AND stddev_pop({m}) OVER h IS NOT NULL
             AND stddev_pop({m}) OVER h <> 0
        THEN abs({m} - avg({m}) OVER h) / stddev_pop({m}) OVER h > 3 ELSE false END AS {m}_drift"""
    for m in ("optimal_threshold", "alert_rate", "crash_index_mean", "crash_index_std"))


_NULLS = "SELECT " + ", ".join(f"{_count_if(p)} AS {n}" for n, _, p in _JOB_RULES[8:]) + " FROM {t}"
_SUMMARY = "SELECT " + ", ".join(f"{_count_if(p)} AS {n}" for n, _, p in _JOB_RULES[:8]) + " FROM {t}"

ORACLE: dict[str, str] = {
    "bars_adapter": _q("SELECT *, CAST(trade_timestamp AS DATE) AS trade_date FROM bars_raw"),
    "duplicate_keys": _q("SELECT trade_timestamp, count(*) AS n_rows FROM bars_raw "
                         "GROUP BY trade_timestamp HAVING count(*) > 1"),
    "top_duplicate_keys": _q("SELECT trade_timestamp, count(*) AS n_rows FROM bars_raw "
                             "GROUP BY trade_timestamp HAVING count(*) > 1 "
                             "ORDER BY n_rows DESC, trade_timestamp ASC LIMIT 20"),
    "dedup_bars": _q("SELECT * FROM bars"),
    "valid_bars": _q("SELECT * FROM valid"),
    "input_profile": _q("SELECT count(*) AS input_rows, min(trade_date) AS min_date, "
                        "max(trade_date) AS max_date FROM bars"),
    "log_returns": _q(f"SELECT trade_timestamp, trade_date, close_price, {_rd('log_return')} FROM r"),
    "momentum": _feature("momentum_5min", "momentum_15min"),
    "rolling_volatility": _feature("volatility_15min", "volatility_30min", "volatility_60min"),
    "volume_ratio": _q(f"SELECT trade_timestamp, volume, {_rd('avg_volume_30min')}, {_rd('volume_ratio')} "
                       "FROM final"),
    "vwap": _feature("vwap_15min", "vwap_30min"),
    "avg_range": _feature("avg_range_15min"),
    "volatility_baseline": _feature("volatility_mean_60", "volatility_std_60"),
    "volatility_zscore": _feature("volatility_zscore"),
    "drawdown": _feature("rolling_peak", "drawdown"),
    "var_proxy": _feature("var_95_proxy"),
    "crash_index": _feature("crash_index"),
    "true_crash": _q(f"SELECT trade_timestamp, {_rd('drawdown')}, true_crash FROM final"),
    "confusion_sweep": _q("SELECT threshold, tp, fp, fn FROM sweep"),
    "f1_scores": _q(f"SELECT threshold, tp, fp, fn, {_rd('precision')}, {_rd('recall')}, {_rd('f1')} FROM f1s"),
    "best_threshold": _q(f"SELECT threshold, {_rd('f1')} FROM best"),
    "alert_flag": _q(f"SELECT trade_timestamp, {_rd('crash_index')}, crash_alert_flag FROM final"),
    "crash_severity": _q("SELECT trade_timestamp, crash_alert_flag, crash_severity FROM final"),
    "severity_counts": _q("SELECT crash_severity, count(*) AS n_rows FROM final GROUP BY crash_severity"),
    "null_checks": _q(_NULLS.format(t="final")),
    "validation_summary": _q(_SUMMARY.format(t="final")),
    "rule_violations": _q(_rules_sql(_JOB_RULES, "job") + "\nUNION ALL\n" + _rules_sql(_VERIFY_RULES, "verify")),
    "gap_rows": _q("SELECT * FROM gaps"),
    "gap_count": _q("SELECT count(*) AS gap_count FROM gaps"),
    "row_coverage": _q(f"""
        SELECT raw_rows_distinct, analytics_rows,
               {_round('CASE WHEN raw_rows_distinct > 0 THEN analytics_rows / raw_rows_distinct ELSE 0.0 END', 6)}
                 + 0.0 AS coverage_ratio,
               (analytics_rows > 0 AND analytics_rows <= raw_rows_distinct
                AND CASE WHEN raw_rows_distinct > 0 THEN analytics_rows / raw_rows_distinct ELSE 0.0 END >= 0.95)
                 AS coverage_ok
        FROM (SELECT count(DISTINCT trade_timestamp) AS raw_rows_distinct FROM bars_raw) a,
             (SELECT count(*) AS analytics_rows FROM final) b"""),
    "date_range_match": _q("""
        SELECT min_raw, max_raw, min_analytics, max_analytics,
               coalesce(min_raw IS NOT NULL AND max_raw IS NOT NULL AND min_analytics IS NOT NULL
                        AND max_analytics IS NOT NULL AND min_raw = min_analytics
                        AND max_raw = max_analytics, false) AS date_range_ok
        FROM (SELECT min(CAST(trade_timestamp AS DATE)) AS min_raw,
                     max(CAST(trade_timestamp AS DATE)) AS max_raw FROM bars_raw) a,
             (SELECT min(trade_date) AS min_analytics, max(trade_date) AS max_analytics FROM final) b"""),
    "latest_rows": _q(f"""SELECT trade_timestamp, close_price, {_rd('crash_index')}, crash_alert_flag,
                              crash_severity FROM final ORDER BY trade_timestamp DESC LIMIT 10"""),
    "table_checksum": _q(_checksum_sql("final", _CHECK_TEXT)),
    "row_fingerprint": _q(_fingerprint("bars_raw", _BAR_COLS)),
    "daily_runs": _q("SELECT * FROM daily"),
    "drift_test": _q(f"""
        SELECT trade_date, optimal_threshold, alert_rate, crash_index_mean, crash_index_std,
               optimal_threshold_drift, alert_rate_drift, crash_index_mean_drift, crash_index_std_drift,
               (optimal_threshold_drift OR alert_rate_drift OR crash_index_mean_drift
                OR crash_index_std_drift) AS drift_detected
        FROM (SELECT trade_date, optimal_threshold, alert_rate, crash_index_mean, crash_index_std, {_DRIFT}
              FROM daily
              WINDOW h AS (ORDER BY trade_date ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)) t"""),
    "run_metrics": _q(f"""
        SELECT {_round('(SELECT threshold FROM best)', 4)} AS optimal_threshold,
               {_round('avg(crash_alert_flag)', 4)} AS alert_rate,
               {_round('avg(crash_index)', 4)} AS crash_index_mean,
               {_round('stddev_samp(crash_index)', 4)} AS crash_index_std
        FROM final"""),
    "feature_table": _q("SELECT " + ", ".join(c if c in _INT_OR_TEXT else _rd(c) for c in _FEATURE_COLS)
                        + " FROM final"),
    "verification_row": _q(_verification_row_sql("final")),
    "ingest_guardrail": _q(f"""
        , incoming AS ({_fingerprint("(SELECT *, CAST(ts AS DATE) AS trade_date FROM events)",
                                     _EVENT_COLS, "trade_date")}),
        ledger AS (SELECT fingerprint FROM incoming WHERE day(trade_date) % 3 = 0),
        existing AS (SELECT CAST(ts AS DATE) AS trade_date,
                            CASE WHEN day(CAST(ts AS DATE)) % 3 = 1 THEN count(*)
                                 ELSE count(DISTINCT date_trunc('minute', ts)) END AS existing_rows
                     FROM events GROUP BY CAST(ts AS DATE))
        SELECT i.trade_date, i.fingerprint AS dataset_hash, i.n_rows AS row_count,
               (i.fingerprint IN (SELECT fingerprint FROM ledger)) AS already_ingested,
               coalesce(e.existing_rows, 0) AS existing_rows,
               CASE WHEN i.fingerprint IN (SELECT fingerprint FROM ledger) THEN 'skip_known'
                    WHEN coalesce(e.existing_rows, 0) >= i.n_rows THEN 'skip_covered'
                    ELSE 'ingest' END AS decision
        FROM incoming i LEFT JOIN existing e ON i.trade_date = e.trade_date"""),
}


# ---- keyed series: one series per event type ---------------------------------------
_K = ("event_type",)
_KEYED_TEXT = "concat_ws('|', " + ", ".join([_cell("event_type"), *_CHECK_PARTS]) + ")"
_DRIFT_K = _DRIFT

ORACLE.update({
    "keyed_dedup_bars": _q("SELECT * FROM bars", _K),
    "keyed_feature_table": _q("SELECT event_type, " + ", ".join(
        c if c in _INT_OR_TEXT else _rd(c) for c in _FEATURE_COLS) + " FROM final", _K),
    "keyed_daily_runs": _q("SELECT * FROM daily", _K),
    "keyed_drift_test": _q(f"""
        SELECT event_type, trade_date, optimal_threshold, alert_rate, crash_index_mean, crash_index_std,
               optimal_threshold_drift, alert_rate_drift, crash_index_mean_drift, crash_index_std_drift,
               (optimal_threshold_drift OR alert_rate_drift OR crash_index_mean_drift
                OR crash_index_std_drift) AS drift_detected
        FROM (SELECT event_type, trade_date, optimal_threshold, alert_rate, crash_index_mean, crash_index_std,
                     {_DRIFT_K}
              FROM daily
              WINDOW h AS (PARTITION BY event_type ORDER BY trade_date
                           ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)) t""", _K),
    "keyed_gap_count": _q("SELECT count(*) AS gap_count FROM gaps", _K),
    "keyed_table_checksum": _q(_checksum_sql("final", _KEYED_TEXT), _K),
    "keyed_verification_row": _q(f"""
        SELECT min(trade_date) AS min_date, max(trade_date) AS max_date,
               {_count_if('crash_index IS NULL')} AS null_crash_index,
               {_count_if("crash_alert_flag = 1 AND crash_severity = 'LOW'")} AS alert_mismatch,
               {_count_if('drawdown > 0')} AS positive_drawdown,
               {_count_if('volatility_30min < 0')} AS negative_volatility,
               {_count_if('volume_ratio < 0')} AS negative_volume_ratio,
               {_count_if('abs(volatility_zscore) > 10')} AS extreme_zscore,
               {_count_if('abs(crash_index) > 50')} AS extreme_crash_index,
               (SELECT count(*) FROM dups) AS duplicate_count,
               (SELECT count(*) FROM gaps) AS gap_count
        FROM final""", _K),
})


def _record_sql(raw: str, table: str) -> str:
    """The verification record of a feature table against a table of raw bars."""
    gaps, dups = _gaps_and_dups(table)
    return f"""
    SELECT a.* EXCLUDE (s1, s2), r.*,
           md5(CAST(a.n_rows AS VARCHAR) || '|' || CAST(a.s1 AS VARCHAR) || '|' || CAST(a.s2 AS VARCHAR))
             AS checksum,
           {dups} AS duplicate_count, {gaps} AS gap_count,
           {_round('CASE WHEN r.raw_rows_distinct > 0 THEN a.analytics_rows / r.raw_rows_distinct ELSE 0.0 END', 6)}
             + 0.0 AS coverage_ratio,
           (a.analytics_rows > 0 AND a.analytics_rows <= r.raw_rows_distinct
            AND CASE WHEN r.raw_rows_distinct > 0 THEN a.analytics_rows / r.raw_rows_distinct ELSE 0.0 END
                >= 0.95) AS coverage_ok,
           coalesce(r.min_raw = a.min_analytics AND r.max_raw = a.max_analytics, false) AS date_range_ok
    FROM (SELECT count(*) AS analytics_rows, min(trade_date) AS min_analytics, max(trade_date) AS max_analytics,
                 {", ".join(f"{_count_if(p)} AS {n}" for n, _, p in _VERIFY_RULES if p)},
                 count(*) AS n_rows,
                 coalesce(sum({_hex(f'md5({_CHECK_TEXT})', 1)}), 0) AS s1,
                 coalesce(sum({_hex(f'md5({_CHECK_TEXT})', 16)}), 0) AS s2
          FROM {table}) a,
         (SELECT count(DISTINCT trade_timestamp) AS raw_rows_distinct,
                 min(CAST(trade_timestamp AS DATE)) AS min_raw, max(CAST(trade_timestamp AS DATE)) AS max_raw
          FROM {raw}) r"""


ORACLE["verification_record"] = _q(_record_sql("bars_raw", "final"))

# The split evaluation must give exactly the plain feature table.
ORACLE["feature_table_split"] = ORACLE["feature_table"]
ORACLE["gap_rows_split"] = ORACLE["gap_rows"]
ORACLE["keyed_feature_table_split"] = _q("SELECT series, " + ", ".join(
    c if c in _INT_OR_TEXT else _rd(c) for c in _FEATURE_COLS) + " FROM final", ("series",))


# ---- planted faults --------------------------------------------------------------------
_N = "((hour(trade_timestamp) * 60 + minute(trade_timestamp)) % 97)"
_PLANTED = f""", planted AS (
  SELECT f.* REPLACE (
    CASE WHEN {_N} = 1 THEN NULL ELSE trade_timestamp END AS trade_timestamp,
    CASE WHEN {_N} = 2 THEN -1.0 ELSE volatility_30min END AS volatility_30min,
    CASE WHEN {_N} = 3 THEN NULL WHEN {_N} = 4 THEN CAST('NaN' AS DOUBLE) WHEN {_N} = 7 THEN 51.0
         ELSE crash_index END AS crash_index,
    CASE WHEN {_N} = 5 THEN -1.0 ELSE volume_ratio END AS volume_ratio,
    CASE WHEN {_N} = 6 THEN 11.0 ELSE volatility_zscore END AS volatility_zscore,
    CASE WHEN {_N} = 8 THEN 1 ELSE crash_alert_flag END AS crash_alert_flag,
    CASE WHEN {_N} = 8 THEN 'LOW' ELSE crash_severity END AS crash_severity,
    CASE WHEN {_N} = 9 THEN 0.5 ELSE drawdown END AS drawdown,
    CASE WHEN {_N} = 10 THEN NULL ELSE log_return END AS log_return,
    CASE WHEN {_N} = 11 THEN CAST('NaN' AS DOUBLE) ELSE momentum_5min END AS momentum_5min,
    CASE WHEN {_N} = 12 THEN NULL ELSE momentum_15min END AS momentum_15min)
  FROM final f, generate_series(1, 3) g(copy)
  WHERE copy = 1 OR {_N} = 13
)
"""


def _p(select: str) -> str:
    return "WITH " + BASE.strip() + _PLANTED + select


_LED = """, led AS (
  SELECT CAST(trade_date AS VARCHAR) AS run_id, trade_date AS execution_ts, optimal_threshold,
         CASE WHEN day(trade_date) % 4 = 0 THEN NULL ELSE alert_rate END AS alert_rate, crash_index_mean,
         CASE WHEN day(trade_date) % 3 = 0 THEN NULL ELSE crash_index_std END AS crash_index_std
  FROM daily
), recent AS (SELECT * FROM led ORDER BY execution_ts DESC, run_id DESC LIMIT 5)
"""
_METRICS = ("optimal_threshold", "alert_rate", "crash_index_mean", "crash_index_std")
_LATEST = ", ".join(
    f"""CASE WHEN l.{m} IS NOT NULL AND (SELECT count({m}) FROM recent) >= 2 AND (SELECT stddev_pop({m}) FROM recent) <> 0
        THEN abs(l.{m} - (SELECT avg({m}) FROM recent)) / (SELECT stddev_pop({m}) FROM recent) > 3 ELSE false END AS {m}_drift"""
    for m in _METRICS)

_ERRORS = ["null_crash_index", "alert_mismatch", "positive_drawdown", "negative_volatility", "negative_volume_ratio",
           "duplicate_count", "gap_count"]
_VERDICT = """SELECT '{name}' AS source, raw_rows_distinct, analytics_rows,
       (gate IS NULL OR gate > 2) AS row_coverage_ratio, (gate IS NULL OR gate > 3) AS date_range_ok,
       (gate IS NULL OR gate > 4) AS crash_index_ok, false AS sample_read_ok,
       CASE WHEN gate IS NULL THEN checksum END AS checksum, gate AS failed_gate, failing
FROM (SELECT *, CASE WHEN analytics_rows <= 0 THEN 0 WHEN analytics_rows > raw_rows_distinct THEN 1
                     WHEN NOT coverage_ok THEN 2 WHEN NOT date_range_ok THEN 3 WHEN {total} > 0 THEN 4 END AS gate,
             concat_ws(', ', {failing}) AS failing
      FROM ({record}) rec) v"""


def _verdict_sql(name: str, raw: str, table: str) -> str:
    return _VERDICT.format(name=name, record=_record_sql(raw, table), total="(" + " + ".join(_ERRORS) + ")",
                           failing=", ".join(f"CASE WHEN {e} > 0 THEN '{e}' END" for e in _ERRORS))


_BAR_TEXT = _fp_text([(c, t) for c, t in _BAR_COLS if c != "trade_timestamp"])

ORACLE.update({
    "rule_violations_planted": _p(_rules_sql(_JOB_RULES, "job", "planted") + "\nUNION ALL\n"
                                  + _rules_sql(_VERIFY_RULES, "verify", "planted")),
    "validation_summary_planted": _p(_SUMMARY.format(t="planted")),
    "null_checks_planted": _p(_NULLS.format(t="planted")),
    "verification_row_planted": _p(_verification_row_sql("planted")),
    "verification_row_planted_split": _p(_verification_row_sql("planted")),
    "table_checksum_planted": _p(_checksum_sql("planted", _CHECK_TEXT)),
    "valid_bars_planted": _q("""
        SELECT * FROM (SELECT b.* REPLACE (
            CASE WHEN volume % 17 = 0 THEN CAST('NaN' AS DOUBLE) ELSE close_price END AS close_price,
            CASE WHEN volume % 19 = 0 THEN NULL ELSE open_price END AS open_price,
            CASE WHEN volume % 23 = 0 THEN -low_price - 1 ELSE low_price END AS low_price) FROM bars b) p
        WHERE volume % 17 <> 0 AND volume % 19 <> 0 AND open_price >= 0 AND high_price >= 0 AND low_price >= 0
          AND close_price >= 0"""),
    "dedup_bars_by_value": _q(f"""
        SELECT * EXCLUDE (event_id, d) FROM (SELECT *, substr(md5({_BAR_TEXT}), 1, 15) AS d FROM bars_raw) x
        QUALIFY row_number() OVER (PARTITION BY trade_timestamp ORDER BY d) = 1"""),
    "csv_text_bars": _q("SELECT * EXCLUDE (event_id) FROM bars_raw WHERE event_id % 11 > 1 AND event_id % 13 <> 0 "
                        "AND NOT (event_id % 2 = 1 AND event_id % 17 = 0)"),
    "run_drift": _q(_LED + f"""SELECT *, (optimal_threshold_drift OR alert_rate_drift OR crash_index_mean_drift
        OR crash_index_std_drift) AS drift_detected FROM (SELECT l.run_id, {_LATEST} FROM led l) t"""),
    "verdict": _q(""", closed AS (SELECT f.* REPLACE (CAST(trade_date AS TIMESTAMP) + to_minutes(
            row_number() OVER (PARTITION BY trade_date ORDER BY trade_timestamp)) AS trade_timestamp) FROM final f),
        none AS (SELECT * FROM final WHERE false)
        """ + "\nUNION ALL\n".join([_verdict_sql("events", "bars_raw", "final"), _verdict_sql("closed_up", "closed", "closed"),
                                     _verdict_sql("empty", "bars_raw", "none")])),
})


# ---- order-sensitive digest, running moments, reconciliation, mergeable states ------------
# Primes and bases of the four lanes.
_POLY = [(2147483647, 1000003), (2147483629, 998244353), (2147483587, 1234567891), (2147483579, 1597334677)]


def _ordered_sql(table: str, text: str, keys: str = "") -> str:
    """The polynomial of the whole table, by Horner's rule over one ordered list of row hashes."""
    lists = ", ".join(f"""list_reduce(list_prepend(0::BIGINT, list(('0x' || substr(d, {8 * k + 1}, 8))::BIGINT % {p - 1} + 1
        ORDER BY n DESC)), lambda a, x: (a * {b} + x) % {p}) AS h{k}""" for k, (p, b) in enumerate(_POLY))
    return f"""
        SELECT n_rows, md5(concat_ws('|', n_rows, h0, h1, h2, h3)) AS checksum FROM (
          SELECT count(*) AS n_rows, {lists} FROM (
            SELECT d, row_number() OVER (ORDER BY trade_date NULLS FIRST{keys}, trade_timestamp NULLS FIRST, d) AS n
            FROM (SELECT *, md5({text}) AS d FROM {table}) x) y) z"""


_ROLLED = ["momentum_5min", "momentum_15min", "volatility_15min", "volatility_30min", "volatility_60min", "volume_ratio",
           "avg_range_15min", "rolling_peak", "drawdown", "volatility_mean_60", "volatility_std_60", "volatility_zscore"]
_ROLLED_OUT = ", ".join([*[_rd(c) for c in _ROLLED], *[f"{_round(f'ln({c})', D)} + 0.0 AS log_{c}" for c in ("vwap_15min", "vwap_30min")]])


def _differences(keys: str = "") -> str:
    k = f", {keys}" if keys else ""
    same = f" AND e.{keys} IS NOT DISTINCT FROM f.{keys}" if keys else ""
    pick = f", coalesce(e.{keys}, f.{keys}) AS {keys}" if keys else ""
    hit = "(dayofyear(trade_date) % 5 = 0 AND minute(trade_timestamp) % {} = 0)"
    return f"""
        , lossy AS (SELECT trade_date{k}, trade_timestamp + CASE WHEN {hit.format(13)} THEN INTERVAL 30 SECOND ELSE INTERVAL 0 SECOND END AS trade_timestamp
                    FROM r, generate_series(1, 2) g(copy) WHERE NOT {hit.format(7)} AND (copy = 1 OR {hit.format(11)})),
        e AS (SELECT trade_date{k}, trade_timestamp, count(*) AS n FROM r GROUP BY ALL),
        f AS (SELECT trade_date{k}, trade_timestamp, count(*) AS n FROM lossy GROUP BY ALL)
        SELECT coalesce(e.trade_date, f.trade_date) AS trade_date{pick}, coalesce(e.trade_timestamp, f.trade_timestamp) AS trade_timestamp,
               CASE WHEN coalesce(e.n, 0) > coalesce(f.n, 0) THEN 'lost' ELSE 'unexpected' END AS finding,
               abs(coalesce(e.n, 0) - coalesce(f.n, 0)) AS n
        FROM e FULL JOIN f ON e.trade_timestamp = f.trade_timestamp{same}
        WHERE coalesce(e.n, 0) <> coalesce(f.n, 0)"""


def _price(c: str) -> str:
    return f"CAST(CAST({c} AS DECIMAL(18,4)) AS VARCHAR)"


_LINES = f"""
    , lines AS (SELECT CAST(CAST(trade_timestamp AS DATE) AS VARCHAR) AS file, concat_ws(',',
        CASE WHEN event_id % 23 = 0 THEN strftime(trade_timestamp, '%Y-%m-%d') ELSE strftime(trade_timestamp, '%Y%m%d %H:%M:%S') END,
        {_price('open_price')}, {_price('high_price')}, {_price('low_price')},
        CASE WHEN event_id % 31 = 0 THEN 'NA' ELSE {_price('close_price')} END,
        CASE WHEN event_id % 29 = 0 THEN 'x' ELSE CAST(volume AS VARCHAR) END,
        CAST(event_id AS VARCHAR), {_price('average_price')}, CASE WHEN event_id % 19 = 0 THEN '9' END) AS line,
        CASE WHEN event_id % 19 = 0 THEN 'fields' WHEN event_id % 31 = 0 THEN 'missing' WHEN event_id % 23 = 0 THEN 'time'
             WHEN event_id % 29 = 0 THEN 'number' ELSE 'good' END AS outcome
      FROM bars_raw)"""

ORACLE.update({
    "rejected_rows": _q(_LINES + " SELECT file, line, outcome FROM lines WHERE outcome <> 'good'"),
    "line_outcomes": _q(_LINES + " SELECT file, outcome, count(*) AS n, CASE WHEN outcome = 'good' THEN count(*) ELSE 0 END AS loaded FROM lines GROUP BY file, outcome"),
    "new_files": "WITH files AS (" + _fingerprint("(SELECT *, strftime(ts, '%Y-%m-%d %H') AS path FROM events)", _EVENT_COLS, "path") + """),
        known AS (SELECT fingerprint FROM files WHERE CAST(substr(path, 12, 2) AS INT) % 3 = 0)
        SELECT path, fingerprint AS dataset_hash, n_rows AS row_count FROM files WHERE fingerprint NOT IN (SELECT fingerprint FROM known)""",
    "ordered_checksum": _q(_ordered_sql("final", _CHECK_TEXT)),
    "ordered_checksum_split": _q(_ordered_sql("final", _CHECK_TEXT)),
    "ordered_checksum_planted": _p(_ordered_sql("planted", _CHECK_TEXT)),
    "keyed_ordered_checksum": _q(_ordered_sql("final", _KEYED_TEXT, ", event_type NULLS FIRST"), _K),
    "rolling_moments": _q(f"SELECT trade_timestamp, {_ROLLED_OUT} FROM final"),
    "keyed_rolling_moments": _q(f"SELECT event_type, trade_timestamp, {_ROLLED_OUT} FROM final", _K),
    "missing_keys": _q(_differences()),
    "keyed_missing_keys": _q(_differences("series"), ("series",)),
    "differing_days": _q("SELECT DISTINCT trade_date FROM r WHERE dayofyear(trade_date) % 5 = 0 AND "
                         "(minute(trade_timestamp) % 7 = 0 OR minute(trade_timestamp) % 11 = 0 OR minute(trade_timestamp) % 13 = 0)"),
    "distinct_bars_bitmap": _q("SELECT count(DISTINCT trade_timestamp + CASE WHEN event_id % 10 = 0 THEN INTERVAL 20 SECOND "
                               "ELSE INTERVAL 0 SECOND END) AS distinct_keys FROM bars_raw"),
    "keyed_distinct_bars_bitmap": _q("SELECT count(*) AS distinct_keys FROM (SELECT DISTINCT series, trade_timestamp FROM bars_raw) x", ("series",)),
    "sweep_state_merge": _q("SELECT threshold, tp, fp, fn FROM sweep"),
    "merged_index_stats": _q(f"""
        SELECT bucket, count(*) AS n, CAST(sum(true_crash) AS BIGINT) AS positives, {_round('avg(crash_index)', D)} + 0.0 AS mean,
               {_round('stddev_samp(crash_index)', D)} + 0.0 AS deviation
        FROM (SELECT *, CAST((SELECT count(*) FROM grid g WHERE s.crash_index > g.threshold) AS INTEGER) AS bucket FROM scored s) x GROUP BY bucket"""),
})
