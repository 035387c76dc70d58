"""Table contracts and the description of an ordered series.

Every table the engine reads or writes has a fixed ``StructType`` here; writers
conform to it by name (select + cast), so column order in the input never
matters and nothing is inferred.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


D, L, I, S, B = T.DoubleType(), T.LongType(), T.IntegerType(), T.StringType(), T.BooleanType()
TS, DATE = T.TimestampNTZType(), T.DateType()

# Raw one-minute bars as loaded from the source file.
RAW_BARS = _schema(
    ("trade_timestamp", TS, False),
    ("open_price", D, True),
    ("high_price", D, True),
    ("low_price", D, True),
    ("close_price", D, True),
    ("volume", L, True),
    ("bar_count", I, True),
    ("average_price", D, True),
)

# Feature table, in the order it is written.
FEATURES = _schema(
    ("trade_timestamp", TS, False),
    ("trade_date", DATE, False),
    ("open_price", D, True),
    ("high_price", D, True),
    ("low_price", D, True),
    ("close_price", D, True),
    ("volume", L, True),
    ("log_return", D, True),
    ("momentum_5min", D, True),
    ("momentum_15min", D, True),
    ("volatility_15min", D, True),
    ("volatility_30min", D, True),
    ("volatility_60min", D, True),
    ("volume_ratio", D, True),
    ("vwap_15min", D, True),
    ("vwap_30min", D, True),
    ("avg_range_15min", D, True),
    ("rolling_peak", D, True),
    ("drawdown", D, True),
    ("var_95_proxy", D, True),
    ("volatility_mean_60", D, True),
    ("volatility_std_60", D, True),
    ("volatility_zscore", D, True),
    ("crash_index", D, True),
    ("true_crash", I, True),
    ("crash_alert_flag", I, True),
    ("crash_severity", S, True),
)

INGESTION_LEDGER = _schema(
    ("dataset_hash", S, False),
    ("row_count", L, True),
    ("ingested_at", TS, True),
)

RUN_LEDGER = _schema(
    ("run_id", S, False),
    ("raw_rows_distinct", L, True),
    ("analytics_rows", L, True),
    ("data_checksum", S, True),
    ("optimal_threshold", D, True),
    ("alert_rate", D, True),
    ("crash_index_mean", D, True),
    ("crash_index_std", D, True),
    ("execution_ts", TS, False),
    ("drift_detected", B, True),
)

RUN_METRICS = _schema(
    ("optimal_threshold", D, True),
    ("alert_rate", D, True),
    ("crash_index_mean", D, True),
    ("crash_index_std", D, True),
)

VERDICT = _schema(
    ("raw_rows_distinct", L, True),
    ("analytics_rows", L, True),
    ("row_coverage_ratio", B, False),
    ("date_range_ok", B, False),
    ("crash_index_ok", B, False),
    ("sample_read_ok", B, False),
    ("checksum", S, True),
    ("error", S, True),
)

# Source file header after strip + lower, mapped to the raw bar columns.
CSV_COLUMNS = {
    "date": "trade_timestamp",
    "open": "open_price",
    "high": "high_price",
    "low": "low_price",
    "close": "close_price",
    "volume": "volume",
    "barcount": "bar_count",
    "average": "average_price",
}


@dataclass(frozen=True)
class SeriesSpec:
    """Names the columns of an ordered series of bars.

    ``keys`` identifies independent series (instruments); state never crosses a
    ``(keys, day)`` boundary.  The default is the single-series layout.
    """

    keys: tuple[str, ...] = ()
    time: str = "trade_timestamp"
    day: str = "trade_date"
    open: str = "open_price"
    high: str = "high_price"
    low: str = "low_price"
    close: str = "close_price"
    volume: str = "volume"

    @property
    def group(self) -> list[str]:
        """Window partition: day first, so the window's sort order also
        satisfies a writer partitioned by day."""
        return [self.day, *self.keys]

    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.group).orderBy(self.time)

    def rows_sql(self, preceding: int | None) -> str:
        """The same trailing frame as SQL text, for ``F.expr`` window columns."""
        start = "UNBOUNDED PRECEDING" if preceding is None else f"{preceding} PRECEDING"
        part = ", ".join(f"`{c}`" for c in self.group)
        return f"(PARTITION BY {part} ORDER BY `{self.time}` ROWS BETWEEN {start} AND CURRENT ROW)"

    def with_keys(self, *keys: str) -> "SeriesSpec":
        return SeriesSpec(keys=tuple(keys), time=self.time, day=self.day, open=self.open,
                          high=self.high, low=self.low, close=self.close, volume=self.volume)


DEFAULT_SPEC = SeriesSpec()


def conform(df, schema: T.StructType):
    """Select and cast the columns of ``schema`` by name; fail on a missing one."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns for contract: {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
