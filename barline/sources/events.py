"""Bars derived from the ``events`` table of the test data.

The driver's tables carry no price bars, so an event becomes one raw bar of
its minute.  Copies of a minute are real duplicates for the dedup step; the
event id is the deterministic tie-break.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.functions import minute_floor

# Fixed values of the adapter: price offsets in cents derived from ``props.k``.
TICK = 0.01
OPEN_OFFSET_MOD = 5      # open = value - (k % 5) ticks
RANGE_MOD = 3            # high/low widen by (k % 3) ticks
BAR_COUNT_MOD = 100      # bar_count = event_id % 100


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def bars_from_events(events: DataFrame, keep_id: bool = True, keys: tuple[str, ...] = ()) -> DataFrame:
    """Raw bar columns (plus ``event_id`` as tie-break) from events.  ``keys``
    are event columns carried through as series keys (e.g. ``event_type``)."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    tick = F.lit(TICK)
    base = events.select(
        "event_id",
        *keys,
        minute_floor("ts").alias("trade_timestamp"),
        (F.col("value") - (k % OPEN_OFFSET_MOD) * tick).alias("open_price"),
        F.col("value").alias("close_price"),
        k.alias("volume"),
        (k % RANGE_MOD).alias("_widen"),
    )
    bars = base.select(
        "event_id",
        *keys,
        "trade_timestamp",
        "open_price",
        (F.greatest("open_price", "close_price") + F.col("_widen") * tick).alias("high_price"),
        (F.least("open_price", "close_price") - F.col("_widen") * tick).alias("low_price"),
        "close_price",
        "volume",
        (F.col("event_id") % BAR_COUNT_MOD).cast("int").alias("bar_count"),
        ((F.col("open_price") + F.col("close_price")) / 2).alias("average_price"),
    )
    return bars if keep_id else bars.drop("event_id")
