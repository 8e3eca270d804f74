"""Price bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.clock import bucket_start, local_date
from tickloom.functions.ordering_keys import MAX_PACKED_SECONDS, causal_key, guard_nulls


def _aggregate(trades: DataFrame, keys: list, price: Column, seconds: int, wide: bool, more=()):
    """Group to bars. Partial aggregation leaves one row per bar and scan task to shuffle."""
    key = causal_key(
        F.col("ts_event_ns") - F.col("bar_start_ns"),
        F.col("sequence"),
        F.col("source_row_number"),
        wide or seconds > MAX_PACKED_SECONDS,
    )
    keyed = trades.select(*keys, price.alias("price"), "size", key.alias("_key"))
    return keyed.groupBy(*keys).agg(
        F.min_by("price", "_key").alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", "_key").alias("close"),
        F.sum("size").alias("volume"),
        *more,
    )


def ohlcv_bars(tape: DataFrame, seconds: int, wide_keys: bool = False) -> DataFrame:
    """Bars per symbol, session and epoch-aligned bucket; first and last trade in causal order.

    A null in a column that bars need raises.
    """
    cols = ("ts_event_ns", "sequence", "symbol", "price", "size", "session_id", "source_row_number")
    price = guard_nulls(F.col("price"), *(F.col(c) for c in cols))
    placed = tape.select(
        *cols, bucket_start(F.col("ts_event_ns"), seconds).alias("bar_start_ns")
    )
    return _aggregate(placed, ["symbol", "session_id", "bar_start_ns"], price, seconds, wide_keys)


def rollup_bars(bars: DataFrame, seconds: int, tz: str | None = None) -> DataFrame:
    """Longer bars from shorter ones whose width divides theirs; trades are not read again."""
    keys = [c for c in ("symbol", "session_id") if c in bars.columns]
    counts = [F.sum("trades").alias("trades")] if "trades" in bars.columns else []
    start = bucket_start(F.col("bar_start_ns"), seconds, tz)
    rolled = (
        bars.withColumn("_start", start)
        .groupBy(*keys, F.col("_start"))
        .agg(
            F.min_by("open", "bar_start_ns").alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", "bar_start_ns").alias("close"),
            F.sum("volume").alias("volume"),
            *counts,
        )
        .withColumnRenamed("_start", "bar_start_ns")
    )
    if "range" in bars.columns:
        rolled = rolled.withColumn("range", F.col("high") - F.col("low"))
    return rolled


def candles(
    trades: DataFrame, seconds: int, tz: str | None = None, wide_keys: bool = False
) -> DataFrame:
    """Bars without a session key, with the trade count and range.

    ``tz`` lines the bars up with that zone's clock instead of the epoch.
    """
    placed = trades.withColumn("bar_start_ns", bucket_start(F.col("ts_event_ns"), seconds, tz))
    count = F.count(F.lit(1)).alias("trades")
    bars = _aggregate(
        placed, ["symbol", "bar_start_ns"], F.col("price"), seconds, wide_keys, (count,)
    )
    return bars.withColumn("range", F.col("high") - F.col("low"))


def daily_ranges(bars: DataFrame, tz: str) -> DataFrame:
    """High minus low of each local day."""
    day = local_date(F.col("bar_start_ns"), tz)
    return (
        bars.groupBy("symbol", day.alias("local_date"))
        .agg(F.max("high").alias("high"), F.min("low").alias("low"))
        .select("symbol", "local_date", (F.col("high") - F.col("low")).alias("day_range"))
    )
