"""Exchange sessions and market hours as column functions of an epoch-ns column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickloom.config import TapeConfig, clock_seconds
from tickloom.functions.clock import (
    DAY,
    DAY_US,
    day_number,
    local_us,
    ns_from_local,
    seconds_of_day,
)

# Fixed value: seconds of the day at which the skipped bar starts, 09:30.
OPEN_BAR = 9 * 3600 + 30 * 60


def trading_date(ns: Column, cfg: TapeConfig) -> Column:
    """Local date, moved to the next day from the session start on; '' for a null time."""
    to_midnight = (DAY - clock_seconds(cfg.session_start)) * 1_000_000
    day = day_number(local_us(ns, cfg.exchange_timezone) + to_midnight)
    return F.coalesce(F.date_from_unix_date(day).cast("string"), F.lit(""))


def session_id(date_text: Column, cfg: TapeConfig) -> Column:
    """Session name of a trading date; '' stays ''."""
    return F.when(date_text == "", F.lit("")).otherwise(
        F.concat(F.lit(cfg.session_prefix), date_text)
    )


def is_rth(ns: Column, cfg: TapeConfig) -> Column:
    """Inside regular trading hours, end excluded; false for a null time."""
    clock = seconds_of_day(local_us(ns, cfg.exchange_timezone))
    inside = (clock >= clock_seconds(cfg.rth_start)) & (clock < clock_seconds(cfg.rth_end))
    return F.coalesce(inside, F.lit(False))


def session_segment(ns: Column, cfg: TapeConfig) -> Column:
    return (
        F.when(ns.isNull(), F.lit("UNKNOWN"))
        .when(is_rth(ns, cfg), F.lit("RTH"))
        .otherwise(F.lit("OVERNIGHT"))
    )


def session_open_ns(date_text: Column, cfg: TapeConfig) -> Column:
    """UTC ns of the session start, on the evening before the trading date."""
    return _local_clock(F.unix_date(date_text.cast("date")) - 1, cfg.session_start, cfg)


def session_close_ns(date_text: Column, cfg: TapeConfig) -> Column:
    return _local_clock(F.unix_date(date_text.cast("date")), cfg.session_end, cfg)


def _local_clock(day: Column, text: str, cfg: TapeConfig) -> Column:
    us = day.cast("bigint") * DAY_US + clock_seconds(text) * 1_000_000
    return ns_from_local(us, cfg.exchange_timezone)


def in_market_hours(
    ns: Column, tz: str, first_hour: int = 3, last_hour: int = 16, skip_open_bar: bool = True
) -> Column:
    """first_hour <= local hour < last_hour, without the bar that starts at 09:30."""
    clock = seconds_of_day(local_us(ns, tz))
    inside = (clock >= first_hour * 3600) & (clock < last_hour * 3600)
    if skip_open_bar:
        inside = inside & ~clock.between(OPEN_BAR, OPEN_BAR + 59)
    return inside
