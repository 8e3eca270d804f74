"""Prices, sizes and ids as column functions.

Prices travel as DOUBLE; arithmetic that decides something runs on DECIMAL(18,8), which a cast
fills from the shortest decimal text of the double.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

_ROUNDERS = {"half_up": lambda c: F.round(c, 0), "up": F.ceil, "down": F.floor}


def dec(price: Column) -> Column:
    return price.cast("decimal(18,8)")


def tick_scale(tick: Decimal) -> int:
    """Decimal places that a multiple of ``tick`` is written with."""
    return max(0, -tick.as_tuple().exponent)


def round_to_tick(price: Column, tick: Decimal, mode: str = "half_up") -> Column:
    """Nearest tick (ties away from zero), next tick up or next tick down, as a DECIMAL."""
    ticks = _ROUNDERS[mode](price.cast("decimal(20,10)") / F.lit(tick))
    return (ticks.cast("decimal(18,0)") * F.lit(tick)).cast(f"decimal(18,{tick_scale(tick)})")


def on_tick(price: Column, tick: Decimal) -> Column:
    """Finite, positive and within 1e-9 ticks of a multiple; false for null."""
    return finite_positive(price) & tick_aligned(price, tick)


def tick_aligned(price: Column, tick: Decimal) -> Column:
    """Within 1e-9 ticks of a multiple; false for null, NaN and infinity."""
    scaled = price * F.lit(float(1 / tick))
    return F.coalesce(F.abs(scaled - F.rint(scaled)) <= 1e-9, F.lit(False))


def finite_positive(price: Column) -> Column:
    """Above zero and below infinity, which NaN is not either; false for null."""
    return F.coalesce((price > 0) & (price < F.lit(float("inf"))), F.lit(False))


def signed_volume(side: Column, size: Column) -> Column:
    """Buyers count up, sellers down, anything else nothing."""
    return (
        F.when(side == "B", size).when(side == "A", -size).otherwise(F.lit(0)).cast("bigint")
    )


def unknown_aggressor(side: Column) -> Column:
    return F.coalesce(side == "N", F.lit(False))


def price_text(price: Column) -> Column:
    """Shortest plain decimal text with at least one decimal place: ``100.0``, ``17432.25``."""
    plain = F.rtrim(price.cast("decimal(28,10)").cast("string"), F.lit("0"))
    return F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)


def stable_id(*parts: Column, prefix: str = "", length: int = 64) -> Column:
    """``prefix`` and the first ``length`` hex digits of the SHA-256 of the joined parts."""
    digest = F.sha2(F.concat_ws("|", *parts), 256)
    return F.concat(F.lit(prefix), F.left(digest, F.lit(length)))


def zone_mid(low: Column, high: Column) -> Column:
    return (low + high) / 2


def overlaps_zone(high: Column, low: Column, zone_low: Column, zone_high: Column) -> Column:
    return (high >= zone_low) & (low <= zone_high)


def barrier_geometry(side: Column, entry: Column, stop: Column, target: Column) -> Column:
    """Stop and target lie on the right sides of the entry."""
    return F.when(side == "LONG", (stop < entry) & (entry < target)).otherwise(
        (target < entry) & (entry < stop)
    )


def contracts(
    equity: Column,
    day_equity: Column,
    daily_loss: Column,
    risk_points: Column,
    risk_pct: Column,
    *,
    point_value: float,
    cost: float,
    slip: float,
    margin: float,
    daily_limit: float,
    safety: float,
) -> Column:
    """Whole contracts that both the risk budget and the margin allow."""
    room = F.lit(daily_limit) - daily_loss
    cash = F.least(equity * risk_pct, room * day_equity * safety)
    per_contract = risk_points * point_value + cost + slip
    usable = (equity > 0) & (day_equity > 0) & (risk_points > 0) & (room > 0) & (cash > 0)
    size = F.least(F.floor(cash / per_contract), F.floor(equity / margin))
    return F.when(usable & (per_contract > 0), size).otherwise(F.lit(0)).cast("bigint")
