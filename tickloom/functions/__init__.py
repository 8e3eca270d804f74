"""Column functions."""

from tickloom.functions.clock import (
    bucket_start,
    epoch_ns,
    local_date,
    local_us,
    month_label,
    ns_to_iso,
    ns_to_offset_iso,
    ns_to_ts,
    parse_utc_ns,
)
from tickloom.functions.ordering_keys import causal_key, guard_nulls
from tickloom.functions.prices import (
    barrier_geometry,
    contracts,
    on_tick,
    overlaps_zone,
    price_text,
    round_to_tick,
    signed_volume,
    stable_id,
    unknown_aggressor,
    zone_mid,
)
from tickloom.functions.sessions import (
    in_market_hours,
    is_rth,
    session_close_ns,
    session_id,
    session_open_ns,
    session_segment,
    trading_date,
)

__all__ = [name for name in dir() if not name.startswith("_")]
