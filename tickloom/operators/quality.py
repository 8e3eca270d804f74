"""Row quality: which rows are trades, which are broken and why."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom import schema as S
from tickloom.config import TapeConfig
from tickloom.errors import QualityError
from tickloom.functions.clock import epoch_ns, ns_to_iso, ns_to_ts
from tickloom.functions.prices import (
    finite_positive,
    on_tick,
    signed_volume,
    tick_aligned,
    unknown_aggressor,
)
from tickloom.functions.sessions import is_rth, session_id, session_segment, trading_date

# Names of the reasons.
REASONS = (
    "invalid_action",
    "invalid_side",
    "invalid_ts_event",
    "invalid_ts_recv",
    "invalid_sequence",
    "invalid_price",
    "invalid_size",
    "invalid_symbol",
    "invalid_tick_price",
)


def _true(condition):
    return F.coalesce(condition, F.lit(False))


def quality_flags(df: DataFrame, cfg: TapeConfig) -> DataFrame:
    """Raw rows with parsed times, one flag per reason, ``reasons``, ``trade_scope`` and
    ``valid_trade``.

    Stateless: one projection over the scan. Action, side, time and sequence are judged on every
    row, the rest only on trades of the wanted symbols. ``valid_trade`` is one conjunction
    that compiles into the scan stage; the array of reasons is built only where it is used.
    """
    symbol = F.col("symbol")
    wanted = _true(symbol.isin(*cfg.symbol_filters)) if cfg.symbol_filters else F.lit(True)
    base = df.withColumns(
        {
            "ts_event_ns": epoch_ns(df, "ts_event"),
            "ts_recv_ns": epoch_ns(df, "ts_recv"),
            "trade_scope": _true(F.col("action") == "T") & wanted,
        }
    )
    scope, price = F.col("trade_scope"), F.col("price")
    everywhere = {
        "invalid_action": _true(F.col("action").isin(*S.ACTIONS)),
        "invalid_side": _true(F.col("side").isin(*S.SIDES)),
        "invalid_ts_event": F.col("ts_event_ns").isNotNull(),
        "invalid_ts_recv": F.col("ts_recv_ns").isNotNull(),
        "invalid_sequence": F.col("sequence").isNotNull(),
    }
    in_scope = {
        "invalid_price": finite_positive(price),
        "invalid_size": _true(F.col("size") > 0),
        "invalid_symbol": _true(symbol != ""),
        "invalid_tick_price": tick_aligned(price, cfg.tick_size),
    }
    flagged = {name: ~ok for name, ok in everywhere.items()}
    flagged |= {name: scope & ~ok for name, ok in in_scope.items()}
    # A bad price is a bad tick as well; a row's validity need not ask twice.
    flagged["invalid_tick_price"] = scope & ~on_tick(price, cfg.tick_size)
    sound = reduce(and_, [*everywhere.values(), *in_scope.values()], scope)
    named = F.array(*(F.when(F.col(r), F.lit(r)) for r in REASONS))
    return base.withColumns({**flagged, "valid_trade": sound}).withColumn(
        "reasons", F.array_compact(named)
    )


def quarantine_rows(flags: DataFrame) -> DataFrame:
    """Trades in scope that are not valid, with their sorted reasons in one text."""
    rejected = flags.filter(F.col("trade_scope") & ~F.col("valid_trade"))
    return S.conform(
        rejected.select(
            F.array_join(F.sort_array("reasons"), ",").alias("rejection_reason"),
            "source_row_number",
            ns_to_iso(F.col("ts_event_ns")).alias("ts_event"),
            ns_to_iso(F.col("ts_recv_ns")).alias("ts_recv"),
            "sequence",
            "publisher_id",
            "instrument_id",
            "symbol",
            "action",
            "side",
            "price",
            "size",
        ),
        S.QUARANTINE,
    )


def reason_counts(flags: DataFrame) -> DataFrame:
    """Rows per reason; reasons that never occur are left out."""
    total = flags.agg(*(F.count_if(F.col(r)).alias(r) for r in REASONS))
    return total.unpivot([], list(REASONS), "reason", "rows").filter("rows > 0")


def canonical_trades(flags: DataFrame, cfg: TapeConfig) -> DataFrame:
    """Valid trades in the tape's columns."""
    ns, side = F.col("ts_event_ns"), F.col("side")
    day = trading_date(ns, cfg)
    size = F.col("size").cast("bigint")
    valid = flags.filter("valid_trade")
    return S.conform(
        valid.select(
            ns_to_ts(ns).alias("ts_event"),
            "ts_event_ns",
            ns_to_ts(F.col("ts_recv_ns")).alias("ts_recv"),
            "ts_recv_ns",
            "sequence",
            "publisher_id",
            "instrument_id",
            "symbol",
            "price",
            size.alias("size"),
            side.alias("aggressor_side"),
            signed_volume(side, size).alias("signed_volume"),
            unknown_aggressor(side).alias("unknown_aggressor"),
            day.alias("trading_date"),
            session_id(day, cfg).alias("session_id"),
            session_segment(ns, cfg).alias("session_segment"),
            is_rth(ns, cfg).alias("is_rth"),
            "source_row_number",
        ),
        S.TAPE,
    )


def enforce_policy(reasons: DataFrame, ordering: DataFrame, cfg: TapeConfig) -> None:
    """Under *fail*, raise when any reason or ordering anomaly was counted.

    Both inputs are small reports (``reason_counts`` has at most nine rows, ``ordering_report``
    one). Under *quarantine* and *warn* nothing is raised.
    """
    if cfg.invalid_row_policy != "fail":
        return
    bad = {r["reason"]: r["rows"] for r in reasons.collect()}
    if bad:
        raise QualityError(f"rows break the quality rules: {bad}")
    anomalies = ordering.first()["ordering_anomalies"]
    if anomalies:
        raise QualityError(f"rows out of causal order: {anomalies}")
