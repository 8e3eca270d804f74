"""Reports on a raw scan, all rolled up from one grouped pass over it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom import schema as S
from tickloom.config import TapeConfig
from tickloom.functions.clock import NS, ns_to_iso
from tickloom.functions.prices import signed_volume
from tickloom.functions.sessions import (
    session_close_ns,
    session_id,
    session_open_ns,
    trading_date,
)
from tickloom.operators.quality import REASONS

_CELL = ("symbol", "session_id", "action", "side")
_NULL = "<NULL>"


def audit_cells(flags: DataFrame, cfg: TapeConfig) -> DataFrame:
    """One row per (symbol, session of a valid trade, action, side) with every audit measure.

    The only pass over the raw rows besides the ordering audit. It is a single aggregate with
    partial aggregation in the scan tasks, so a dominant symbol or session costs nothing extra;
    every other report reads this small table.
    """
    valid = F.col("valid_trade")
    day = trading_date(F.col("ts_event_ns"), cfg)
    size = F.col("size").cast("bigint")
    keyed = flags.withColumn("session_id", F.when(valid, session_id(day, cfg)))
    parsed = {"ts_event": "ts_event_ns", "ts_recv": "ts_recv_ns"}
    nulls = [
        F.count_if(F.col(parsed.get(c, c)).isNull()).alias(f"null_{c}") for c in S.MBO_SCANNED
    ]
    broken = [F.count_if(F.col(r)).alias(r) for r in REASONS]
    trade = lambda c: F.when(valid, c)
    return keyed.groupBy(*_CELL).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(valid).alias("valid_rows"),
        F.sum(trade(size)).alias("sum_size"),
        F.sum(trade(signed_volume(F.col("side"), size))).alias("sum_signed"),
        F.min(trade(F.col("price"))).alias("min_price"),
        F.max(trade(F.col("price"))).alias("max_price"),
        F.min(trade(size)).alias("min_size"),
        F.max(trade(size)).alias("max_size"),
        F.min("ts_event_ns").alias("min_ts_ns"),
        F.max("ts_event_ns").alias("max_ts_ns"),
        *nulls,
        *broken,
    )


def action_side_report(cells: DataFrame) -> DataFrame:
    """Row counts by action, by side and by both; nulls appear as ``<NULL>``."""
    named = cells.select(
        F.coalesce("action", F.lit(_NULL)).alias("action"),
        F.coalesce("side", F.lit(_NULL)).alias("side"),
        "rows",
    )
    return (
        named.groupingSets([["action"], ["side"], ["action", "side"]], "action", "side")
        .agg(F.sum("rows").alias("rows"), F.grouping_id().alias("_g"))
        .select(
            F.element_at(
                F.array(F.lit("action_side"), F.lit("action"), F.lit("side")),
                F.col("_g").cast("int") + 1,
            ).alias("grouping"),
            "action",
            "side",
            "rows",
        )
    )


def null_counts(cells: DataFrame) -> DataFrame:
    """Nulls per scanned column; an unreadable time counts as null."""
    total = cells.agg(*(F.coalesce(F.sum(f"null_{c}"), F.lit(0)).alias(c) for c in S.MBO_SCANNED))
    return total.unpivot([], list(S.MBO_SCANNED), "column_name", "nulls")


def rows_per_symbol(cells: DataFrame) -> DataFrame:
    name = F.coalesce("symbol", F.lit(_NULL)).alias("symbol")
    return cells.groupBy(name).agg(F.sum("rows").alias("rows"))


def invalid_counts(cells: DataFrame) -> DataFrame:
    """Rows per reason, from the cells; reasons that never occur are left out."""
    total = cells.agg(*(F.coalesce(F.sum(r), F.lit(0)).alias(r) for r in REASONS))
    return total.unpivot([], list(REASONS), "reason", "rows").filter("rows > 0")


def volume_report(cells: DataFrame) -> DataFrame:
    """Trade and fill totals, volume sums and ranges, as one row."""
    is_t, side_n = F.col("action") == "T", F.col("side") == "N"
    return cells.agg(
        _sum("rows").alias("total_rows"),
        _sum(F.when(is_t, F.col("rows"))).alias("total_t_rows"),
        _sum(F.when(F.col("action") == "F", F.col("rows"))).alias("total_f_rows"),
        _sum("valid_rows").alias("valid_t_rows"),
        _sum(F.when(side_n, F.col("valid_rows"))).alias("unknown_side_t_rows"),
        _sum("sum_size").alias("sum_t_size"),
        _sum("sum_signed").alias("sum_signed_volume"),
        F.min("min_price").alias("min_price"),
        F.max("max_price").alias("max_price"),
        F.min("min_size").alias("min_size"),
        F.max("max_size").alias("max_size"),
        _sum("invalid_tick_price").alias("invalid_tick_prices"),
        F.min("min_ts_ns").alias("min_ts_event_ns"),
        F.max("max_ts_ns").alias("max_ts_event_ns"),
    )


def timestamp_report(cells: DataFrame) -> DataFrame:
    """First and last event time and the unreadable times."""
    return cells.agg(
        ns_to_iso(F.min("min_ts_ns")).alias("min_ts_event"),
        ns_to_iso(F.max("max_ts_ns")).alias("max_ts_event"),
        _sum("invalid_ts_event").alias("invalid_ts_event"),
        _sum("invalid_ts_recv").alias("invalid_ts_recv"),
    )


def session_coverage(cells: DataFrame) -> DataFrame:
    """Rows and first and last time of each session of valid trades."""
    # Cells with valid rows are those with a session; asking for the count keeps the test above
    # the aggregate instead of repeating the session arithmetic in the scan's filter.
    return (
        cells.filter(F.col("valid_rows") > 0)
        .groupBy("session_id")
        .agg(
            F.sum("valid_rows").alias("rows"),
            F.min("min_ts_ns").alias("min_ts_ns"),
            F.max("max_ts_ns").alias("max_ts_ns"),
        )
    )


def partial_sessions(coverage: DataFrame, cfg: TapeConfig) -> DataFrame:
    """The first and last session when they start late or end early.

    Reads the coverage table only: one row per session, so the two edges come from one aggregate.
    """
    edges = coverage.agg(
        F.array_distinct(
            F.array(
                F.min(F.struct("session_id", "rows", "min_ts_ns", "max_ts_ns")),
                F.max(F.struct("session_id", "rows", "min_ts_ns", "max_ts_ns")),
            )
        ).alias("edges")
    ).select(F.inline("edges"))
    day = F.substring(F.col("session_id"), len(cfg.session_prefix) + 1, 10)
    slack = cfg.partial_session_tolerance_minutes * 60 * NS
    bounded = edges.select(
        "*",
        session_open_ns(day, cfg).alias("open_ns"),
        session_close_ns(day, cfg).alias("close_ns"),
    )
    late = F.col("min_ts_ns") > F.col("open_ns") + slack
    early = F.col("max_ts_ns") < F.col("close_ns") - slack
    return bounded.filter(late | early).select(
        "session_id",
        "rows",
        ns_to_iso(F.col("min_ts_ns")).alias("observed_min"),
        ns_to_iso(F.col("max_ts_ns")).alias("observed_max"),
        ns_to_iso(F.col("open_ns")).alias("expected_open"),
        ns_to_iso(F.col("close_ns")).alias("expected_close"),
        F.lit(True).alias("potentially_partial"),
    )


def _sum(col) -> Column:
    return F.coalesce(F.sum(col), F.lit(0))
