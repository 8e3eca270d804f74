"""Setup candidates from bars."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom import schema as S
from tickloom.config import GapSetupConfig, IndicatorSetupConfig
from tickloom.functions.clock import NS, ns_to_offset_iso, ns_to_ts
from tickloom.functions.prices import dec, overlaps_zone, round_to_tick, stable_id
from tickloom.operators.blocks import numbered, own_rows, with_halo
from tickloom.operators.gaps import gap_zones
from tickloom.operators.indicators import atr, effort_ratios, macd, rsi, with_entry_bar
from tickloom.operators.matching import greedy_match


def _targets(entry: Column, risk: Column, up: Column, ratios, tick: Decimal) -> dict[str, Column]:
    out = {}
    for i, r in enumerate(ratios, 1):
        move = risk * F.lit(r)
        out[f"target_{i}"] = round_to_tick(F.when(up, entry + move).otherwise(entry - move), tick)
    return out


def failed_gap_pairs(zone_bars: DataFrame, signal_bars: DataFrame, cfg: GapSetupConfig) -> DataFrame:
    """Every (signal bar, zone) that passes all tests which do not depend on zone use."""
    blocked = with_halo(numbered(signal_bars), max(cfg.range_window, cfg.volume_window), 1)
    bars = own_rows(
        with_entry_bar(
            effort_ratios(blocked, cfg.range_window, cfg.volume_window), cfg.signal_bar_seconds
        )
    )
    # Gates on exact sums: ratio > mult  <=>  value * n > mult * sum.
    effort = (
        F.col("effort_range_ratio").isNotNull()
        & (F.col("bar_range") * cfg.range_window > F.col("range_sum") * F.lit(cfg.effort_range_mult))
        & (F.col("volume") * cfg.volume_window > F.col("volume_sum") * F.lit(cfg.effort_volume_mult))
    )
    signals = bars.filter(
        F.col("entry_ns").isNotNull()
        & (F.col("bar_no") >= max(cfg.range_window, cfg.volume_window))
        & effort
    ).withColumnRenamed("bar_start_ns", "signal_ns")
    zones = gap_zones(zone_bars, cfg.zone_bar_seconds)
    age = F.col("signal_ns") - F.col("available_ns")
    pairs = signals.join(zones, ["symbol", "session_id"]).filter(
        age.between(0, cfg.zone_window_seconds * NS)
        & overlaps_zone(F.col("high"), F.col("low"), F.col("zone_low"), F.col("zone_high"))
    )
    bull = F.col("kind") == "BULL"
    failed = F.when(bull, F.col("close") < F.col("zone_high")).otherwise(
        F.col("close") > F.col("zone_low")
    )
    tick = cfg.tick_size
    buffer = F.lit(tick * cfg.stop_buffer_ticks)
    stop = F.when(bull, round_to_tick(dec(F.col("high")) + buffer, tick, "up")).otherwise(
        round_to_tick(dec(F.col("low")) - buffer, tick, "down")
    )
    priced = pairs.filter(failed).withColumns(
        {"entry": round_to_tick(dec(F.col("entry_open")), tick), "stop": stop}
    )
    risk = F.when(bull, F.col("stop") - F.col("entry")).otherwise(F.col("entry") - F.col("stop"))
    return priced.withColumn("risk", risk).filter(F.col("risk") > 0)


def failed_gap_candidates(
    zone_bars: DataFrame, signal_bars: DataFrame, cfg: GapSetupConfig
) -> DataFrame:
    """Setups against a gap that price went back through with effort but without result."""
    pairs = failed_gap_pairs(zone_bars, signal_bars, cfg)
    used = greedy_match(pairs, ["symbol", "session_id"], "signal_ns", "zone_id", "available_ns")
    bull = F.col("kind") == "BULL"
    side = F.when(bull, "SHORT").otherwise("LONG")
    signal_ts = ns_to_ts(F.col("signal_ns"))
    setup_id = stable_id(
        F.lit(cfg.setup_version),
        F.col("zone_id"),
        ns_to_offset_iso(F.col("signal_ns")),
        side,
        F.col("entry").cast("string"),
        prefix="setup_",
        length=16,
    )
    targets = _targets(F.col("entry"), F.col("risk"), ~bull, cfg.take_profit_r, cfg.tick_size)
    # Setup types and reason codes.
    reasons = F.array(
        F.when(bull, "FAILED_BULL_FVG_SHORT").otherwise("FAILED_BEAR_FVG_LONG"),
        F.lit("FVG_OVERLAP_CONFIRMED"),
        F.lit("EFFORT_WITHOUT_RESULT"),
    )
    return S.conform(
        used.select(
            setup_id.alias("setup_id"),
            signal_ts.alias("ts_event"),
            "symbol",
            F.col("session_id").alias("cme_session_id"),
            F.when(bull, "FAILED_BULL_FVG").otherwise("FAILED_BEAR_FVG").alias("setup_type"),
            side.alias("entry_side"),
            F.col("zone_mid").alias("reference_level"),
            F.col("entry").alias("entry_price"),
            ns_to_ts(F.col("entry_ns")).alias("entry_timestamp"),
            F.when(bull, F.col("high")).otherwise(F.col("low")).alias("structural_invalidation"),
            F.col("stop").alias("stop_price"),
            *(c.alias(n) for n, c in targets.items()),
            F.lit(cfg.max_holding_bars).alias("max_holding_bars"),
            F.lit(cfg.max_holding_bars * cfg.signal_bar_seconds).alias("max_holding_seconds"),
            reasons.alias("reason_codes"),
            signal_ts.alias("feature_timestamp"),
            F.lit(cfg.setup_version).alias("setup_version"),
            F.col("zone_id").alias("fvg_id"),
            F.col("zone_low").alias("fvg_low"),
            F.col("zone_high").alias("fvg_high"),
            "effort_range_ratio",
            "effort_volume_ratio",
        ),
        S.CANDIDATE,
    )


def indicator_side(rsi_value: Column, line: Column, signal: Column) -> Column:
    """LONG or SHORT when RSI and both MACD tests agree, else null."""
    return F.when((rsi_value > 50) & (line > signal) & (line > 0), "LONG").when(
        (rsi_value < 50) & (line < signal) & (line < 0), "SHORT"
    )


def atr_reason(mult: Decimal) -> str:
    return f"QEP_ATR_STOP_{mult.normalize()}X"


def indicator_candidates(bars: DataFrame, cfg: IndicatorSetupConfig) -> DataFrame:
    """Setups in the direction of RSI and MACD with a stop some ATRs away."""
    n, tick = cfg.atr_window, cfg.tick_size
    blocked = with_halo(numbered(bars), max(cfg.rsi_period, n), 1)
    based = own_rows(atr(rsi(with_entry_bar(blocked, cfg.bar_seconds), cfg.rsi_period), n))
    rated = macd(based, cfg.macd_fast, cfg.macd_slow, cfg.macd_signal)
    line, trigger = F.round("macd", 9), F.round("macd_signal", 9)
    sided = rated.withColumn("side", indicator_side(F.round("rsi", 9), line, trigger)).filter(
        (F.col("bar_no") >= cfg.warmup)
        & F.col("entry_ns").isNotNull()
        & F.col("atr").isNotNull()
        & F.col("side").isNotNull()
    )
    long = F.col("side") == "LONG"
    entry = round_to_tick(dec(F.col("entry_open")), tick)
    distance = F.col("true_range_sum") * F.lit(cfg.atr_stop_mult) / F.lit(n) + F.lit(
        tick * cfg.stop_buffer_ticks
    )
    distance = distance.cast("decimal(24,12)")
    stop = F.when(long, round_to_tick(F.col("entry") - distance, tick, "down")).otherwise(
        round_to_tick(F.col("entry") + distance, tick, "up")
    )
    priced = (
        sided.withColumn("entry", entry)
        .withColumn("stop", stop)
        .withColumn("risk", F.abs(F.col("entry") - F.col("stop")))
        .filter(F.when(long, F.col("entry") > F.col("stop")).otherwise(F.col("stop") > F.col("entry")))
    )
    signal_ts = ns_to_ts(F.col("bar_start_ns"))
    setup_id = stable_id(
        F.lit(cfg.setup_version),
        ns_to_offset_iso(F.col("bar_start_ns")),
        F.col("side"),
        F.col("entry").cast("string"),
    )
    targets = _targets(F.col("entry"), F.col("risk"), long, cfg.take_profit_r, tick)
    # Setup type, reason codes and the mark for "no zone".
    reasons = F.array(
        F.when(long, "QEP_RSI_ABOVE_50").otherwise("QEP_RSI_BELOW_50"),
        F.when(long, "QEP_MACD_BULLISH_POSITIVE").otherwise("QEP_MACD_BEARISH_NEGATIVE"),
        F.lit(atr_reason(cfg.atr_stop_mult)),
    )
    return S.conform(
        priced.select(
            setup_id.alias("setup_id"),
            signal_ts.alias("ts_event"),
            "symbol",
            F.col("session_id").alias("cme_session_id"),
            F.lit("QEP_TECHNICAL").alias("setup_type"),
            F.col("side").alias("entry_side"),
            F.col("close").alias("reference_level"),
            F.col("entry").alias("entry_price"),
            ns_to_ts(F.col("entry_ns")).alias("entry_timestamp"),
            F.col("stop").alias("structural_invalidation"),
            F.col("stop").alias("stop_price"),
            *(c.alias(k) for k, c in targets.items()),
            F.lit(cfg.max_holding_bars).alias("max_holding_bars"),
            F.lit(cfg.max_holding_bars * cfg.bar_seconds).alias("max_holding_seconds"),
            reasons.alias("reason_codes"),
            signal_ts.alias("feature_timestamp"),
            F.lit(cfg.setup_version).alias("setup_version"),
            F.lit("QEP_TECHNICAL_NA").alias("fvg_id"),
            F.col("low").alias("fvg_low"),
            F.col("high").alias("fvg_high"),
            ((F.col("high") - F.col("low")) / F.col("atr")).alias("effort_range_ratio"),
            F.lit(0.0).alias("effort_volume_ratio"),
        ),
        S.CANDIDATE,
    )
