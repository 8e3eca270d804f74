"""Regime-aware study of failed gaps on bars, at fixed size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.config import StudyConfig
from tickloom.functions.clock import NS, local_date
from tickloom.functions.prices import contracts, overlaps_zone
from tickloom.functions.sessions import in_market_hours
from tickloom.operators.bars import daily_ranges
from tickloom.operators.blocks import numbered, own_rows, with_halo
from tickloom.operators.gaps import gap_zones
from tickloom.operators.indicators import effort_ratios, with_entry_bar
from tickloom.operators.matching import greedy_match


def volatility_regimes(bars: DataFrame, cfg: StudyConfig) -> DataFrame:
    """Regime of each local day from the day before against the median of the days before it.

    One row per symbol and day goes through the window.
    """
    w = Window.partitionBy("symbol").orderBy("local_date")
    frame = w.rowsBetween(-cfg.lookback_days, -1)
    base = F.percentile("day_range", F.lit(0.5)).over(frame)
    ratio = F.when(F.col("_base") > 0, F.col("_prior") / F.col("_base"))
    return (
        daily_ranges(bars, cfg.market_tz)
        .select(
            "symbol",
            "local_date",
            F.lag("day_range").over(w).alias("_prior"),
            base.alias("_base"),
        )
        .withColumn("volatility_ratio", ratio)
        .select(
            "symbol",
            "local_date",
            F.when(F.col("volatility_ratio") <= cfg.low_ratio, "LOW")
            .when(F.col("volatility_ratio") >= cfg.high_ratio, "HIGH")
            .otherwise("NORMAL")
            .alias("regime"),
            "volatility_ratio",
        )
    )


def _by_regime(cfg: StudyConfig, field: str) -> Column:
    """A parameter of the row's regime; three literals, so no join."""
    low, normal, high = (getattr(cfg.regime(n), field) for n in ("LOW", "NORMAL", "HIGH"))
    return (
        F.when(F.col("regime") == "LOW", F.lit(low))
        .when(F.col("regime") == "HIGH", F.lit(high))
        .otherwise(F.lit(normal))
    )


def with_regime(bars: DataFrame, regimes: DataFrame | None, cfg: StudyConfig) -> DataFrame:
    """Regime of the bar's local day; NORMAL where none is known or regimes are off."""
    dated = bars.withColumn("local_date", local_date(F.col("bar_start_ns"), cfg.market_tz))
    if regimes is None:
        out = dated.withColumns(
            {"regime": F.lit("NORMAL"), "volatility_ratio": F.lit(None).cast("double")}
        )
    else:
        out = dated.join(regimes, ["symbol", "local_date"], "left").withColumn(
            "regime", F.coalesce("regime", F.lit("NORMAL"))
        )
    fields = (
        "window_min",
        "range_mult",
        "volume_mult",
        "stop_buffer",
        "take_profit_r",
        "max_hold_bars",
        "risk_pct",
    )
    return out.withColumns({f"regime_{f}": _by_regime(cfg, f) for f in fields})


def study_bars(bars: DataFrame, cfg: StudyConfig) -> DataFrame:
    """Signal bars with baselines, number, regime, entry bar and whether they may signal."""
    regimes = volatility_regimes(bars, cfg) if cfg.use_regimes else None
    n = cfg.baseline_bars
    blocked = with_halo(numbered(bars), n, 1)
    rated = own_rows(with_entry_bar(effort_ratios(blocked, n, n, strict=False), cfg.signal_bar_seconds))
    hours = in_market_hours(
        F.col("bar_start_ns"), cfg.market_tz, cfg.first_hour, cfg.last_hour, cfg.skip_open_bar
    )
    open_bar = hours & (F.col("bar_no") >= n) & ~F.col("is_last")
    return with_regime(rated, regimes, cfg).withColumns(
        {
            "may_signal": open_bar & F.col("entry_ns").isNotNull(),
            "missing_entry": open_bar & F.col("entry_ns").isNull(),
        }
    )


def regime_signals(zone_bars: DataFrame, rated: DataFrame, cfg: StudyConfig) -> DataFrame:
    """Signals that took a zone or met one they could not trade (``tradable`` false).

    Zones and signals meet through an equi-join on symbol and two-hour slots of time: a zone is
    copied to each slot its longest window reaches, so a symbol's zones never meet all its bars.
    """
    slot = 7200 * NS
    reach = max(r.window_min for r in cfg.regimes) * 60 * NS
    zones = gap_zones(zone_bars, cfg.zone_bar_seconds, session_scoped=False)
    first = F.col("available_ns") - F.pmod("available_ns", F.lit(slot))
    last = F.col("available_ns") + reach
    zones = zones.withColumn("slot", F.explode(F.sequence(first, last - F.pmod(last, F.lit(slot)), F.lit(slot))))
    effort = (
        F.col("may_signal")
        & (F.col("bar_range") > 0)
        & (F.col("effort_range_ratio") > F.col("regime_range_mult"))
        & (F.col("effort_volume_ratio") > F.col("regime_volume_mult"))
    )
    signals = (
        rated.filter(effort)
        .withColumnRenamed("bar_start_ns", "signal_ns")
        .withColumn("slot", F.col("signal_ns") - F.pmod("signal_ns", F.lit(slot)))
    )
    age = F.col("signal_ns") - F.col("available_ns")
    bull = F.col("kind") == "BULL"
    failed = F.when(bull, F.col("close") < F.col("zone_high")).otherwise(
        F.col("close") > F.col("zone_low")
    )
    pairs = signals.join(zones, ["symbol", "slot"]).filter(
        age.between(F.lit(0), F.col("regime_window_min").cast("bigint") * 60 * NS)
        & overlaps_zone(F.col("high"), F.col("low"), F.col("zone_low"), F.col("zone_high"))
        & failed
    )
    stop = F.when(bull, F.col("high") + F.col("regime_stop_buffer")).otherwise(
        F.col("low") - F.col("regime_stop_buffer")
    )
    entry = F.col("entry_open")
    priced = pairs.withColumn("stop", stop).withColumns(
        {
            "direction": F.when(bull, "SHORT").otherwise("LONG"),
            "risk_points": F.when(bull, F.col("stop") - entry).otherwise(entry - F.col("stop")),
            "close_vs_mid": F.col("close") - F.col("zone_mid"),
            "close_vs_zone": F.col("close")
            - F.when(bull, F.col("zone_high")).otherwise(F.col("zone_low")),
        }
    )
    if cfg.contracts is None:
        size = contracts(
            F.lit(cfg.initial),
            F.lit(cfg.initial),
            F.lit(0.0),
            F.col("risk_points"),
            F.col("regime_risk_pct"),
            point_value=cfg.point_value,
            cost=cfg.cost,
            slip=cfg.slip,
            margin=cfg.margin,
            daily_limit=cfg.daily_loss_limit,
            safety=cfg.daily_safety,
        )
    else:
        size = F.lit(cfg.contracts).cast("bigint")
    sized = priced.withColumn("contracts", size).withColumn(
        "tradable", (F.col("risk_points") > 0) & (F.col("contracts") > 0)
    )
    return greedy_match(
        sized, ["symbol", "local_date"], "signal_ns", "formed_ns", "available_ns", "tradable"
    )


def bar_barrier_outcomes(signals: DataFrame, bars: DataFrame, cfg: StudyConfig) -> DataFrame:
    """First bar of the holding window that reaches stop (wins ties) or target, else time out.

    A signal asks for its bars by number, so the window is an equi-join on (symbol, bar number).
    """
    short = F.col("direction") == "SHORT"
    target = F.when(
        short, F.col("entry_open") - F.col("risk_points") * F.col("regime_take_profit_r")
    ).otherwise(F.col("entry_open") + F.col("risk_points") * F.col("regime_take_profit_r"))
    asked = signals.withColumn("target", target)
    first = F.col("bar_no") + 1
    wanted = asked.select(
        "symbol",
        "signal_ns",
        "direction",
        "stop",
        "target",
        F.explode(F.sequence(first, first + F.col("regime_max_hold_bars") - 1)).alias("hold_no"),
    )
    held = bars.select(
        "symbol",
        F.col("bar_no").alias("hold_no"),
        F.col("bar_start_ns").alias("hold_ns"),
        F.col("high").alias("hold_high"),
        F.col("low").alias("hold_low"),
        F.col("close").alias("hold_close"),
    )
    hit_stop = F.when(short, F.col("hold_high") >= F.col("stop")).otherwise(
        F.col("hold_low") <= F.col("stop")
    )
    hit_target = F.when(short, F.col("hold_low") <= F.col("target")).otherwise(
        F.col("hold_high") >= F.col("target")
    )
    hit_no = F.when(hit_stop | hit_target, F.col("hold_no"))
    exits = (
        wanted.join(held, ["symbol", "hold_no"])
        .groupBy("symbol", "signal_ns")
        .agg(
            F.min_by(hit_stop, hit_no).alias("_stopped"),
            F.min_by("hold_ns", hit_no).alias("_hit_ns"),
            F.max_by("hold_close", "hold_no").alias("_last_close"),
            F.max("hold_ns").alias("_last_ns"),
        )
    )
    # Outcome names.
    status = (
        F.when(F.col("_hit_ns").isNull(), "TIME_OUT")
        .when(F.col("_stopped"), "STOP_LOSS")
        .otherwise("TAKE_PROFIT")
    )
    exit_price = (
        F.when(F.col("status") == "STOP_LOSS", F.col("stop"))
        .when(F.col("status") == "TAKE_PROFIT", F.col("target"))
        .otherwise(F.col("_last_close"))
    )
    done = (
        asked.join(exits, ["symbol", "signal_ns"])
        .withColumn("status", status)
        .withColumn("exit_price", exit_price)
    )
    points = F.when(short, F.col("entry_open") - F.col("exit_price")).otherwise(
        F.col("exit_price") - F.col("entry_open")
    )
    pnl = F.col("contracts") * (F.col("points") * cfg.point_value - (cfg.cost + cfg.slip))
    return (
        done.withColumn("exit_ns", F.coalesce("_hit_ns", "_last_ns"))
        .withColumn("points", points)
        .withColumn("pnl", pnl)
        .drop("_stopped", "_hit_ns", "_last_close", "_last_ns")
    )


def equity_curve(trades: DataFrame, cfg: StudyConfig) -> DataFrame:
    """Running balance, peak and drawdown, and the loss since the day's first balance.

    ``trades`` has symbol, month, entry_ns and pnl; a window holds one symbol's month of trades.
    """
    order = Window.partitionBy("symbol", "month").orderBy("entry_ns")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    day = Window.partitionBy("symbol", "month", "entry_date").orderBy("entry_ns")
    so_far = day.rowsBetween(Window.unboundedPreceding, 0)
    dated = trades.withColumn("entry_date", local_date(F.col("entry_ns"), cfg.market_tz))
    run = dated.withColumn("balance", cfg.initial + F.sum("pnl").over(upto))
    run = run.withColumns(
        {
            "peak": F.greatest(F.lit(cfg.initial), F.max("balance").over(upto)),
            "_day_start": F.first(F.col("balance") - F.col("pnl")).over(so_far),
        }
    )
    return run.withColumns(
        {
            "drawdown": F.col("peak") - F.col("balance"),
            "daily_loss": F.greatest(
                F.lit(0.0), (F.col("_day_start") - F.col("balance")) / F.col("_day_start")
            ),
        }
    ).drop("_day_start")


def trade_summary(
    curve: DataFrame, skipped: DataFrame, cfg: StudyConfig
) -> DataFrame:
    """One row per symbol and month: results from the curve, skip counts beside them."""
    won = F.col("pnl") > 0
    n = F.count(F.lit(1))
    done = curve.groupBy("symbol", "month").agg(
        n.alias("trades"),
        F.count_if(won).alias("wins"),
        F.count_if(~won).alias("losses"),
        F.round(F.count_if(won) / n * 100, 2).alias("win_rate"),
        F.round(F.sum("pnl"), 2).alias("net_pnl"),
        F.round(F.sum("pnl") / cfg.initial * 100, 2).alias("return_pct"),
        F.round(F.max("drawdown") / F.max("peak") * 100, 2).alias("max_drawdown_pct"),
        F.round(F.max("daily_loss") * 100, 2).alias("max_daily_dd_pct"),
        F.count_if(F.col("regime") == "LOW").alias("low_vol_trades"),
        F.count_if(F.col("regime") == "NORMAL").alias("normal_vol_trades"),
        F.count_if(F.col("regime") == "HIGH").alias("high_vol_trades"),
    )
    both = skipped.join(done, ["symbol", "month"], "left")
    counts = ("trades", "wins", "losses", "low_vol_trades", "normal_vol_trades", "high_vol_trades")
    rates = ("win_rate", "net_pnl", "return_pct", "max_drawdown_pct", "max_daily_dd_pct")
    return both.fillna(0, list(counts)).fillna(0.0, list(rates))
