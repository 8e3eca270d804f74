"""Registered queries: each operator over the whole ``events`` table seen as market data."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom import functions as fn
from tickloom import schema as S
from tickloom.config import (
    ExecutionConfig,
    GapSetupConfig,
    IndicatorSetupConfig,
    StudyConfig,
    TapeConfig,
)
from tickloom.errors import QualityError
from tickloom.functions.clock import month_label
from tickloom.functions.prices import dec
from tickloom.operators import audit as A
from tickloom.operators import bars as B
from tickloom.operators import gaps as G
from tickloom.operators import indicators as I
from tickloom.operators import labels as L
from tickloom.operators import quality as Q
from tickloom.operators import reports as R
from tickloom.operators import study as ST
from tickloom.operators.ordering import ordering_report
from tickloom.operators.tape import tape_totals, validate_tape
from tickloom.plans import jobs as J
from tickloom.sources import readers, writers
from tickloom.sources.events import dirty_view, mbo_view, raw_files, read_events, spoiled_view, tape_view
from tickloom.streaming.tape import stream_tape, stored_cells

CLEAN = TapeConfig()
DIRTY = TapeConfig(invalid_row_policy="quarantine", overwrite=True)
SCOPED = TapeConfig(symbol_filters=("S0", "S2"), invalid_row_policy="warn")
GAP = GapSetupConfig(range_window=3, volume_window=3)
TECH = IndicatorSetupConfig()
FILLS = ExecutionConfig(
    commission_per_side=Decimal("0.62"),
    entry_slippage_ticks=1,
    stop_slippage_ticks=1,
    time_exit_slippage_ticks=2,
    entry_latency_seconds=1,
)
LATE = ExecutionConfig(entry_latency_seconds=21_601)
STUDY = StudyConfig()

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn_: Query) -> Query:
    QUERIES[fn_.__name__] = fn_
    return fn_


def plain(df: DataFrame) -> DataFrame:
    """Values that compare across engines: epoch micros, rounded doubles, joined arrays."""
    out = []
    for f in df.schema:
        col = F.col(f.name)
        if isinstance(f.dataType, T.TimestampType):
            col = F.unix_micros(col)
        elif isinstance(f.dataType, (T.DoubleType, T.DecimalType)):
            col = F.round(col.cast("double"), 6)
        elif isinstance(f.dataType, T.ArrayType):
            col = F.array_join(col, ",")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType)):
            col = col.cast("bigint")
        out.append(col.alias(f.name))
    return df.select(*out)


def _flags(spark, d):
    return Q.quality_flags(dirty_view(spark, d), DIRTY)


def _cells(spark, d):
    return A.audit_cells(_flags(spark, d), DIRTY)


def _m30(spark, d):
    return B.ohlcv_bars(tape_view(spark, d), 1800)


def _h1(spark, d):
    return B.rollup_bars(_m30(spark, d), 3600)


# Tape ---------------------------------------------------------------------------------------


@query
def trade_tape(spark, d):
    return plain(tape_view(spark, d))


@query
def trade_tape_scoped(spark, d):
    """Symbol scope and the warn policy: broken rows and other symbols are left out."""
    return plain(J.build_tape(dirty_view(spark, d), SCOPED)).select(
        "symbol", "ts_event_ns", "sequence", "price", "size", "signed_volume", "source_row_number"
    )


@query
def tape_totals_report(spark, d):
    return tape_totals(tape_view(spark, d))


@query
def tape_reconcile(spark, d):
    totals = tape_totals(J.build_tape(dirty_view(spark, d), DIRTY))
    return plain(validate_tape(totals, A.volume_report(_cells(spark, d))))


@query
def tape_roundtrip(spark, d):
    """Partitioned write in causal order, read back by the tape reader."""
    path = writers.scratch_path(spark, "tape")
    writers.write_tape(tape_view(spark, d), path, CLEAN)
    return plain(readers.read_tape(spark, path))


@query
def quarantine_roundtrip(spark, d):
    path = writers.scratch_path(spark, "quarantine")
    writers.write_quarantine(Q.quarantine_rows(_flags(spark, d)), path, DIRTY)
    return plain(spark.read.schema(S.QUARANTINE).parquet(path))


@query
def csv_roundtrip(spark, d):
    """Diagnostic trades through CSV."""
    path = writers.scratch_path(spark, "csv")
    curve = bar_study(spark, d)
    writers.write_csv(curve, path)
    return spark.read.schema(curve.schema).option("header", True).csv(path)


@query
def scan_row_numbers(spark, d):
    """Scan positions of the file, against its own increasing ids."""
    numbered = readers.with_source_row_number(read_events(spark, d))
    return numbered.select("source_row_number", "event_id")


@query
def schema_report(spark, d):
    """Columns of the events against the raw format's, with the nulls in each."""
    events = read_events(spark, d)
    nulls = events.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in events.columns))
    nulls = nulls.unpivot([], events.columns, "column_name", "nulls")
    return plain(S.schema_report(events).join(nulls, "column_name", "left"))


@query
def normalize_trades(spark, d):
    """Loose trades of the raw rows; broken ones and other actions fall out."""
    loose = dirty_view(spark, d).select(
        "symbol", "ts_event", "price", "size", "action", "sequence", "source_row_number"
    )
    return plain(readers.normalize_trades(loose))


@query
def chart_trades(spark, d):
    """Chart trades of one symbol from text columns, some not numeric."""
    damaged = dirty_view(spark, d).select(
        "symbol",
        "ts_event",
        F.when(F.col("event_id") % 19 == 3, "n/a").otherwise(F.col("price").cast("string")).alias("price"),
        F.when(F.col("event_id") % 23 == 4, "?").otherwise(F.col("size").cast("string")).alias("size"),
        "source_row_number",
    )
    out = readers.chart_trades(damaged, "S1")
    return plain(out.select("symbol", "ts_event_ns", "price", "size", "source_row_number"))


# Quality --------------------------------------------------------------------------------------


@query
def quality_flags(spark, d):
    flags = _flags(spark, d)
    return flags.select(
        "source_row_number",
        "trade_scope",
        "valid_trade",
        F.array_join(F.sort_array("reasons"), ",").alias("reasons"),
    )


@query
def quarantine_rows(spark, d):
    return plain(Q.quarantine_rows(_flags(spark, d)))


@query
def reason_counts(spark, d):
    return Q.reason_counts(_flags(spark, d))


@query
def reason_counts_from_cells(spark, d):
    return A.invalid_counts(_cells(spark, d))


@query
def timestamp_parse(spark, d):
    """Good and malformed texts made from every event time."""
    text = fn.ns_to_iso(fn.epoch_ns(read_events(spark, d), "ts"))
    n = F.col("event_id") % 10
    shaped = (
        F.when(n == 0, text)
        .when(n == 1, F.concat(F.left(text, F.lit(19)), F.lit("Z")))
        .when(n == 2, F.concat(F.left(text, F.lit(23)), F.lit("Z")))
        .when(n == 3, F.translate(text, "T", " "))
        .when(n == 4, F.translate(text, "Z", ""))
        .when(n == 5, F.concat(F.lit("2024-02-30"), F.substring(text, 11, 20)))
        .when(n == 6, F.concat(F.left(text, F.lit(29)), F.lit("5Z")))
        .when(n == 8, F.concat(F.lit("1700"), F.substring(text, 5, 26)))
        .when(n == 9, F.concat(F.lit("2200"), F.substring(text, 5, 26)))
    )
    return (
        read_events(spark, d)
        .select("event_id", shaped.alias("text"))
        .select("event_id", fn.parse_utc_ns(F.col("text")).alias("ns"))
        .withColumn("invalid", F.col("ns").isNull())
    )


@query
def ns_to_iso(spark, d):
    ns = fn.epoch_ns(read_events(spark, d), "ts") + F.col("event_id") % 1000
    return read_events(spark, d).select(
        "event_id", fn.ns_to_iso(ns).alias("iso"), fn.ns_to_offset_iso(ns).alias("offset_iso")
    )


@query
def action_side_report(spark, d):
    return A.action_side_report(_cells(spark, d))


@query
def null_counts(spark, d):
    return A.null_counts(_cells(spark, d))


@query
def rows_per_symbol(spark, d):
    return A.rows_per_symbol(_cells(spark, d))


@query
def volume_report(spark, d):
    return plain(A.volume_report(_cells(spark, d)))


@query
def timestamp_report(spark, d):
    return A.timestamp_report(_cells(spark, d))


@query
def session_coverage(spark, d):
    return A.session_coverage(_cells(spark, d))


@query
def partial_sessions(spark, d):
    return A.partial_sessions(A.session_coverage(_cells(spark, d)), DIRTY)


@query
def ordering_report_scrambled(spark, d):
    """Ordering audit with the rows put in another scan order, by blocks of 1,000,003 positions.

    The block's length is a prime, so no two rows share a position, however many there are.
    """
    row = F.col("source_row_number")
    block = F.expr("source_row_number div 1000003")
    return ordering_report(
        _flags(spark, d).withColumn("source_row_number", block * 1000003 + row * 7919 % 1000003)
    )


@query
def ordering_report_scan(spark, d):
    """Ordering audit on real scan positions, with times that step back or repeat."""
    rows = readers.with_source_row_number(read_events(spark, d))
    ns = fn.epoch_ns(rows, "ts")
    step = 60_000_000_000
    rough = ns - F.pmod(ns, F.lit(step)) - F.when(F.col("event_id") % 37 == 5, step).otherwise(0)
    return ordering_report(
        rows.select(
            "source_row_number",
            F.when(F.col("event_id") % 41 != 7, rough).alias("ts_event_ns"),
            (F.col("event_id") % 3).alias("sequence"),
        )
    )


# Sessions and functions -------------------------------------------------------------------------


@query
def session_bounds(spark, d):
    """Open and close of every trading date in the data and of its shifts over a year."""
    days = tape_view(spark, d).select("trading_date").distinct()
    shifted = days.select(
        F.explode(F.sequence(F.lit(0), F.lit(360), F.lit(30))).alias("k"), "trading_date"
    ).select(F.date_add(F.col("trading_date").cast("date"), F.col("k")).cast("string").alias("trading_date"))
    day = F.col("trading_date")
    return shifted.distinct().select(
        "trading_date",
        fn.session_open_ns(day, CLEAN).alias("open_ns"),
        fn.session_close_ns(day, CLEAN).alias("close_ns"),
    )


@query
def sessions_over_dst(spark, d):
    """Session columns of event times spread over a year, with both clock changes."""
    ns = fn.epoch_ns(read_events(spark, d), "ts") + (F.col("event_id") % 366) * 86_400_000_000_000
    rows = read_events(spark, d).select("event_id", ns.alias("ns"))
    day = fn.trading_date(F.col("ns"), CLEAN)
    return rows.select(
        "event_id",
        day.alias("trading_date"),
        fn.session_id(day, CLEAN).alias("session_id"),
        fn.session_segment(F.col("ns"), CLEAN).alias("session_segment"),
        fn.is_rth(F.col("ns"), CLEAN).alias("is_rth"),
    )


@query
def market_hours(spark, d):
    rows = read_events(spark, d)
    ns = fn.epoch_ns(rows, "ts")
    half_hour = ns - F.pmod(ns, F.lit(1_800_000_000_000))
    return rows.select(
        "event_id", fn.in_market_hours(half_hour, STUDY.market_tz).alias("in_market_hours")
    )


@query
def tick_rounding(spark, d):
    """Three rounding modes on the raw event values."""
    tick = Decimal("0.25")
    value = dec(F.col("value"))
    return read_events(spark, d).select(
        "event_id",
        fn.round_to_tick(value, tick).cast("double").alias("nearest"),
        fn.round_to_tick(value, tick, "up").cast("double").alias("up"),
        fn.round_to_tick(value, tick, "down").cast("double").alias("down"),
        fn.on_tick(F.col("value"), tick).alias("on_tick"),
    )


@query
def stable_ids(spark, d):
    tape = tape_view(spark, d)
    parts = [F.col("symbol"), fn.ns_to_offset_iso(F.col("ts_event_ns")), fn.price_text(F.col("price"))]
    return tape.select(
        "source_row_number",
        fn.stable_id(*parts, prefix="setup_", length=16).alias("short_id"),
        fn.stable_id(*parts).alias("full_id"),
    )


@query
def month_labels(spark, d):
    """Labels of file names made from the event times."""
    stem = F.concat(
        F.date_format(F.col("ts").cast("date"), "yyyy-MM"),
        F.when(F.col("event_id") % 3 == 0, "_S").when(F.col("event_id") % 3 == 1, "").otherwise("x_"),
        F.when(F.col("event_id") % 3 == 1, "").otherwise((F.col("user_id") % 4).cast("string")),
    )
    path = F.concat(F.lit("/data/raw/"), stem, F.lit(".parquet"))
    return read_events(spark, d).select("event_id", fn.month_label(path).alias("month"))


@query
def contracts(spark, d):
    """Position size over made-up equity and risk taken from the events."""
    equity = F.lit(4000.0) + F.col("event_id") % 50 * 200
    rows = read_events(spark, d)
    size = fn.contracts(
        equity,
        F.lit(10_000.0),
        (F.col("event_id") % 20) / 1000.0,
        F.col("value") / 8 - 1,
        F.lit(0.025),
        point_value=STUDY.point_value,
        cost=STUDY.cost,
        slip=STUDY.slip,
        margin=STUDY.margin,
        daily_limit=STUDY.daily_loss_limit,
        safety=STUDY.daily_safety,
    )
    return rows.select("event_id", size.alias("contracts"))


# Bars -----------------------------------------------------------------------------------------


@query
def bars_m30(spark, d):
    return plain(_m30(spark, d))


@query
def bars_m30_wide_keys(spark, d):
    return plain(B.ohlcv_bars(tape_view(spark, d), 1800, wide_keys=True))


@query
def bars_ties(spark, d):
    """Bars of trades that share minutes and sequences and are scanned out of order."""
    ns = F.col("ts_event_ns")
    row = F.col("source_row_number")
    tied = tape_view(spark, d).withColumns(
        {
            "ts_event_ns": ns - F.pmod(ns, F.lit(600_000_000_000)),
            "sequence": row % 5,
            "source_row_number": row * 7919 % 1000003,
        }
    )
    return plain(B.ohlcv_bars(tied, 1800))


@query
def bars_h1(spark, d):
    return plain(_h1(spark, d))


@query
def candles_15m(spark, d):
    return plain(B.candles(tape_view(spark, d), 900))


@query
def bars_market_tz(spark, d):
    """Hour bars on the clock of a zone half an hour off."""
    return plain(B.candles(tape_view(spark, d), 3600, "Asia/Kolkata"))


@query
def daily_ranges(spark, d):
    return plain(B.daily_ranges(B.candles(tape_view(spark, d), 1800), STUDY.market_tz))


# Gaps -----------------------------------------------------------------------------------------


@query
def gap_zones(spark, d):
    return plain(G.gap_zones(_h1(spark, d), 3600))


@query
def gap_zones_any(spark, d):
    return plain(G.gap_zones(B.candles(tape_view(spark, d), 900), 900, session_scoped=False))


@query
def gap_fill_status(spark, d):
    return plain(G.gap_fill_status(B.candles(tape_view(spark, d), 1800), 1800))


@query
def latest_gaps(spark, d):
    return plain(G.latest_gaps(G.gap_zones(_h1(spark, d), 3600), 300))


# Indicators -----------------------------------------------------------------------------------


@query
def effort_ratios(spark, d):
    out = I.effort_ratios(_m30(spark, d), 3, 5)
    return plain(out.select("symbol", "bar_start_ns", "effort_range_ratio", "effort_volume_ratio"))


@query
def trailing_baselines(spark, d):
    out = I.effort_ratios(B.candles(tape_view(spark, d), 1800), 20, 20, strict=False)
    return plain(out.select("symbol", "bar_start_ns", "baseline_range", "baseline_volume"))


@query
def rsi(spark, d):
    return plain(I.rsi(_m30(spark, d), 14).select("symbol", "bar_start_ns", "rsi"))


@query
def ema(spark, d):
    out = I.ema(I.ema(_m30(spark, d), "close", 12, "ema_12"), "close", 200, "ema_200")
    return plain(out.select("symbol", "bar_start_ns", "ema_12", "ema_200"))


@query
def macd(spark, d):
    out = I.macd(_m30(spark, d), 12, 26, 9)
    return plain(out.select("symbol", "bar_start_ns", "macd", "macd_signal"))


@query
def atr(spark, d):
    return plain(I.atr(_m30(spark, d), 14).select("symbol", "bar_start_ns", "true_range", "atr"))


@query
def entry_bars(spark, d):
    out = I.with_entry_bar(_m30(spark, d), 1800)
    return plain(out.select("symbol", "bar_start_ns", "entry_ns", "entry_open", "is_last"))


# Candidates -----------------------------------------------------------------------------------


@query
def failed_gap_candidates(spark, d):
    return plain(J.gap_candidates(tape_view(spark, d), GAP))


@query
def indicator_candidates(spark, d):
    return plain(J.technical_candidates(tape_view(spark, d), TECH))


@query
def candidate_roundtrip(spark, d):
    path = writers.scratch_path(spark, "candidates")
    tape = tape_view(spark, d)
    both = J.gap_candidates(tape, GAP).unionByName(J.technical_candidates(tape, TECH))
    writers.write_table(both, path, CLEAN, sort=("entry_timestamp", "setup_id"))
    out = readers.read_candidates(spark, path)
    return plain(out.select("setup_id", "symbol", "setup_type", "entry_timestamp", "entry_price"))


# Labels ---------------------------------------------------------------------------------------


def _tape_path(spark, d):
    """Labels and reports start from a tape on disk, as the jobs do."""
    path = writers.scratch_path(spark, "tape")
    writers.write_tape(tape_view(spark, d), path, CLEAN)
    return path


def _candidates(spark, path):
    wide = readers.tape_needs_wide_keys(spark, path)
    return writers.stored(J.technical_candidates(readers.read_tape(spark, path), TECH, wide), "candidates")


def _labels(spark, path, cfg=FILLS):
    return J.label_tape(spark, path, _candidates(spark, path), cfg)


@query
def first_barrier_labels(spark, d):
    return plain(_labels(spark, _tape_path(spark, d)))


@query
def label_invalids(spark, d):
    """Candidates with side, stop or target altered by turns."""
    path = _tape_path(spark, d)
    turn = F.unix_micros("entry_timestamp") / 1_800_000_000 % 4
    made = _candidates(spark, path).withColumn("_turn", turn.cast("int"))
    stop, target = F.col("stop_price"), F.col("target_1")
    made = made.withColumns(
        {
            "entry_side": F.when(F.col("_turn") == 0, "FLAT").otherwise(F.col("entry_side")),
            "stop_price": F.when(F.col("_turn") == 1, F.col("entry_price"))
            .when(F.col("_turn") == 2, target)
            .otherwise(stop),
        }
    ).drop("_turn")
    out = J.label_tape(spark, path, made, FILLS)
    return plain(_label_core(out))


@query
def label_no_future(spark, d):
    """Latency beyond the holding time leaves every window empty."""
    return plain(_label_core(_labels(spark, _tape_path(spark, d), LATE)))


def _label_core(labels):
    return labels.select(
        "setup_id",
        "symbol",
        "entry_timestamp",
        "exit_reason",
        "success",
        "entry_fill_price",
        "exit_timestamp",
        "exit_fill_price",
        "planned_risk_points",
        "net_r",
        "event_count",
        "label_available_timestamp",
    )


@query
def label_gate_report(spark, d):
    return R.label_gate_report(_labels(spark, _tape_path(spark, d)))


@query
def label_summary(spark, d):
    path = _tape_path(spark, d)
    tape = readers.read_tape(spark, path)
    return R.label_summary(_labels(spark, path), B.ohlcv_bars(tape, 1800))


@query
def label_counts(spark, d):
    return R.label_counts(_labels(spark, _tape_path(spark, d)))


@query
def net_r_buckets(spark, d):
    return R.net_r_buckets(_labels(spark, _tape_path(spark, d)))


@query
def label_diagnosis(spark, d):
    """Diagnosis of labels that went through the stored form and the report reader."""
    path = writers.scratch_path(spark, "labels")
    tape = _tape_path(spark, d)
    writers.write_table(_labels(spark, tape), path, CLEAN)
    bars = B.ohlcv_bars(readers.read_tape(spark, tape), 1800)
    out = R.diagnose(R.label_summary(readers.read_labels(spark, path), bars))
    return out.select("candidate_count", F.array_join("diagnosis", "; ").alias("diagnosis"))


# Study ----------------------------------------------------------------------------------------


def _study(spark, d, cfg=STUDY):
    return J.bar_study(readers.normalize_trades(tape_view(spark, d)), cfg)


@query
def volatility_regimes(spark, d):
    return plain(ST.volatility_regimes(B.candles(tape_view(spark, d), 1800), STUDY))


@query
def regime_signals(spark, d):
    out = _study(spark, d)["signals"]
    return plain(
        out.select(
            "symbol",
            "signal_ns",
            "formed_ns",
            "direction",
            "regime",
            "entry_open",
            "stop",
            "risk_points",
            "contracts",
            "tradable",
            "effort_range_ratio",
            "effort_volume_ratio",
            "close_vs_mid",
            "close_vs_zone",
        )
    )


@query
def bar_study(spark, d):
    out = _study(spark, d)["outcomes"]
    return plain(
        out.select(
            "symbol",
            "month",
            "signal_ns",
            "entry_ns",
            "exit_ns",
            "direction",
            "contracts",
            "entry_open",
            "stop",
            "target",
            "exit_price",
            "status",
            "points",
            "pnl",
            "regime",
        )
    )


@query
def equity_curve(spark, d):
    out = _study(spark, d)["curve"]
    return plain(
        out.select("symbol", "month", "entry_ns", "pnl", "balance", "peak", "drawdown", "daily_loss")
    )


@query
def trade_summary(spark, d):
    return plain(_study(spark, d)["summary"])


@query
def fixed_size_summary(spark, d):
    """The study with one contract and no regimes."""
    cfg = StudyConfig(contracts=1, use_regimes=False)
    return plain(_study(spark, d, cfg)["summary"])


# Raw files, policies and parts of a tape -----------------------------------------------------------


def _raw(spark, view, files):
    path = writers.scratch_path(spark, "raw")
    raw_files(view, path, files)
    return path


@query
def scan_many_files(spark, d):
    """The raw reader over 24 files: ten columns and the position in the whole scan."""
    return plain(readers.read_mbo(spark, _raw(spark, mbo_view(spark, d), 24)))


def _streamed(spark, d, view, cfg):
    """Paths of a tape and reports that a stream made of raw files, five to a batch."""
    raw = _raw(spark, view, 12)
    target, reports, checkpoint = (writers.scratch_path(spark, x) for x in ("tape", "reports", "offsets"))
    schema = spark.read.parquet(raw).schema
    stream_tape(spark, raw, schema, target, reports, checkpoint, cfg, files_per_batch=5).awaitTermination()
    return target, reports


@query
def stream_trade_tape(spark, d):
    """The tape of files that arrive in batches; which number a row has follows their arrival."""
    target, _ = _streamed(spark, d, mbo_view(spark, d), CLEAN)
    return plain(readers.read_tape(spark, target)).drop("source_row_number")


@query
def stream_volume_report(spark, d):
    """The audit of a stream over damaged rows, rolled up from its batches' counters."""
    _, reports = _streamed(spark, d, dirty_view(spark, d), DIRTY)
    return plain(A.volume_report(stored_cells(spark, reports)))


@query
def tape_day_replaced(spark, d):
    """A tape that lacks a third of its newest day gets that day again, complete."""
    path = writers.scratch_path(spark, "tape")
    tape = writers.stored(tape_view(spark, d), "whole-tape")
    last = tape.agg(F.max("trading_date")).first()[0]
    day = F.col("trading_date") == last
    writers.write_tape(tape.filter(~(day & (F.col("sequence") % 3 == 0))), path, CLEAN)
    writers.replace_days(tape.filter(day), path, CLEAN, writers.day_totals(tape.filter(day)))
    return plain(readers.read_tape(spark, path))


@query
def all_invalid_reasons(spark, d):
    """Rows for each of the nine reasons, over rows in which all of them occur."""
    return Q.reason_counts(Q.quality_flags(spoiled_view(spark, d), DIRTY))


@query
def row_policies(spark, d):
    """For each policy whether damaged rows stop the job, and the tape's rows where they do not."""
    flags = _flags(spark, d)
    cells = A.audit_cells(flags, DIRTY)
    out = None
    for policy in ("fail", "quarantine", "warn"):
        cfg = TapeConfig(invalid_row_policy=policy)
        try:
            Q.enforce_policy(A.invalid_counts(cells), ordering_report(flags), cfg)
            rows = tape_totals(Q.canonical_trades(flags, cfg)).select("row_count", F.lit(False).alias("raised"))
        except QualityError:
            rows = cells.agg(F.lit(0).cast("bigint").alias("row_count"), F.lit(True).alias("raised"))
        rows = rows.withColumn("policy", F.lit(policy))
        out = rows if out is None else out.unionByName(rows)
    return out


@query
def null_guards(spark, d):
    """For each column that bars need, whether a null in one row stops them."""
    tape = tape_view(spark, d)
    broken = None
    for name in ("price", "size", "session_id", "sequence"):
        hurt = tape.withColumn(name, F.when(F.col("sequence") % 4004 != 0, F.col(name)))
        try:
            B.ohlcv_bars(hurt, 1800).agg(F.sum("open"), F.sum("volume")).first()
            raised = False
        except Exception as e:  # the engine's own error class
            raised = "null in a required column" in str(e)
        row = tape.agg(F.count_if(F.col("sequence") % 4004 == 0).alias("nulls")).withColumns({"column_name": F.lit(name), "raised": F.lit(raised)})
        broken = row if broken is None else broken.unionByName(row)
    return broken


@query
def tape_reconcile_failing(spark, d):
    """A tape that lost the rows of one symbol, against the report of its source."""
    tape = J.build_tape(dirty_view(spark, d), DIRTY).filter("symbol <> 'S3'")
    return plain(validate_tape(tape_totals(tape), A.volume_report(_cells(spark, d))))


@query
def bar_study_by_file(spark, d):
    """The study of two input files, each with every second ten days, by the month in their names."""
    path = writers.scratch_path(spark, "files")
    late = F.expr("(ts_event_ns div 864000000000000) % 2 = 1")
    trades = tape_view(spark, d).withColumn("late", late)
    for name, part in (("2024-01_trades", ~F.col("late")), ("2024-02_trades", F.col("late"))):
        trades.filter(part).drop("late").write.parquet(f"{path}/{name}")
    read = spark.read.parquet(f"{path}/2024-01_trades", f"{path}/2024-02_trades")
    folder = F.regexp_extract(F.col("_metadata.file_path"), "([^/]+)/[^/]+$", 1)
    out = J.bar_study_by_file(read.withColumn("file", month_label(folder)), "file", STUDY)["outcomes"]
    return plain(
        out.select(
            "symbol",
            "month",
            "signal_ns",
            "entry_ns",
            "exit_ns",
            "direction",
            "contracts",
            "entry_open",
            "stop",
            "target",
            "exit_price",
            "status",
            "points",
            "pnl",
            "regime",
        )
    )
