"""Jobs a user calls: audit, tape, candidates, labels, study."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom import schema as S
from tickloom.config import (
    ExecutionConfig,
    GapSetupConfig,
    IndicatorSetupConfig,
    StudyConfig,
    TapeConfig,
)
from tickloom.functions.clock import local_date
from tickloom.functions.ordering_keys import needs_wide_keys
from tickloom.operators import audit as A
from tickloom.operators.bars import candles, ohlcv_bars, rollup_bars
from tickloom.operators.candidates import failed_gap_candidates, indicator_candidates
from tickloom.operators.labels import first_barrier_labels
from tickloom.operators.ordering import ordering_report
from tickloom.operators.quality import (
    canonical_trades,
    enforce_policy,
    quality_flags,
    quarantine_rows,
)
from tickloom.operators.study import (
    bar_barrier_outcomes,
    equity_curve,
    regime_signals,
    study_bars,
    trade_summary,
)
from tickloom.operators.reports import label_counts, label_gate_report
from tickloom.operators.tape import require_valid, tape_totals, validate_tape
from tickloom.sources.readers import read_candidates, read_mbo, read_tape, tape_needs_wide_keys
from tickloom.sources.writers import stored, write_quarantine, write_table, write_tape

# Up to this many symbols are named in the tape's partition filter.
PRUNED_SYMBOLS = 1_000


def _kept(report: DataFrame) -> DataFrame:
    """A one-row report, computed once."""
    return report.sparkSession.createDataFrame([report.first()], report.schema)


def _write_reports(audit: dict[str, DataFrame], reports: str, cfg: TapeConfig) -> None:
    for name, df in audit.items():
        if name != "cells":
            write_table(df, f"{reports}/{name}", cfg)


def audit_mbo(mbo: DataFrame, cfg: TapeConfig, raw: DataFrame | None = None) -> dict[str, DataFrame]:
    """All reports on raw rows. Two passes: one grouped aggregate, one ordering audit.

    ``raw`` is the input before its columns were chosen, for the schema report. The ordering
    report is one row; it is computed here and kept, as the policy and the report both need it.
    The grouped table is persisted because every report reads it; it is small, and a lost
    executor only means it is computed again.
    """
    flags = quality_flags(mbo, cfg)
    cells = A.audit_cells(flags, cfg).persist()
    coverage = A.session_coverage(cells)
    return {
        "cells": cells,
        "schema_report": S.schema_report(mbo if raw is None else raw),
        "null_counts": A.null_counts(cells),
        "action_side_report": A.action_side_report(cells),
        "timestamp_report": A.timestamp_report(cells),
        "session_report": coverage,
        "partial_sessions": A.partial_sessions(coverage, cfg),
        "trade_volume_report": A.volume_report(cells),
        "rows_per_symbol": A.rows_per_symbol(cells),
        "reason_counts": A.invalid_counts(cells),
        "duplicate_report": _kept(ordering_report(flags)),
    }


def build_tape(mbo: DataFrame, cfg: TapeConfig) -> DataFrame:
    """The canonical tape of raw rows; a stateless projection and filter."""
    return canonical_trades(quality_flags(mbo, cfg), cfg)


def run_audit_job(spark: SparkSession, source: str, reports: str, cfg: TapeConfig) -> None:
    """All reports on raw rows, without a tape."""
    audit = audit_mbo(read_mbo(spark, source), cfg, spark.read.parquet(source))
    _write_reports(audit, reports, cfg)
    audit["cells"].unpersist()


def run_tape_job(
    spark: SparkSession, source: str, target: str, reports: str, cfg: TapeConfig
) -> dict:
    """Audit, judge, write the tape and its reports.

    What was written is reconciled with the audit before it takes the old tape's place. Returns
    the reconciliation, with the rejected rows (``quarantine``) under that policy.
    """
    mbo = read_mbo(spark, source)
    audit = audit_mbo(mbo, cfg, spark.read.parquet(source))
    enforce_policy(audit["reason_counts"], audit["duplicate_report"], cfg)
    flags = quality_flags(mbo, cfg)
    result: dict = {}

    def reconcile(written: dict[str, int]) -> None:
        totals = spark.createDataFrame(
            [tuple(written[k] for k in ("row_count", "sum_size", "sum_signed_volume"))],
            "row_count bigint, sum_size bigint, sum_signed_volume bigint",
        )
        result.update(require_valid(validate_tape(totals, audit["trade_volume_report"])))

    write_tape(canonical_trades(flags, cfg), target, cfg, reconcile)
    if cfg.invalid_row_policy == "quarantine":
        rejected = quarantine_rows(flags)
        result["quarantine"] = write_quarantine(rejected, f"{reports}/quarantine_rows", cfg)
    _write_reports(audit, reports, cfg)
    audit["cells"].unpersist()
    return result


def run_validate_job(spark: SparkSession, tape_path: str, reports: str) -> dict:
    """Reconcile a stored tape with its stored volume report; raises where they differ."""
    totals = tape_totals(read_tape(spark, tape_path, ("size", "signed_volume")))
    return require_valid(validate_tape(totals, spark.read.parquet(f"{reports}/trade_volume_report")))


def _bars(tape: DataFrame, seconds: int, wide_keys: bool | None) -> DataFrame:
    """Bars; whether they take wide keys is found out by a scan of two columns if not given."""
    return ohlcv_bars(tape, seconds, needs_wide_keys(tape) if wide_keys is None else wide_keys)


def setup_bars(tape: DataFrame, zone_seconds: int, signal_seconds: int, wide_keys: bool | None = None):
    """Zone bars and signal bars from one aggregate over the trades.

    The bars are read several times later on, so they are stored: the tape is scanned once.
    """
    signal = stored(_bars(tape, signal_seconds, wide_keys), "signal_bars")
    return rollup_bars(signal, zone_seconds), signal


def gap_candidates(tape: DataFrame, cfg: GapSetupConfig, wide_keys: bool | None = None) -> DataFrame:
    zone, signal = setup_bars(tape, cfg.zone_bar_seconds, cfg.signal_bar_seconds, wide_keys)
    return failed_gap_candidates(zone, signal, cfg)


def technical_candidates(tape: DataFrame, cfg: IndicatorSetupConfig, wide_keys: bool | None = None) -> DataFrame:
    return indicator_candidates(_bars(tape, cfg.bar_seconds, wide_keys), cfg)


def run_candidate_job(
    spark: SparkSession,
    tape_path: str,
    target: str,
    cfg: TapeConfig,
    setup: GapSetupConfig | IndicatorSetupConfig,
) -> None:
    """Read a tape, build the setups of ``setup``'s kind and write them."""
    tape = read_tape(
        spark,
        tape_path,
        ("ts_event_ns", "sequence", "symbol", "price", "size", "session_id", "source_row_number"),
    )
    build = gap_candidates if isinstance(setup, GapSetupConfig) else technical_candidates
    write_table(build(tape, setup, tape_needs_wide_keys(spark, tape_path)), target, cfg)


def label_tape(
    spark: SparkSession, tape_path: str, candidates: DataFrame, cfg: ExecutionConfig
) -> DataFrame:
    """Labels of candidates over a stored tape.

    Their times, and their symbols when few, choose the partitions of the tape to read. A trading
    date is the date of a zone's clock or the one after, so whatever the zone and the session's
    start, it lies from the day before the UTC date to two days after it.
    """
    cols = (
        "ts_event_ns",
        "sequence",
        "symbol",
        "price",
        "session_id",
        "source_row_number",
        "trading_date",
    )
    entry = F.unix_seconds("entry_timestamp")
    day = lambda seconds, by: F.date_add(F.date_from_unix_date((F.floor(seconds / 86_400)).cast("int")), by)
    hold = F.coalesce(F.col("max_holding_seconds"), F.lit(0)) + cfg.entry_latency_seconds
    seen = candidates.agg(
        F.min(day(entry, -1)).cast("string").alias("first"),
        F.max(day(entry + hold, 2)).cast("string").alias("last"),
    ).first()
    tape = read_tape(spark, tape_path, cols).filter(
        F.col("trading_date").between(seen["first"], seen["last"])
    )
    names = candidates.select("symbol").distinct().limit(PRUNED_SYMBOLS + 1).collect()
    if len(names) <= PRUNED_SYMBOLS:
        tape = tape.filter(F.col("symbol").isin([r["symbol"] for r in names]))
    # Without candidates there are no days, and no trade is read.
    days = (seen["first"], seen["last"])
    wide = seen["first"] is not None and tape_needs_wide_keys(spark, tape_path, days)
    return first_barrier_labels(candidates, tape, cfg, wide_keys=wide)


def run_label_job(
    spark: SparkSession,
    tape_path: str,
    candidates_path: str,
    target: str,
    cfg: TapeConfig,
    execution: ExecutionConfig,
    reports: str | None = None,
) -> None:
    """Label stored candidates; with ``reports``, write the gate report and the counts there."""
    labels = label_tape(spark, tape_path, read_candidates(spark, candidates_path), execution)
    write_table(labels, target, cfg, sort=("entry_timestamp", "setup_id"))
    if reports:
        written = spark.read.schema(labels.schema).parquet(target)
        write_table(label_gate_report(written), f"{reports}/label_gate_report", cfg)
        write_table(label_counts(written), f"{reports}/label_counts", cfg)


def bar_study(
    trades: DataFrame, cfg: StudyConfig, month: Column | None = None
) -> dict[str, DataFrame]:
    """Signals, outcomes, equity and monthly summary of loose trades, which are scanned once.

    A trade's month is that of its entry, or ``month``, made from its symbol.
    """
    signal_bars = stored(candles(trades, cfg.signal_bar_seconds, cfg.market_tz), "study_bars")
    zone_bars = rollup_bars(signal_bars, cfg.zone_bar_seconds, cfg.market_tz)
    rated = stored(study_bars(signal_bars, cfg), "study_rated")
    signals = regime_signals(zone_bars, rated, cfg)
    named = month is not None
    month = month if named else F.left(local_date(F.col("entry_ns"), cfg.market_tz), F.lit(7))
    outcomes = bar_barrier_outcomes(signals.filter("tradable"), rated, cfg).withColumn(
        "month", month
    )
    curve = equity_curve(outcomes, cfg)
    bar_month = month if named else F.left(local_date(F.col("bar_start_ns"), cfg.market_tz), F.lit(7))
    missing = rated.groupBy("symbol", bar_month.alias("month")).agg(
        F.count_if("missing_entry").alias("skipped_missing_entry")
    )
    bad_risk = ~F.col("tradable") & ~(F.col("risk_points") > 0)
    refused = (
        signals.withColumn("month", month)
        .groupBy("symbol", "month")
        .agg(
            F.count_if(bad_risk).alias("skipped_invalid_risk"),
            F.count_if(~F.col("tradable") & ~bad_risk).alias("skipped_no_contracts"),
        )
    )
    skipped = missing.join(refused, ["symbol", "month"], "left").fillna(
        0, ["skipped_invalid_risk", "skipped_no_contracts"]
    )
    return {
        "rated": rated,
        "signals": signals,
        "outcomes": outcomes,
        "curve": curve,
        "summary": trade_summary(curve, skipped, cfg),
    }



def bar_study_by_file(trades: DataFrame, file: str, cfg: StudyConfig) -> dict[str, DataFrame]:
    """``bar_study`` of each input file by itself; ``file`` is the column that names a row's file.

    Baselines, regimes, zone use and equity start afresh at a file, and ``month`` is that column
    (``month_label`` makes it from a path). The file becomes a part of the symbol, which keys every
    operator, so files run side by side in one plan; the results carry it apart again.
    """
    mark = "\u001f"
    keyed = trades.withColumn("symbol", F.concat(F.coalesce(file, F.lit("")), F.lit(mark), "symbol")).drop(file)
    parts = F.split("symbol", mark, 2)
    out = {}
    for name, df in bar_study(keyed, cfg, parts[0]).items():
        month = {"month": parts[0]} if "month" in df.columns else {file: parts[0]}
        out[name] = df.withColumns({**month, "symbol": parts[1]})
    return out
