"""Physical plans, and the registered queries next to their SQL."""

import os
import re
import subprocess
import sys

import duckdb
import pytest
from helpers import ELEVEN, MBO, candidate, candidates, mbo, ns
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import check
from tickloom import schema as S
from tickloom.checks.queries import QUERIES
from tickloom.config import ExecutionConfig, TapeConfig
from tickloom.operators.audit import audit_cells
from tickloom.operators.bars import ohlcv_bars, rollup_bars
from tickloom.operators.gaps import gap_zones
from tickloom.operators.labels import first_barrier_labels
from tickloom.operators.quality import canonical_trades, quality_flags
from tickloom.plans.jobs import build_tape
from tickloom.sources import readers, writers

DATA = "/root/testdata/sf0.001"
CFG = TapeConfig()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored_tape(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "tape")
    writers.write_tape(build_tape(mbo(spark, ELEVEN), CFG), path, CFG)
    return path


def test_scan_reads_ten_columns_and_pushes_the_trade_filter(spark, tmp_path):
    spark.createDataFrame(ELEVEN, MBO).write.parquet(str(tmp_path / "raw"))
    raw = readers.read_mbo(spark, str(tmp_path / "raw"), numbered=False)
    text = plan(raw)
    assert all(c not in text for c in ("channel_id", "ts_in_delta", "order_id"))
    numbered = raw.withColumn("source_row_number", F.lit(0))
    text = plan(canonical_trades(quality_flags(numbered, CFG), CFG).select("price"))
    assert "IsNotNull(price)" in text or "PushedFilters: [IsNotNull" in text
    assert "In(side" in text or "side" in re.search(r"DataFilters: .*", text).group(0)
    assert "Exchange" not in text and "Python" not in text


def test_row_numbers_take_a_broadcast_of_file_counts(spark, tmp_path):
    spark.createDataFrame(ELEVEN, MBO).write.parquet(str(tmp_path / "raw"))
    text = plan(readers.read_mbo(spark, str(tmp_path / "raw")))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert "ReadSchema: struct<>" in text


def test_bars_aggregate_by_hash_with_one_shuffle(spark, stored_tape):
    text = plan(ohlcv_bars(readers.read_tape(spark, stored_tape), 1800))
    assert text.count("HashAggregate") == 2 and "SortAggregate" not in text
    assert len(re.findall(r"[+-] Exchange", text)) == 1 and "Window" not in text
    assert "publisher_id" not in text


def test_audit_is_one_hash_aggregate(spark):
    text = plan(audit_cells(quality_flags(mbo(spark, ELEVEN), CFG), CFG))
    assert "SortAggregate" not in text and text.count("HashAggregate") == 2


def test_zone_windows_are_partitioned(spark, stored_tape):
    bars = ohlcv_bars(readers.read_tape(spark, stored_tape), 1800)
    text = plan(gap_zones(rollup_bars(bars, 3600), 3600))
    assert "SinglePartition" not in text and "Exchange SinglePartition" not in text


def test_counted_candidates_are_broadcast(spark, stored_tape):
    cands = candidates(
        spark, candidate("a", "LONG", "2026-04-06T10:00:00Z", 100.0, 95.0, 105.0)
    )
    tape = readers.read_tape(spark, stored_tape)
    cfg = ExecutionConfig()
    text = plan(first_barrier_labels(cands, tape, cfg))
    assert "BroadcastHashJoin" in text and "BroadcastNestedLoopJoin" not in text
    assert "CartesianProduct" not in text and "Python" not in text
    day = tape.filter(F.col("trading_date").between("2026-04-06", "2026-04-07"))
    text = plan(first_barrier_labels(cands, day, cfg))
    assert re.search(r"PartitionFilters: \[[^]]*trading_date", text)


def test_key_width_comes_from_footers(spark, stored_tape):
    before = {k: spark.conf.get(k) for k in ("spark.sql.sources.useV1SourceList", "spark.sql.parquet.aggregatePushdown")}
    days = ("2026-04-06", "2026-04-07")
    for most in (readers.largest_order_parts(spark, stored_tape), readers.largest_order_parts(spark, stored_tape, days)):
        text = plan(most)
        assert "PushedAggregation: [MAX(sequence), MAX(source_row_number)]" in text
    assert before == {k: spark.conf.get(k) for k in before}
    tape = readers.read_tape(spark, stored_tape)
    want = tape.agg(F.max("sequence"), F.max("source_row_number")).first()
    assert tuple(readers.largest_order_parts(spark, stored_tape).first()) == tuple(want)
    assert readers.tape_needs_wide_keys(spark, stored_tape) is False
    assert readers.tape_needs_wide_keys(spark, stored_tape, ("1999-01-01", "1999-01-02")) is False


@pytest.mark.parametrize(("sequence", "wide"), [(10**11, True), (10**11 - 1, False), (None, False)])
def test_key_width_of_a_stored_tape(spark, stored_tape, tmp_path, sequence, wide):
    """A column that is all null has no bounds in the footers; it is scanned."""
    tape = readers.read_tape(spark, stored_tape).withColumn("sequence", F.lit(sequence).cast("bigint"))
    tape.write.partitionBy(*S.PARTITIONS).parquet(str(tmp_path / "t"))
    assert readers.tape_needs_wide_keys(spark, str(tmp_path / "t")) is wide


def test_tape_files_are_sorted_and_bounded(spark, tmp_path):
    start = ns("2026-04-06T14:00:00Z")
    df = spark.range(5000).select(
        *(
            F.lit(None).cast(f.dataType).alias(f.name)
            if f.name not in ("ts_event_ns", "sequence", "symbol", "price", "size",
                              "signed_volume", "trading_date", "source_row_number")
            else {
                "ts_event_ns": start + (F.col("id") * 7919) % 5000,
                "sequence": F.col("id") % 3,
                "symbol": F.when(F.col("id") % 3 > 0, "HOT").otherwise("B"),
                "price": F.lit(1.0),
                "size": F.lit(1).cast("bigint"),
                "signed_volume": F.lit(1).cast("bigint"),
                "trading_date": F.lit("2026-04-06"),
                "source_row_number": F.col("id"),
            }[f.name].alias(f.name)
            for f in S.TAPE
        )
    )
    path = str(tmp_path / "t")
    totals = writers.write_tape(df, path, TapeConfig(target_rows_per_file=1000))
    assert totals == {"row_count": 5000, "sum_size": 5000, "sum_signed_volume": 5000}
    back = readers.read_tape(spark, path, ("ts_event_ns", "symbol", "source_row_number"))
    placed = back.select("*", F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("i"))
    files = {}
    for r in placed.orderBy("i").collect():
        files.setdefault(r["file"], []).append(r["ts_event_ns"])
    assert all(v == sorted(v) and len(v) <= 1000 for v in files.values())


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() == 917


def test_every_query_of_the_tape_has_sql():
    missing = set(QUERIES) - set(entry_points.oracle_sql())
    assert not missing


@pytest.mark.parametrize(
    "name",
    [
        "trade_tape",
        "quality_flags",
        "ordering_report_scrambled",
        "sessions_over_dst",
        "bars_market_tz",
        "gap_fill_status",
        "macd",
        "indicator_candidates",
        "first_barrier_labels",
        "trade_summary",
    ],
)
def test_query_agrees_with_sql(spark, name):
    assert duckdb.__version__
    ok, note = check.compare(spark, DATA, name)
    assert ok, note


def test_scrambled_scan_order_has_no_ties(spark, tmp_path):
    """Rows whose positions lie more than 1,000,003 apart still have positions of their own."""
    source = f"SELECT * REPLACE (event_id + r * 250000 AS event_id) FROM '{DATA}/events.parquet', range(4) t(r)"
    duckdb.sql(f"COPY ({source}) TO '{tmp_path}/events.parquet'")
    for table in check.TABLES[1:]:
        os.symlink(f"{DATA}/{table}.parquet", tmp_path / f"{table}.parquet")
    ok, note = check.compare(spark, str(tmp_path), "ordering_report_scrambled")
    assert ok, note
    sql = entry_points.oracle_sql()["ordering_report_scrambled"]
    inner = re.search(r"FROM \((SELECT source_row_number // .*? FROM dirty)\)", sql, re.S).group(1)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
    ties = con.execute(sql[: sql.rindex("SELECT coalesce(sum((ts < pts")] + f"SELECT count(*) - count(DISTINCT pos) FROM ({inner})")
    assert ties.fetchone()[0] == 0


def test_bench_and_check_import_without_a_session():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = "import bench, check, __spark_entry__ as e; assert len(e.queries()) > 60"
    assert subprocess.run([sys.executable, "-c", code], cwd=root).returncode == 0
