"""Raw files that arrive bit by bit, days that are replaced, and a study by file."""

import os

import pytest
from helpers import ELEVEN, MBO, mbo, mbo_row
from pyspark.sql import functions as F

from tickloom import schema as S
from tickloom.checks.queries import QUERIES, STUDY
from tickloom.config import TapeConfig
from tickloom.errors import OutputError
from tickloom.operators import audit as A
from tickloom.operators.quality import quality_flags
from tickloom.plans.jobs import bar_study, bar_study_by_file, build_tape
from tickloom.sources import readers, writers
from tickloom.sources.events import dirty_view, mbo_view, raw_files, tape_view
from tickloom.streaming import tape as streaming

DATA = "/root/testdata/sf0.001"
WARN = TapeConfig(invalid_row_policy="warn")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def files(path):
    out = {}
    for folder, _, names in os.walk(path):
        for n in names:
            if n.endswith(".parquet"):
                out.setdefault(os.path.relpath(folder, path), set()).add(n)
    return out


@pytest.fixture
def raw(spark, tmp_path):
    """A function that puts a view's rows as ``n`` more raw files into the source folder."""
    source = tmp_path / "source"
    source.mkdir()

    def put(view, n, name):
        made = tmp_path / f"made-{name}"
        raw_files(view, str(made), n)
        for f in sorted(made.glob("*.parquet")):
            os.link(f, source / f"{name}-{f.name}")
        return spark.read.parquet(str(made)).schema

    return source, put


def run(spark, source, schema, tmp_path, cfg=WARN, files_per_batch=2):
    paths = [str(tmp_path / x) for x in ("tape", "reports", "offsets")]
    streaming.stream_tape(spark, str(source), schema, *paths, cfg, files_per_batch).awaitTermination()
    return paths


def test_a_stream_goes_on_where_it_ended(spark, tmp_path, raw):
    source, put = raw
    view = dirty_view(spark, DATA)
    early, late = view.filter("event_id < 400"), view.filter("event_id >= 400")
    schema = put(early, 3, "a")
    tape, reports, _ = run(spark, source, schema, tmp_path)
    half = files(tape)
    put(late, 3, "b")
    run(spark, source, schema, tmp_path)
    got = readers.read_tape(spark, tape)
    assert rows(got.drop("source_row_number")) == rows(build_tape(view, WARN).drop("source_row_number"))
    assert {k: v for k, v in files(tape).items() if k in half} == half
    # Nothing new: nothing happens.
    before = files(tape)
    run(spark, source, schema, tmp_path)
    assert files(tape) == before
    whole = A.audit_cells(quality_flags(view, WARN), WARN)
    for report in (A.volume_report, A.invalid_counts, A.session_coverage, A.null_counts, A.action_side_report):
        assert rows(report(streaming.stored_cells(spark, reports))) == rows(report(whole))


def test_row_numbers_are_the_position_in_all_batches(spark, tmp_path, raw):
    source, put = raw
    view = mbo_view(spark, DATA)
    schema = put(view.filter("event_id < 300"), 1, "a")
    tape, *_ = run(spark, source, schema, tmp_path)
    put(view.filter("event_id >= 300"), 1, "b")
    run(spark, source, schema, tmp_path)
    got = {r[0]: r[1] for r in readers.read_tape(spark, tape, ("sequence", "source_row_number")).collect()}
    order = [r.sequence for r in view.orderBy("source_row_number").select("sequence").collect()]
    assert got == {s: got[s] for s in got} and all(order[n] == s for s, n in got.items())


def test_a_batch_run_again_changes_nothing(spark, tmp_path, raw):
    source, put = raw
    schema = put(dirty_view(spark, DATA), 2, "a")
    cfg = TapeConfig(invalid_row_policy="quarantine")
    tape, reports, _ = run(spark, source, schema, tmp_path, cfg)
    batch = spark.read.schema(schema).parquet(str(source)).select(
        *S.MBO_SCANNED, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_index")
    )
    before = [rows(readers.read_tape(spark, tape))] + [rows(spark.read.parquet(f"{reports}/{x}")) for x in ("quarantine_rows", "cells", "ledger")]
    streaming.process_batch(batch, 0, tape, reports, cfg)
    after = [rows(readers.read_tape(spark, tape))] + [rows(spark.read.parquet(f"{reports}/{x}")) for x in ("quarantine_rows", "cells", "ledger")]
    assert after == before


def test_a_broken_batch_stops_a_strict_stream_and_leaves_no_rows(spark, tmp_path, raw):
    source, put = raw
    schema = put(dirty_view(spark, DATA), 1, "a")
    with pytest.raises(Exception, match="break the quality rules"):
        run(spark, source, schema, tmp_path, TapeConfig(invalid_row_policy="fail"))
    assert not files(tmp_path / "tape")


def test_a_late_day_rewrites_that_day_only(spark, tmp_path):
    path = str(tmp_path / "tape")
    tape = writers.stored(tape_view(spark, DATA), "tape")
    days = sorted(r[0] for r in tape.select("trading_date").distinct().collect())
    day = F.col("trading_date") == days[1]
    writers.write_tape(tape.filter(~(day & (F.col("sequence") % 3 == 0))), path, TapeConfig())
    before = files(path)
    totals = writers.replace_days(tape.filter(day), path, TapeConfig(), writers.day_totals(tape.filter(day)))
    after = files(path)
    assert rows(readers.read_tape(spark, path)) == rows(tape)
    assert totals.count() == tape.filter(day).select("symbol").distinct().count()
    changed = {k for k in after if after[k] != before.get(k)}
    assert changed and all(days[1] in k for k in changed)
    assert {k for k in before if days[1] not in k} <= set(after) - changed


def test_a_day_with_other_totals_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "tape")
    tape = build_tape(mbo(spark, ELEVEN), TapeConfig())
    writers.write_tape(tape, path, TapeConfig())
    before = files(path)
    expected = writers.day_totals(tape).withColumn("sum_size", F.col("sum_size") + 1)
    with pytest.raises(OutputError, match="day totals differ"):
        writers.replace_days(tape, path, TapeConfig(), expected)
    with pytest.raises(OutputError, match="no trade rows"):
        writers.replace_days(tape.limit(0), path, TapeConfig())
    assert files(path) == before and MBO
    assert [x for x in os.listdir(tmp_path) if ".days-" in x] == []


def test_each_file_is_studied_by_itself(spark):
    path = "/root/testdata/sf0.01"
    trades = writers.stored(tape_view(spark, path), "tape")
    filed = trades.withColumn("file", F.when(F.expr("(ts_event_ns div 864000000000000) % 2 = 1"), "2024-02").otherwise("2024-01"))
    both = bar_study_by_file(filed, "file", STUDY)
    keep = ("symbol", "signal_ns", "regime", "entry_open", "stop", "status", "pnl")
    got = set()
    for month in ("2024-01", "2024-02"):
        alone = bar_study(filed.filter(F.col("file") == month).drop("file"), STUDY)
        assert rows(both["outcomes"].filter(F.col("month") == month).select(*keep)) == rows(alone["outcomes"].select(*keep))
        balance = ("symbol", "entry_ns", "balance", "drawdown")
        if alone["outcomes"].select("month").distinct().count() == 1:
            assert rows(both["curve"].filter(F.col("month") == month).select(*balance)) == rows(alone["curve"].select(*balance))
        got |= set(rows(alone["outcomes"].select(*keep)))
    assert got != set(rows(bar_study(trades, STUDY)["outcomes"].select(*keep)))
    assert "bar_study_by_file" in QUERIES


def test_rows_of_a_batch_and_of_raw_files_are_made_once(spark, tmp_path):
    """Neither a range sample nor the passes over a batch make the texts of times again."""
    made = spark.sparkContext.accumulator(0)

    def counted(text):
        made.add(1)
        return text

    raw = mbo(spark, [mbo_row("T", "B", sequence=i, ts=None if i == 3 else "2026-04-06T00:00:00.001184655Z") for i in range(40)])
    text = F.udf(counted, "string")("ts_event")
    raw_files(raw.select(*S.MBO_SCANNED, "source_row_number").withColumn("ts_event", text), f"{tmp_path}/raw", 4)
    assert made.value == 40
    files = spark.read.parquet(f"{tmp_path}/raw")
    batch = files.select(*S.MBO_SCANNED, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_index"))
    batch = batch.withColumn("ts_event", F.udf(counted, "string")("ts_event"))
    made.value = 0
    streaming.process_batch(batch, 0, f"{tmp_path}/tape", f"{tmp_path}/reports", TapeConfig(invalid_row_policy="quarantine"))
    assert made.value == 40
    assert A.volume_report(streaming.stored_cells(spark, f"{tmp_path}/reports")).first()["valid_t_rows"] == 39
    assert [r.sequence for r in readers.read_mbo(spark, f"{tmp_path}/raw").orderBy("source_row_number").collect()] == list(range(40))
