"""Raw rows to tape: quality rules, policies, writing and reading."""

import random
from decimal import Decimal

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from helpers import ELEVEN, MBO, mbo, mbo_row, ns
from pyspark.sql import functions as F

from tickloom import schema as S
from tickloom.config import TapeConfig
from tickloom.errors import ConfigError, OutputError, QualityError, SchemaError
from tickloom.functions import ns_to_iso, parse_utc_ns
from tickloom.functions.clock import floor_div
from tickloom.operators.audit import (
    audit_cells,
    partial_sessions,
    session_coverage,
    volume_report,
)
from tickloom.operators.ordering import ordering_report
from tickloom.operators.quality import quality_flags, quarantine_rows
from tickloom.operators.tape import require_valid, tape_totals, validate_tape
from tickloom.plans.jobs import audit_mbo, build_tape, run_audit_job, run_tape_job, run_validate_job
from tickloom.sources import readers, writers

CFG = TapeConfig(symbol_filters=("ESM6",), invalid_row_policy="quarantine", overwrite=True)


def raw_file(spark, path, rows, files=1):
    spark.createDataFrame(rows, MBO).coalesce(1).write.mode("overwrite").parquet(str(path))
    return str(path)


def test_trades_only_and_signed_volume(spark):
    out = build_tape(mbo(spark, ELEVEN), CFG)
    rows = out.collect()
    assert sorted(r["signed_volume"] for r in rows) == [-3, 0, 1, 2]
    assert sum(r["size"] for r in rows) == 10
    assert {r["trading_date"] for r in rows} == {"2026-04-06"}
    assert out.columns == [f.name for f in S.TAPE]


def test_job_writes_and_reconciles(spark, tmp_path):
    source = raw_file(spark, tmp_path / "raw", ELEVEN)
    target, reports = str(tmp_path / "tape"), str(tmp_path / "reports")
    result = run_tape_job(spark, source, target, reports, CFG)
    assert result["row_count"] == 4 and result["sum_size"] == 10 and result["valid"]
    back = readers.read_tape(spark, target)
    assert {f.name: f.dataType for f in back.schema} == {f.name: f.dataType for f in S.TAPE}
    assert back.count() == 4
    assert spark.read.parquet(f"{reports}/quarantine_rows").count() == 2
    volume = spark.read.parquet(f"{reports}/trade_volume_report").first()
    assert volume["total_f_rows"] == 1 and volume["valid_t_rows"] == 4
    first = sorted(map(tuple, back.collect()))
    run_tape_job(spark, source, target, reports, CFG)
    assert sorted(map(tuple, readers.read_tape(spark, target).collect())) == first


def test_fills_are_not_counted_twice(spark, tmp_path):
    rows = [mbo_row("T", "B", size=5, sequence=1), mbo_row("F", "B", size=5, sequence=2)]
    source = raw_file(spark, tmp_path / "raw", rows)
    cfg = TapeConfig(symbol_filters=("ESM6",), overwrite=True)
    run_tape_job(spark, source, str(tmp_path / "tape"), str(tmp_path / "rep"), cfg)
    (row,) = readers.read_tape(spark, str(tmp_path / "tape")).collect()
    assert (row["size"], row["signed_volume"]) == (5, 5)


@pytest.mark.parametrize(
    "rows",
    [
        [mbo_row("T", "B", price=18000.10)],
        [mbo_row("X", "B")],
        [mbo_row("T", "B", ts="2026-04-06 00:00:00Z")],
        [mbo_row("T", "B", sequence=None)],
        [mbo_row("T", "B", sequence=2), mbo_row("T", "B", sequence=1)],
    ],
)
def test_fail_policy_raises(spark, tmp_path, rows):
    source = raw_file(spark, tmp_path / "raw", rows)
    with pytest.raises(QualityError):
        run_tape_job(spark, source, str(tmp_path / "t"), str(tmp_path / "r"), TapeConfig())
    assert not (tmp_path / "t").exists()


def test_existing_output_and_empty_output(spark, tmp_path):
    cfg = TapeConfig()
    tape = build_tape(mbo(spark, ELEVEN), cfg)
    writers.write_tape(tape, str(tmp_path / "t"), cfg)
    with pytest.raises(Exception, match="(?i)exists"):
        writers.write_tape(tape, str(tmp_path / "t"), cfg)
    with pytest.raises(OutputError):
        writers.write_tape(tape.filter("size > 100"), str(tmp_path / "u"), cfg)


def test_reasons_and_sample_limit(spark, tmp_path):
    rows = [
        mbo_row("T", None, price=float("nan"), size=None, sequence=None, ts="bad"),
        mbo_row("T", "B", price=-1.0),
        mbo_row("T", "B", price=None),
        mbo_row(None, "B", price=-1.0),
        mbo_row("A", "Q", price=-1.0),
    ]
    flags = quality_flags(mbo(spark, rows), TapeConfig(invalid_row_policy="quarantine"))
    out = quarantine_rows(flags).orderBy("source_row_number").collect()
    assert [r["rejection_reason"] for r in out] == [
        "invalid_price,invalid_sequence,invalid_side,invalid_size,invalid_tick_price,"
        "invalid_ts_event,invalid_ts_recv",
        "invalid_price,invalid_tick_price",
        "invalid_price,invalid_tick_price",
    ]
    seen = {r["source_row_number"]: r["reasons"] for r in flags.collect()}
    assert seen[3] == ["invalid_action"] and seen[4] == ["invalid_side"]
    cfg = TapeConfig(quarantine_sample_limit=2)
    writers.write_quarantine(quarantine_rows(flags), str(tmp_path / "q"), cfg)
    kept = spark.read.parquet(str(tmp_path / "q")).collect()
    assert sorted(r["source_row_number"] for r in kept) == [0, 1]


def test_reconciliation_failures(spark):
    raw = mbo(spark, ELEVEN)
    flags = quality_flags(raw, CFG)
    volume = volume_report(audit_cells(flags, CFG))
    tape = build_tape(raw, CFG)
    assert require_valid(validate_tape(tape_totals(tape), volume))["row_count"] == 4
    short = validate_tape(tape_totals(tape.filter("size <> 3")), volume)
    with pytest.raises(OutputError, match="row count.*size sum.*signed-volume"):
        require_valid(short)


def test_timestamp_text(spark):
    good = {
        "2026-04-06T00:00:00.001184655Z": ns("2026-04-06T00:00:00Z") + 1_184_655,
        "2026-04-06T00:00:00Z": ns("2026-04-06T00:00:00Z"),
        "1969-12-31T23:59:59.5Z": -500_000_000,
    }
    bad = [
        "2026-04-06T00:00:00",
        "2026-04-06 00:00:00Z",
        "2026-02-30T00:00:00Z",
        "2026-04-06T24:00:00Z",
        "2026-04-06T00:00:00.0123456789Z",
        "0000-01-01T00:00:00Z",
        "9999-01-01T00:00:00Z",
        "x",
        None,
    ]
    df = spark.createDataFrame([(t,) for t in [*good, *bad]], "t string")
    got = {r["t"]: r["n"] for r in df.select("t", parse_utc_ns(F.col("t")).alias("n")).collect()}
    assert got == {**good, **dict.fromkeys(bad)}
    back = spark.createDataFrame([(n,) for n in good.values()], "n bigint")
    assert [r[0] for r in back.select(ns_to_iso(F.col("n"))).collect()] == [
        "2026-04-06T00:00:00.001184655Z",
        "2026-04-06T00:00:00.000000000Z",
        "1969-12-31T23:59:59.500000000Z",
    ]


def test_all_times_of_a_long(spark):
    """Texts at both ends of the nanosecond range, and floors of numbers there."""
    ends = {
        "1677-09-21T00:12:43.145224192Z": -(2**63),
        "1677-09-21T00:12:43.145224191Z": None,
        "1969-12-31T23:59:59.999999999Z": -1,
        "2262-04-11T23:47:16.854775807Z": 2**63 - 1,
        "2262-04-11T23:47:16.854775808Z": None,
        "9999-12-31T00:00:00Z": None,
        "2026-01-01T00:00:00Z\n": None,
    }
    df = spark.createDataFrame([(t,) for t in ends], "t string")
    parsed = df.select("t", parse_utc_ns(F.col("t")).alias("n"))
    assert {r["t"]: r["n"] for r in parsed.collect()} == ends
    back = parsed.filter("n is not null").select("t", ns_to_iso(F.col("n")).alias("again"))
    assert all(r["t"] == r["again"] for r in back.collect())
    values = [-(2**63), -(2**63) + 1, -1001, -1000, -1, 0, 1, 999, 1000, 2**63 - 1]
    by = [1, 3, 6, 64, 1000, 10**9, 86_400_000_000, 1800 * 10**9, 4 * 10**9 * 86_400]
    rows = spark.createDataFrame([(v,) for v in values], "v bigint")
    got = rows.select("v", *(floor_div(F.col("v"), b).alias(str(b)) for b in by)).collect()
    assert all(r[str(b)] == r["v"] // b for r in got for b in by)


def test_sessions_do_not_depend_on_session_time_zone(spark):
    from tickloom.functions import is_rth, session_close_ns, session_open_ns, trading_date

    cfg = TapeConfig()
    times = [ns("2026-03-08T22:30:00Z"), ns("2026-03-09T14:00:00Z"), None]
    df = spark.createDataFrame([(t,) for t in times], "n bigint")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Asia/Tokyo", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            n = F.col("n")
            rows = df.select(trading_date(n, cfg), is_rth(n, cfg)).collect()
            assert [tuple(r) for r in rows] == [
                ("2026-03-09", False),
                ("2026-03-09", True),
                ("", False),
            ]
            day = F.lit("2026-03-09")
            bounds = df.select(session_open_ns(day, cfg), session_close_ns(day, cfg)).first()
            assert tuple(bounds) == (ns("2026-03-08T22:00:00Z"), ns("2026-03-09T21:00:00Z"))
            text = spark.createDataFrame([("2026-03-08T02:30:00.5Z",)], "t string")
            got = text.select(parse_utc_ns(F.col("t"))).first()[0]
            assert got == ns("2026-03-08T02:30:00Z") + 500_000_000
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def brute_ordering(rows):
    last, anomalies, twins = None, 0, 0
    for _, ts, seq in sorted(rows):
        if ts is None or seq is None:
            continue
        if last is not None:
            anomalies += (ts, seq) < last
            twins += (ts, seq) == last
        last = (ts, seq)
    return anomalies, twins


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_ordering_audit_matches_a_walk(spark, parts):
    rng = random.Random(parts)
    rows = [
        (
            i * (1 if i < 3000 else 700_001),
            None if rng.random() < 0.05 else i // 3 - rng.choice([0, 0, 0, 5]),
            None if rng.random() < 0.05 else rng.randrange(3),
        )
        for i in range(6000)
    ]
    mixed = rows[:]
    if parts > 1:
        rng.shuffle(mixed)
    df = spark.createDataFrame(
        mixed, "source_row_number bigint, ts_event_ns bigint, sequence bigint"
    )
    got = ordering_report(df.repartition(parts) if parts > 1 else df.coalesce(1)).first()
    assert (got["ordering_anomalies"], got["duplicate_candidates"]) == brute_ordering(rows)


def test_ordering_audit_of_nothing(spark):
    df = spark.createDataFrame([], "source_row_number bigint, ts_event_ns bigint, sequence bigint")
    assert tuple(ordering_report(df).first()) == (0, 0)


def test_row_numbers_over_files(spark, tmp_path):
    for i, n in enumerate((5, 0, 7)):
        table = pa.table({"v": pa.array(range(100 * i, 100 * i + n), pa.int64())})
        pq.write_table(table, tmp_path / f"part-{i}.parquet", row_group_size=2)
    df = readers.with_source_row_number(spark.read.parquet(str(tmp_path)))
    got = [tuple(r) for r in df.orderBy("source_row_number").select("source_row_number", "v").collect()]
    values = [*range(5), *range(200, 207)]
    assert got == list(enumerate(values))


def test_foreign_tape_with_nanoseconds(spark, tmp_path):
    stamp = pa.timestamp("ns", tz="UTC")
    exact = ns("2026-04-06T10:00:00Z") + 123_456_789
    table = pa.table(
        {
            "ts_event": pa.array([exact], stamp),
            "ts_recv": pa.array([exact + 5], stamp),
            "sequence": pa.array([7], pa.uint64()),
            "price": pa.array([100.25], pa.float64()),
            "size": pa.array([3], pa.int64()),
            "session_id": ["CME_EQ_FUT_2026-04-06"],
            "source_row_number": pa.array([11], pa.uint64()),
        }
    )
    folder = tmp_path / "symbol=007" / "trading_date=2026-04-06"
    folder.mkdir(parents=True)
    pq.write_table(table, folder / "x.parquet")
    cols = ("ts_event", "ts_event_ns", "sequence", "symbol", "price", "session_id", "trading_date")
    row = readers.read_tape(spark, str(tmp_path), cols).first()
    assert row["ts_event_ns"] == exact and row["sequence"] == 7
    assert (row["symbol"], row["trading_date"]) == ("007", "2026-04-06")
    with pytest.raises(SchemaError, match="publisher_id"):
        readers.read_tape(spark, str(tmp_path))


def test_schema_checks(spark, tmp_path):
    with pytest.raises(SchemaError, match="input has a twice, no c"):
        S.require_columns(["a", "a", "b"], ["a", "c"])
    spark.range(1).write.parquet(str(tmp_path / "x"))
    with pytest.raises(SchemaError):
        readers.read_mbo(spark, str(tmp_path / "x"))
    report = S.schema_report(spark.createDataFrame([], MBO)).collect()
    assert len(report) == 15 and all(r["input_valid"] for r in report)


def test_partial_sessions_only_at_the_edges(spark):
    hour = 3600
    times = []
    for day in ("2026-04-06", "2026-04-07", "2026-04-08"):
        start = ns(f"{day}T00:00:00Z")
        lo, hi = (2, 10) if day != "2026-04-06" else (-2, 21)
        times += [start + lo * hour * 10**9, start + hi * hour * 10**9 - 10**9]
    rows = [mbo_row("T", "B", sequence=i + 1) for i in range(len(times))]
    raw = mbo(spark, rows).drop("ts_event")
    stamps = spark.createDataFrame(list(enumerate(times)), "source_row_number bigint, ts_event bigint")
    flags = quality_flags(raw.join(stamps, "source_row_number"), CFG)
    out = partial_sessions(session_coverage(audit_cells(flags, CFG)), CFG).collect()
    assert [r["session_id"] for r in out] == ["CME_EQ_FUT_2026-04-08"]
    assert out[0]["expected_open"] == "2026-04-07T22:00:00.000000000Z"


def test_audit_reports(spark):
    out = audit_mbo(mbo(spark, ELEVEN), CFG)
    counts = {
        (r["grouping"], r["action"], r["side"]): r["rows"]
        for r in out["action_side_report"].collect()
    }
    assert counts["action", "T", None] == 6 and counts["side", None, "B"] == 6
    assert counts["action_side", "F", "B"] == 1
    assert {r["reason"]: r["rows"] for r in out["reason_counts"].collect()} == {
        "invalid_size": 1,
        "invalid_tick_price": 1,
    }
    assert out["rows_per_symbol"].collect()[0]["rows"] == 11


def test_config():
    for bad in (
        {"invalid_row_policy": "drop"},
        {"exchange_timezone": "Mars/Base"},
        {"tick_size": Decimal(0)},
        {"session_start": "25:00:00"},
        {"compression": "zip"},
        {"quarantine_sample_limit": -1},
    ):
        with pytest.raises(ConfigError):
            TapeConfig(**bad)


def test_old_tape_survives_a_refused_one(spark, tmp_path):
    path, cfg = str(tmp_path / "t"), TapeConfig(overwrite=True)
    tape = build_tape(mbo(spark, ELEVEN), CFG)
    writers.write_tape(tape, path, cfg)

    def refuse(totals):
        raise OutputError(f"{totals['row_count']} rows")

    for part, check, said in ((tape.filter("size > 1000"), None, "no trade rows"), (tape, refuse, "4 rows")):
        with pytest.raises(OutputError, match=said):
            writers.write_tape(part, path, cfg, check)
        assert readers.read_tape(spark, path).count() == 4
        assert [p.name for p in tmp_path.iterdir()] == ["t"]
    writers.write_tape(tape.limit(2), path, cfg)
    assert readers.read_tape(spark, path).count() == 2


def test_audit_and_validate_jobs(spark, tmp_path):
    source, tape, reports = (str(tmp_path / x) for x in ("raw", "tape", "reports"))
    mbo(spark, ELEVEN).withColumn("flags", F.lit(0)).drop("source_row_number").write.parquet(source)
    run_audit_job(spark, source, reports, CFG)
    seen = {r["column_name"] for r in spark.read.parquet(f"{reports}/schema_report").collect()}
    assert "flags" in seen
    build_tape(readers.read_mbo(spark, source), CFG).transform(lambda df: writers.write_tape(df, tape, CFG) and df)
    assert run_validate_job(spark, tape, reports)["row_count"] == 4
    writers.write_tape(readers.read_tape(spark, tape).limit(3), f"{tape}2", CFG)
    with pytest.raises(OutputError):
        run_validate_job(spark, f"{tape}2", reports)


def test_shared_folder_is_asked_for(spark, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared or spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        assert not writers.scratch_path(spark, "x").startswith("/tmp/spark-")
    else:
        with pytest.raises(OutputError, match="spark.checkpoint.dir"):
            writers.scratch_path(spark, "x")
