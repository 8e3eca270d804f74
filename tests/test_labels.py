"""Labels, reports and the study."""

import random
from dataclasses import replace
from datetime import UTC, datetime
from decimal import Decimal

import pytest
from helpers import NS, bars, candidate, candidates, ns, tape
from pyspark.sql import functions as F

from tickloom import schema as S
from tickloom.config import ConfigError, ExecutionConfig, StudyConfig, TapeConfig
from tickloom.operators import labels as labels_operator
from tickloom.operators.labels import first_barrier_labels
from tickloom.operators.reports import (
    diagnose,
    label_counts,
    label_gate_report,
    label_summary,
    net_r_buckets,
)
from tickloom.operators.study import bar_barrier_outcomes, equity_curve, trade_summary
from tickloom.plans.jobs import run_candidate_job, run_label_job
from tickloom.sources import readers, writers

FREE = ExecutionConfig()


def ts(text):
    return datetime.fromisoformat(text.replace("Z", "+00:00")).astimezone(UTC).replace(tzinfo=None)


FIVE = [
    ("2026-04-06T09:59:59Z", 106.0, 1, 1),
    ("2026-04-06T10:00:01Z", 105.0, 1, 2),
    ("2026-04-06T10:00:02Z", 95.0, 1, 3),
    ("2026-04-06T11:00:01Z", 198.0, 1, 4),
    ("2026-04-06T11:00:02Z", 205.0, 1, 5),
]


def test_first_barrier_golden(spark):
    cands = candidates(
        spark,
        candidate("long_target", "LONG", "2026-04-06T10:00:00Z", 100.0, 95.0, 105.0),
        candidate("short_stop", "SHORT", "2026-04-06T11:00:00Z", 200.0, 205.0, 195.0),
    )
    out = {r["setup_id"]: r for r in first_barrier_labels(cands, tape(spark, FIVE), FREE).collect()}
    win, loss = out["long_target"], out["short_stop"]
    assert (win["exit_reason"], win["success"], win["gross_r"], win["net_r"]) == ("TARGET_1", True, 1.0, 1.0)
    assert win["exit_timestamp"] == ts("2026-04-06T10:00:01Z") and win["event_count"] == 4
    assert (loss["exit_reason"], loss["success"], loss["net_r"]) == ("STOP", False, -1.0)
    assert loss["exit_timestamp"] == ts("2026-04-06T11:00:02Z")


def test_verdicts_and_empty_windows(spark):
    at = "2026-04-06T10:00:00Z"
    cands = candidates(
        spark,
        candidate("side", "FLAT", at, 100.0, 95.0, 105.0),
        candidate("risk", "LONG", at, 100.0, 100.0, 105.0),
        candidate("geometry", "SHORT", at, 100.0, 95.0, 105.0),
        candidate("nothing", "LONG", "2026-04-06T18:00:00Z", 100.0, 95.0, 105.0),
        candidate("hold", "LONG", at, 100.0, 50.0, 150.0, max_holding_seconds=2),
    )
    cfg = replace(FREE, entry_slippage_ticks=1, time_exit_slippage_ticks=2, commission_per_side=Decimal("0.5"))
    out = {r["setup_id"]: r for r in first_barrier_labels(cands, tape(spark, FIVE), cfg).collect()}
    assert out["side"]["exit_reason"] == "INVALID_ENTRY_SIDE"
    assert out["risk"]["exit_reason"] == "INVALID_RISK"
    assert out["geometry"]["exit_reason"] == "INVALID_BARRIER_GEOMETRY"
    for name in ("side", "risk", "geometry"):
        assert out[name]["entry_fill_price"] is None and out[name]["event_count"] == 0
        assert out[name]["label_available_timestamp"] == ts(at)
    empty = out["nothing"]
    assert empty["exit_reason"] == "NO_FUTURE_DATA" and empty["net_r"] is None
    assert empty["entry_fill_price"] == 100.25 and empty["planned_risk_points"] == 5.0
    assert empty["label_available_timestamp"] == empty["max_exit_timestamp"]
    held = out["hold"]
    assert held["exit_reason"] == "MAX_HOLD" and held["exit_trade_price"] == 95.0
    assert held["exit_fill_price"] == 94.5 and held["event_count"] == 2
    assert held["net_points"] == 94.5 - 100.25 - 0.5


def brute(c, trades, cfg):
    entry, stop, target, side = c["entry"], c["stop"], c["target"], c["side"]
    start = c["at"] + cfg.entry_latency_seconds * NS
    end = c["at"] + c["hold"] * NS
    seen = sorted((t for t in trades if start <= t[0] <= end), key=lambda t: (t[0], t[3], t[4]))
    if not seen:
        return ("NO_FUTURE_DATA", None, None, 0)
    for t in seen:
        if (t[1] <= stop) if side == "LONG" else (t[1] >= stop):
            return ("STOP", t[0] // 1000, t[1], len(seen))
        if (t[1] >= target) if side == "LONG" else (t[1] <= target):
            return ("TARGET_1", t[0] // 1000, t[1], len(seen))
    return ("MAX_HOLD", seen[-1][0] // 1000, seen[-1][1], len(seen))


@pytest.mark.parametrize(
    ("bucket", "latency", "wide", "probed"),
    [(60, 0, False, 0), (7, 13, True, 0), (900, 1, False, 500_000), (86_400, 0, False, 500_000)],
)
def test_labels_against_a_walk(spark, monkeypatch, bucket, latency, wide, probed):
    monkeypatch.setattr(labels_operator, "MOST_PROBED", probed)
    rng = random.Random(bucket)
    start = ns("2026-04-06T10:00:00Z")
    price, trades = 100.0, []
    for i in range(1500):
        price += rng.choice([-0.5, -0.25, 0, 0.25, 0.5])
        t = start + rng.randrange(0, 9000) * NS + rng.choice([0, 0, 1, 500])
        trades.append((t, price, 1, rng.randrange(3), i))
    cands, rows = [], []
    for i in range(80):
        at = start + rng.randrange(0, 9500) * NS
        near = rng.choice([95, 100, 105]) + rng.randrange(8) / 4
        side, wide_by = rng.choice(["LONG", "SHORT"]), rng.choice([1, 3, 40])
        sign = 1 if side == "LONG" else -1
        hold = rng.choice([0, 5, 600, 3600])
        c = {"at": at, "entry": near, "stop": near - sign * wide_by, "target": near + sign * wide_by,
             "side": side, "hold": hold, "id": f"c{i}"}
        cands.append(c)
        text = datetime.fromtimestamp(at // NS, UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
        rows.append(candidate(c["id"], side, text, near, c["stop"], c["target"], max_holding_seconds=hold))
    cfg = ExecutionConfig(entry_latency_seconds=latency)
    df = tape(spark, trades)
    out = first_barrier_labels(
        candidates(spark, *rows, rows[0]), df.repartition(5), cfg, bucket, wide
    ).collect()
    assert len(out) == 81
    got = {
        r["setup_id"]: (
            r["exit_reason"],
            None if r["exit_timestamp"] is None
            else int(r["exit_timestamp"].replace(tzinfo=UTC).timestamp() * 1_000_000 + 0.5),
            r["exit_trade_price"],
            r["event_count"],
        )
        for r in out
    }
    assert got == {c["id"]: brute(c, trades, cfg) for c in cands}


def test_candidates_need_their_columns(spark):
    broken = candidate("x", "LONG", "2026-04-06T10:00:00Z", 100.0, 95.0, 105.0, cme_session_id=None)
    with pytest.raises(Exception, match="null in a required column"):
        first_barrier_labels(candidates(spark, broken), tape(spark, FIVE), FREE).collect()


def label(setup_id, side, reason, success, net_r, code):
    values = dict.fromkeys(f.name for f in S.LABEL)
    values.update(setup_id=setup_id, entry_side=side, exit_reason=reason, success=success, net_r=net_r,
                  reason_codes=[code], setup_type="QEP_TECHNICAL", entry_timestamp=datetime(2026, 4, 6))
    return tuple(values[f.name] for f in S.LABEL)


def test_label_report_golden(spark, tmp_path):
    rows = [
        label("1", "LONG", "MAX_HOLD", False, -0.2, "QEP_RSI_ABOVE_50"),
        label("2", "LONG", "MAX_HOLD", False, -0.1, "QEP_RSI_ABOVE_50"),
        label("3", "SHORT", "MAX_HOLD", False, -0.4, "QEP_RSI_BELOW_50"),
        label("4", "SHORT", "STOP", False, -1.0, "QEP_RSI_BELOW_50"),
        label("5", "LONG", "TARGET_1", True, 0.0, "QEP_RSI_ABOVE_50"),
    ]
    spark.createDataFrame(rows, S.LABEL).write.parquet(str(tmp_path / "labels"))
    labels = readers.read_labels(spark, str(tmp_path / "labels"))
    row = diagnose(label_summary(labels, spark.range(10))).first()
    assert (row["candidate_count"], row["success_count"], row["hit_rate"]) == (5, 1, 0.2)
    assert (row["sum_net_r"], row["avg_net_r"], row["candidate_density"]) == (-1.7, -0.34, 0.5)
    text = "; ".join(row["diagnosis"])
    for part in ("negative expectancy", "MAX_HOLD dominates", "target conversion is weak", "density is high"):
        assert part in text
    assert "STOP exits" not in text
    counts = {(r["kind"], r["value"]): r["labels"] for r in label_counts(labels).collect()}
    assert counts["exit_reason", "MAX_HOLD"] == 3 and counts["reason_code", "QEP_RSI_BELOW_50"] == 2
    stats = {(r["kind"], r["value"]): (r["sum_net_r"], r["avg_net_r"]) for r in net_r_buckets(labels).collect()}
    assert stats["exit_reason", "MAX_HOLD"] == (-0.7, -0.2333)
    gate = {r["exit_reason"]: r["successes"] for r in label_gate_report(labels).collect()}
    assert gate == {"MAX_HOLD": 0, "STOP": 0, "TARGET_1": 1}
    empty = diagnose(label_summary(labels.limit(0), spark.range(0))).first()
    assert empty["hit_rate"] is None and empty["candidate_density"] is None
    assert "no single dominant" in empty["diagnosis"][0]


def test_jobs_end_to_end(spark, tmp_path):
    from test_setups import GAP, TRADES

    rows = [(f"2026-04-06T{t}Z", p, s, i) for i, (t, p, s) in enumerate(TRADES, 1)]
    from pyspark.sql import functions as F

    full = tape(spark, rows).withColumn("trading_date", F.lit("2026-04-06"))
    full.write.partitionBy("symbol", "trading_date").parquet(str(tmp_path / "tape"))
    cfg = TapeConfig()
    run_candidate_job(spark, str(tmp_path / "tape"), str(tmp_path / "cands"), cfg, GAP)
    run_label_job(spark, str(tmp_path / "tape"), str(tmp_path / "cands"), str(tmp_path / "labels"), cfg, FREE)
    foreign = TapeConfig(session_prefix="CME_")
    run_label_job(spark, str(tmp_path / "tape"), str(tmp_path / "cands"), str(tmp_path / "more"), foreign, FREE, str(tmp_path / "reports"))
    assert spark.read.parquet(str(tmp_path / "more")).collect() == spark.read.parquet(str(tmp_path / "labels")).collect()
    gate = spark.read.parquet(str(tmp_path / "reports/label_gate_report")).collect()
    assert [(r["exit_reason"], r["labels"]) for r in gate] == [("MAX_HOLD", 1)]
    (row,) = spark.read.parquet(str(tmp_path / "labels")).collect()
    assert row["symbol"] == "ESM6"
    assert row["exit_reason"] == "MAX_HOLD" and row["event_count"] == 2 and row["exit_trade_price"] == 99.0
    with pytest.raises(Exception, match="(?i)exists"):
        run_candidate_job(spark, str(tmp_path / "tape"), str(tmp_path / "cands"), cfg, GAP)


def test_bar_outcomes(spark):
    rows = [(f"2026-04-06T{14 + i // 2}:{'30' if i % 2 else '00'}:00Z", 100, h, low, c, 1)
            for i, (h, low, c) in enumerate([(100, 99, 100), (101, 99, 100), (103, 97, 102), (110, 90, 105)])]
    from pyspark.sql import functions as F

    numbered = bars(spark, rows).withColumn("bar_no", (F.col("bar_start_ns") - ns("2026-04-06T14:00:00Z")) / (1800 * NS))
    numbered = numbered.withColumn("bar_no", F.col("bar_no").cast("bigint"))
    signals = spark.createDataFrame(
        [
            ("ESM6", 1, 0, "LONG", 100.0, 97.0, 3.0, 1.0, 3, 1),
            ("ESM6", 2, 0, "LONG", 100.0, 96.0, 4.0, 0.75, 3, 2),
            ("ESM6", 3, 0, "SHORT", 100.0, 120.0, 20.0, 4.0, 2, 1),
            ("ESM6", 4, 0, "SHORT", 100.0, 103.5, 3.5, 1.0, 3, 1),
        ],
        "symbol string, signal_ns bigint, bar_no bigint, direction string, entry_open double, stop double, "
        "risk_points double, regime_take_profit_r double, regime_max_hold_bars int, contracts bigint",
    )
    out = {r["signal_ns"]: r for r in bar_barrier_outcomes(signals, numbered, StudyConfig()).collect()}
    assert (out[1]["status"], out[1]["points"], out[1]["pnl"]) == ("STOP_LOSS", -3.0, -20.0)
    assert (out[2]["status"], out[2]["points"], out[2]["pnl"]) == ("TAKE_PROFIT", 3.0, 20.0)
    assert (out[3]["status"], out[3]["exit_price"]) == ("TIME_OUT", 102.0)
    assert (out[4]["status"], out[4]["exit_price"]) == ("STOP_LOSS", 103.5)


def test_equity_and_summary(spark):
    cfg = StudyConfig()
    times = [ns(f"2026-04-0{d}T15:00:00Z") + i for d, i in ((6, 0), (6, 1), (7, 0))]
    rows = [("A", "2026-04", t, p, "LOW") for t, p in zip(times, (500.0, -800.0, -100.0))]
    trades = spark.createDataFrame(rows, "symbol string, month string, entry_ns bigint, pnl double, regime string")
    curve = equity_curve(trades, cfg)
    got = [(r["balance"], r["peak"], r["drawdown"]) for r in curve.orderBy("entry_ns").collect()]
    assert got == [(10500.0, 10500.0, 0.0), (9700.0, 10500.0, 800.0), (9600.0, 10500.0, 900.0)]
    skipped = spark.createDataFrame(
        [("A", "2026-04", 2, 1, 0), ("B", "2026-04", 1, 0, 0)],
        "symbol string, month string, skipped_missing_entry bigint, skipped_invalid_risk bigint, "
        "skipped_no_contracts bigint",
    )
    a, b = trade_summary(curve, skipped, cfg).orderBy("symbol").collect()
    assert (a["trades"], a["wins"], a["losses"], a["net_pnl"], a["return_pct"]) == (3, 1, 2, -400.0, -4.0)
    assert a["max_drawdown_pct"] == 8.57 and a["max_daily_dd_pct"] == 3.0 and a["low_vol_trades"] == 3
    assert (b["trades"], b["win_rate"], b["skipped_missing_entry"]) == (0, 0.0, 1)


def test_loose_readers(spark, tmp_path):
    rows = spark.createDataFrame(
        [(0, "T", 10.0, 1), (1, "F", 10.0, 1), (2, "T", -1.0, 1), (3, "T", 10.0, 0), (None, "T", 1.0, 1)],
        "ts_event bigint, action string, price double, size bigint",
    )
    assert [r["ts_event_ns"] for r in readers.normalize_trades(rows).collect()] == [0]
    assert readers.normalize_trades(rows.drop("action")).count() == 2
    rows.coalesce(1).write.parquet(str(tmp_path / "2024-01_x"))
    labelled = readers.normalize_trades(spark.read.parquet(str(tmp_path / "2024-01_x")), with_month=True)
    assert labelled.first()["month"].startswith("part-")
    chart = readers.chart_trades(rows.select("ts_event", "price"))
    assert chart.count() == 4 and chart.first()["size"] == 0.0
    with pytest.raises(S.SchemaError):
        readers.chart_trades(rows, "S0")
    writers.write_csv(chart, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 4


def test_study_config():
    for bad in ({"low_ratio": 2.0}, {"last_hour": 3}, {"market_tz": "No/Where"}):
        with pytest.raises(ConfigError):
            StudyConfig(**bad)
    with pytest.raises(ConfigError):
        ExecutionConfig(point_value=Decimal(0))


def test_first_touched_bucket_matches_a_walk(spark):
    rng = random.Random(11)
    keys = ["symbol", "cme_session_id", "stop_price", "target_price", "task"]
    walk = {}
    for symbol in ("A", "B"):
        price = 100.0
        for no in range(-300, 5_000):
            price += rng.choice([-0.25, 0.0, 0.25])
            if rng.random() < 0.7:
                walk[symbol, no] = (price - 0.25 * rng.randint(0, 2), price + 0.25, rng.randint(1, 5))
    buckets = spark.createDataFrame(
        [(s, "X", no, lo, hi, n) for (s, no), (lo, hi, n) in walk.items()],
        "symbol string, cme_session_id string, no long, lo double, hi double, n long",
    )
    tasks = []
    for k in range(300):
        start = rng.randint(-320, 4_900)
        width = rng.choice([0, -3, 1, 5, 63, 64, 65, 130, 1_380, 4_500])
        mid = 100 + rng.randint(-60, 60) / 4
        tasks.append(("AB"[k % 2], "X", mid - rng.randint(1, 60) / 4, mid + rng.randint(1, 60) / 4, k, start, start + width))
    tasks.append(("C", "X", 1.0, 2.0, 999, 0, 50))
    df = spark.createDataFrame(
        tasks, "symbol string, cme_session_id string, stop_price double, target_price double, task int, from_no long, to_no long"
    )
    touched = lambda lo, hi: (lo <= F.col("stop_price")) | (hi >= F.col("target_price"))
    got = {r.task: (r.inner_n, r.last_no, r.hit_no) for r in labels_operator.first_touched(df, buckets, keys, touched).collect()}
    want = {}
    for symbol, _, stop, target, k, start, end in tasks:
        seen = [(no, *walk[symbol, no]) for no in range(start, end) if (symbol, no) in walk]
        if seen:
            hits = [no for no, lo, hi, _ in seen if lo <= stop or hi >= target]
            want[k] = (sum(x[3] for x in seen), seen[-1][0], min(hits, default=None))
    assert {k: v for k, v in got.items() if v[0]} == want
    assert len({v[2] for v in want.values()}) > 50


def test_a_task_meets_four_nodes_whatever_its_window(spark):
    rows = [(a, a + n) for a in (-130, -1, 0, 5, 63, 4_095) for n in (0, 1, 2, 20, 63)]
    df = spark.createDataFrame(rows, "a long, b long").select("a", "b", labels_operator.tree_places(F.col("a"), F.col("b")).alias("p"))
    for r in df.collect():
        assert len(r.p) <= 4
        met = [x.node for x in r.p if x.level == 1]
        met += [n for x in r.p if x.level == 2 for n in range(x.node * labels_operator.FAN, (x.node + 1) * labels_operator.FAN) if r.a < n < r.b]
        assert sorted(met) == list(range(r.a, r.b + 1))
