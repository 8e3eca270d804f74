"""Bars, gaps, indicators and candidates."""

import random
from decimal import ROUND_CEILING, ROUND_FLOOR, ROUND_HALF_UP, Decimal

import pytest
from helpers import NS, bars, iso, ns, tape
from pyspark.sql import functions as F

from tickloom.config import ConfigError, GapSetupConfig, IndicatorSetupConfig
from tickloom.functions import month_label, price_text, round_to_tick
from tickloom.operators.bars import candles, ohlcv_bars, rollup_bars
from tickloom.operators.candidates import (
    atr_reason,
    failed_gap_candidates,
    indicator_candidates,
)
from tickloom.operators.gaps import gap_fill_status, gap_zones, latest_gaps
from tickloom.operators.indicators import atr, effort_ratios, emas, rsi
from tickloom.operators.matching import greedy_match
from tickloom.plans.jobs import gap_candidates, technical_candidates

GAP = GapSetupConfig(range_window=3, volume_window=3)
TECH = IndicatorSetupConfig(rsi_period=3, macd_fast=2, macd_slow=3, macd_signal=2, atr_window=3)

H1 = [
    ("2026-04-06T13:00:00Z", 100, 100, 95, 100, 100),
    ("2026-04-06T14:00:00Z", 100, 101, 96, 100, 100),
    ("2026-04-06T15:00:00Z", 100, 106, 102, 100, 100),
]
M30 = [
    ("2026-04-06T14:30:00Z", 99.0, 100, 99, 99.5, 100),
    ("2026-04-06T15:00:00Z", 101.0, 102, 101, 101.5, 100),
    ("2026-04-06T15:30:00Z", 102.0, 103, 102, 102.5, 100),
    ("2026-04-06T16:00:00Z", 102.5, 103, 99.5, 100.75, 200),
    ("2026-04-06T16:30:00Z", 100.5, 101, 98, 99, 150),
]


def flat(times_closes):
    return [(t, c, c, c, c, 100) for t, c in times_closes]


TIMES = [f"2026-04-07T{h:02d}:{m:02d}:00Z" for h in range(13, 18) for m in (0, 30)]


def test_gap_zone_golden(spark):
    rows = [
        ("2026-04-06T13:00:00Z", 100, 100, 95, 100, 1),
        ("2026-04-06T14:00:00Z", 100, 104, 102, 100, 1),
        ("2026-04-06T15:00:00Z", 100, 106, 102, 100, 1),
        ("2026-04-06T16:00:00Z", 100, 99, 93, 100, 1),
    ]
    out = gap_zones(bars(spark, rows), 3600).orderBy("formed_ns").collect()
    got = [(r["kind"], r["zone_low"], r["zone_high"], r["available_ns"]) for r in out]
    assert got == [
        ("BULL", 100.0, 102.0, ns("2026-04-06T16:00:00Z")),
        ("BEAR", 99.0, 102.0, ns("2026-04-06T17:00:00Z")),
    ]
    assert out[0]["zone_id"].startswith("setup_") and len(out[0]["zone_id"]) == 22


def test_no_zone_over_a_session_break(spark):
    broken = H1[:2] + [(*H1[2], "CME_EQ_FUT_2026-04-08")]
    assert gap_zones(bars(spark, broken), 3600).count() == 0
    assert gap_zones(bars(spark, broken), 3600, session_scoped=False).count() == 1


def test_failed_gap_golden_and_causality(spark):
    zone_bars, signal_bars = bars(spark, H1), bars(spark, M30)
    (row,) = failed_gap_candidates(zone_bars, signal_bars, GAP).collect()
    assert (row["setup_type"], row["entry_side"]) == ("FAILED_BULL_FVG", "SHORT")
    assert row["entry_price"] == 100.5 and row["stop_price"] == 103.0
    assert row["structural_invalidation"] == 103.0
    assert (row["target_1"], row["target_2"], row["target_3"]) == (98.0, 95.5, 90.5)
    assert (row["max_holding_bars"], row["max_holding_seconds"]) == (12, 21600)
    assert row["reason_codes"] == [
        "FAILED_BULL_FVG_SHORT",
        "FVG_OVERLAP_CONFIRMED",
        "EFFORT_WITHOUT_RESULT",
    ]
    future = M30 + [
        ("2026-04-06T17:00:00Z", 99, 110, 90, 105, 999),
        ("2026-04-06T17:30:00Z", 105, 106, 80, 81, 999),
    ]
    again = failed_gap_candidates(zone_bars, bars(spark, future), GAP).collect()
    assert row in again


def test_failed_gap_needs_the_next_bar(spark):
    hole = M30[:4] + [("2026-04-06T17:00:00Z", 100.5, 101, 98, 99, 150)]
    assert failed_gap_candidates(bars(spark, H1), bars(spark, hole), GAP).count() == 0


TRADES = [
    ("13:00:00", 95.0, 50), ("13:30:00", 100.0, 50), ("14:00:00", 96.0, 50), ("14:10:00", 101.0, 50),
    ("14:30:00", 99.0, 50), ("14:59:00", 100.0, 50), ("15:00:00", 101.0, 50), ("15:29:00", 102.0, 50),
    ("15:30:00", 102.0, 50), ("15:59:00", 103.0, 50), ("16:00:00", 102.5, 50), ("16:10:00", 103.0, 50),
    ("16:20:00", 99.5, 50), ("16:29:00", 100.75, 50), ("16:30:00", 100.5, 50), ("16:45:00", 99.0, 100),
]


def test_tape_to_failed_gap(spark):
    rows = [(f"2026-04-06T{t}Z", p, s, i) for i, (t, p, s) in enumerate(TRADES, 1)]
    (row,) = gap_candidates(tape(spark, rows), GAP).collect()
    assert (row["entry_price"], row["stop_price"], row["target_3"]) == (100.5, 103.0, 90.5)


def test_tape_to_indicator(spark):
    closes = [100, 101, 102, 103, 103]
    rows = [(t.replace("04-07", "04-06"), c, 100, i) for i, (t, c) in enumerate(zip(TIMES, closes), 1)]
    (row,) = technical_candidates(tape(spark, rows), TECH).collect()
    assert (row["entry_side"], row["entry_price"], row["stop_price"]) == ("LONG", 103.0, 101.0)
    assert row["reason_codes"][2] == "QEP_ATR_STOP_2X"


@pytest.mark.parametrize(
    ("closes", "side", "stop", "targets"),
    [
        ([100, 101, 102, 103, 103], "LONG", 101.0, (106.0, 109.0, 112.0)),
        ([103, 102, 101, 100, 100], "SHORT", 102.0, (97.0, 94.0, 91.0)),
    ],
)
def test_indicator_golden_and_causality(spark, closes, side, stop, targets):
    rows = flat(zip(TIMES, closes))
    (row,) = indicator_candidates(bars(spark, rows), TECH).collect()
    assert row["entry_side"] == side and row["stop_price"] == stop
    assert (row["target_1"], row["target_2"], row["target_3"]) == targets
    assert len(row["setup_id"]) == 64
    later = flat(zip(TIMES, [*closes, 90, 80]))
    assert row in indicator_candidates(bars(spark, later), TECH).collect()


def test_bars_in_causal_order_whatever_the_layout(spark):
    rng = random.Random(5)
    start = ns("2026-04-06T14:00:00Z")
    rows = [
        (start + rng.randrange(7200) * NS + rng.choice([0, 1, 999]), 100 + rng.randrange(40) / 4,
         rng.randrange(1, 9), rng.randrange(5), i)
        for i in range(3000)
    ]
    want = {}
    for t, p, s, q, i in sorted(rows, key=lambda r: (r[0], r[3], r[4])):
        key = t // (1800 * NS) * 1800 * NS
        o, h, low, _, v = want.get(key, (p, p, p, p, 0))
        want[key] = (o, max(h, p), min(low, p), p, v + s)
    base = tape(spark, rows)
    for df in (base.repartition(1), base.repartition(7), base.orderBy(F.rand(3)).repartition(64)):
        for wide in (False, True):
            out = ohlcv_bars(df, 1800, wide_keys=wide).collect()
            got = {
                r["bar_start_ns"]: (r["open"], r["high"], r["low"], r["close"], r["volume"])
                for r in out
            }
            assert got == want
    direct = sorted(map(tuple, ohlcv_bars(base, 3600).collect()))
    rolled = rollup_bars(ohlcv_bars(base, 1800), 3600)
    assert sorted(map(tuple, rolled.select(ohlcv_bars(base, 3600).columns).collect())) == direct


def test_bar_guards(spark):
    with pytest.raises(Exception, match="null in a required column"):
        ohlcv_bars(tape(spark, [("2026-04-06T14:00:00Z", None, 1, 1)]), 1800).collect()
    huge = tape(spark, [("2026-04-06T14:00:00Z", 1.0, 1, 10**11), ("2026-04-06T14:00:01Z", 2.0, 1, 1)])
    with pytest.raises(Exception, match="wide keys"):
        ohlcv_bars(huge, 1800).collect()
    assert ohlcv_bars(huge, 1800, wide_keys=True).first()["close"] == 2.0
    week = candles(huge, 7 * 86_400).first()
    assert (week["open"], week["close"], week["trades"]) == (1.0, 2.0, 2)


def test_candles_on_a_local_clock(spark):
    rows = [("2026-03-08T04:30:00Z", 1.0, 1, 1), ("2026-03-08T05:30:00Z", 2.0, 1, 2),
            ("2026-03-09T03:59:59Z", 3.0, 1, 3), ("2026-03-09T04:00:00Z", 4.0, 1, 4)]
    out = candles(tape(spark, rows), 86_400, "America/New_York").orderBy("bar_start_ns").collect()
    assert [(r["open"], r["close"]) for r in out] == [(1.0, 1.0), (2.0, 3.0), (4.0, 4.0)]


def test_gap_fill_against_a_scan(spark):
    rng = random.Random(11)
    rows, price = [], 1000.0
    for i in range(4500):
        price += rng.choice([-3, -2, -1, 0, 1, 2, 3.25])
        rows.append((i * 1800 * NS, price + rng.random(), price - rng.random()))
    df = spark.createDataFrame(
        [("A", *r) for r in rows] + [("B", *r) for r in rows[:70]],
        "symbol string, bar_start_ns bigint, high double, low double",
    )

    def scan(rows):
        out = {}
        for i in range(2, len(rows)):
            t, high, low = rows[i]
            _, far_high, far_low = rows[i - 2]
            if low > far_high:
                later = (r[0] for r in rows[i + 1 :] if r[2] <= far_high)
            elif high < far_low:
                later = (r[0] for r in rows[i + 1 :] if r[1] >= far_low)
            else:
                continue
            fill = next(later, None)
            end = (rows[-1][0] if fill is None else fill) + 1800 * NS
            out[t] = ("OPEN" if fill is None else "FULLY_FILLED", end)
        return out

    got = {"A": {}, "B": {}}
    for r in gap_fill_status(df, 1800).collect():
        got[r["symbol"]][r["start_ns"]] = (r["status"], r["end_ns"])
    assert got["A"] == scan(rows) and got["B"] == scan(rows[:70])
    few = gap_fill_status(df.where("symbol = 'B'").orderBy("bar_start_ns").limit(40), 1800)
    assert {r["start_ns"]: (r["status"], r["end_ns"]) for r in few.collect()} == scan(rows[:40])
    assert gap_fill_status(df.where("symbol = 'C'"), 1800).count() == 0
    newest = latest_gaps(gap_fill_status(df, 1800), 5).collect()
    assert [r["start_ns"] for r in newest] == sorted(got["A"], reverse=True)[:5]


def test_greedy_match_against_a_walk(spark):
    rng = random.Random(3)
    rows = []
    for g in range(60):
        for s in range(rng.randrange(1, 9)):
            for z in rng.sample(range(5), rng.randrange(0, 4)):
                rows.append((g, s, z, z * 10, rng.random() < 0.7))
    df = spark.createDataFrame(rows, "g bigint, s bigint, z bigint, at bigint, good boolean")
    want = set()
    for g in range(60):
        used = set()
        for s in sorted({r[1] for r in rows if r[0] == g}):
            options = sorted((r for r in rows if r[:2] == (g, s)), key=lambda r: -r[3])
            for r in options:
                if r[2] in used:
                    continue
                want.add(r)
                if r[4]:
                    used.add(r[2])
                break
    got = greedy_match(df, ["g"], "s", "z", "at", "good").select("g", "s", "z", "at", "good")
    assert {tuple(r) for r in got.collect()} == want


def test_averages_against_the_recurrence(spark):
    rng = random.Random(1)
    closes = [1000.0]
    for _ in range(3000):
        closes.append(closes[-1] + rng.choice([-1, 0.25, 1.5, -0.75]))
    df = spark.createDataFrame(
        [("A", i, c) for i, c in enumerate(closes)], "symbol string, bar_start_ns bigint, close double"
    )
    periods = {"e1": 1, "e2": 2, "e9": 9, "e26": 26, "e300": 300}
    out = emas(df, {k: ("close", n) for k, n in periods.items()}).orderBy("bar_start_ns").collect()
    for name, n in periods.items():
        value, alpha = None, 2 / (n + 1)
        for row, c in zip(out, closes):
            value = c if value is None else (c - value) * alpha + value
            assert abs(row[name] - value) < 1e-8


def test_averages_carry_over_all_blocks(spark):
    closes = [1e300] + [0.0] * 400
    df = spark.createDataFrame(
        [("A", i, c) for i, c in enumerate(closes)], "symbol string, bar_start_ns bigint, close double"
    )
    out = emas(df, {"e": ("close", 3)}).orderBy("bar_start_ns").collect()
    for i, row in enumerate(out):
        assert abs(row["e"] / (1e300 * 0.5**i) - 1) < 1e-9


def test_rsi_and_atr_edges(spark):
    rows = flat(zip(TIMES, [10, 10, 10, 10, 11, 12, 13, 12]))
    out = rsi(bars(spark, rows), 3).orderBy("bar_start_ns").collect()
    assert [r["rsi"] for r in out[:3]] == [None] * 3
    assert out[3]["rsi"] == 50.0 and out[6]["rsi"] == 100.0
    assert round(out[7]["rsi"], 6) == round(100 - 100 / (1 + 2 / 1), 6)
    ranges = atr(bars(spark, rows), 3).orderBy("bar_start_ns").collect()
    assert ranges[4]["atr"] is None and ranges[6]["atr"] == 1.0


def test_effort_needs_full_positive_windows(spark):
    rows = [(t, 10, 10 + w, 10, 10, v) for t, w, v in zip(TIMES, [1, 0, 1, 1, 2], [5, 5, 5, 5, 20])]
    out = effort_ratios(bars(spark, rows), 2, 2).orderBy("bar_start_ns").collect()
    assert [r["effort_range_ratio"] for r in out] == [None, None, None, None, 2.0]
    assert out[4]["effort_volume_ratio"] == 4.0
    loose = effort_ratios(bars(spark, rows), 2, 2, strict=False).orderBy("bar_start_ns").collect()
    assert [r["baseline_range"] for r in loose] == [None, None, 0.5, 0.5, 1.0]


def test_tick_rounding_against_decimal(spark):
    values = [-1.375, -1.125, -0.1, 0.0, 0.1, 0.125, 0.375, 100.13, 17432.37, 17432.875]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    modes = {"half_up": ROUND_HALF_UP, "up": ROUND_CEILING, "down": ROUND_FLOOR}
    for tick in (Decimal("0.25"), Decimal("0.1"), Decimal("0.01")):
        for mode, rule in modes.items():
            got = [r[0] for r in df.select(round_to_tick(F.col("v"), tick, mode)).collect()]
            want = [(Decimal(str(v)) / tick).to_integral_value(rounding=rule) * tick for v in values]
            assert got == want


def test_texts(spark):
    prices = [100.0, 17432.25, 12345678.5, 0.1]
    df = spark.createDataFrame([(p,) for p in prices], "p double")
    assert [r[0] for r in df.select(price_text(F.col("p"))).collect()] == [str(p) for p in prices]
    names = {
        "/a/2024-01_MES.parquet": "2024-01",
        "2024-01.parquet": "2024-01",
        "C:\\x\\2024-02_b.c.parquet": "2024-02",
        "/a/2024-011_x.parquet": "2024-011_x",
        "/a/trades_2024-01.parquet": "trades_2024-01",
    }
    paths = spark.createDataFrame([(n,) for n in names], "p string")
    assert [r[0] for r in paths.select(month_label(F.col("p"))).collect()] == list(names.values())
    assert [atr_reason(Decimal(v)) for v in ("2", "2.50", "1.5")] == [
        "QEP_ATR_STOP_2X", "QEP_ATR_STOP_2.5X", "QEP_ATR_STOP_1.5X",
    ]


def test_config_checks():
    for bad in ({"range_window": 0}, {"stop_buffer_ticks": -1}, {"tick_size": Decimal(0)}):
        with pytest.raises(ConfigError):
            GapSetupConfig(**bad)
    for bad in ({"macd_fast": 26}, {"rsi_period": 0}, {"atr_stop_mult": Decimal(0)}):
        with pytest.raises(ConfigError):
            IndicatorSetupConfig(**bad)
    assert IndicatorSetupConfig().warmup == 33 and iso(0) == "1970-01-01T00:00:00Z"
