"""Windows over blocks of numbered bars."""

import random
import re
import time

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickloom.operators import blocks, gaps
from tickloom.operators import indicators as I
from tickloom.operators.gaps import gap_fill_status, gap_zones
from tickloom.operators.matching import greedy_match

SCHEMA = "symbol string, session_id string, bar_start_ns long, open double, high double, low double, close double, volume long"
NS = 1_000_000_000


def bars(spark, n=400, symbols=("A", "B"), seed=1):
    rng = random.Random(seed)
    rows = []
    for s in symbols:
        t = -50 * 86_400 * NS  # days before the epoch, with long silences
        for k in range(n if s == "A" else n // 10):
            t += 1800 * NS * (1 if rng.random() < 0.9 else rng.randint(2, 200))
            low = 100 + rng.randint(-40, 40) / 4
            high = low + rng.randint(0, 12) / 4
            rows.append((s, f"S{k // 13}", t, low, high, low, rng.choice([low, high]), rng.randint(0, 9)))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA)


def ordered(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def tiny(monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK", 7)


def test_numbers_are_row_numbers(spark):
    df = bars(spark)
    w = Window.partitionBy("symbol").orderBy("bar_start_ns", "session_id")
    want = df.withColumn("bar_no", F.row_number().over(w).cast("bigint") - 1)
    for cell in (1, 3_600, 86_400, 10**9):
        assert ordered(blocks.numbered(df, cell)) == ordered(want)
    assert blocks.numbered(want) is want
    assert blocks.numbered(df.limit(0)).collect() == []


def test_halo_gives_every_row_its_neighbours(spark):
    df = blocks.numbered(bars(spark, 100))
    for before, after, block in ((0, 0, 7), (3, 1, 7), (20, 15, 7), (2, 2, 1), (5, 5, 1000)):
        blocked = blocks.with_halo(df, before, after, block)
        w = blocks.block_window(blocked).rowsBetween(-before, after)
        got = blocks.own_rows(blocked.withColumn("near", F.collect_list("bar_no").over(w)), block)
        assert "_part" not in got.columns
        last = {r.symbol: r.n for r in df.groupBy("symbol").agg(F.max("bar_no").alias("n")).collect()}
        rows = got.collect()
        assert len(rows) == df.count()
        for r in rows:
            assert r.near == list(range(max(0, r.bar_no - before), min(last[r.symbol], r.bar_no + after) + 1))


@pytest.mark.parametrize(
    "name", ["effort", "loose", "rsi", "ema", "macd", "atr", "entry", "zones", "fills"]
)
def test_small_blocks_change_nothing(spark, monkeypatch, name):
    run = {
        "effort": lambda b: I.effort_ratios(b, 3, 20),
        "loose": lambda b: I.effort_ratios(b, 20, 5, strict=False),
        "rsi": lambda b: I.rsi(b, 14),
        "ema": lambda b: I.ema(b, "close", 9, "e"),
        "macd": lambda b: I.macd(b, 3, 7, 4),
        "atr": lambda b: I.atr(b, 14),
        "entry": lambda b: I.with_entry_bar(b, 1800),
        "zones": lambda b: gap_zones(b, 1800, session_scoped=False),
        "fills": lambda b: gap_fill_status(b, 1800),
    }[name]
    df = bars(spark)
    whole = ordered(run(df))
    monkeypatch.setattr(blocks, "BLOCK", 7)
    assert ordered(run(df)) == whole and whole


def windows(df):
    """Partition keys and first order column of each window of a plan."""
    text = df._jdf.queryExecution().executedPlan().toString()
    strip = lambda x: re.sub(r"#\d+L?", "", x)
    return {(strip(keys), strip(order)) for keys, order in re.findall(r"Window \[.*\], \[([^\]]*)\], \[(\w+#\d+L?)", text)}


def test_no_window_holds_a_whole_symbol_of_bars(spark, tiny):
    df = blocks.numbered(bars(spark))
    plans = [I.effort_ratios(df, 3, 5), I.rsi(df), I.macd(df), I.atr(df), I.with_entry_bar(df, 1800), gap_zones(df, 1800, session_scoped=False)]
    for p in plans:
        found = windows(p)
        assert found
        # One row a cell or block, not bars: the sums of numbers and the carry of averages.
        small = {("symbol", "_cell"), ("symbol", "_block")}
        assert all(keys in ("symbol, _part", "symbol, _block") for keys, _ in found - small), found


def test_one_symbol_uses_many_tasks(spark, tiny):
    df = I.rsi(blocks.numbered(bars(spark, 2000, ("A",))))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        used = len({r.p for r in df.select("rsi", F.spark_partition_id().alias("p")).collect()})
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert used > 4


def filled(rows, seconds=1800):
    """Zones of one symbol's (time, high, low), each with its first fill by a plain scan."""
    out = {}
    for i in range(2, len(rows)):
        (t, high, low), (_, far_high, far_low) = rows[i], rows[i - 2]
        if low > far_high:
            later = (r[0] for r in rows[i + 1 :] if r[2] <= far_high)
        elif high < far_low:
            later = (r[0] for r in rows[i + 1 :] if r[1] >= far_low)
        else:
            continue
        fill = next(later, None)
        end = (rows[-1][0] if fill is None else fill) + seconds * NS
        out[t] = ("OPEN" if fill is None else "FULLY_FILLED", end)
    return out


def drifting(kind, n=420):
    """(time, high, low) of bars that wander, only rise, rise until one bar fills every zone, or stand still."""
    rng, price, rows = random.Random(kind), 1000.0, []
    for i in range(n):
        price += {"walk": rng.choice([-3, -1, 0, 1, 2]), "flat": 0}.get(kind, 3)
        low = 1.0 if kind == "crash" and i == n - 5 else price - 0.5
        rows.append((i * 1800 * NS, price + 0.5, low))
    return rows


@pytest.mark.parametrize("fan", [2, 3, 64])
def test_fills_in_trees_of_any_fan_equal_a_scan(spark, monkeypatch, fan):
    monkeypatch.setattr(gaps, "_FAN", fan)
    markets = {k: drifting(k) for k in ("walk", "rise", "crash", "flat")} | {"short": drifting("walk", 3)}
    rows = [(s, *r) for s, market in markets.items() for r in market]
    df = spark.createDataFrame(rows, "symbol string, bar_start_ns long, high double, low double")
    got = {s: {} for s in markets}
    for r in gap_fill_status(df, 1800).collect():
        assert r.start_ns not in got[r.symbol]
        got[r.symbol][r.start_ns] = (r.status, r.end_ns)
    assert got == {s: filled(market) for s, market in markets.items()}
    assert {x[0] for x in got["crash"].values()} == {"FULLY_FILLED", "OPEN"} and len(got["rise"]) > 400


def test_zones_are_keyed_by_their_own_block(spark, monkeypatch):
    """A symbol whose zones all stay open until one bar has many keys, none with more than a block's zones."""
    monkeypatch.setattr(gaps, "_FAN", 3)
    rows = [("A", *r) for r in drifting("crash", 600)]
    df = spark.createDataFrame(rows, "symbol string, bar_start_ns long, high double, low double")
    tables = []
    monkeypatch.setattr(gaps, "stored", lambda found, name: tables.append(blocks.stored(found, name)) or tables[-1])
    assert gap_fill_status(df, 1800).count() > 590
    assert tables
    for t in tables:
        held = [r["count"] for r in t.groupBy("symbol", "block").count().collect()]
        assert max(held) <= 9 and len(held) > 60


def test_walk_of_zone_use_is_linear(spark):
    """20,000 signals that each meet zones used before; a fold over taken zones would take minutes."""
    n = 20_000
    pairs = spark.range(n).selectExpr("1 AS g", "id AS s", "explode(sequence(greatest(id - 3, 0), id)) AS z", "CAST(1 AS decimal(9,2)) AS kept")
    df = pairs.withColumn("at", F.col("z"))
    started = time.monotonic()
    got = greedy_match(df, ["g"], "s", "z", "at")
    assert got.columns == df.columns
    assert got.where("s = z").count() == n == got.count()
    assert time.monotonic() - started < 60
