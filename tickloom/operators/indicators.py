"""Bar indicators.

Windows hold one block of a symbol's bars and the few rows of its neighbours that they reach
(``operators.blocks``). A function takes plain bars, or bars that its caller has put in blocks for
several indicators at once.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.prices import dec
from tickloom.operators.blocks import bar_order, block_window, in_blocks, numbered

# Block ends that an average is folded over: 1e-18 to this power takes the largest double to zero.
_REACH = 36


def bar_range() -> Column:
    return dec(F.col("high")) - dec(F.col("low"))


def effort_ratios(
    bars: DataFrame, range_window: int = 20, volume_window: int = 20, strict: bool = True
) -> DataFrame:
    """Range and volume against the mean of the bars before, current bar excluded.

    ``strict`` asks for a positive current bar and only positive prior values; otherwise a full
    window is enough (``baseline_range`` and ``baseline_volume`` are then plain trailing means).
    The exact sums stay in ``range_sum`` and ``volume_sum`` for gates that must not round.
    """
    compute = lambda df: _effort(df, range_window, volume_window, strict)
    return in_blocks(bars, compute, max(range_window, volume_window))


def _effort(bars: DataFrame, range_window: int, volume_window: int, strict: bool) -> DataFrame:
    w = block_window(bars)
    wr, wv = w.rowsBetween(-range_window, -1), w.rowsBetween(-volume_window, -1)
    out = bars.withColumn("bar_range", bar_range()).withColumns(
        {
            "range_sum": F.sum("bar_range").over(wr),
            "volume_sum": F.sum("volume").over(wv),
            "_nr": F.count("bar_range").over(wr),
            "_nv": F.count("volume").over(wv),
            "_lr": F.min("bar_range").over(wr),
            "_lv": F.min("volume").over(wv),
        }
    )
    ready = (F.col("_nr") == range_window) & (F.col("_nv") == volume_window)
    if strict:
        usable = (
            ready
            & (F.col("bar_range") > 0)
            & (F.col("volume") > 0)
            & (F.col("_lr") > 0)
            & (F.col("_lv") > 0)
        )
    else:
        usable = ready & (F.col("range_sum") > 0) & (F.col("volume_sum") > 0)
    num = lambda c: F.col(c).cast("double")
    return out.withColumns(
        {
            "baseline_range": F.when(F.col("_nr") == range_window, num("range_sum") / range_window),
            "baseline_volume": F.when(
                F.col("_nv") == volume_window, num("volume_sum") / volume_window
            ),
            "effort_range_ratio": F.when(usable, num("bar_range") * range_window / num("range_sum")),
            "effort_volume_ratio": F.when(usable, num("volume") * volume_window / num("volume_sum")),
        }
    ).drop("_nr", "_nv", "_lr", "_lv")


def _close_before(df: DataFrame) -> DataFrame:
    before = F.lag(dec(F.col("close"))).over(block_window(df))
    return df if "close_before" in df.columns else df.withColumn("close_before", before)


def rsi(bars: DataFrame, period: int = 14) -> DataFrame:
    """RSI with simple averages of the last ``period`` changes; null until there are enough."""
    return in_blocks(bars, lambda df: _rsi(df, period), period)


def _rsi(bars: DataFrame, period: int) -> DataFrame:
    frame = block_window(bars).rowsBetween(-(period - 1), 0)
    change = dec(F.col("close")) - F.col("close_before")
    sums = _close_before(bars).withColumns(
        {
            "_gain": F.sum(F.greatest(change, F.lit(0))).over(frame).cast("double"),
            "_loss": F.sum(F.greatest(-change, F.lit(0))).over(frame).cast("double"),
            "_n": F.count(change).over(frame),
        }
    )
    value = (
        F.when(F.col("_n") < period, F.lit(None))
        .when((F.col("_loss") == 0) & (F.col("_gain") > 0), F.lit(100.0))
        .when(F.col("_loss") == 0, F.lit(50.0))
        .otherwise(100.0 - 100.0 / (1.0 + F.col("_gain") / F.col("_loss")))
    )
    return sums.withColumn("rsi", value).drop("_gain", "_loss", "_n")


def _folded(ends: Column, decay: float) -> Column:
    """The recurrence ``older * decay + end`` over an array."""
    return F.aggregate(ends, F.lit(0.0), lambda older, end: older * decay + end)


def emas(df: DataFrame, wanted: dict[str, tuple[str, int]]) -> DataFrame:
    """Exponential averages ``{out: (column, period)}``, alpha = 2 / (period + 1), each seeded with
    the first value.

    The recurrence is cut into blocks of rows. Inside a block it is a weighted running sum; what
    came before adds the average at the last block's end times r^k. These averages are the same
    recurrence over the table of block ends, one row a block, which is folded over ``_REACH``
    blocks: the block length puts r^block under 1e-18, so the weight of anything older takes
    every double to zero. All averages share the block of the slowest one.
    """
    placed_in = numbered(df)
    direct = {out: F.col(c).cast("double") for out, (c, n) in wanted.items() if n == 1}
    slow = {out: cn for out, cn in wanted.items() if cn[1] > 1}
    if not slow:
        return placed_in.withColumns(direct)
    r_of = {out: (n - 1.0) / (n + 1.0) for out, (_, n) in slow.items()}
    block = math.ceil(18 * math.log(10) / -math.log(max(r_of.values())))
    if block * -math.log(min(r_of.values())) > 600:
        # Weights of the fastest one would leave the range of a double: take them apart.
        first = min(slow, key=lambda out: slow[out][1])
        rest = {out: cn for out, cn in wanted.items() if out != first}
        return emas(emas(placed_in, {first: wanted[first]}), rest)
    inside = (
        Window.partitionBy("symbol", "_block")
        .orderBy(*bar_order(df))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    past = Window.partitionBy("symbol").orderBy("_block").rowsBetween(1 - _REACH, 0)
    k = F.col("_k")
    local, carry, total = {}, {}, {}
    for out, (col, n) in slow.items():
        r = r_of[out]
        weight = F.when(F.col("bar_no") == 0, F.lit(1.0)).otherwise(F.lit(2.0 / (n + 1)))
        scaled = weight * F.col(col).cast("double") * F.pow(F.lit(1.0 / r), k)
        local[f"_l_{out}"] = F.sum(scaled).over(inside) * F.pow(F.lit(r), k)
        ends_so_far = F.collect_list(F.coalesce(F.col(f"_l_{out}"), F.lit(0.0))).over(past)
        carry[f"_c_{out}"] = _folded(ends_so_far, r**block)
        tail = F.coalesce(F.col(f"_c_{out}") * F.pow(F.lit(r), k + 1), F.lit(0.0))
        total[out] = F.col(f"_l_{out}") + tail
    placed = placed_in.withColumns(
        {
            "_block": F.floor(F.col("bar_no") / block),
            "_k": (F.col("bar_no") % block).cast("double"),
        }
    ).withColumns(local)
    ends = placed.filter(k == block - 1).select(
        "symbol", (F.col("_block") + 1).alias("_block"), *local
    )
    ends = ends.select("symbol", "_block", *(c.alias(name) for name, c in carry.items()))
    joined = placed.join(ends, ["symbol", "_block"], "left").withColumns({**total, **direct})
    return joined.select(*placed_in.columns, *(out for out in wanted if out not in placed_in.columns))


def ema(df: DataFrame, col: str, period: int, out: str) -> DataFrame:
    """One exponential average; see ``emas``."""
    return emas(df, {out: (col, period)})


def macd(bars: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9) -> DataFrame:
    """Fast minus slow average of the close (``macd``) and its own average (``macd_signal``)."""
    out = emas(bars, {"_fast": ("close", fast), "_slow": ("close", slow)})
    out = out.withColumn("macd", F.col("_fast") - F.col("_slow")).drop("_fast", "_slow")
    return ema(out, "macd", signal, "macd_signal")


def atr(bars: DataFrame, period: int = 14) -> DataFrame:
    """Mean true range of the last ``period`` bars; null early on or when one of them is not
    positive. The exact sum stays in ``true_range_sum``."""
    return in_blocks(bars, lambda df: _atr(df, period), period)


def _atr(bars: DataFrame, period: int) -> DataFrame:
    frame = block_window(bars).rowsBetween(-(period - 1), 0)
    high, low, before = dec(F.col("high")), dec(F.col("low")), F.col("close_before")
    out = _close_before(bars).withColumn(
        "true_range", F.greatest(high - low, F.abs(high - before), F.abs(low - before))
    )
    usable = (F.col("bar_no") >= period) & (F.min("true_range").over(frame) > 0)
    total = F.sum("true_range").over(frame)
    return out.withColumn("true_range_sum", F.when(usable, total)).withColumn(
        "atr", F.col("true_range_sum").cast("double") / period
    )


def with_entry_bar(bars: DataFrame, seconds: int) -> DataFrame:
    """Add start and open of the next bar, null unless it follows at once in the same session."""
    return in_blocks(bars, lambda df: _entry_bar(df, seconds), 0, 1)


def _entry_bar(bars: DataFrame, seconds: int) -> DataFrame:
    w = block_window(bars)
    cols = ["bar_start_ns", "open"] + (["session_id"] if "session_id" in bars.columns else [])
    out = bars.withColumn("_next", F.lead(F.struct(*cols)).over(w))
    follows = F.col("_next.bar_start_ns") == F.col("bar_start_ns") + seconds * 1_000_000_000
    if "session_id" in bars.columns:
        follows = follows & (F.col("_next.session_id") == F.col("session_id"))
    return out.withColumns(
        {
            "entry_ns": F.when(follows, F.col("_next.bar_start_ns")),
            "entry_open": F.when(follows, F.col("_next.open")),
            "is_last": F.col("_next").isNull(),
        }
    ).drop("_next")
