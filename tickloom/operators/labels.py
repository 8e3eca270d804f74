"""First-barrier labels: what the trades after an entry reach first."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom import schema as S
from tickloom.config import ExecutionConfig
from tickloom.functions.clock import NS, bucket_start, floor_div, ns_to_ts
from tickloom.functions.ordering_keys import causal_key, guard_nulls
from tickloom.functions.prices import barrier_geometry, dec
from tickloom.sources.writers import stored

# What decides a label; equal candidates share one search.
_TASK = (
    "symbol",
    "cme_session_id",
    "entry_side",
    "stop_price",
    "target_price",
    "start_ns",
    "end_ns",
)


def _hit(side: Column, low: Column, high: Column, stop: Column, target: Column) -> Column:
    """Prices from ``low`` to ``high`` touch a barrier."""
    return F.when(side == "LONG", (low <= stop) | (high >= target)).otherwise(
        (high >= stop) | (low <= target)
    )


def with_windows(candidates: DataFrame, cfg: ExecutionConfig) -> DataFrame:
    """Add the search window and the verdict on the candidate itself.

    Latency moves the start of the window, not its end.
    """
    required = ("symbol", "cme_session_id", "entry_side", "entry_timestamp", "entry_price",
                "stop_price", "target_1", "max_holding_seconds", "setup_id", "setup_type", "ts_event")
    entry_ns = F.unix_micros(F.col("entry_timestamp")) * 1000
    side, entry = F.col("entry_side"), F.col("entry_price")
    stop, target = F.col("stop_price"), F.col("target_1")
    # Verdicts, in the order they are tested.
    verdict = (
        F.when(~side.isin("LONG", "SHORT"), "INVALID_ENTRY_SIDE")
        .when(entry == stop, "INVALID_RISK")
        .when(~barrier_geometry(side, entry, stop, target), "INVALID_BARRIER_GEOMETRY")
    )
    checked = guard_nulls(F.col("setup_id"), *(F.col(c) for c in required))
    return candidates.withColumns(
        {
            "setup_id": checked,
            "start_ns": entry_ns + cfg.entry_latency_seconds * NS,
            "end_ns": entry_ns + F.col("max_holding_seconds") * NS,
            "target_price": target,
            "verdict": verdict,
        }
    )


#: Distinct (symbol, session, minute) keys that are broadcast: about 40 MB of short texts.
MOST_PROBED = 500_000


def _tasks(windows: DataFrame) -> DataFrame:
    return windows.filter(F.col("verdict").isNull()).select(*_TASK).distinct()


#: Buckets under a node, and nodes under its parent: a session of any length is a few parents.
FAN = 64


def extreme_tree(buckets: DataFrame) -> DataFrame:
    """``level, node, kids`` over ``buckets`` numbered ``no`` by symbol and session.

    A node holds its ``FAN`` children as one array of (no, lo, hi, n, last): price range, trades and
    last bucket with trades. Level 1 are nodes over buckets, level 2 their parents.
    """
    keys = ["symbol", "cme_session_id"]

    def above(below: DataFrame) -> DataFrame:
        kid = F.struct("no", "lo", "hi", "n", "last")
        return below.groupBy(*keys, floor_div(F.col("no"), FAN).alias("node")).agg(
            F.array_sort(F.collect_list(kid)).alias("kids"),
            F.min("lo").alias("lo"),
            F.max("hi").alias("hi"),
            F.when(F.count_if(F.col("n").isNull()) == 0, F.sum("n")).alias("n"),
            F.max("last").alias("last"),
        )

    first = stored(above(buckets.withColumn("last", F.col("no"))), "extreme-nodes")
    second = above(first.select(*keys, F.col("node").alias("no"), "lo", "hi", "n", "last"))
    out = [d.select(*keys, F.lit(k).alias("level"), "node", "kids") for k, d in ((1, first), (2, second))]
    return out[0].unionByName(out[1])


def tree_places(a: Column, b: Column) -> Column:
    """The nodes ``(level, node)`` that a window from node ``a`` to node ``b`` of level 1 meets.

    Both ends, and the parents of what lies between: at most four for up to ``FAN`` nodes.
    """
    nothing = F.array().cast("array<struct<level:int,node:bigint>>")
    place = lambda level, node: F.struct(F.lit(level).alias("level"), node.alias("node"))
    first = floor_div(a + 1, FAN)
    parents = F.transform(F.sequence(first, F.greatest(first, floor_div(b - 1, FAN))), lambda p: place(2, p))
    return F.concat(
        F.array(place(1, a)),
        F.when(b > a, F.array(place(1, b))).otherwise(nothing),
        F.when(b > a + 1, parents).otherwise(nothing),
    )


def first_touched(tasks: DataFrame, buckets: DataFrame, keys: list[str], touched) -> DataFrame:
    """First touched bucket (``hit_no``), last bucket and trade count in ``[from_no, to_no)`` of each task.

    A task meets at most four nodes, whatever its window holds: the two at the window's ends, with
    their buckets, and the parents of those between, with the nodes; if a node between is the first
    that is touched, one more join finds the bucket in it.
    """
    tree = extreme_tree(buckets)
    low, high = F.col("from_no"), F.col("to_no")
    ends = tasks.withColumns({"_a": floor_div(low, FAN), "_b": floor_div(high - 1, FAN)})
    a, b = F.col("_a"), F.col("_b")
    edge = F.col("level") == 1
    inside = F.filter(
        F.col("kids"),
        lambda k: (k["no"] >= F.when(edge, low).otherwise(a + 1)) & (k["no"] < F.when(edge, high).otherwise(b)),
    )
    count = F.aggregate(F.col("_in"), F.lit(0).cast("bigint"), lambda n, k: n + k["n"])
    met = (
        ends.filter(low < high)
        .withColumn("_asked", F.explode(tree_places(a, b)))
        .select(*keys, "_a", F.col("_asked.level").alias("level"), F.col("_asked.node").alias("node"), "from_no", "to_no", "_b")
        .join(tree, ["symbol", "cme_session_id", "level", "node"])
        .withColumn("_in", inside)
        .withColumn("_first", F.get(F.filter("_in", lambda k: touched(k["lo"], k["hi"])), F.lit(0))["no"])
        .withColumn("_n", guard_nulls(count, count))
        .groupBy(*keys)
        .agg(
            F.sum("_n").alias("inner_n"),
            F.max(F.array_max(F.transform("_in", lambda k: k["last"]))).alias("last_no"),
            F.min(F.when(edge & (F.col("node") == a), F.col("_first"))).alias("_head"),
            F.min(F.when(~edge, F.col("_first"))).alias("_between"),
            F.min(F.when(edge & (F.col("node") != a), F.col("_first"))).alias("_tail"),
        )
    )
    # A task without a node between that counts asks for one that does not exist, each for its own.
    seek = F.when(F.col("_head").isNull(), F.col("_between"))
    nodes = tree.filter("level = 1").select("symbol", "cme_session_id", F.col("node").alias("_seek"), "kids")
    found = met.withColumn("_seek", F.coalesce(seek, -1 - F.abs(F.xxhash64(*keys)) % (1 << 40))).join(
        nodes, ["symbol", "cme_session_id", "_seek"], "left"
    )
    deep = F.get(F.filter("kids", lambda k: touched(k["lo"], k["hi"])), F.lit(0))["no"]
    hit = F.coalesce("_head", F.when(seek.isNotNull(), deep), "_tail")
    return found.select(*keys, "inner_n", "last_no", hit.alias("hit_no"))


def barrier_events(
    tasks: DataFrame,
    tape: DataFrame,
    bucket_seconds: int = 60,
    wide_keys: bool = False,
) -> DataFrame:
    """First hit, last trade and trade count in each task's window.

    Two passes over the tape instead of one row per (candidate, trade) pair:

    1. Trades are aggregated to short buckets (price range, count, last price), and these to a tree
       of ranges, in which each task finds the first bucket strictly inside its window that touches
       a barrier (``first_touched``).
    2. Only the trades of that bucket, of the last one with trades and of the two at the window's
       edges are joined, through an equi-join on (symbol, session, bucket). The distinct buckets
       are counted; up to ``MOST_PROBED`` of them are broadcast to drop other trades before any
       exchange, beyond that the equi-join alone does it.
    """
    join_on = ["symbol", "cme_session_id"]
    cols = ["symbol", "session_id", "ts_event_ns", "sequence", "source_row_number", "price"]
    keys = [*join_on, *(c for c in _TASK if c not in join_on)]
    trades = tape.select(*cols).withColumnRenamed("session_id", "cme_session_id")
    trades = trades.withColumn("bucket", bucket_start(F.col("ts_event_ns"), bucket_seconds))
    needed = [F.col(c) for c in ("price", "sequence", "source_row_number")]
    broken = needed[0].isNull() | needed[1].isNull() | needed[2].isNull()
    buckets = (
        trades.filter(F.col("ts_event_ns").isNotNull())
        .select(*join_on, "bucket", "price", broken.alias("_broken"))
        .groupBy(*join_on, "bucket")
        .agg(
            F.min("price").alias("lo"),
            F.max("price").alias("hi"),
            F.when(F.count_if("_broken") == 0, F.count(F.lit(1))).alias("n"),
        )
    )
    width = bucket_seconds * NS
    spanned = tasks.withColumns(
        {
            "first_bucket": bucket_start(F.col("start_ns"), bucket_seconds),
            "last_bucket": bucket_start(F.col("end_ns"), bucket_seconds),
        }
    )
    ranged = spanned.withColumns(
        {"from_no": floor_div(F.col("first_bucket"), width) + 1, "to_no": floor_div(F.col("last_bucket"), width)}
    )
    stop, target, side = F.col("stop_price"), F.col("target_price"), F.col("entry_side")
    inner = first_touched(
        ranged.select(*keys, "from_no", "to_no"),
        buckets.withColumn("no", floor_div(F.col("bucket"), width)),
        keys,
        lambda lo, hi: _hit(side, lo, hi, stop, target),
    )
    coarse = spanned.join(inner, keys, "left").select(
        *keys,
        "first_bucket",
        "last_bucket",
        "inner_n",
        (F.col("hit_no") * width).alias("hit_bucket"),
        (F.col("last_no") * width).alias("inner_last"),
    )
    wanted = F.array_distinct(
        F.array_compact(F.array("first_bucket", "last_bucket", "hit_bucket", "inner_last"))
    )
    probes = coarse.select(
        *keys,
        F.coalesce("inner_n", F.lit(0)).alias("inner_n"),
        "first_bucket",
        "last_bucket",
        F.explode(wanted).alias("bucket"),
    )
    probes = stored(probes, "probes")
    probed = probes.select(*join_on, "bucket").distinct()
    if probed.count() <= MOST_PROBED:
        trades = trades.join(F.broadcast(probed), [*join_on, "bucket"], "left_semi")
    order = causal_key(
        F.col("ts_event_ns") - F.col("start_ns"),
        F.col("sequence"),
        F.col("source_row_number"),
        wide_keys,
    )
    edge = F.col("bucket").isin(F.col("first_bucket"), F.col("last_bucket"))
    hit = _hit(side, F.col("price"), F.col("price"), stop, target)
    return (
        trades.join(probes, [*join_on, "bucket"])
        .filter(F.col("ts_event_ns").between(F.col("start_ns"), F.col("end_ns")))
        .select(
            *keys,
            "inner_n",
            "ts_event_ns",
            guard_nulls(F.col("price"), *needed).alias("price"),
            edge.alias("_edge"),
            hit.alias("_hit"),
            order.alias("_order"),
        )
        .withColumn("_hit_order", F.when(F.col("_hit"), F.col("_order")))
        .groupBy(*keys)
        .agg(
            (F.max("inner_n") + F.count_if("_edge")).alias("event_count"),
            F.min_by("price", "_hit_order").alias("hit_price"),
            F.min_by("ts_event_ns", "_hit_order").alias("hit_ns"),
            F.max_by("price", "_order").alias("last_price"),
            F.max_by("ts_event_ns", "_order").alias("last_ns"),
        )
        .select(*_TASK, "event_count", "hit_ns", "hit_price", "last_ns", "last_price")
    )


def entry_fill(side: Column, entry: Column, cfg: ExecutionConfig) -> Column:
    slip = F.lit(cfg.tick_size * cfg.entry_slippage_ticks)
    return F.when(side == "LONG", entry + slip).otherwise(entry - slip)


def barrier_fill(
    side: Column, reason: Column, stop: Column, target: Column, trade: Column, cfg: ExecutionConfig
) -> Column:
    """A stop fills at the worse of stop and trade, with slippage; a target at its price."""
    slip = F.lit(cfg.tick_size * cfg.stop_slippage_ticks)
    worse = F.when(side == "LONG", F.least(stop, trade) - slip).otherwise(
        F.greatest(stop, trade) + slip
    )
    return F.when(reason == "TARGET_1", target).otherwise(worse)


def time_exit_fill(side: Column, trade: Column, cfg: ExecutionConfig) -> Column:
    slip = F.lit(cfg.tick_size * cfg.time_exit_slippage_ticks)
    return F.when(side == "LONG", trade - slip).otherwise(trade + slip)


def first_barrier_labels(
    candidates: DataFrame,
    tape: DataFrame,
    cfg: ExecutionConfig,
    bucket_seconds: int = 60,
    wide_keys: bool = False,
) -> DataFrame:
    """One label per candidate: exit, fills, points and R after costs.

    The packed order key spans windows up to 27 hours; ``wide_keys`` lifts that. See
    ``barrier_events`` for how the trades are searched.
    """
    windows = with_windows(candidates, cfg)
    events = barrier_events(_tasks(windows), tape, bucket_seconds, wide_keys)
    joined = windows.join(events, list(_TASK), "left")
    side, verdict = F.col("entry_side"), F.col("verdict")
    entry, stop, target = dec(F.col("entry_price")), dec(F.col("stop_price")), dec(F.col("target_price"))
    hit_stop = F.when(side == "LONG", F.col("hit_price") <= F.col("stop_price")).otherwise(
        F.col("hit_price") >= F.col("stop_price")
    )
    # Exit reasons.
    reason = (
        F.when(verdict.isNotNull(), verdict)
        .when(F.col("hit_ns").isNotNull() & hit_stop, "STOP")
        .when(F.col("hit_ns").isNotNull(), "TARGET_1")
        .when(F.col("last_ns").isNotNull(), "MAX_HOLD")
        .otherwise("NO_FUTURE_DATA")
    )
    valid = verdict.isNull()
    at = joined.withColumns(
        {
            "exit_reason": reason,
            "exit_ns": F.when(valid, F.coalesce("hit_ns", "last_ns")),
            "exit_trade_price": F.when(valid, F.coalesce("hit_price", "last_price")),
            "risk": F.abs(entry - stop),
        }
    )
    trade = dec(F.col("exit_trade_price"))
    exit_fill = F.when(F.col("exit_reason") == "MAX_HOLD", time_exit_fill(side, trade, cfg)).when(
        F.col("exit_reason").isin("STOP", "TARGET_1"),
        barrier_fill(side, F.col("exit_reason"), stop, target, trade, cfg),
    )
    commission = F.lit(Decimal(2) * cfg.commission_per_side / cfg.point_value).cast("decimal(30,18)")
    filled = at.withColumns(
        {"entry_fill": F.when(valid, entry_fill(side, entry, cfg)), "exit_fill": exit_fill}
    )
    gross = F.when(side == "LONG", F.col("exit_fill") - F.col("entry_fill")).otherwise(
        F.col("entry_fill") - F.col("exit_fill")
    )
    filled = filled.withColumn("gross", gross).withColumn("net", F.col("gross") - commission)
    risk = F.when(valid, F.col("risk").cast("double"))
    available = (
        F.when(~valid, F.col("start_ns"))
        .when(F.col("exit_ns").isNull(), F.col("end_ns"))
        .otherwise(F.col("exit_ns"))
    )
    return S.conform(
        filled.select(
            "setup_id",
            "ts_event",
            "symbol",
            "cme_session_id",
            "setup_type",
            "entry_side",
            "entry_timestamp",
            ns_to_ts(F.col("start_ns")).alias("earliest_entry_timestamp"),
            ns_to_ts(F.col("end_ns")).alias("max_exit_timestamp"),
            "entry_price",
            F.col("entry_fill").alias("entry_fill_price"),
            "stop_price",
            "target_price",
            ns_to_ts(F.col("exit_ns")).alias("exit_timestamp"),
            "exit_trade_price",
            F.col("exit_fill").alias("exit_fill_price"),
            "exit_reason",
            (F.col("exit_reason") == "TARGET_1").alias("success"),
            risk.alias("planned_risk_points"),
            F.col("gross").alias("gross_points"),
            (F.col("gross").cast("double") / risk).alias("gross_r"),
            F.col("net").alias("net_points"),
            (F.col("net").cast("double") / risk).alias("net_r"),
            F.lit(float(cfg.commission_per_side)).alias("commission_per_side"),
            F.lit(float(cfg.point_value)).alias("point_value"),
            F.lit(cfg.entry_slippage_ticks).alias("entry_slippage_ticks"),
            F.lit(cfg.stop_slippage_ticks).alias("stop_slippage_ticks"),
            F.lit(cfg.time_exit_slippage_ticks).alias("time_exit_slippage_ticks"),
            F.lit(cfg.entry_latency_seconds).alias("entry_latency_seconds"),
            F.coalesce("event_count", F.lit(0)).alias("event_count"),
            ns_to_ts(available).alias("label_available_timestamp"),
            F.lit(cfg.ambiguity_policy).alias("ambiguity_policy"),
            F.coalesce("reason_codes", F.array().cast("array<string>")).alias("reason_codes"),
        ),
        S.LABEL,
    )
