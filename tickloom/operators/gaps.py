"""Three-bar price gaps and when they fill."""

from __future__ import annotations

from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.clock import NS, floor_div, ns_to_offset_iso
from tickloom.functions.prices import price_text, stable_id, zone_mid
from tickloom.operators.blocks import block_window, in_blocks, numbered
from tickloom.sources.writers import stored

# Children per node of the fill search, which travel as one bounded array; a block has _FAN**2 bars.
_FAN = 64


def _zone_columns() -> list[Column]:
    """The zone of a bar that carries high and low of the bar two before as ``_far``."""
    high, low = F.col("high"), F.col("low")
    far_high, far_low = F.col("_far.high"), F.col("_far.low")
    kind = F.when(low > far_high, "BULL").when(high < far_low, "BEAR")
    return [
        kind.alias("kind"),
        F.when(kind == "BULL", far_high).otherwise(high).alias("zone_low"),
        F.when(kind == "BULL", low).otherwise(far_low).alias("zone_high"),
    ]


def _zones(placed: DataFrame, keys: list[str], seconds: int) -> DataFrame:
    """Zones of bars that carry ``_far``."""
    return (
        placed.select(
            *keys,
            F.col("bar_start_ns").alias("formed_ns"),
            (F.col("bar_start_ns") + seconds * NS).alias("available_ns"),
            *_zone_columns(),
        )
        .filter(F.col("kind").isNotNull())
        .withColumn("zone_mid", zone_mid(F.col("zone_low"), F.col("zone_high")))
    )


def gap_zones(bars: DataFrame, seconds: int, session_scoped: bool = True) -> DataFrame:
    """Zones between a bar and the bar two before it, usable once the later bar has closed.

    With ``session_scoped`` the three bars share their session and the window is partitioned by
    it; otherwise it runs over blocks of a symbol's bars.
    """
    far = F.struct("high", "low")
    if session_scoped:
        keys = ["symbol", "session_id"]
        w = Window.partitionBy(*keys).orderBy("bar_start_ns")
        placed = bars.withColumn("_far", F.lag(far, 2).over(w))
    else:
        keys = ["symbol"]
        number = [c for c in ("bar_no",) if c in bars.columns]
        plain = bars.select(*keys, "bar_start_ns", "high", "low", *number)
        placed = in_blocks(plain, lambda df: df.withColumn("_far", F.lag(far, 2).over(block_window(df))), 2)
    zoned = _zones(placed, keys, seconds)
    if not session_scoped:
        return zoned
    return zoned.withColumn(
        "zone_id",
        stable_id(
            F.lit("fvg"),
            F.col("symbol"),
            F.col("session_id"),
            ns_to_offset_iso(F.col("formed_ns")),
            F.col("kind"),
            price_text(F.col("zone_low")),
            price_text(F.col("zone_high")),
            prefix="setup_",
            length=16,
        ),
    )


def _nodes(children: DataFrame) -> DataFrame:
    """Parents of ``children`` (symbol, node, lo, hi, at), each with the array of its children."""
    kid = F.struct("node", "lo", "hi", "at")
    return children.groupBy("symbol", floor_div(F.col("node"), _FAN).alias("parent")).agg(
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
        F.min("at").alias("at"),
        F.array_sort(F.collect_list(kid)).alias("kids"),
    )


def _first_fill(kids: Column) -> Column:
    """First of the children that reaches the far side of the zone."""
    bull = F.col("kind") == "BULL"
    hits = F.filter(
        kids,
        lambda k: F.when(bull, k["lo"] <= F.col("zone_low")).otherwise(k["hi"] >= F.col("zone_high")),
    )
    return F.get(hits, F.lit(0))


def _fill_finder():
    """Arrow function from a block of bars to its zones, with the fills that lie in the block.

    It walks the bars backwards with a stack of those that no bar nearer by undercuts: their values
    rise to its top, so a zone finds its first fill by bisection. Ships as a closure.
    """

    def first_reached(lows: list, asked: list) -> list:
        found, places, values = [None] * len(lows), [], []
        for i in range(len(lows) - 1, -1, -1):
            if asked[i] is not None:
                k = bisect_right(values, asked[i])
                found[i] = places[k - 1] if k else None
            if lows[i] is not None:
                while values and values[-1] >= lows[i]:
                    values.pop()
                    places.pop()
                values.append(lows[i])
                places.append(i)
        return found

    def negative(values: list) -> list:
        return [None if v is None else -v for v in values]

    def fills(table: pa.Table) -> pa.Table:
        table = table.sort_by("bar_no")
        columns = {c: table[c].to_pylist() for c in ("bar_start_ns", "kind", "low", "high", "zone_low", "zone_high")}

        def asked(kind: str, values: list) -> list:
            return [v if k == kind else None for k, v in zip(columns["kind"], values, strict=True)]

        bull = first_reached(columns["low"], asked("BULL", columns["zone_low"]))
        bear = first_reached(negative(columns["high"]), asked("BEAR", negative(columns["zone_high"])))
        hits = [a if a is not None else b for a, b in zip(bull, bear, strict=True)]
        zones = [i for i, k in enumerate(columns["kind"]) if k is not None]
        times = [None if hits[i] is None else columns["bar_start_ns"][hits[i]] for i in zones]
        kept = table.drop_columns(["bar_no", "low", "high"]).take(pa.array(zones, pa.int64()))
        return kept.append_column("fill_ns", pa.array(times, pa.int64()))

    return fills


def _filled_inside(bars: DataFrame) -> DataFrame:
    """All zones of numbered bars; those that a later bar of their block fills have ``fill_ns``."""
    far = F.lag(F.struct("high", "low"), 2)
    placed = in_blocks(bars, lambda df: df.withColumn("_far", far.over(block_window(df))), 2)
    asked = placed.select(
        "symbol",
        floor_div(F.col("bar_no"), _FAN**2).alias("block"),
        "bar_no",
        "bar_start_ns",
        "low",
        "high",
        *_zone_columns(),
    )
    kept = [f for f in asked.schema if f.name not in ("bar_no", "low", "high")]
    schema = T.StructType([*kept, T.StructField("fill_ns", T.LongType())])
    return asked.groupBy("symbol", "block").applyInArrow(_fill_finder(), schema)


def gap_fill_status(bars: DataFrame, seconds: int) -> DataFrame:
    """Gap zones of any candles with the first later bar that fills them, or OPEN.

    Fills inside a block of 4,096 bars are found by a monotone stack. What is left looks for its
    first later block in a tree of price ranges with 64 children a node. Nodes are joined to blocks,
    not to zones: a block carries its later siblings of every level, and on the way down each pair of
    a block and a node meets the node's children once. So zones are only ever keyed by their own
    block, however many of a symbol stay open or are filled by one bar.
    """
    bars = numbered(bars.select("symbol", "bar_start_ns", "high", "low"))
    level = bars.select(
        "symbol",
        F.col("bar_no").alias("node"),
        F.col("low").alias("lo"),
        F.col("high").alias("hi"),
        F.col("bar_start_ns").alias("at"),
    )
    # As many levels as the longest symbol needs for one root; one number comes to the driver.
    last = bars.agg(F.max("bar_no")).first()[0] or 0
    tree = []
    while len(tree) < 2 or _FAN ** len(tree) <= last:
        level = _nodes(level)
        tree.append(level.select("symbol", "parent", "kids"))
        level = level.select("symbol", F.col("parent").alias("node"), "lo", "hi", "at")
    ends = bars.groupBy("symbol").agg(F.max("bar_start_ns").alias("last_ns"))
    around = tree[1].select("symbol", F.col("parent").alias("block")).join(ends, "symbol")
    # Up: the later siblings of each block and of the nodes above it; the lowest level is nearest.
    upper = range(2, len(tree))
    for depth in upper:
        own = floor_div(F.col("block"), _FAN ** (depth - 2))
        around = (
            around.withColumns({"_own": own, "parent": floor_div(own, _FAN)})
            .join(tree[depth], ["symbol", "parent"])
            .withColumn(f"_up{depth}", F.filter("kids", lambda k: k["node"] > F.col("_own")))
            .drop("_own", "parent", "kids")
        )
    hits = [
        F.when(F.size(F.col(f"_up{depth}")) > 0, _first_fill(F.col(f"_up{depth}"))["node"]) for depth in upper
    ]
    is_open = F.col("fill_ns").isNull()
    reached = [F.when(is_open & h.isNotNull(), F.lit(d)) for d, h in zip(upper, hits, strict=True)]
    found = _filled_inside(bars).join(around, ["symbol", "block"]).select(
        "symbol",
        "block",
        "bar_start_ns",
        "kind",
        "zone_low",
        "zone_high",
        "fill_ns",
        "last_ns",
        F.coalesce(*reached, F.lit(-1)).alias("level"),
        F.coalesce(*hits, F.lit(-1)).cast("bigint").alias("node"),
    )
    # Down: the first hit among the children of the node that holds it.
    for depth in reversed(range(len(tree) - 1 if upper else 0)):
        found = stored(found, "open-zones")
        deeper = F.col("level") > depth
        pairs = found.filter(deeper).select("symbol", "block", "node").distinct()
        kids = pairs.join(tree[depth].withColumnRenamed("parent", "node"), ["symbol", "node"])
        kid = _first_fill(F.col("kids"))
        found = found.join(kids, ["symbol", "block", "node"], "left").select(
            *(c for c in found.columns if c not in ("node", "fill_ns")),
            F.when(deeper, kid["node"]).otherwise(F.col("node")).alias("node"),
            (F.when(deeper, kid["at"]).otherwise(F.col("fill_ns")) if depth == 0 else F.col("fill_ns")).alias("fill_ns"),
        )
    return found.select(
        "symbol",
        F.concat("kind", F.lit("_FVG")).alias("kind"),
        F.col("bar_start_ns").alias("start_ns"),
        (F.coalesce("fill_ns", "last_ns") + seconds * NS).alias("end_ns"),
        "zone_low",
        "zone_high",
        F.when(F.col("fill_ns").isNull(), "OPEN").otherwise("FULLY_FILLED").alias("status"),
    )


def latest_gaps(zones: DataFrame, n: int) -> DataFrame:
    """The ``n`` newest zones (top-k; no full sort)."""
    start = "start_ns" if "start_ns" in zones.columns else "formed_ns"
    return zones.orderBy(F.desc(start), F.desc("symbol")).limit(n)
