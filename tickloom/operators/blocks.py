"""Bars in numbered blocks: windows that reach a few rows back or ahead need no symbol in one task.

Numbering is a prefix sum over a small table: bars are ranked inside cells of time, the cells of a
symbol are added up, and a bar's number is its cell's sum plus its rank.  Blocks are ranges of
numbers; the rows that a window reaches over a block's edge are copied into the block as a halo.
Every window over bars is then keyed (symbol, block), so a symbol that holds all bars uses all tasks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickloom.functions.clock import NS, floor_div
from tickloom.sources.writers import stored

#: Bars of a block, and the width of a cell: a symbol has one row a day in the table of cells.
BLOCK, CELL_SECONDS = 4096, 86_400
_PART = "_part"


def bar_order(df: DataFrame) -> list[str]:
    """Columns that order the bars of a symbol."""
    return ["bar_start_ns", *(c for c in ("session_id",) if c in df.columns)]


def numbered(bars: DataFrame, cell_seconds: int = CELL_SECONDS) -> DataFrame:
    """``bars`` with ``bar_no``, the 0-based index of a bar in its symbol; kept if there is one.

    The ranked bars are written to a scratch table, as the cells are counted from them and they are
    joined with the sums; bars are small beside the trades they come from, which are read once.
    """
    if "bar_no" in bars.columns:
        return bars
    inside = Window.partitionBy("symbol", "_cell").orderBy(*bar_order(bars))
    ranked = bars.withColumn("_cell", floor_div(F.col("bar_start_ns"), cell_seconds * NS))
    ranked = stored(ranked.withColumn("_rank", F.row_number().over(inside).cast("bigint") - 1), "ranked-bars")
    earlier = Window.partitionBy("symbol").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = ranked.groupBy("symbol", "_cell").agg((F.max("_rank") + 1).alias("_n"))
    sums = cells.select("symbol", "_cell", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    out = ranked.join(sums, ["symbol", "_cell"]).withColumn("bar_no", F.col("_before") + F.col("_rank"))
    return out.select(*bars.columns, "bar_no")


def with_halo(df: DataFrame, before: int, after: int = 0, block: int | None = None) -> DataFrame:
    """Numbered rows in their blocks, and copied into those whose windows reach them.

    A window over ``block_window`` sees the ``before`` rows ahead of each row of the block itself and
    the ``after`` rows behind it; ``own_rows`` leaves the copies out again.
    """
    block = block or BLOCK
    low = floor_div(F.greatest(F.col("bar_no") - after, F.lit(0)), block)
    return df.withColumn(_PART, F.explode(F.sequence(low, floor_div(F.col("bar_no") + before, block))))


def block_window(df: DataFrame) -> WindowSpec:
    """Rows of a block in order; ``df`` comes from ``with_halo``."""
    return Window.partitionBy("symbol", _PART).orderBy("bar_no")


def is_blocked(df: DataFrame) -> bool:
    return _PART in df.columns


def own_rows(df: DataFrame, block: int | None = None) -> DataFrame:
    return df.filter(F.col(_PART) == floor_div(F.col("bar_no"), block or BLOCK)).drop(_PART)


def in_blocks(df: DataFrame, compute: Callable[[DataFrame], DataFrame], before: int, after: int = 0) -> DataFrame:
    """``compute``, which uses ``block_window``, on rows with the halo it needs; a caller that has
    blocked the rows with a halo wide enough for several steps gets them back blocked."""
    if is_blocked(df):
        return compute(df)
    out = own_rows(compute(with_halo(numbered(df), before, after)))
    return out if "bar_no" in df.columns else out.drop("bar_no")
