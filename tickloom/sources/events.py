"""The ``events`` table seen as market data.

Each event becomes a trade on a 0.25 tick: a triangular price wave plus noise, four symbols.
Integer arithmetic only, so other engines get the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.config import TapeConfig
from tickloom.functions.clock import epoch_ns, ns_to_iso
from tickloom.plans.jobs import build_tape


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def mbo_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a trade T, some also as F, A and C; one scan, copies by ``inline``."""
    events = read_events(spark, sf_dir)
    return (
        events.select("event_id", "user_id", "value", epoch_ns(events, "ts").alias("ns"))
        .withColumn("lane", F.col("user_id") % 4)
        .withColumn("half", F.expr("lane div 2"))
        .withColumn("sec", F.expr("ns div 1000000000"))
        .selectExpr(
            "*",
            "4000 + (abs((sec + lane * 7200) % (43200 + half * 388800) - (21600 + half * 194400)) * 4)"
            " div 200 + cast(floor(value / 2) as bigint) AS ticks",
            "inline(array("
            "named_struct('action', 'T', 'k', 0), "
            "if(event_id % 5 = 0, named_struct('action', 'F', 'k', 1), null), "
            "if(event_id % 7 = 0, named_struct('action', 'A', 'k', 2), null), "
            "if(event_id % 11 = 0, named_struct('action', 'C', 'k', 3), null)))",
        )
        .filter("action is not null")
        .selectExpr(
            "event_id",
            "ns + 250000 AS ts_recv",
            "ns AS ts_event",
            "cast(1 AS bigint) AS publisher_id",
            "100 + lane AS instrument_id",
            "action",
            "CASE WHEN event_id % 10 = 0 THEN 'N' WHEN event_id % 10 < 5 THEN 'B' ELSE 'A' END AS side",
            "cast(ticks AS double) / 4 AS price",
            "event_id % 9 + 1 AS size",
            "event_id * 4 + k AS sequence",
            "concat('S', lane) AS symbol",
            "event_id * 4 + k AS source_row_number",
        )
    )


def dirty_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows with text times and every kind of damage."""
    mbo = mbo_view(spark, sf_dir)
    text = ns_to_iso(F.col("ts_event"))
    hurt = lambda every, rest: F.col("event_id") % every == rest
    return mbo.withColumns(
        {
            "ts_recv": ns_to_iso(F.col("ts_recv")),
            "ts_event": F.when(hurt(113, 6), F.translate(text, "T", " ")).otherwise(text),
            "price": F.when(hurt(97, 1), F.col("price") + 0.1).otherwise(F.col("price")),
            "size": F.when(hurt(101, 2), 0).otherwise(F.col("size")).cast("bigint"),
            "side": F.when(~hurt(103, 3), F.col("side")),
            "action": F.when(hurt(107, 4), "X").otherwise(F.col("action")),
            "sequence": F.when(~hurt(109, 5), F.col("sequence")),
        }
    )


def spoiled_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``dirty_view`` with prices, symbols and receive times broken as well: all reasons occur."""
    hurt = lambda every, rest: F.col("event_id") % every == rest
    price = F.when(hurt(127, 7), -F.col("price")).when(hurt(149, 11), float("nan")).when(~hurt(131, 8), F.col("price"))
    return dirty_view(spark, sf_dir).withColumns(
        {
            "price": price,
            "symbol": F.when(hurt(137, 9), "").when(~hurt(151, 12), F.col("symbol")),
            "ts_recv": F.when(hurt(139, 10), "yesterday").otherwise(F.col("ts_recv")),
        }
    )


def raw_files(df: DataFrame, path: str, files: int) -> None:
    """Write a view as raw input of several files, in scan order, with all columns of the format.

    The files' first rows are about equal parts of the row numbers, which are all that is read to
    find them; ranges by Spark's own sample would make the whole view a second time.
    """
    extra = {"rtype": 160, "channel_id": 0, "order_id": 0, "flags": 0, "ts_in_delta": 0}
    full = df.withColumns({k: F.lit(v) for k, v in extra.items()})
    row = F.col("source_row_number")
    shares = [k / files for k in range(1, files)]
    starts = df.agg(F.percentile_approx(row, shares, 10_000)).first()[0] if shares else []
    file = sum((F.when(row > start, 1).otherwise(0) for start in starts or []), F.lit(0))
    full.repartitionById(files, file).sortWithinPartitions(row).drop("source_row_number").write.parquet(path)


def tape_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The canonical tape of the clean rows."""
    return build_tape(mbo_view(spark, sf_dir), TapeConfig())
