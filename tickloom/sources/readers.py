"""Parquet readers and the row identity of a scan."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom import schema as S
from tickloom.errors import SchemaError
from tickloom.functions.clock import epoch_ns, month_label, ns_to_ts
from tickloom.functions.ordering_keys import beyond_packed, needs_wide_keys

# Beyond this many files the offset table is joined without a broadcast hint.
MAX_BROADCAST_FILES = 100_000


def configure(spark: SparkSession) -> SparkSession:
    """Session settings that foreign nanosecond Parquet files need."""
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    return spark


def read_mbo(spark: SparkSession, path: str, numbered: bool = True) -> DataFrame:
    """The ten scanned columns of a raw event table, with ``source_row_number``."""
    df = configure(spark).read.parquet(path)
    S.require_columns(df.columns, S.MBO_REQUIRED, "raw events")
    kept = [F.col(c) for c in S.MBO_SCANNED]
    if not numbered:
        return df.select(*kept)
    return with_source_row_number(df).select(*kept, "source_row_number")


def with_source_row_number(df: DataFrame) -> DataFrame:
    """Contiguous 0-based position over all files, in path order.

    Per-file counts come from Parquet footers only. The count table has one row per file, so its
    size is known from the file list before the join is planned.
    """
    n_files = len(df.inputFiles())
    file = F.col("_metadata.file_path")
    counts = df.groupBy(file.alias("_file")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    )
    if n_files <= MAX_BROADCAST_FILES:
        offsets = F.broadcast(offsets)
    named = df.select("*", file.alias("_file"), F.col("_metadata.row_index").alias("_index"))
    return (
        named.join(offsets, "_file")
        .withColumn("source_row_number", F.col("_offset") + F.col("_index"))
        .drop("_file", "_index", "_offset")
    )


def read_partitioned(spark: SparkSession, path: str) -> DataFrame:
    """Parquet whose directory keys stay text (Spark would turn dates and numbers around)."""
    found = configure(spark).read.parquet(path).schema
    keys = T.StructType(
        [
            T.StructField(f.name, T.StringType()) if f.name in S.PARTITIONS else f
            for f in found
        ]
    )
    return spark.read.schema(keys).parquet(path)


def read_tape(spark: SparkSession, path: str, columns: tuple[str, ...] | None = None) -> DataFrame:
    """A trade tape, ours or one with nanosecond timestamps only, in the tape's types."""
    df = read_partitioned(spark, path)
    wanted = columns or tuple(f.name for f in S.TAPE)
    have = set(df.columns)
    derived = {"ts_event_ns": "ts_event", "ts_recv_ns": "ts_recv"}
    S.require_columns(
        df.columns, {c if c in have else derived.get(c, c) for c in wanted}, "trade tape"
    )
    out = []
    for field in S.TAPE:
        name = field.name
        if name not in wanted:
            continue
        if name in derived and name not in have:
            col = epoch_ns(df, derived[name])
        elif isinstance(field.dataType, T.TimestampType):
            is_ts = isinstance(df.schema[name].dataType, T.TimestampType)
            col = F.col(name) if is_ts else ns_to_ts(epoch_ns(df, name))
        else:
            col = F.col(name)
        out.append(col.cast(field.dataType).alias(name))
    return df.select(*out)


def largest_order_parts(spark: SparkSession, path: str, days: tuple[str, str] | None = None) -> DataFrame:
    """Largest ``sequence`` and ``source_row_number`` of a stored tape, from its Parquet footers.

    The aggregate is pushed into the scan, whose tasks then read footers only; ``days`` (first and
    last trading date) leaves out whole folders. The two settings that this takes are made in a
    session of its own, so the caller's are not touched.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    tape = read_partitioned(own, path)
    if days is not None:
        tape = tape.filter(F.col("trading_date").between(*days))
    return tape.agg(F.max("sequence").alias("sequence"), F.max("source_row_number").alias("row"))


def tape_needs_wide_keys(spark: SparkSession, path: str, days: tuple[str, str] | None = None) -> bool:
    """``needs_wide_keys`` of a stored tape without reading its columns.

    Files whose footers lack these statistics (foreign writers, columns that are all null) or hold
    them in an unsigned type are scanned instead.
    """
    try:
        most = largest_order_parts(spark, path, days).first()
    except (PySparkException, Py4JJavaError):
        tape = read_tape(spark, path, ("sequence", "source_row_number", "trading_date"))
        return needs_wide_keys(tape.filter(F.col("trading_date").between(*days)) if days else tape)
    return beyond_packed(most["sequence"], most["row"])


def read_candidates(spark: SparkSession, path: str) -> DataFrame:
    """Setup candidates; all columns must be there."""
    return _read_exact(spark, path, S.CANDIDATE, "setup candidates")


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """The label columns that the reports need."""
    wanted = T.StructType([f for f in S.LABEL if f.name in S.LABEL_REPORT_COLUMNS])
    return _read_exact(spark, path, wanted, "labels")


def _read_exact(spark: SparkSession, path: str, schema: T.StructType, what: str) -> DataFrame:
    df = read_partitioned(spark, path)
    S.require_columns(df.columns, schema.fieldNames(), what)
    out = []
    for field in schema:
        col = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType) and not isinstance(
            df.schema[field.name].dataType, T.TimestampType
        ):
            col = ns_to_ts(epoch_ns(df, field.name))
        out.append(col.cast(field.dataType).alias(field.name))
    return df.select(*out)


def normalize_trades(df: DataFrame, with_month: bool = False) -> DataFrame:
    """Loose trades: action T where that column exists, no nulls, positive price and size.

    ``with_month`` adds the month label of the file each row came from.
    """
    S.require_columns(df.columns, ("ts_event", "price", "size"), "trades")
    if "action" in df.columns:
        df = df.filter(F.col("action") == "T")
    ns = F.col("ts_event_ns") if "ts_event_ns" in df.columns else epoch_ns(df, "ts_event")
    symbol = F.col("symbol") if "symbol" in df.columns else F.lit("")
    cols = [symbol.alias("symbol"), ns.alias("ts_event_ns"), "price", "size", *_order_columns(df)]
    if with_month:
        cols.append(month_label(F.col("_metadata.file_path")).alias("month"))
    return df.select(*cols).filter(
        F.col("ts_event_ns").isNotNull() & (F.col("price") > 0) & (F.col("size") > 0)
    )


def chart_trades(df: DataFrame, symbol: str | None = None) -> DataFrame:
    """Trades for candles: bad numbers become null or 0, rows without time or price go."""
    S.require_columns(df.columns, ("ts_event", "price"), "trades")
    if symbol is not None:
        if "symbol" not in df.columns:
            raise SchemaError("a symbol was asked for but the trades have no symbol column")
        df = df.filter(F.col("symbol") == symbol)
    ns = F.col("ts_event_ns") if "ts_event_ns" in df.columns else epoch_ns(df, "ts_event")
    size = F.col("size").try_cast("double") if "size" in df.columns else F.lit(0.0)
    name = F.col("symbol") if "symbol" in df.columns else F.lit("")
    price = F.col("price").try_cast("double")
    return df.select(
        name.alias("symbol"),
        ns.alias("ts_event_ns"),
        F.when(~F.isnan(price), price).alias("price"),
        F.when(F.isnan(size), F.lit(0.0)).otherwise(F.coalesce(size, F.lit(0.0))).alias("size"),
        *_order_columns(df),
    ).filter(F.col("ts_event_ns").isNotNull() & F.col("price").isNotNull())


def _order_columns(df: DataFrame) -> list:
    """Tie breakers of equal times; 0 where a loose input has none."""
    return [
        (F.col(n) if n in df.columns else F.lit(0)).cast("bigint").alias(n)
        for n in ("sequence", "source_row_number")
    ]
