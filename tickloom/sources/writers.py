"""Parquet and CSV writers. Spark's commit protocol stages files, so a lost task leaves no trace."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickloom import schema as S
from tickloom.config import CODECS, TapeConfig
from tickloom.errors import OutputError


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the cluster shares.

    That is ``spark.checkpoint.dir``, or else the context's checkpoint folder. Only a local master
    may do without, as its executors share the machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        of_context = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = of_context.get() if of_context.isDefined() else None
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise OutputError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return os.path.join(root, f"{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new scratch table and read back.

    Cuts a long plan where its result is read several times; a lost executor then rereads the
    table instead of running the plan again, and the reader knows the table's size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """The scratch tables of one job, dropped when a later one has taken their place.

    ``store`` writes and reads back as ``stored`` does, ``drop`` deletes tables that are not read
    any more, and leaving the ``with`` block deletes the rest, so what leaves it must be stored.
    """

    def __init__(self, spark: SparkSession, name: str):
        self._spark, self._folder = spark, scratch_path(spark, name)
        self._tables: list[tuple[DataFrame, str]] = []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        _drop(self._spark, self._folder)

    def store(self, df: DataFrame, name: str) -> DataFrame:
        path = os.path.join(self._folder, f"{name}-{uuid.uuid4().hex}")
        df.write.parquet(path)
        out = self._spark.read.schema(df.schema).parquet(path)
        self._tables.append((out, path))
        return out

    def drop(self, *tables: DataFrame) -> None:
        for table, path in self._tables:
            if any(table is x for x in tables):
                _drop(self._spark, path)
        self._tables = [x for x in self._tables if not any(x[0] is t for t in tables)]


def _mode(overwrite: bool) -> str:
    return "overwrite" if overwrite else "errorifexists"


def _swap(spark: SparkSession, new: str, path: str) -> None:
    """Put the finished folder ``new`` in the place of ``path``."""
    jvm = spark.sparkContext._jvm
    to = jvm.org.apache.hadoop.fs.Path(path)
    fs = to.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    old = jvm.org.apache.hadoop.fs.Path(f"{new}-old")
    there = fs.exists(to)
    if there and not fs.rename(to, old):
        raise OutputError(f"{path} could not be moved away")
    if not fs.rename(jvm.org.apache.hadoop.fs.Path(new), to):
        if there:
            fs.rename(old, to)
        raise OutputError(f"{path} could not be put in place")
    if there:
        fs.delete(old, True)


def _drop(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def write_tape(
    df: DataFrame, path: str, cfg: TapeConfig, check: Callable[[dict[str, int]], None] | None = None
) -> dict[str, int]:
    """Write a tape under symbol / trading_date in causal order; return what was written.

    Rows are rebalanced by the partition keys: adaptive execution splits a symbol or day that
    holds most rows over many tasks and joins small ones, from the shuffle's own sizes, so the
    input is read once and each task touches few directories. The totals are counted while
    writing. The tape is written beside its place and judged there: an empty one, or one that
    ``check`` refuses by raising, leaves what stood at ``path`` untouched.
    """
    spark = df.sparkSession
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    taken = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)
    if taken and not cfg.overwrite:
        raise OutputError(f"{path} already exists")
    seen = Observation(f"tape-{uuid.uuid4().hex}")
    out = (
        S.conform(df, S.TAPE)
        .hint("rebalance", *S.PARTITIONS)
        .sortWithinPartitions(*S.PARTITIONS, *S.CAUSAL)
        .observe(
            seen,
            F.count(F.lit(1)).alias("row_count"),
            F.coalesce(F.sum("size"), F.lit(0)).alias("sum_size"),
            F.coalesce(F.sum("signed_volume"), F.lit(0)).alias("sum_signed_volume"),
        )
    )
    beside = f"{path.rstrip('/')}.next-{uuid.uuid4().hex}"
    try:
        (
            out.write.option("maxRecordsPerFile", cfg.target_rows_per_file)
            .option("compression", CODECS[cfg.compression])
            .partitionBy(*S.PARTITIONS)
            .parquet(beside)
        )
        totals = {k: int(v) for k, v in seen.get.items()}
        if totals["row_count"] == 0:
            raise OutputError("no trade rows were written")
        if check:
            check(totals)
    except BaseException:
        _drop(spark, beside)
        raise
    _swap(spark, beside, path)
    return totals


def day_totals(tape: DataFrame) -> DataFrame:
    """Rows, size and signed volume of each symbol and trading date."""
    return tape.groupBy(*S.PARTITIONS).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("sum_size"),
        F.coalesce(F.sum("signed_volume"), F.lit(0)).alias("sum_signed_volume"),
    )


def replace_days(df: DataFrame, path: str, cfg: TapeConfig, expected: DataFrame | None = None) -> DataFrame:
    """Put the symbols and days of ``df``, each complete, in the place of those in the tape at ``path``.

    Only the folders of these symbols and days are written anew (dynamic partition overwrite); all
    others keep their files. The rows are written beside the tape first and judged there, day by
    day: where their totals differ from ``expected`` (columns of ``day_totals``), nothing changes.
    Returns the totals of what was put in place, one row for each symbol and day.
    """
    spark = df.sparkSession
    beside = f"{path.rstrip('/')}.days-{uuid.uuid4().hex}"
    options = {"maxRecordsPerFile": cfg.target_rows_per_file, "compression": CODECS[cfg.compression]}
    tape = S.conform(df, S.TAPE).hint("rebalance", *S.PARTITIONS).sortWithinPartitions(*S.PARTITIONS, *S.CAUSAL)
    try:
        tape.write.options(**options).partitionBy(*S.PARTITIONS).parquet(beside)
        new = spark.read.schema(S.TAPE).parquet(beside)
        totals = stored(day_totals(new), "day-totals")
        if totals.isEmpty():
            raise OutputError("no trade rows were written")
        if expected is not None:
            off = expected.select(totals.columns).exceptAll(totals).unionByName(totals.exceptAll(expected.select(totals.columns)))
            wrong = off.select(*S.PARTITIONS).distinct().orderBy(*S.PARTITIONS).limit(20).collect()
            if wrong:
                names = ", ".join(f"{r['symbol']} {r['trading_date']}" for r in wrong)
                raise OutputError(f"day totals differ from what was expected: {names}")
        placed = new.hint("rebalance", *S.PARTITIONS).sortWithinPartitions(*S.PARTITIONS, *S.CAUSAL)
        out = placed.write.options(**options).option("partitionOverwriteMode", "dynamic")
        out.mode("overwrite").partitionBy(*S.PARTITIONS).parquet(path)
    finally:
        _drop(spark, beside)
    return totals


def write_quarantine(rejected: DataFrame, path: str, cfg: TapeConfig) -> dict[str, int]:
    """All rejected rows, or the first ``quarantine_sample_limit`` in scan order if that is set.

    Returns how many were rejected (``total``) and how many stored (``written``).
    """
    seen = Observation(f"quarantine-{uuid.uuid4().hex}")
    rows = S.conform(rejected, S.QUARANTINE).observe(seen, F.count(F.lit(1)).alias("total"))
    if cfg.quarantine_sample_limit is not None:
        rows = rows.orderBy("source_row_number").limit(cfg.quarantine_sample_limit)
    rows.write.mode(_mode(cfg.overwrite)).parquet(path)
    total = int(seen.get["total"])
    limit = cfg.quarantine_sample_limit
    return {"total": total, "written": total if limit is None else min(total, limit)}


def write_table(df: DataFrame, path: str, cfg: TapeConfig, sort: tuple[str, ...] = ()) -> None:
    """Candidates or labels, optionally in order across the files."""
    if sort:
        df = df.orderBy(*sort)
    (
        df.write.mode(_mode(cfg.overwrite))
        .option("compression", CODECS[cfg.compression])
        .parquet(path)
    )


def write_csv(df: DataFrame, path: str, overwrite: bool = False) -> None:
    df.write.mode(_mode(overwrite)).option("header", True).csv(path)
