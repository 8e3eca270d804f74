"""Audit of the scan order without sorting the scan."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.clock import floor_div

_RUN = (
    "first_row bigint, first_ts bigint, first_seq bigint, last_ts bigint, last_seq bigint, "
    "anomalies bigint, duplicates bigint"
)
# Rows of the scan that one merge group spans, per level; the last level is one small group.
_LEVEL_ROWS = (2**20, 2**32, 2**62)


def _run_finder():
    """The task function, as a closure so that executors need not have this package."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per unbroken stretch of scan positions in a batch, with its inner counts."""
        for batch in batches:
            row = batch.column("source_row_number").to_numpy(zero_copy_only=False)
            if not len(row):
                continue
            stretch = np.concatenate(([0], np.cumsum(np.diff(row) != 1)))
            known = ~(
                batch.column("ts_event_ns").is_null().to_numpy(zero_copy_only=False)
                | batch.column("sequence").is_null().to_numpy(zero_copy_only=False)
            )
            row, stretch = row[known], stretch[known]
            if not len(row):
                continue
            ts = batch.column("ts_event_ns").fill_null(0).to_numpy(zero_copy_only=False)[known]
            seq = batch.column("sequence").fill_null(0).to_numpy(zero_copy_only=False)[known]
            same = stretch[1:] == stretch[:-1]
            tie = ts[1:] == ts[:-1]
            back = same & ((ts[1:] < ts[:-1]) | (tie & (seq[1:] < seq[:-1])))
            twin = same & tie & (seq[1:] == seq[:-1])
            first = np.flatnonzero(np.concatenate(([True], ~same)))
            last = np.append(first[1:], len(row)) - 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row[first]),
                    pa.array(ts[first]),
                    pa.array(seq[first]),
                    pa.array(ts[last]),
                    pa.array(seq[last]),
                    pa.array(np.add.reduceat(np.append(0, back).astype(np.int64), first)),
                    pa.array(np.add.reduceat(np.append(0, twin).astype(np.int64), first)),
                ],
                names=[
                    "first_row",
                    "first_ts",
                    "first_seq",
                    "last_ts",
                    "last_seq",
                    "anomalies",
                    "duplicates",
                ],
            )

    return runs


def _merge(runs: DataFrame, span: int) -> DataFrame:
    """Join neighbouring runs of each span, counting what happens between them."""
    group = floor_div(F.col("first_row"), span)
    w = Window.partitionBy("g").orderBy("first_row")
    before_ts, before_seq = F.lag("last_ts").over(w), F.lag("last_seq").over(w)
    tie = F.col("first_ts") == before_ts
    back = (F.col("first_ts") < before_ts) | (tie & (F.col("first_seq") < before_seq))
    twin = tie & (F.col("first_seq") == before_seq)
    one = lambda c: F.coalesce(c.cast("bigint"), F.lit(0))
    return (
        runs.withColumn("g", group)
        .select(
            "*",
            (F.col("anomalies") + one(back)).alias("_a"),
            (F.col("duplicates") + one(twin)).alias("_d"),
        )
        .groupBy("g")
        .agg(
            F.min("first_row").alias("first_row"),
            F.min_by("first_ts", "first_row").alias("first_ts"),
            F.min_by("first_seq", "first_row").alias("first_seq"),
            F.max_by("last_ts", "first_row").alias("last_ts"),
            F.max_by("last_seq", "first_row").alias("last_seq"),
            F.sum("_a").alias("anomalies"),
            F.sum("_d").alias("duplicates"),
        )
        .drop("g")
    )


def ordering_report(flags: DataFrame) -> DataFrame:
    """Anomalies and adjacent duplicates of (time, sequence) in scan order, as one row.

    Rows without a time or sequence are stepped over. Each task compares neighbours inside its
    Arrow batches, so the raw rows are never shuffled or sorted; only one row per unbroken
    stretch goes on, and stretches are merged over ever wider spans. The result does not depend
    on how rows are spread over tasks; a scan merely has fewer stretches than shuffled rows.
    """
    keys = flags.select(
        F.col("source_row_number").cast("bigint"),
        F.col("ts_event_ns").cast("bigint"),
        F.col("sequence").cast("bigint"),
    )
    runs = keys.mapInArrow(_run_finder(), _RUN)
    for span in _LEVEL_ROWS:
        runs = _merge(runs, span)
    return runs.agg(
        F.coalesce(F.sum("anomalies"), F.lit(0)).alias("ordering_anomalies"),
        F.coalesce(F.sum("duplicates"), F.lit(0)).alias("duplicate_candidates"),
    )
