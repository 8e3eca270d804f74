"""Labelled rows to fit a classifier on: all, or a bounded sample in the order of a hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column | str) -> Column:
    """True on the fifth of the ids whose labels are never learned; a null id is not labelled."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_ids(labels: DataFrame, label: str, rows: int | None = None) -> DataFrame:
    """``doc_id, label`` of the labelled ids that are not held out, at most ``rows`` where that is given.

    Null ids and labels are left out; of several labels of one id the greatest counts.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out("doc_id"))
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    return known if rows is None else known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
