"""Totals of a written tape and their reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.errors import OutputError


def tape_totals(tape: DataFrame) -> DataFrame:
    """Rows, size and signed volume, reading two columns."""
    return tape.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("sum_size"),
        F.coalesce(F.sum("signed_volume"), F.lit(0)).alias("sum_signed_volume"),
    )


def validate_tape(totals: DataFrame, volume: DataFrame) -> DataFrame:
    """Compare one-row tape totals with the one-row volume report of the source.

    ``failures`` lists what does not agree; it is empty for a sound tape.
    """
    source = volume.select(
        "total_rows",
        "total_f_rows",
        "valid_t_rows",
        "sum_t_size",
        F.col("sum_signed_volume").alias("source_signed_volume"),
    )
    # Two one-row tables with different columns, put side by side.
    stacked = totals.unionByName(source, allowMissingColumns=True)
    both = stacked.agg(*(F.max(c).alias(c) for c in stacked.columns))
    # The messages.
    checks = [
        (F.col("row_count") != F.col("valid_t_rows"), "output row count does not match manifest"),
        (F.col("sum_size") != F.col("sum_t_size"), "output size sum does not match manifest"),
        (
            F.col("sum_signed_volume") != F.col("source_signed_volume"),
            "signed-volume sum does not match manifest",
        ),
        (
            (F.col("total_f_rows") > 0) & (F.col("row_count") == F.col("total_rows")),
            "manifest suggests F rows may have been included",
        ),
    ]
    return both.select(
        "row_count",
        "sum_size",
        "sum_signed_volume",
        F.array_compact(F.array(*(F.when(bad, F.lit(m)) for bad, m in checks))).alias("failures"),
    ).withColumn("valid", F.size("failures") == 0)


def require_valid(report: DataFrame) -> dict:
    """The one-row report as a dict, or an error naming the failures."""
    row = report.first().asDict()
    if not row["valid"]:
        raise OutputError("; ".join(row["failures"]))
    return row
