"""One comparable value for the causal order (time, sequence, source row)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Digits that the packed key gives to its parts; together the 38 of a DECIMAL.
OFFSET_DIGITS, SEQUENCE_DIGITS, ROW_DIGITS = 14, 11, 13
MAX_PACKED_SECONDS = 10**OFFSET_DIGITS // 10**9


def causal_key(offset_ns: Column, sequence: Column, row: Column, wide: bool = False) -> Column:
    """Key over an offset inside a bar or window.

    The packed DECIMAL(38,0) keeps aggregates on the hash path; it is null when a part is. A part that does not fit raises;
    ``wide`` then gives a struct that takes any value, at the price of a sort aggregate.
    """
    if wide:
        return F.struct(offset_ns.alias("o"), sequence.alias("s"), row.alias("r"))
    fits = (
        offset_ns.between(0, 10**OFFSET_DIGITS - 1)
        & sequence.between(0, 10**SEQUENCE_DIGITS - 1)
        & row.between(0, 10**ROW_DIGITS - 1)
    )
    packed = (
        offset_ns.cast(f"decimal({OFFSET_DIGITS},0)")
        * F.expr(f"{10 ** (SEQUENCE_DIGITS + ROW_DIGITS)}BD")
        + sequence.cast(f"decimal({SEQUENCE_DIGITS},0)") * F.expr(f"{10**ROW_DIGITS}BD")
        + row.cast(f"decimal({ROW_DIGITS},0)")
    )
    too_big = F.raise_error(F.lit("order key part out of packed range; use wide keys"))
    return F.when(fits, packed.cast("decimal(38,0)")).when(~fits, too_big.cast("decimal(38,0)"))


def guard_nulls(value: Column, *required: Column) -> Column:
    """``value``, or an error when any required column is null."""
    missing = required[0].isNull()
    for col in required[1:]:
        missing = missing | col.isNull()
    return F.when(missing, F.raise_error(F.lit("null in a required column"))).otherwise(value)


def beyond_packed(sequence: int | None, row: int | None) -> bool:
    """Whether a largest sequence or source row does not fit the packed key."""
    return (sequence or 0) >= 10**SEQUENCE_DIGITS or (row or 0) >= 10**ROW_DIGITS


def needs_wide_keys(tape: DataFrame) -> bool:
    """Whether a sequence or source row of the tape is beyond the packed key; reads two columns."""
    most = tape.agg(F.max("sequence").alias("s"), F.max("source_row_number").alias("r")).first()
    return beyond_packed(most["s"], most["r"])
