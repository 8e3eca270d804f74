"""Greedy one-to-one use of zones by signals."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _walker(signal: str, zone: str, newest: str):
    """Arrow function that keeps the pairs a walk over one group takes; ships as a closure."""

    def walk(table: pa.Table) -> pa.Table:
        order = [(signal, "ascending"), (newest, "descending"), (zone, "ascending"), ("_ok", "ascending")]
        table = table.sort_by(order)
        columns = (table[c].to_pylist() for c in (signal, zone, "_ok"))
        used, taken, settled = set(), [], None
        for i, (s, z, ok) in enumerate(zip(*columns, strict=True)):
            if s == settled or z in used:
                continue
            taken.append(i)
            settled = s
            if ok:
                used.add(z)
        return table.take(pa.array(taken, pa.int64())).drop_columns(["_ok"])

    return walk


def greedy_match(
    pairs: DataFrame, group: list[str], signal: str, zone: str, newest: str, ok: str | None = None
) -> DataFrame:
    """Walk the signals of a group in time order; each takes its newest zone still unused.

    ``pairs`` holds only pairs that pass every stateless test. A pair whose ``ok`` is false ends
    its signal without using the zone; it is returned too, so callers can count it. A group is one
    session's pairs: at most its signal bars times the zones alive at one time. Used zones are a
    set, so the walk is linear in the pairs after their sort.
    """
    good = F.coalesce(F.col(ok), F.lit(False)) if ok else F.lit(True)
    judged = pairs.withColumn("_ok", good)
    return judged.groupBy(*group).applyInArrow(_walker(signal, zone, newest), pairs.schema)
