"""Column contracts of inputs and outputs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.errors import SchemaError

# Raw columns that must exist, and those that are read.
MBO_REQUIRED = (
    "ts_recv",
    "ts_event",
    "rtype",
    "publisher_id",
    "instrument_id",
    "action",
    "side",
    "price",
    "size",
    "channel_id",
    "order_id",
    "flags",
    "ts_in_delta",
    "sequence",
    "symbol",
)
MBO_SCANNED = (
    "ts_recv",
    "ts_event",
    "publisher_id",
    "instrument_id",
    "action",
    "side",
    "price",
    "size",
    "sequence",
    "symbol",
)
ACTIONS = ("A", "C", "M", "R", "T", "F")
SIDES = ("A", "B", "N")
PARTITIONS = ("symbol", "trading_date")
CAUSAL = ("ts_event_ns", "sequence", "source_row_number")


_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "array<string>": T.ArrayType(T.StringType()),
}


def _struct(text: str) -> T.StructType:
    """A flat schema from its text, without needing a running session."""
    pairs = (part.split() for part in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# The tape carries each timestamp twice: exact as BIGINT ns, readable as TIMESTAMP.
TAPE = _struct(
    "ts_event timestamp, ts_event_ns bigint, ts_recv timestamp, ts_recv_ns bigint, "
    "sequence bigint, publisher_id bigint, instrument_id bigint, symbol string, price double, "
    "size bigint, aggressor_side string, signed_volume bigint, unknown_aggressor boolean, "
    "trading_date string, session_id string, session_segment string, is_rth boolean, "
    "source_row_number bigint"
)
QUARANTINE = _struct(
    "rejection_reason string, source_row_number bigint, ts_event string, ts_recv string, "
    "sequence bigint, publisher_id bigint, instrument_id bigint, symbol string, action string, "
    "side string, price double, size bigint"
)
CANDIDATE = _struct(
    "setup_id string, ts_event timestamp, symbol string, cme_session_id string, "
    "setup_type string, entry_side string, reference_level double, entry_price double, "
    "entry_timestamp timestamp, structural_invalidation double, stop_price double, "
    "target_1 double, target_2 double, target_3 double, max_holding_bars bigint, "
    "max_holding_seconds bigint, reason_codes array<string>, feature_timestamp timestamp, "
    "setup_version string, fvg_id string, fvg_low double, fvg_high double, "
    "effort_range_ratio double, effort_volume_ratio double"
)
LABEL = _struct(
    "setup_id string, ts_event timestamp, symbol string, cme_session_id string, "
    "setup_type string, entry_side string, entry_timestamp timestamp, "
    "earliest_entry_timestamp timestamp, max_exit_timestamp timestamp, entry_price double, "
    "entry_fill_price double, stop_price double, target_price double, exit_timestamp timestamp, "
    "exit_trade_price double, exit_fill_price double, exit_reason string, success boolean, "
    "planned_risk_points double, gross_points double, gross_r double, net_points double, "
    "net_r double, commission_per_side double, point_value double, entry_slippage_ticks bigint, "
    "stop_slippage_ticks bigint, time_exit_slippage_ticks bigint, entry_latency_seconds bigint, "
    "event_count bigint, label_available_timestamp timestamp, ambiguity_policy string, "
    "reason_codes array<string>"
)
LABEL_REPORT_COLUMNS = (
    "setup_id",
    "setup_type",
    "entry_side",
    "entry_timestamp",
    "exit_reason",
    "success",
    "net_r",
    "reason_codes",
)


def _column_rows(names: list[str], required: Iterable[str]) -> list[tuple[int, str, bool, bool, bool]]:
    """Position, name, and whether required, present and repeated: the input's columns, then the lacking ones."""
    wanted = list(required)
    every = dict.fromkeys([*names, *wanted])
    return [(i, n, n in wanted, n in names, names.count(n) > 1) for i, n in enumerate(every)]


def _fault(row: tuple[int, str, bool, bool, bool]) -> str | None:
    _, name, required, present, repeated = row
    return f"{name} twice" if repeated else f"no {name}" if required and not present else None


def require_columns(names: Iterable[str], required: Iterable[str], what: str = "input") -> None:
    """Raise where the schema report would call the input invalid."""
    faults = [f for f in map(_fault, _column_rows(list(names), required)) if f]
    if faults:
        raise SchemaError(f"{what} has {', '.join(faults)}")


def schema_report(df: DataFrame, required: Iterable[str] = MBO_REQUIRED) -> DataFrame:
    """One row per present or missing column, with the verdict on the whole input."""
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    found = _column_rows(df.columns, required)
    valid = not any(map(_fault, found))
    return df.sparkSession.createDataFrame(
        [(i, name, types.get(name), *flags, valid) for i, name, *flags in found],
        "position int, column_name string, column_type string, required boolean, "
        "present boolean, duplicated boolean, input_valid boolean",
    )


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in its order and types."""
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema))
