"""Small hand-made inputs."""

from datetime import UTC, datetime

from pyspark.sql import types as T

from tickloom import schema as S

NS = 1_000_000_000
SESSION = "CME_EQ_FUT_2026-04-06"


def ns(text: str) -> int:
    stamp = datetime.fromisoformat(text.replace("Z", "+00:00")).astimezone(UTC)
    return int(stamp.timestamp()) * NS + stamp.microsecond * 1000


def iso(value: int) -> str:
    return datetime.fromtimestamp(value // NS, UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


BAR = "ts string, open double, high double, low double, close double, volume bigint, session_id string"


def bars(spark, rows, symbol="ESM6"):
    """Bars from (time, open, high, low, close, volume[, session])."""
    out = [
        (symbol, r[6] if len(r) > 6 else SESSION, ns(r[0]), *map(float, r[1:5]), r[5]) for r in rows
    ]
    return spark.createDataFrame(
        out,
        "symbol string, session_id string, bar_start_ns bigint, open double, high double, "
        "low double, close double, volume bigint",
    )


def tape(spark, rows, symbol="ESM6"):
    """Tape rows from (time text or ns, price, size, sequence[, source row])."""
    out = []
    for r in rows:
        t = ns(r[0]) if isinstance(r[0], str) else r[0]
        row = r[4] if len(r) > 4 else r[3]
        out.append((t, r[3], symbol, float(r[1]) if r[1] is not None else None, r[2], SESSION, row))
    return spark.createDataFrame(
        out,
        "ts_event_ns bigint, sequence bigint, symbol string, price double, size bigint, "
        "session_id string, source_row_number bigint",
    )


def candidate(setup_id, side, entry_time, entry, stop, target, **more):
    stamp = datetime.fromisoformat(entry_time.replace("Z", "+00:00")).astimezone(UTC)
    base = {
        "setup_id": setup_id,
        "ts_event": stamp,
        "symbol": "ESM6",
        "cme_session_id": SESSION,
        "setup_type": "TEST",
        "entry_side": side,
        "reference_level": entry,
        "entry_price": entry,
        "entry_timestamp": stamp,
        "structural_invalidation": stop,
        "stop_price": stop,
        "target_1": target,
        "target_2": target,
        "target_3": target,
        "max_holding_bars": 12,
        "max_holding_seconds": 21_600,
        "reason_codes": ["TEST"],
        "feature_timestamp": stamp,
        "setup_version": "test",
        "fvg_id": "z",
        "fvg_low": min(entry, target),
        "fvg_high": max(entry, target),
        "effort_range_ratio": 2.0,
        "effort_volume_ratio": 2.0,
    }
    base.update(more)
    return tuple(base[f.name] for f in S.CANDIDATE)


def candidates(spark, *rows):
    return spark.createDataFrame(list(rows), S.CANDIDATE)


MBO = T.StructType(
    [
        T.StructField("ts_recv", T.StringType()),
        T.StructField("ts_event", T.StringType()),
        T.StructField("rtype", T.LongType()),
        T.StructField("publisher_id", T.LongType()),
        T.StructField("instrument_id", T.LongType()),
        T.StructField("action", T.StringType()),
        T.StructField("side", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("size", T.LongType()),
        T.StructField("channel_id", T.LongType()),
        T.StructField("order_id", T.LongType()),
        T.StructField("flags", T.LongType()),
        T.StructField("ts_in_delta", T.LongType()),
        T.StructField("sequence", T.LongType()),
        T.StructField("symbol", T.StringType()),
    ]
)


def mbo_row(action, side, price=18000.25, size=1, sequence=1, ts="2026-04-06T00:00:00.001184655Z"):
    return (ts, ts, 160, 1, 123, action, side, price, size, 1, 1000 + (sequence or 0), 0, 0, sequence, "ESM6")


def mbo(spark, rows):
    """Raw rows with their position as the source row."""
    schema = T.StructType([*MBO.fields, T.StructField("source_row_number", T.LongType())])
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], schema)


ELEVEN = [
    mbo_row("T", "B", size=2, sequence=1),
    mbo_row("F", "B", size=2, sequence=2),
    mbo_row("T", "A", size=3, sequence=3),
    mbo_row("T", "N", size=4, sequence=3),
    mbo_row("A", "B", size=8, sequence=4),
    mbo_row("C", "A", size=8, sequence=5),
    mbo_row("M", "N", size=8, sequence=6),
    mbo_row("R", "B", size=8, sequence=7),
    mbo_row("T", "B", price=18000.10, size=1, sequence=8),
    mbo_row("T", "A", size=0, sequence=9),
    mbo_row("T", "B", size=1, sequence=10),
]
