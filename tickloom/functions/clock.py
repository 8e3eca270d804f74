"""Time columns.

Nanoseconds since the epoch are the working form: Spark timestamps stop at microseconds. Local
clocks are microseconds too, moved by the zone's offset, so days and hours are integer arithmetic
and no result depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NS = 1_000_000_000
DAY = 86_400
DAY_US = DAY * 1_000_000
# Fixed value: the accepted text form of a UTC timestamp.
UTC_TEXT = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,9})?Z\z"


def floor_div(value: Column, by: int) -> Column:
    """Integer division rounding down, for any BIGINT; divisors that 4 divides name ``value`` once.

    The twos in the divisor are an arithmetic shift, which rounds down and leaves room to make the
    dividend positive, so that truncation by the odd rest rounds down as well. An expression that
    repeats its argument would double the generated code at every nesting.
    """
    twos = (by & -by).bit_length() - 1
    odd = by >> twos
    value = value.cast("bigint")
    if odd > 1 and twos < 2:
        below = F.when(value % F.lit(by) < 0, F.lit(1)).otherwise(F.lit(0))
        return F.call_function("div", value, F.lit(by)) - below
    value = F.shiftright(value, twos)
    if odd == 1:
        return value
    shift = -(-(1 << (63 - twos)) // odd)
    return F.call_function("div", value + F.lit(shift * odd), F.lit(odd)) - F.lit(shift)


def ns_to_ts(ns: Column) -> Column:
    """TIMESTAMP of an epoch-ns column, cut to microseconds."""
    return F.timestamp_micros(floor_div(ns, 1000))


def local_us(ns: Column, tz: str) -> Column:
    """Microseconds on the clock of ``tz`` since its 1970-01-01 00:00."""
    return F.unix_micros(F.from_utc_timestamp(ns_to_ts(ns), tz))


def ns_from_local(us: Column, tz: str) -> Column:
    """Epoch ns of a local clock given in microseconds."""
    return F.unix_micros(F.to_utc_timestamp(F.timestamp_micros(us), tz)) * 1000


def day_number(us: Column) -> Column:
    """Days since 1970-01-01 of a clock in microseconds."""
    return floor_div(us, DAY_US).cast("int")


def seconds_of_day(us: Column) -> Column:
    return F.call_function("div", F.pmod(us, F.lit(DAY_US)), F.lit(1_000_000))


def local_date(ns: Column, tz: str) -> Column:
    """``YYYY-MM-DD`` on the clock of ``tz``."""
    return F.date_from_unix_date(day_number(local_us(ns, tz))).cast("string")


def parse_utc_ns(text: Column) -> Column:
    """Epoch ns of a strict UTC text; anything else, or a time that BIGINT can't hold, is null.

    The pattern is matched once; the parts then sit at fixed places. The zone is in the text that
    is cast, so the session time zone plays no part. Times before 1970 are counted back from the
    next full second, so that the earliest ones are in reach.
    """
    seconds = F.unix_seconds(F.concat(F.left(text, F.lit(19)), F.lit("Z")).try_cast("timestamp"))
    fraction = F.rpad(F.rtrim(F.substring(text, 21, 9), F.lit("Z")), 9, "0").try_cast("bigint")
    early = F.when(text < "1970", F.lit(1)).otherwise(F.lit(0)).cast("bigint")
    whole = F.try_multiply(seconds + early, F.lit(NS).cast("bigint"))
    return F.when(text.rlike(UTC_TEXT), F.try_add(whole, fraction - early * NS))


def epoch_ns(df: DataFrame, name: str) -> Column:
    """Epoch ns of column ``name`` whatever form the file gave it."""
    kind = df.schema[name].dataType
    col = F.col(name)
    if isinstance(kind, T.StringType):
        return parse_utc_ns(col)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(col) * 1000
    if isinstance(kind, T.TimestampNTZType):
        since = (col - F.expr("timestamp_ntz'1970-01-01'")).cast("interval second")
        return (since.cast("decimal(20,6)") * 1_000_000).cast("bigint") * 1000
    if isinstance(kind, (T.LongType, T.DecimalType)):
        return col.cast("bigint")
    raise TypeError(f"{name} has no timestamp form: {kind.simpleString()}")


def ns_to_iso(ns: Column) -> Column:
    """``2026-04-06T00:00:00.001184655Z``; null stays null."""
    part = F.pmod(ns, F.lit(NS))
    return F.concat(_clock_text(ns), F.lit("."), F.lpad(part.cast("string"), 9, "0"), F.lit("Z"))


def ns_to_offset_iso(ns: Column) -> Column:
    """``2026-04-06T16:00:00+00:00``; microseconds appear only when they are not zero."""
    micros = F.call_function("div", F.pmod(ns, F.lit(NS)), F.lit(1000))
    tail = F.when(micros == 0, F.lit("")).otherwise(
        F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0"))
    )
    return F.concat(_clock_text(ns), tail, F.lit("+00:00"))


def _clock_text(ns: Column) -> Column:
    """``YYYY-MM-DDTHH:MM:SS`` of the UTC clock."""
    second = F.expr("interval '1' second")
    clock = F.expr("timestamp_ntz'1970-01-01 00:00:00'") + floor_div(ns, NS) * second
    return F.replace(clock.cast("string"), F.lit(" "), F.lit("T"))


def bucket_start(ns: Column, seconds: int, tz: str | None = None) -> Column:
    """Start of the bar holding ``ns``, counted from the epoch.

    With ``tz``, bars shorter than a day are counted from the local midnight, so the hour that a
    clock change repeats keeps its own bars; longer bars hold whole local days.
    """
    width = seconds * NS
    if tz is None:
        return floor_div(ns, width) * width
    span = max(seconds // DAY, 1) * DAY_US
    midnight = ns_from_local(floor_div(local_us(ns, tz), span) * span, tz)
    if seconds >= DAY:
        return midnight
    return ns - F.pmod(ns - midnight, F.lit(width))


def month_label(path: Column) -> Column:
    """``YYYY-MM`` when the file name starts with it and an underscore or end, else the stem."""
    name = F.regexp_extract(path, r"([^/\\]*)$", 1)
    stem = F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")
    month = F.regexp_extract(stem, r"^(\d{4}-\d{2})(?:_|$)", 1)
    return F.when(month != "", month).otherwise(stem)
