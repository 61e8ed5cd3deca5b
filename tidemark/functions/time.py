"""Column helpers for event time, intervals and money."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text layout of window bounds in printed results (millisecond precision).
TS_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def interval(spec: str) -> Column:
    """``"2 hours"`` -> an interval literal usable in ``ts + interval``."""
    return F.expr(f"INTERVAL {spec}")


def interval_seconds(spec: str) -> int:
    """``"2 hours"`` -> 7200 (for arithmetic on epoch numbers)."""
    units = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800,
             "millisecond": 0.001}
    total = 0.0
    parts = spec.split()
    for amount, unit in zip(parts[0::2], parts[1::2]):
        total += float(amount) * units[unit.lower().rstrip("s")]
    return int(total) if total == int(total) else total


def event_time_from_seconds(c: str | Column) -> Column:
    """Event time derived from an integer field in seconds (``field * 1000`` ms)."""
    return F.timestamp_seconds(col(c))


def epoch_micros(c: str | Column) -> Column:
    """Microseconds since the epoch for timestamp or timestamp_ntz columns. A wall-clock
    value (ntz) is taken as it reads, with no zone: in the session zone two of its values may
    be one instant, or none, where clocks change."""
    x = col(c)
    since = x - F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")

    def part(field: str) -> Column:
        return F.extract(F.lit(field), since)

    wall = ((part("DAY").cast("bigint") * 24 + part("HOUR")) * 60 + part("MINUTE")) * 60_000_000 + (part("SECOND") * 1_000_000).cast("bigint")
    return F.when(F.typeof(x) == "timestamp_ntz", wall).otherwise(F.unix_micros(x.cast("timestamp")))


def cents(c: str | Column) -> Column:
    """Two-decimal money as exact integer cents (sums stay exact and order-free)."""
    return F.round(col(c) * 100).cast("bigint")


def format_ts(c: str | Column) -> Column:
    return F.date_format(col(c), TS_TEXT_FORMAT)


def to_stream_time(c: str | Column) -> Column:
    """``withWatermark`` rejects timestamp_ntz: streams carry zone-aware time (the
    session zone is UTC, so wall-clock values are kept)."""
    return col(c).cast("timestamp")
