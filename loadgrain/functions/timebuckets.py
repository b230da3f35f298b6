"""Time buckets over the nanosecond sample clock."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed-width buckets count from Monday 2000-01-03, month buckets
# from 2000-01-01 (both 00:00 UTC).
WEEK_ORIGIN_SECONDS = 946_857_600
MONTH_ORIGIN_YEAR = 2000

_UNIT_SECONDS = {
    "ms": 0.001,
    "s": 1,
    "second": 1,
    "m": 60,
    "minute": 60,
    "h": 3600,
    "hour": 3600,
    "d": 86400,
    "day": 86400,
    "w": 604800,
    "week": 604800,
}


def seconds(width: str | int | float) -> float:
    """``"5 seconds"``, ``"1h30m"``, ``"10ms"`` or a number, as seconds."""
    if isinstance(width, (int, float)):
        return width
    parts = re.findall(r"([0-9]*\.?[0-9]+)\s*([a-z]+)", width.lower())
    if not parts or re.sub(r"([0-9]*\.?[0-9]+)\s*([a-z]+)", "", width.lower()).strip():
        raise ValueError(f"not a duration: {width!r}")
    total = 0.0
    for number, unit in parts:
        unit = unit if unit in _UNIT_SECONDS else unit.rstrip("s")
        if unit not in _UNIT_SECONDS:
            raise ValueError(f"not a duration: {width!r}")
        total += float(number) * _UNIT_SECONDS[unit]
    return total


def sample_time(nanos: str | Column = "ts_unix_nano") -> Column:
    """The sample clock as TIMESTAMP (microseconds, rounded down)."""
    col = F.col(nanos) if isinstance(nanos, str) else nanos
    # pmod first: `div` alone would round times before 1970 towards zero.
    micros = F.call_function("div", col - F.pmod(col, F.lit(1000)), F.lit(1000))
    return F.timestamp_micros(micros)


def time_bucket(width: str | int | float, nanos: str | Column = "ts_unix_nano") -> Column:
    """Start of the fixed-width bucket holding a nanosecond time, as TIMESTAMP."""
    col = F.col(nanos) if isinstance(nanos, str) else nanos
    step = round(seconds(width) * 1_000_000_000)
    if step <= 0:
        raise ValueError("bucket width must be > 0")
    offset = WEEK_ORIGIN_SECONDS * 1_000_000_000 % step
    start = col - F.pmod(col - F.lit(offset), F.lit(step))
    if step % 1000 == 0:
        return F.timestamp_micros(F.call_function("div", start, F.lit(1000)))
    return sample_time(start)


def month_bucket(months: int, nanos: str | Column = "ts_unix_nano") -> Column:
    """Start of the ``months``-wide calendar bucket holding a nanosecond time."""
    ts = sample_time(nanos)
    index = (F.year(ts) - F.lit(MONTH_ORIGIN_YEAR)) * 12 + F.month(ts) - 1
    first = index - F.pmod(index, F.lit(months))
    return F.add_months(F.lit(f"{MONTH_ORIGIN_YEAR}-01-01").cast("date"), first).cast("timestamp")
