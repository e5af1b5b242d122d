"""Time conversions (F08, F09, F10, F11) and slice helpers.

Epoch values are UTC; ``tidemark.session.ensure_utc`` pins the session time zone that
Spark uses when it turns a ``timestamp_ntz`` into an instant.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.durations import duration_us


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_ms(ts: str | Column) -> Column:
    """timestamp / timestamp_ntz -> epoch milliseconds (bigint, floor)."""
    return F.unix_millis(_c(ts).cast("timestamp"))


def epoch_us(ts: str | Column) -> Column:
    return F.unix_micros(_c(ts).cast("timestamp"))


def ms_to_ts(ms: str | Column) -> Column:
    """epoch ms -> timestamp_ntz (UTC wall clock)."""
    return F.timestamp_millis(_c(ms)).cast("timestamp_ntz")


def seconds_ts(ms: str | Column) -> Column:
    """``TO_TIMESTAMP(FROM_UNIXTIME(ts / 1000))`` — integer division, so the result is
    cut to whole seconds (``ts / 1000`` as a fraction would keep them)."""
    return F.timestamp_seconds(floordiv(ms, 1000)).cast("timestamp_ntz")


def floor_to(ms: str | Column, size_ms: int) -> Column:
    """``ts / size * size`` for ts >= 0 (window start by integer division)."""
    return floordiv(ms, size_ms) * size_ms


def bucket(ts: str | Column, width: str) -> Column:
    """Epoch-aligned time bucket start (as a tumbling window's), null for a null time; a ``split``
    by plain arithmetic (``F.window`` would drop the rows without a time)."""
    w = duration_us(width)
    return F.timestamp_micros(floordiv(epoch_us(ts), w) * F.lit(w)).cast("timestamp_ntz")


def minus(ts: str | Column, interval: str) -> Column:
    """``et - INTERVAL '1' SECOND``."""
    return _c(ts) - F.expr(f"INTERVAL {interval}")


def floordiv(x: str | Column, w: int) -> Column:
    """Exact ``floor(x / w)`` for bigint ``x`` and a positive integer ``w`` (no floating point)."""
    x = _c(x).cast("bigint")
    wl = F.lit(w).cast("bigint")
    return F.call_function("div", x - F.pmod(x, wl), wl)


def ceildiv(x: str | Column, w: int) -> Column:
    """Exact ``ceil(x / w)`` for bigint ``x`` and a positive integer ``w``."""
    return -floordiv(-_c(x).cast("bigint"), w)
