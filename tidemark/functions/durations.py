"""Durations given as ``'15 minutes'`` / ``'1 hour'`` / seconds, as microseconds."""

from __future__ import annotations

# Fixed unit sizes in microseconds.
_UNITS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 7 * 86_400_000_000,
}


def duration_us(d: str | int | float) -> int:
    """``'10 seconds'`` -> 10_000_000; a bare number is taken as seconds."""
    if isinstance(d, (int, float)):
        return int(d * 1_000_000)
    total, parts = 0, d.lower().split()
    if len(parts) % 2:
        raise ValueError(f"bad duration {d!r}")
    for n, unit in zip(parts[::2], parts[1::2]):
        unit = unit.rstrip("s") if unit not in ("ms", "us") else {"ms": "millisecond", "us": "microsecond"}[unit]
        if unit not in _UNITS:
            raise ValueError(f"bad duration unit in {d!r}")
        total += int(float(n) * _UNITS[unit])
    return total


def interval_sql(d: str | int | float) -> str:
    """A Spark SQL interval literal body for ``INTERVAL ...``."""
    return f"{duration_us(d)} microseconds"
