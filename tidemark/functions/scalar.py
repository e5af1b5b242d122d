"""Scalar functions of the inventory (F01-F16) as column expressions.

F01/F02 split and trim: :mod:`tidemark.functions.text`; F08-F11 time: :mod:`tidemark.functions.time`;
F12 aggregates and F16 collection functions are Spark's own (``count``, ``avg``,
``collect_list``, ``size``, ``element_at``, ``sort_array``, ``map_from_entries``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_long(s: str | Column) -> Column:
    """F03 ``Long.valueOf``: null instead of a failed job for bad text (route such rows aside)."""
    return F.trim(_c(s)).try_cast("bigint")


def to_text(c: str | Column) -> Column:
    """value -> text."""
    return _c(c).cast("string")


def message(fmt: str, *cols: str | Column) -> Column:
    """a message line from typed columns (``format_string``, printf style)."""
    return F.format_string(fmt, *[_c(c) for c in cols])


def window_message(prefix: str, count: str | Column, start: str | Column, end: str | Column) -> Column:
    """the reference's window report line, e.g. ``"window 0 ~ 10000 : 3"``."""
    return F.concat(F.lit(prefix), _c(start).cast("string"), F.lit(" ~ "), _c(end).cast("string"), F.lit(" : "), _c(count).cast("string"))


def subtask_index() -> Column:
    """index of the task's partition (the reference's subtask index)."""
    return F.spark_partition_id()


def processing_time() -> Column:
    """wall-clock time, fixed per query (batch) or micro-batch (stream)."""
    return F.current_timestamp()
