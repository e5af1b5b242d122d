"""Text helpers: Java-compatible split (F01/Q7), trim (F02), lines of a text column."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def java_split(s: Column, sep: str = " ") -> Column:
    """``String.split(sep)`` semantics: trailing empty tokens are dropped, inner ones kept;
    a string of separators only yields no token; the empty string yields one ``''``.
    Spark's ``split`` keeps trailing empties, so trailing separators are cut first."""
    q = re.escape(sep)
    # Spark's rtrim strips trailing spaces only: exactly the cut for a single-space separator
    cut = F.rtrim(s) if sep == " " else F.regexp_replace(s, f"(?:{q})+$", "")
    return F.when((s != F.lit("")) & (cut == F.lit("")), F.array().cast("array<string>")).otherwise(F.split(cut, q))


def lines(text: Column) -> Column:
    """The lines of a text value as a file reader yields them: split at ``\\n``; a final
    newline ends the last line rather than starting an empty one."""
    body = F.when(text.endswith("\n"), text.substr(F.lit(1), F.length(text) - 1)).otherwise(text)
    return F.split(body, "\n")
