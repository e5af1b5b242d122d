"""Line sources and line parsing.

``spark.read.text`` / ``spark.readStream.text`` give one row per line; the parsers turn
``a, b, 123`` lines into typed rows with native column functions (no UDF). Bad numbers do
not kill the job as in the reference: ``try_cast`` yields null and :func:`split_bad`
routes such rows aside.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.text import lines as text_lines


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """A text file or folder, one row per line (column ``value``)."""
    return spark.read.text(path)


def stream_lines(spark: SparkSession, path: str, fmt: str = "text", max_files_per_trigger: int | None = None, **options) -> DataFrame:
    """An unbounded line source. ``fmt='text'`` watches a folder (run it with
    ``trigger(availableNow=True)`` for a bounded stream); other formats (``socket``,
    ``kafka``) take their usual options and must yield a ``value`` column."""
    r = spark.readStream.format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.options(**options).load(path) if fmt == "text" else r.options(**options).load()
    if fmt == "kafka":
        df = df.select(F.col("value").cast("string").alias("value"))
    return df


def lines_of(df: DataFrame, text: str, keep: Sequence[str] = (), line_no: str = "line_no", line: str = "line") -> DataFrame:
    """S01 for text held in a column: one row per line with its 1-based number."""
    return df.select(*keep, F.posexplode(text_lines(F.col(text))).alias(line_no, line)).withColumn(
        line_no, (F.col(line_no) + 1).cast("bigint")
    )


def parse_delimited(
    lines: DataFrame, schema: StructType | str, sep: str = ",", trim: bool = True, col: str = "value", keep_raw: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """S06 (``trim=True``) / S07 (``trim=False``): ``a,b,123`` -> typed columns of ``schema``.
    Missing fields are null; fields that do not cast are null (``try_cast``). ``keep``: columns of
    ``lines`` that stay in front."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    parts = F.split(F.col(col), sep, -1)
    out = []
    for i, f in enumerate(schema.fields):
        v = F.get(parts, i)
        if trim:
            v = F.trim(v)
        if f.dataType.typeName() != "string":
            v = v.try_cast(f.dataType)
        out.append(v.alias(f.name))
    sel = [*out, F.col(col).alias("_raw")] if keep_raw else out
    return lines.select(*keep, *sel)


def split_bad(parsed: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """rows whose ``required`` fields parsed, and the rest (to count or route aside)."""
    ok = F.lit(True)
    for c in required:
        ok = ok & F.col(c).isNotNull()
    return parsed.filter(ok), parsed.filter(~ok)
