"""User-defined mergeable aggregates (G04 aggregate functions, G05 reduce functions).

An aggregate has four parts: ``init``, ``add`` rows, ``merge`` two accumulators, ``finish``. It runs as
Spark's own aggregates do: a partial stage inside each map task keeps one accumulator per key
and ships it when the task ends (or when ``most`` keys are open), a final stage merges what
arrives. A hot key costs one accumulator per map task, never its rows; what arrives of one key
is first merged in ``spread`` groups, so no task merges the accumulators of all tasks at once.

Accumulators and results are tuples typed by a schema string, so they travel as Arrow columns and
spill as rows. Keys keep their Arrow type throughout (null is a key like any other, large integers
stay exact). A window is a key too: group by its ``start`` and ``end``.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, StructType

from tidemark.session import findable

MOST, SPREAD = 100_000, 64


class UserAggregate(ABC):
    """``acc`` and ``out``: schemas (``name type, ...``) of the accumulator and of the result."""

    acc: str
    out: str

    @abstractmethod
    def init(self) -> tuple:
        """The accumulator of no rows."""

    @abstractmethod
    def add(self, acc: tuple, rows: pa.RecordBatch) -> tuple:
        """``acc`` with rows of one key (the input columns, in any order of arrival)."""

    @abstractmethod
    def merge(self, a: tuple, b: tuple) -> tuple:
        """The accumulator of the rows of both."""

    def finish(self, acc: tuple) -> tuple:
        return acc


class Reduce(UserAggregate):
    """A reduce function over rows (dictionaries of ``schema``) of the input's own type, associative and
    commutative; the result has the same columns."""

    def __init__(self, schema: str, function: Callable[[dict, dict], dict]):
        self.acc = self.out = schema
        self.function = function

    def init(self) -> tuple:
        return ()

    def _of(self, acc: tuple, names: Sequence[str]) -> dict | None:
        return dict(zip(names, acc)) if acc else None

    def add(self, acc: tuple, rows: pa.RecordBatch) -> tuple:
        now = self._of(acc, rows.schema.names)
        for row in rows.to_pylist():
            now = row if now is None else self.function(now, row)
        return tuple(now[n] for n in rows.schema.names)

    def merge(self, a: tuple, b: tuple) -> tuple:
        names = [f.strip().split()[0] for f in self.acc.split(",")]
        x = self.function(self._of(a, names), self._of(b, names))
        return tuple(x[n] for n in names)


def groups(batch: pa.RecordBatch, keys: Sequence[str]) -> Iterator[tuple[tuple, np.ndarray]]:
    """Each key of the batch (as Python values) with the places of its rows, in order of arrival."""
    code = np.zeros(batch.num_rows, np.int64)
    for k in keys:
        i = batch.column(batch.schema.get_field_index(k)).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        _, code = np.unique(code * (int(i.max(initial=0)) + 1) + i, return_inverse=True)
    order = np.argsort(code, kind="stable")
    starts = np.flatnonzero(np.concatenate([[True], code[order][1:] != code[order][:-1]])) if len(order) else []
    for s, e in zip(starts, [*starts[1:], len(order)]):
        at = order[s:e]
        yield tuple(batch.column(batch.schema.get_field_index(k))[int(at[0])].as_py() for k in keys), at


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


def aggregate(df: DataFrame, keys: Sequence[str], agg: UserAggregate, inputs: Sequence[str], most: int = MOST, spread: int = SPREAD) -> DataFrame:
    """``keys`` (at least one, not arrays or maps) and the columns of ``agg.out``, one row per key of ``df``;
    ``inputs`` are the columns that ``agg.add`` sees."""
    findable(df.sparkSession)
    keys, inputs = list(keys), list(inputs)
    key_type = StructType([df.schema[k] for k in keys])
    acc_type, out_type = StructType.fromDDL(agg.acc), StructType.fromDDL(agg.out)
    names = [f"_acc{i}" for i in range(len(acc_type))]
    acc_fields = StructType().add("_part", IntegerType())
    for n, f in zip(names, acc_type):
        acc_fields = acc_fields.add(n, f.dataType)
    partial_type = StructType([*key_type, *acc_fields])
    final_type = StructType([*key_type, *out_type])
    partial_schema, final_schema = (to_arrow_schema(t) for t in (partial_type, final_type))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() % spread
        open_: dict[tuple, tuple] = {}
        for b in batches:
            for key, at in groups(b, keys):
                open_[key] = agg.add(open_.get(key) or agg.init(), b.select(inputs).take(pa.array(at)))
            if len(open_) >= most:
                yield _table([(*k, part, *v) for k, v in open_.items()], partial_schema)
                open_ = {}
        if open_:
            yield _table([(*k, part, *v) for k, v in open_.items()], partial_schema)

    def merging(more: Sequence[str], schema: pa.Schema, finish: Callable[[tuple], tuple]):
        """Rows sorted by ``keys`` and ``more``: accumulators of equal ones merged, one open at a time."""
        by = [*keys, *more]

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, acc, out = None, None, []
            for b in batches:
                for key, row in zip(zip(*[b.column(c).to_pylist() for c in by]), zip(*[b.column(c).to_pylist() for c in names])):
                    if now is not None and all(x == y or (x != x and y != y) for x, y in zip(key, now)):
                        acc = agg.merge(acc, row)
                        continue
                    if now is not None:
                        out.append((*now, *finish(acc)))
                    now, acc = key, row
                    if len(out) >= 4096:
                        yield _table(out, schema)
                        out = []
            if now is not None:
                yield _table([*out, (*now, *finish(acc))], schema)

        return work

    d = df.select(*keys, *[c for c in inputs if c not in keys]).mapInArrow(partial, partial_type)
    for more, schema, kind, finish in ((["_part"], partial_schema, partial_type, tuple), ([], final_schema, final_type, agg.finish)):
        by = [*keys, *more]
        d = d.repartition(*by).sortWithinPartitions(*by).mapInArrow(merging(more, schema, finish), kind)
    return d


class MeanOf(UserAggregate):
    """Integer mean of one bigint column (the sum divided down), null values left out."""

    acc = "total bigint, n bigint"

    def __init__(self, column: str, name: str):
        self.column, self.out = column, f"{name} bigint"

    def init(self) -> tuple:
        return 0, 0

    def add(self, acc: tuple, rows: pa.RecordBatch) -> tuple:
        c = rows.column(rows.schema.get_field_index(self.column))
        return acc[0] + (pc.sum(c).as_py() or 0), acc[1] + len(c) - c.null_count

    def merge(self, a: tuple, b: tuple) -> tuple:
        return a[0] + b[0], a[1] + b[1]

    def finish(self, acc: tuple) -> tuple:
        return (acc[0] // acc[1] if acc[1] else None,)


class Collected(UserAggregate):
    """A list and a map in one accumulator, both bounded: the ``n`` smallest distinct values of
    ``column`` with a value, and the number of rows per value of ``by`` (the map grows with the
    distinct values of ``by``, which the caller bounds)."""

    def __init__(self, column: str, by: str, n: int, types: tuple[str, str] = ("bigint", "string")):
        self.column, self.by, self.n = column, by, n
        self.acc = self.out = f"first array<{types[0]}>, per map<{types[1]},bigint>"

    def init(self) -> tuple:
        return [], {}

    def add(self, acc: tuple, rows: pa.RecordBatch) -> tuple:
        col = lambda c: rows.column(rows.schema.get_field_index(c))
        counts = pc.value_counts(col(self.by).drop_null())
        return self.merge(acc, (pc.unique(col(self.column).drop_null()).to_pylist(), {r["values"]: r["counts"] for r in counts.to_pylist()}))

    def merge(self, a: tuple, b: tuple) -> tuple:
        per = dict(a[1])
        for k, v in dict(b[1]).items():
            per[k] = per.get(k, 0) + v
        return sorted({*a[0], *b[0]})[: self.n], per

    def finish(self, acc: tuple) -> tuple:
        return acc[0], dict(sorted(dict(acc[1]).items()))
