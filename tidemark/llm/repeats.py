"""Exact repeated substrings: a depth-limited radix sort of suffixes by most significant digits.

Suffixes are only told apart through ``LENGTH`` bytes: groups that are still equal there are
exactly the repeated windows. The passes take ever longer digits, and only suffixes in groups
of two or more go on:

1. Digit of ``GRAM`` bytes. Not every suffix is dealt out: of each window of ``LENGTH`` bytes the
   leftmost of its least gram fingerprints stands for it (equal windows choose alike), so one
   row stands for all neighbouring windows that share it, about one row in 176 bytes.
2. Windows that share a gram, in runs of up to ``RUN`` neighbours: the digit is the bytes common
   to the run. Where in a group the runs' whole stretches are equal too, all their windows repeat.
3. Of groups with different stretches, one run of each: its windows one by one, on all ``LENGTH``
   bytes.

Texts meet as their 16-byte key; equal texts are one text with a count, and all of them goes
if it has ``LENGTH`` bytes. The distinct texts are written once, bucketed by key, so each pass
shuffles only the small side. Fingerprints that decide have 128 bits (a stretch: 64, inside a
group of 64).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vectors as V
from .common import saved, shared_dir, text_key

LENGTH, GRAM, RUN = 400, 50, 32
REACH = LENGTH - GRAM + 1
_PLACE = np.uint64((1 << 28) - 1)


def _sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    n = len(v)
    pad = -n % w
    x = np.concatenate([v, np.full(pad, np.uint64(0xFFFFFFFFFFFFFFFF))]).reshape(-1, w)
    ahead = np.minimum.accumulate(x, axis=1).ravel()
    back = np.minimum.accumulate(x[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - w + 1], ahead[w - 1 : n])


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Gram fingerprint and place of each anchor of one text, and the first and last window it
    stands for."""
    if len(data) > int(_PLACE):
        raise ValueError(f"a text of {len(data)} bytes is longer than {int(_PLACE)}, the bound of a place")
    p = V.prefix(data)
    m = len(data) - GRAM + 1
    g = V.mix((p[GRAM:] - p[:m]) * V.powers(len(p))[1][:m])
    low = _sliding_min((g & ~_PLACE) | np.arange(m, dtype=np.uint64), REACH)
    first = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
    last = np.concatenate([first[1:], [len(low)]]) - 1
    place = (low[first] & _PLACE).astype(np.int64)
    return g[place].view(np.int64), place, first, last


def _two(data: np.ndarray):
    """Fingerprints of spans in two bases."""
    ps = [(V.prefix(data, b), b) for b in (V.BASE, V.BASE2)]
    return lambda s, e: [V.spans_hash(p, s, e, b).view(np.int64) for p, b in ps]


def _texts(batches: Iterator[pa.RecordBatch], text: int):
    for b in batches:
        data, off = V.raw(b.column(text))
        for i in range(b.num_rows):
            yield b, i, data[off[i] : off[i + 1]]


def _flush(schema: pa.Schema, rows: Iterator[tuple], size: int = 60_000) -> Iterator[pa.RecordBatch]:
    hold, n = [], 0
    for r in rows:
        hold.append(r)
        n += len(r[0])
        if n >= size:
            yield _batch(schema, hold)
            hold, n = [], 0
    if hold:
        yield _batch(schema, hold)


def _batch(schema: pa.Schema, hold: list[tuple]) -> pa.RecordBatch:
    cols = []
    for f, parts in zip(schema, zip(*hold)):
        if f.type == pa.binary():
            cols.append(pa.array([x for part in parts for x in part], pa.binary()))
        else:
            cols.append(pa.array(np.concatenate(parts)).cast(f.type))
    return pa.RecordBatch.from_arrays(cols, schema=schema)


_ANCHOR = pa.schema([("g", pa.int64()), ("key", pa.binary()), ("place", pa.int32()), ("first", pa.int32()), ("last", pa.int32())])
_RUNS = pa.schema([("core", pa.int64()), ("stretch", pa.int64()), ("key", pa.binary()), ("first", pa.int32()), ("last", pa.int32())])
_WINDOW = pa.schema([("w1", pa.int64()), ("w2", pa.int64()), ("key", pa.binary()), ("first", pa.int32())])


def _pass1(batches):
    def rows():
        for b, i, data in _texts(batches, 1):
            if len(data) >= LENGTH:
                g, place, first, last = anchors(data)
                yield g, [b.column(0)[i].as_py()] * len(g), place, first, last

    return _flush(_ANCHOR, rows())


def _structs(b: pa.RecordBatch, i: int, col: int) -> list[np.ndarray]:
    s = b.column(col)[i].values
    return [s.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(s.type.num_fields)]


def _pass2(batches):
    """(key, text, anchors) -> runs of windows: fingerprint of what the run's windows share, of the
    stretch of those there are and their places in the run, first and last window."""

    def rows():
        for b, i, data in _texts(batches, 1):
            place, first, last = _structs(b, i, 2)
            n = (place - first) // RUN - (place - last) // RUN + 1
            at = np.repeat(np.arange(len(place)), n)
            k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat((place - last) // RUN, n)
            hi, lo = place[at] - RUN * k, place[at] - RUN * k - RUN + 1  # windows of the run start here
            own_lo, own_hi = np.maximum(lo, first[at]), np.minimum(hi, last[at])
            fp = _two(data)
            # shared by all windows of the run, whichever of them there are
            core = V.mix(fp(np.minimum(hi, len(data)), np.minimum(lo + LENGTH, len(data)))[0].view(np.uint64) + k.astype(np.uint64)).view(np.int64)
            stretch = V.mix(fp(own_lo, own_hi + LENGTH)[1].view(np.uint64) + ((own_lo - lo) * RUN + own_hi - lo).astype(np.uint64)).view(np.int64)
            yield core, stretch, [b.column(0)[i].as_py()] * len(core), own_lo, own_hi

    return _flush(_RUNS, rows())


def _pass3(batches):
    def rows():
        for b, i, data in _texts(batches, 1):
            first, last = _structs(b, i, 2)
            n = last - first + 1
            s = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            w1, w2 = _two(data)(s, s + LENGTH)
            yield w1, w2, [b.column(0)[i].as_py()] * len(s), s

    return _flush(_WINDOW, rows())


def merge_spans(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    new = np.concatenate([[True], lo[1:] > hi[:-1]])
    return lo[new], np.concatenate([hi[:-1][new[1:]], hi[-1:]])


_CUT = "key binary, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary"


def _cut(batches):
    for b, i, data in _texts(batches, 1):
        n = len(data)
        if b.column(2)[i].as_py() > 1 and n >= LENGTH:
            lo, hi = np.array([0]), np.array([n])
        elif b.column(3)[i].is_valid and len(b.column(3)[i].values):
            lo, hi = merge_spans(*_structs(b, i, 3))
        else:
            lo = hi = np.zeros(0, np.int64)
        stay = np.ones(n, bool)
        for x, y in zip(lo, hi):
            stay[x:y] = False
        yield pa.RecordBatch.from_pydict(
            {"key": [b.column(0)[i].as_py()], "n_bytes": [n], "spans": [[{"start": int(x), "end": int(y)} for x, y in zip(lo, hi)]], "kept": [data[stay].tobytes()]},
            schema=pa.schema([("key", pa.binary()), ("n_bytes", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())]),
        )


def distinct_texts(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """key, text, copies: written once, bucketed by key."""
    spark = docs.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    d = docs.select(text_key().alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    d = d.groupBy("key").agg(F.first("text").alias("text"), F.count("*").alias("copies")).repartition(n, "key")
    name = f"llm_texts_{uuid.uuid4().hex}"
    d.write.bucketBy(n, "key").sortBy("key").option("path", f"{shared_dir(spark)}/{name}").saveAsTable(name)
    return spark.table(name)


def repeats(docs: DataFrame) -> DataFrame:
    """By text: key (16 bytes, :func:`text_key`), n_bytes, spans removed (maximal runs of bytes
    covered by a window that also starts elsewhere) and the bytes kept.

    Null text is empty; a text under ``LENGTH`` bytes has no window. Repeated rows are copies
    of each other. An empty table gives no rows."""
    texts = distinct_texts(docs)
    thin = texts.select("key", "text")
    a = saved(thin.mapInArrow(_pass1, "g bigint, key binary, place int, first int, last int"))
    again = a.groupBy("g").agg(F.count("*").alias("n")).filter("n > 1").select("g")
    of_key = a.join(again, "g").groupBy("key").agg(F.collect_list(F.struct("place", "first", "last")).alias("at"))
    r = saved(thin.join(of_key, "key").select("key", "text", "at").mapInArrow(_pass2, "core bigint, stretch bigint, key binary, first int, last int"))
    same = r.groupBy("core", "stretch").agg(F.count("*").alias("n"), F.min(F.struct("key", "first", "last")).alias("at"))
    # equal stretches repeat as they are; where a core has several, one of each goes on
    several = same.groupBy("core").agg(F.count("*").alias("n")).filter("n > 1").select("core")
    covered = r.join(same.filter("n > 1").select("core", "stretch"), ["core", "stretch"]).select("key", "first", "last")
    mixed = same.join(several, "core").select("at.*").groupBy("key").agg(F.collect_list(F.struct("first", "last")).alias("at"))
    w = saved(thin.join(mixed, "key").select("key", "text", "at").mapInArrow(_pass3, "w1 bigint, w2 bigint, key binary, first int"))
    twice = w.groupBy("w1", "w2").agg(F.count("*").alias("n")).filter("n > 1").select("w1", "w2")
    spans = covered.select("key", F.col("first").cast("long").alias("lo"), (F.col("last").cast("long") + LENGTH).alias("hi"))
    spans = spans.unionByName(w.join(twice, ["w1", "w2"]).select("key", F.col("first").cast("long").alias("lo"), (F.col("first").cast("long") + LENGTH).alias("hi")))
    spans = spans.groupBy("key").agg(F.collect_list(F.struct("lo", "hi")).alias("at"))
    return texts.join(spans, "key", "left").select("key", "text", "copies", "at").mapInArrow(_cut, _CUT)


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    r = repeats(docs)
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    r = r.select("key", "n_bytes", gone.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
    return docs.select("doc_id", text_key().alias("key")).join(r, "key").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
