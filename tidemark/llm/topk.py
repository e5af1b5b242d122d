"""Exact top-k inner-product search by distributed histogram selection.

All queries are scored against all vectors, block by block. The first pass gathers, for each
query, a histogram of its scores; the bin that holds the k-th value is refined in further
passes until it is a single score. The last pass keeps what scores more, and of what ties
with the k-th value the smallest ids.

A block sends only its top bins, down to its own k-th score: the k-th value over all blocks is at
least that, so counts from the needed bin up are complete. No query or vector set is
broadcast or collected: query blocks meet candidate blocks in a co-grouped shuffle, and what
is known of each query (bin, rest of k) stays a table.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

BINS = 256
QUERY_BLOCK, BLOCK = 1024, 8192


def whole(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """vec_id and v: floor(scale * x) of every component, for rows with an id and only finite
    components, and ``row``, a number that tells rows of a repeated id apart (written, so it stays)."""
    ok = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    v = vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).filter(ok)
    v = v.select("vec_id", F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))).alias("v"))
    return saved(v.withColumn("row", F.monotonically_increasing_id()))


def _matrix(col: pa.ChunkedArray) -> np.ndarray:
    arr = col.combine_chunks()
    off = arr.offsets.to_numpy()
    flat = arr.values.to_numpy()
    size = np.diff(off)
    d = int(size.max()) if len(size) else 0
    if len(size) and (size == d).all():
        return flat[off[0] : off[-1]].reshape(len(size), d)
    out = np.zeros((len(size), d), np.int64)  # shorter vectors: zeros behind
    for i, (a, b) in enumerate(zip(off[:-1], off[1:])):
        out[i, : b - a] = flat[a:b]
    return out


def _scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    d = max(q.shape[1], c.shape[1])
    q, c = (np.pad(x, ((0, 0), (0, d - x.shape[1]))) for x in (q, c))
    if float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * d < 2**52:  # exact in doubles
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    return q @ c.T


def _parts(left: pa.Table, right: pa.Table):
    """Rows of the query block in parts, with the block's rows in order of id and their scores."""
    ids, rows = right["vec_id"].to_numpy(), right["row"].to_numpy()
    order = np.lexsort((rows, ids))
    ids, rows, c = ids[order], rows[order], _matrix(right["v"])[order]
    for at in range(0, left.num_rows, 128):
        part = left.slice(at, 128)
        yield part, part["row"].to_numpy(), ids, rows, _scores(_matrix(part["v"]), c)


def _histogram(step: int, k: int):
    schema = pa.schema([("query", pa.int64()), ("bin", pa.int64()), ("n", pa.int64())])

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            for part, qrow, _, rows, s in _parts(left, right):
                lo, hi, need = (part[x].to_numpy() for x in ("lo", "hi", "need"))
                for i, q in enumerate(qrow):
                    row = s[i]
                    row = row[(rows != q) & (row >= lo[i]) & (row <= hi[i])]
                    if not len(row):
                        continue
                    if len(row) > need[i]:  # down to the block's own k-th score
                        kth = np.partition(row, len(row) - need[i])[len(row) - need[i]]
                        row = row[row >= lo[i] + (kth - lo[i]) // step * step]
                    b, n = np.unique((row - lo[i]) // step, return_counts=True)
                    out.append((np.full(len(b), q), b, n))
        cols = [np.concatenate(x) if out else np.zeros(0, np.int64) for x in (zip(*out) if out else ((), (), ()))]
        return pa.Table.from_arrays([pa.array(x, pa.int64()) for x in cols], schema=schema)

    return work, "query bigint, bin bigint, n bigint"


def _final(k: int):
    schema = pa.schema([("query", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("row", pa.int64()), ("score", pa.int64())])

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            for part, qrow, ids, rows, s in _parts(left, right):
                qid, lo, need = (part[x].to_numpy() for x in ("vec_id", "lo", "need"))
                for i, q in enumerate(qrow):
                    other = rows != q
                    more = np.flatnonzero(other & (s[i] > lo[i]))
                    tie = np.flatnonzero(other & (s[i] == lo[i]))[: need[i]]  # ids are in order
                    at = np.concatenate([more, tie])
                    out.append((np.full(len(at), q), np.full(len(at), qid[i]), ids[at], rows[at], s[i][at]))
        cols = [np.concatenate(x) if out else np.zeros(0, np.int64) for x in (zip(*out) if out else ((),) * 5)]
        return pa.Table.from_arrays([pa.array(x, pa.int64()) for x in cols], schema=schema)

    return work, "query bigint, query_id bigint, vec_id bigint, row bigint, score bigint"


def search(queries: DataFrame, vectors: DataFrame, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` highest inner products of each query with the other
    rows of ``vectors`` (both as :func:`whole` gives them: ``vec_id``, ``v``, ``row``); ties to the
    smaller id, then row. Rows of a repeated id are queries and candidates each for itself. With
    fewer candidates all of them. Shorter vectors count as padded with zeros. A row holds one vector,
    however long; a block of them is what a task holds."""
    vectors, queries = saved(vectors), saved(queries)
    size = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    n, norm = vectors.agg(F.count("*"), F.max(size)).first()
    n_q, norm_q = queries.agg(F.count("*"), F.max(size)).first()
    spark = vectors.sparkSession
    if not n or not n_q:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    blocks, q_blocks = -(-n // BLOCK), -(-n_q // QUERY_BLOCK)
    bound = int(math.sqrt(norm or 0.0) * math.sqrt(norm_q or 0.0)) + 2  # Cauchy-Schwarz

    pairs = lambda name, m: F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias(name)
    cand = vectors.select("vec_id", "row", "v", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("_c"), pairs("_q", q_blocks))
    c_groups = cand.groupBy("_q", "_c")

    def against(state: DataFrame, work, schema: str) -> DataFrame:
        q = state.select("*", F.pmod(F.xxhash64("row"), F.lit(q_blocks)).cast("int").alias("_q"), pairs("_c", blocks))
        return q.groupBy("_q", "_c").cogroup(c_groups).applyInArrow(work, schema)

    lo, hi = -bound, bound
    state = queries.select("row", "vec_id", "v", F.lit(lo).cast("bigint").alias("lo"), F.lit(hi).cast("bigint").alias("hi"), F.lit(k).cast("bigint").alias("need"))
    width = hi - lo + 1
    while width > 1:
        step = -(-width // BINS)
        work, schema = _histogram(step, k)
        h = against(state, work, schema).groupBy("query", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("query").orderBy(F.col("bin").desc())
        h = h.withColumn("above", F.sum("n").over(down) - F.col("n")).join(state.select(F.col("row").alias("query"), "need"), "query")
        # the highest bin that reaches the rest of k; none: fewer candidates than k
        found = h.filter("above < need and above + n >= need").select(F.col("query").alias("row"), "bin", "above")
        d = state.join(found, "row", "left")
        start = F.col("lo") + F.col("bin") * step
        open_ = F.col("bin").isNull()
        state = saved(
            d.select(
                "row",
                "vec_id",
                "v",
                F.when(open_, F.col("lo")).otherwise(start).alias("lo"),
                F.when(open_, F.col("lo") - 1).otherwise(F.least(start + step - 1, F.col("hi"))).alias("hi"),  # open: no more refining
                F.when(open_, F.col("need")).otherwise(F.col("need") - F.col("above")).alias("need"),
            )
        )
        width = step
    work, schema = _final(k)
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id", "row"))
    top = against(state, work, schema).withColumn("rank", rank).filter(F.col("rank") <= k)
    return top.select("query_id", F.col("rank").cast("int"), "vec_id", "score")
