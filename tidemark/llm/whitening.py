"""Embedding whitening from the singular values of the centred rows, without forming a covariance.

Entries become integers; the fit list is each distinct vector once, so copies weigh nothing. Its count
and its exact sums per dimension give the centre. Every task reduces its centred rows to one
triangle R by QR, block after block, and triangles are stacked and reduced again in a tree of Spark
stages (R'R is n times the covariance, with half the digits lost that a product of rows loses).

The last triangle, d x d whatever the rows, is solved on the driver (:func:`principal`): Householder reflections make it
bidiagonal, dqds finds the squares of its singular values to high relative accuracy, each
direction comes from the twisted factorisation of B'B - lambda that has the smallest pivot at its
twist, and the reflections carry it back. Directions whose values lie closer than ``CLOSE``
are iterated against each other and rotated within their space.

The distinct step is pre-aggregated before its shuffle; all else is a narrow pass. Sent to executors:
the centre and the directions, d x k numbers.

Null vectors, empty ones and those with a null or non-finite entry are left out. If lengths differ, the
length of the most distinct vectors counts (the greater on ties), others are left out. Entries are cut
at 2^61 after scaling. Repeated rows, null ids and ties of values are kept, each row for itself. With
fewer than two distinct vectors there is no direction and no row, as for an empty table; directions
without variance (``FLAT`` of the greatest singular value) are not returned. A deviation beyond a
long is null. Other columns are left out. Of a value that is exactly multiple, any basis may come.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved

CUT = 1 << 61
ROWS = 2048
#: Bytes of triangles that one task stacks.
STACK = 64 << 20
EPS = 2.0**-52
#: Relative gap of values below which directions are treated together; singular values taken for zero.
CLOSE, FLAT = 1e-3, 1e-13


def integers(vectors: DataFrame, column: str = "embedding", scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """The rows of whole vectors with ``x``: floor(scale * entry) + shift of every entry, as long."""
    whole = F.forall(column, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    v = vectors.filter(F.col(column).isNotNull() & (F.size(column) > 0)).filter(whole)
    cut = lambda c: F.greatest(F.least(F.floor(c.cast("double") * F.lit(float(scale))), F.lit(CUT)), F.lit(-CUT))
    return v.withColumn("x", F.transform(column, lambda c: cut(c) + F.lit(shift).cast("bigint")))


def _matrix(col: pa.Array, shift: int) -> np.ndarray:
    """Rows of equal length less ``shift``."""
    return (col.flatten().to_numpy(zero_copy_only=False) - shift).reshape(len(col), -1) if len(col) else np.zeros((0, 0), np.int64)


def _parts(batch: pa.RecordBatch, at: int, shift: int) -> Iterator[tuple[int, np.ndarray]]:
    for i in range(0, batch.num_rows, ROWS):
        yield i, _matrix(batch.column(at).slice(i, ROWS), shift)


def _totals(shift: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            for _, y in _parts(batch, 0, shift):
                small = np.abs(y).max() < 1 << 40
                s = y.sum(0).astype(object) if small else y.astype(object).sum(0)
                n, total = n + len(y), s if total is None else total + s
        if n:
            rows = [-1, *range(len(total))], [n, *map(int, total)]
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int32()), pa.array([str(v) for v in rows[1]])], names=["dim", "total"])

    return work


def _triangle(x: np.ndarray) -> np.ndarray:
    r = np.linalg.qr(x, mode="r")
    return np.vstack([r, np.zeros((x.shape[1] - len(r), x.shape[1]))]) if len(r) < x.shape[1] else r


_R = "no bigint, r binary"


def _reduce(shift: int, centre):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for batch in batches:
            for _, y in _parts(batch, 0, shift):
                x = y - centre.value
                r = _triangle(x if r is None else np.vstack([r, x]))
        if r is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([r.tobytes()], pa.binary())], names=["no", "r"])

    return work


def _stacked(d: int):
    def work(t: pa.Table) -> pa.Table:
        r = None
        for b in t.sort_by("no")["r"].to_pylist():
            x = np.frombuffer(b).reshape(d, d)
            r = _triangle(x if r is None else np.vstack([r, x]))
        return pa.table({"no": [t["no"][0].as_py()], "r": [r.tobytes()]}, schema=pa.schema([("no", pa.int64()), ("r", pa.binary())]))

    return work


def triangle(fit: DataFrame, centre: np.ndarray, shift: int) -> np.ndarray:
    """R of the QR factorisation of the centred rows of ``fit`` (x), by a tree of stacked triangles."""
    d = len(centre)
    fan = max(2, min(32, STACK // (8 * d * d)))
    level = saved(fit.select("x").mapInArrow(_reduce(shift, fit.sparkSession.sparkContext.broadcast(centre)), _R))
    while level.count() > 1:
        # numbers are of partitions, with gaps: dense again before they are grouped
        w = level.select("no", (F.row_number().over(_by_no()) - 1).cast("bigint").alias("k"), "r")
        level = saved(w.select(F.expr(f"k div {fan}").alias("g"), F.col("k").alias("no"), "r").groupBy("g").applyInArrow(_stacked(d), _R))
    return np.frombuffer(level.first()["r"]).reshape(d, d)


def _by_no():
    from pyspark.sql import Window

    return Window.orderBy("no")  # one row a task


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and superdiagonal of B, and W, where r = U B W' by Householder reflections."""
    a, d = r.copy(), r.shape[1]
    w = np.eye(d)
    for k in range(d):
        _reflect(a[k:, k:])
        if k < d - 2:
            v = _reflect(a[k:, k + 1 :].T)
            if v is not None:
                w[:, k + 1 :] -= np.outer(w[:, k + 1 :] @ v, 2 * v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), w


def _reflect(a: np.ndarray) -> np.ndarray | None:
    """Clears the first column below its head, in place; the unit vector of the reflection."""
    v = a[:, 0].copy()
    scale = np.abs(v[1:]).max(initial=0.0)
    if scale == 0.0:
        return None
    v /= max(scale, abs(v[0]))
    v[0] += math.copysign(math.sqrt(v @ v), v[0])
    v /= math.sqrt(v @ v)
    a -= np.outer(2 * v, v @ a)
    a[1:, 0] = 0.0
    return v


def dqds(q: list[float], e: list[float]) -> list[float]:
    """Eigenvalues of B'B by the differential quotient-difference algorithm with shifts; ``q`` and ``e``: squares
    of B's diagonal (positive) and superdiagonal. A shift that would overshoot is refused and made smaller."""
    tol = (64 * EPS) ** 2
    out: list[float] = []
    todo = [(list(q), list(e), 0.0)]
    while todo:
        q, e, moved = todo.pop()
        least = None
        while q:
            n = len(q)
            if n == 1:
                out.append(q.pop() + moved)
                break
            if e[-1] <= tol * (moved + q[-1]):
                out.append(q.pop() + moved)
                e.pop()
                least = None
                continue
            cut = next((k for k in range(n - 2, -1, -1) if e[k] <= tol * moved), None)
            if cut is not None:
                todo.append((q[: cut + 1], e[:cut], moved))
                q, e, least = q[cut + 1 :], e[cut + 1 :], None
                continue
            if 1.5 * q[0] < q[-1]:
                q.reverse()
                e.reverse()
            s = 0.0 if least is None else 0.95 * least
            while (step := _dqds(q, e, s)) is None:
                s = s / 4 if s > 1e-6 * (moved + least) else 0.0
            q, e, least = step
            moved += s
    return out


def _dqds(q: list[float], e: list[float], s: float) -> tuple[list[float], list[float], float] | None:
    """One transform, and the least pivot, which bounds the least value from above; None if the
    shift is too great."""
    d = q[0] - s
    least, q2, e2 = d, [], []
    for k in range(len(e)):
        if d < 0:
            return None
        h = d + e[k]
        if h <= 0:
            return None
        q2.append(h)
        t = q[k + 1] / h
        e2.append(e[k] * t)
        d = d * t - s
        least = min(least, d)
    if d < 0:
        return None
    q2.append(max(d, 1e-300))
    return q2, e2, least


def _twisted(q: np.ndarray, low: np.ndarray, value: float) -> np.ndarray:
    """Unit vector of LDL' (D = q, L = low) for an eigenvalue: the twisted factorisation of LDL' - value from
    both ends, joined where the pivot is smallest."""
    n = len(q)
    tiny = EPS * EPS * max(value, 1e-280)
    s, p, up, down = np.empty(n), np.empty(n), np.empty(n), np.empty(n)
    s[0] = -value
    for i in range(n - 1):
        pivot = s[i] + q[i]
        up[i] = q[i] * low[i] / (pivot if pivot else tiny)
        s[i + 1] = up[i] * low[i] * s[i] - value
    p[n - 1] = q[n - 1] - value
    for i in range(n - 2, -1, -1):
        pivot = q[i] * low[i] * low[i] + p[i + 1]
        t = q[i] / (pivot if pivot else tiny)
        down[i] = low[i] * t
        p[i] = p[i + 1] * t - value
    r = int(np.argmin(np.nan_to_num(np.abs(s + p + value), nan=np.inf)))
    z = np.zeros(n)
    z[r] = 1.0
    for i in range(r - 1, -1, -1):
        z[i] = -up[i] * z[i + 1]
    for i in range(r, n - 1):
        z[i + 1] = -down[i] * z[i]
    return z / np.linalg.norm(z)


def principal(r: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` greatest eigenvalues of r'r above zero, falling, and their unit vectors as columns."""
    d = r.shape[1]
    size = np.abs(r).max(initial=0.0)
    if size == 0.0:
        return np.zeros(0), np.zeros((d, 0))
    diag, above, w = bidiagonal(r / size)
    top = max(np.abs(diag).max(), np.abs(above).max(initial=0.0))
    diag = np.where(np.abs(diag) < top * 1e-30, top * 1e-30, diag)
    above[np.abs(above) <= EPS * 1e-2 * top] = 0.0  # parts that do not meet are solved apart
    ends = [*(np.flatnonzero(above == 0.0) + 1).tolist(), d]
    found: list[tuple[float, int, int]] = []
    for a, b in zip([0, *ends], ends):
        found += [(v, a, b) for v in dqds((diag[a:b] ** 2).tolist(), (above[a : b - 1] ** 2).tolist())]
    found.sort(key=lambda f: -f[0])
    found = [f for f in found if f[0] > FLAT**2 * found[0][0]]
    # whole groups of close values, so that the last one taken is right too
    take = min(most, len(found))
    while take < len(found) and found[take - 1][0] - found[take][0] <= CLOSE * found[take - 1][0]:
        take += 1
    values, z = np.array([f[0] for f in found[:take]]), np.zeros((d, take))
    t = np.diag(diag**2 + np.concatenate([[0.0], above**2])) + np.diag(diag[:-1] * above, 1) + np.diag(diag[:-1] * above, -1)
    for k, (v, a, b) in enumerate(found[:take]):
        z[a:b, k] = _twisted(diag[a:b] ** 2, above[a : b - 1] / diag[a : b - 1], v)
    rng = np.random.default_rng(1)
    k = 0
    while k < take:
        m = k + 1
        while m < take and values[m - 1] - values[m] <= CLOSE * values[m - 1]:
            m += 1
        if m - k > 1:
            z[:, k:m] = _together(t, values[k:m], z[:, k:m], rng)
        k = m
    return values[:most] * size * size, (w @ z)[:, :most]


def _together(t: np.ndarray, values: np.ndarray, z: np.ndarray, rng) -> np.ndarray:
    """Directions of close values: orthogonal, iterated where two fell together, rotated within their space."""
    out = np.zeros_like(z)
    for k in range(z.shape[1]):
        v = z[:, k]
        for turn in range(4):
            left = v - out[:, :k] @ (out[:, :k].T @ v)
            if np.linalg.norm(left) > 0.5:
                break
            off = values[k] * (1 + (turn + 1) * 4 * EPS)
            left = rng.standard_normal(len(v)) if turn == 0 else left
            left = left - out[:, :k] @ (out[:, :k].T @ left)
            v = np.linalg.solve(t - off * np.eye(len(t)), left)
            v /= np.linalg.norm(v)
        left -= out[:, :k] @ (out[:, :k].T @ left)
        out[:, k] = left / np.linalg.norm(left)
    small, turn = np.linalg.eigh(out.T @ t @ out)
    return out @ turn[:, ::-1]


def _projected(shift: int, known):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, direct = known.value[:2]
        total = None
        for batch in batches:
            for _, y in _parts(batch, 0, shift):
                w = (y - centre) @ direct
                now = np.concatenate([w.sum(0), (w.T @ w).ravel()])
                total = now if total is None else total + now
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["at", "v"])

    return work


_OUT = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def _deviations(y: np.ndarray, n: int, total: list[int]) -> list[int | None]:
    """Sum over dimensions of (n * y - total)^2, exact; null beyond a long."""
    far = max(abs(int(y.min())), abs(int(y.max()))) * n + max(map(abs, total))
    if far * far * y.shape[1] < 1 << 63:
        z = y * n - np.array(total, np.int64)
        return (z * z).sum(1).tolist()
    z = y.astype(object) * n - np.array(total, object)
    return [v if v < 1 << 63 else None for v in (z * z).sum(1)]


def _rows(shift: int, known):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, direct, n, total, explained, error = known.value
        k = direct.shape[1]
        for batch in batches:
            for i, y in _parts(batch, 1, shift):
                m = len(y)
                each = np.repeat(np.arange(m), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, m).take(pa.array(each)),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, n, np.int64)),
                        pa.array(_deviations(y, n, total), pa.int64()).take(pa.array(each)),
                        pa.array(((y - centre) @ direct).ravel()),
                        pa.array(np.tile(explained, m)),
                        pa.array(np.full(m * k, error)),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return work


def whiten(vectors: DataFrame, components: int = 16, scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """A row for each whole vector and component: vec_id, component (from 1, by falling value), n (distinct
    vectors), deviation, whitened, explained (share of the trace) and identity_error."""
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], _OUT)
    x = integers(vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding"), "embedding", scale, shift).select("vec_id", "x")
    fit = saved(x.select("x").distinct())
    sizes = fit.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if sizes is None or sizes["count"] < 2:
        return empty
    d = sizes["d"]
    x, fit = x.filter(F.size("x") == d), fit.filter(F.size("x") == d)
    sums = fit.select("x").mapInArrow(_totals(shift), "dim int, total string").groupBy("dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    got = {r["dim"]: int(r["total"]) for r in sums.collect()}  # one row a dimension
    n, total = got[-1], [got[k] for k in range(d)]
    centre = np.array([t // n + (t % n) / n for t in total])
    r = triangle(fit, centre, shift)
    values, direct = principal(r, components)
    if not len(values):
        return empty
    explained = values / float((r * r).sum())
    direct = direct / np.sqrt(values / n)
    k = len(values)
    sums = fit.select("x").mapInArrow(_projected(shift, spark.sparkContext.broadcast((centre, direct))), "at int, v double").groupBy("at").agg(F.sum("v").alias("v"))
    got = {r["at"]: r["v"] for r in sums.collect()}  # k + k * k numbers
    flat = np.array([got[i] for i in range(k + k * k)]) / n
    error = float(np.abs(flat[k:].reshape(k, k) - np.outer(flat[:k], flat[:k]) - np.eye(k)).max())
    return x.mapInArrow(_rows(shift, spark.sparkContext.broadcast((centre, direct, n, total, explained, error))), _OUT)
