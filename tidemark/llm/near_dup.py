"""Near-duplicate classes of documents by MinHash bands, odd sketches and full verification.

1. Per document, in one pass: the word shingles' fingerprints, ``HASHES`` MinHash values, their
   bands, and an odd sketch: the values folded into a bitmap of parities, whose XOR counts
   the values in which two documents differ (each is in the other's symmetric difference).
2. Documents of the same words become one node, so exact copies are never paired.
3. Every member of a band's bucket is paired with three leaders of the bucket, chosen by
   grouped minima. Pairs whose sketches are too far apart fall away; the rest are confirmed on
   the full shingle sets, and components are built.
4. Members of one bucket that are still in different components are paired with each other, in
   the same way filtered and confirmed. So every pair that shares a band is either confirmed,
   refuted or within one component; inside a group of copies pairs are never listed. Here a
   second odd sketch is asked too, of the whole shingle set: its XOR counts the symmetric
   difference itself, without the sampling error, so that documents which merely share a
   passage never become pairs.

With 48 bands of 4, a pair at similarity 0.75 shares no band with probability 1.2e-8, and
its sketch misses the bound with about 1e-7; both fall fast above.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import vectors as V
from .common import SPACE, components, saved

WORDS, PERCENT = 5, 75
BANDS, ROWS = 48, 4
HASHES = BANDS * ROWS
SKETCH, WHOLE = 512, 2048
#: Most bits in which the sketches of two documents of similarity 0.75 differ: mean 80, deviation 12.
FAR = 145


def _constants() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.RandomState(20240501)
    return rng.randint(0, 1 << 31, HASHES).astype(np.uint32) * np.uint32(2) + np.uint32(1), rng.randint(0, 1 << 31, HASHES).astype(np.uint32)


def shingle_hashes(words: np.ndarray) -> np.ndarray:
    """Distinct fingerprints of a text's shingles, from those of its words."""
    n = len(words)
    if n == 0:
        return words
    k = min(n, WORDS)
    m = n - k + 1
    h = np.full(m, k, np.uint64)
    for i in range(k):
        h = V.mix(h * V.BASE2 + words[i : i + m])
    return np.unique(h)


def signature(h: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    low = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    h = (h >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(h), 1024):
        np.minimum(low, (a[:, None] * h[at : at + 1024][None, :] + b[:, None]).min(axis=1), out=low)
    return low


def _bands(m: np.ndarray) -> np.ndarray:
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(m), BANDS)).copy()
    for r in range(ROWS):
        out = V.mix(out * V.BASE + m[:, r::ROWS].astype(np.uint64))
    return out


def _sketches(m: np.ndarray) -> np.ndarray:
    place = V.mix(m.astype(np.uint64) * V.BASE + np.arange(HASHES, dtype=np.uint64)) % np.uint64(SKETCH)
    flat = place.astype(np.int64) + np.arange(len(m))[:, None] * SKETCH
    odd = (np.bincount(flat.ravel(), minlength=len(m) * SKETCH) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(len(m), SKETCH), axis=1)


def _whole(h: np.ndarray) -> np.ndarray:
    """Parities of all shingles, in WHOLE bits."""
    return np.packbits((np.bincount((h >> np.uint64(20)).astype(np.int64) % WHOLE, minlength=WHOLE) & 1).astype(np.uint8))


SIGNED = "doc_id bigint, key binary, n_shingles bigint, bands array<bigint>, sketch array<bigint>, whole array<bigint>"


def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) -> doc_id, key (16 bytes of the word sequence), n_shingles, bands, sketch, whole."""
    a, b = _constants()
    for batch in batches:
        data, off = V.raw(batch.column(1))
        ids = batch.column(0)
        for i, j in V.blocks(off):
            low, o = V.lower(data[off[i] : off[j]]), off[i : j + 1] - off[i]
            space = V.is_space(low)
            s, e = V.runs(~space, o[:-1])
            words = V.spans_hash(V.prefix(low), s, e)
            at = np.searchsorted(s, o)
            # the words joined by single spaces
            ends = np.zeros(len(low) + 1, bool)
            ends[e] = True
            sep = ends[:-1] & space
            flat = np.where(sep, np.uint8(32), low)
            use = ~space | sep
            m = np.full((j - i, HASHES), 0xFFFFFFFF, np.uint32)
            n, keys, whole = [], [], []
            for d in range(j - i):
                h = shingle_hashes(words[at[d] : at[d + 1]])
                n.append(len(h))
                whole.append(_whole(h))
                if len(h):
                    m[d] = signature(h, a, b)
                piece = slice(o[d], o[d + 1])
                keys.append(hashlib.sha256(flat[piece][use[piece]].tobytes().rstrip(b" ")).digest()[:16])
            bands, sk, whole = _bands(m).view(np.int64), _sketches(m).view(np.int64), np.stack(whole).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(i, j - i).cast(pa.int64()),
                    pa.array(keys, pa.binary()),
                    pa.array(n, pa.int64()),
                    *[pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel())) for x in (bands, sk, whole)],
                ],
                names=["doc_id", "key", "n_shingles", "bands", "sketch", "whole"],
            )


def shingles(text: str | None) -> set:
    """The exact set: distinct shingles of the lower-cased (A-Z) words."""
    w = bytes.translate((text or "").encode("utf-8", "surrogatepass"), _LOWER).split()
    if len(w) < WORDS:
        return {tuple(w)} if w else set()
    return set(zip(*[w[i:] for i in range(WORDS)]))


_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, text_a, text_b) -> the pairs that are similar enough. Rows come ordered by b, so
    its set is made once for a run of rows."""
    last, y = None, set()
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            a, b, ta, tb = (c.to_pylist() for c in part.columns)
            keep = []
            for i in range(len(a)):
                if tb[i] != last:
                    last, y = tb[i], shingles(tb[i])
                x = shingles(ta[i])
                both = len(x & y)
                keep.append(both > 0 and 100 * both >= PERCENT * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], names=["a", "b"]).filter(pa.array(keep))


def _longs(c: str, n: int) -> list[Column]:
    """The first ``n`` bits of an array of numbers as plain, non-null columns."""
    return [F.coalesce(F.get(c, F.lit(i)), F.lit(0).cast("bigint")).alias(f"{c}{i}") for i in range(n // 64)]


def _bits(x: str, y: str, c: str, n: int) -> Column:
    """Bits in which two sketches differ. Plain columns keep the compiled condition small."""
    return sum((F.bit_count(F.col(f"{x}.{c}{i}").bitwiseXOR(F.col(f"{y}.{c}{i}"))) for i in range(n // 64)), F.lit(0))


def _whole_fit(x: str, y: str) -> Column:
    """Sets of similarity 0.75 differ in a seventh of their sizes' sum at most. That many parities
    flip no more bits than they are, and a known mean of bits, here with six deviations."""
    d = (F.col(f"{x}.n_shingles") + F.col(f"{y}.n_shingles")) / F.lit((100 + PERCENT) / (100 - PERCENT))
    mean = F.lit(WHOLE / 2) * (F.lit(1.0) - F.exp(F.lit(-2.0 / WHOLE) * d))
    deviation = F.least(d * F.lit((2 / WHOLE) ** 0.5), F.lit(WHOLE**0.5 / 2))
    return _bits(x, y, "whole", WHOLE) <= F.least(d, mean + F.lit(6.0) * deviation + F.lit(2.0))


def _sizes_fit(x: Column, y: Column) -> Column:
    return (F.lit(100) * F.least(x, y) >= F.lit(PERCENT) * F.greatest(x, y)) & (x > 0) & (y > 0)


def _plausible(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    n = nodes.select("node", "n_shingles", *_longs("sketch", SKETCH))
    p = pairs.alias("p").join(n.alias("x"), F.col("p.a") == F.col("x.node")).join(n.alias("y"), F.col("p.b") == F.col("y.node"))
    return p.filter(_sizes_fit(F.col("x.n_shingles"), F.col("y.n_shingles")) & (_bits("x", "y", "sketch", SKETCH) <= FAR)).select("p.a", "p.b").distinct()


def _confirmed(pairs: DataFrame, docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs of nodes whose full shingle sets are similar enough."""
    pairs = saved(pairs)
    need = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    at = nodes.join(need, "node", "left_semi").select("node", F.col("node").alias("doc_id"))
    texts = saved(docs.select("doc_id", "text").join(at, "doc_id").select("node", "text"))
    both = pairs.join(texts.toDF("a", "ta"), "a").join(texts.toDF("b", "tb"), "b").select("a", "b", "ta", "tb")
    return saved(both.mapInArrow(_confirm, "a bigint, b bigint").distinct())


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, _key, n_shingles, component_id, one row per row of ``docs``.

    A text without words (null, empty) has no shingles and is linked with nothing. Rows of one
    ``doc_id`` are one document; a null ``doc_id`` cannot be named: such a row is linked with
    nothing and its component is null. Other columns are ignored."""
    signed = saved(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(sign, SIGNED))
    linked = signed.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    nodes = saved(
        linked.groupBy("key")
        .agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"), F.first("whole").alias("whole"))
    )
    band = nodes.select("node", F.explode("bands").alias("bucket"))
    by = lambda k: F.min(F.struct(F.xxhash64("node", F.lit(k)).alias("h"), "node"))["node"]
    buckets = saved(band.groupBy("bucket").agg(F.count("*").alias("n"), F.array(F.min("node"), by(1), by(2)).alias("leaders")).filter("n > 1"))
    members = saved(band.join(buckets, "bucket").select("bucket", "node", "leaders"))
    stars = members.select("node", F.explode("leaders").alias("b")).filter("node <> b")
    stars = stars.select(F.greatest("node", "b").alias("a"), F.least("node", "b").alias("b")).distinct()
    stars = saved(_plausible(stars, nodes))
    comp = saved(components(_confirmed(stars, docs, nodes)))

    # what is left: members of a bucket in different components (written before they are joined with themselves:
    # plans that hold all these steps twice take hundreds of MB of the driver)
    at = members.select("bucket", "node").join(comp.withColumnRenamed("id", "node"), "node", "left")
    at = at.select("bucket", "node", F.coalesce("component", "node").alias("component"))
    split = at.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y").select("bucket")
    rest = saved(at.join(split, "bucket"))
    rest = rest.join(nodes.select("node", "n_shingles", *_longs("sketch", SKETCH), *_longs("whole", WHOLE)), "node")
    x, y = rest.alias("x"), rest.alias("y")
    near = (
        (F.col("x.bucket") == F.col("y.bucket"))
        & (F.col("x.node") > F.col("y.node"))
        & (F.col("x.component") != F.col("y.component"))
        & _sizes_fit(F.col("x.n_shingles"), F.col("y.n_shingles"))
        & (_bits("x", "y", "sketch", SKETCH) <= FAR)
        & _whole_fit("x", "y")
    )
    cross = x.join(y, near).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
    cross = cross.join(stars, ["a", "b"], "left_anti")
    more = _confirmed(cross, docs, nodes)
    # these links join whole components, each of which is named by its smallest id
    at = comp.withColumnRenamed("id", "node")
    ends = more.join(at.toDF("a", "x"), "a", "left").join(at.toDF("b", "y"), "b", "left")
    joined = saved(components(ends.select(F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b"))).toDF("component", "least"))
    whole = nodes.select("key", "node").join(at, "node", "left").select("key", F.coalesce("component", "node").alias("component"))
    whole = whole.join(joined, "component", "left").select("key", F.coalesce("least", "component").alias("component_id"))
    out = signed.select("doc_id", "key", "n_shingles").join(whole, "key", "left")
    # rows without words, or without an id
    own = F.when(F.col("doc_id").isNull() | (F.col("n_shingles") == 0), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("key").alias("_key"), "n_shingles", own.alias("component_id"))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable), kept."""
    return classes(docs).select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


#: Odd ids (see :func:`keep`) that are sent to every executor: 8 bytes each.
FEW = 1_000_000


def _words(text: str) -> Column:
    """The word sequence as 16 bytes; null without words."""
    lower = F.translate(F.col(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.trim(F.regexp_replace(lower, SPACE, " "))
    return F.when(words != "", F.substring(F.unhex(F.sha2(words, 256)), 1, 16))


def keep(docs: DataFrame) -> DataFrame:
    """One row of each class of ``docs``, the one of the smallest ``doc_id``; rows without words (null,
    empty) are in no class and all stay.

    A row is decided by its own text: if a ``doc_id`` has several texts, or none is given (null), each
    text is a document of its own, which stands behind all others in its class. Of rows with the same
    ``doc_id`` and words one stays, that of the smallest hash of its columns."""
    few = lambda x, n: F.broadcast(x) if n <= FEW else x
    d = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("bigint").alias("id"))
    again = saved(d.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1 or id is null").select("id", F.lit(True).alias("again")))
    n = again.count()
    if n:  # ids that are not one row's: only their texts are compared here
        d = d.withColumnRenamed("id", "i").join(few(again, n), F.col("i").eqNullSafe(F.col("id")), "left").drop("id")
        some = d.filter("again").withColumn("w", _words("row.text"))
        # one text of one id may be a third of all rows: one of them stays, found by a pre-aggregated minimum
        one = saved(some.filter("w is not null").groupBy("i", "w").agg(F.min_by("row", F.xxhash64("row.*")).alias("row")))
        several = one.groupBy("i").agg(F.count("*").alias("n")).filter("n > 1 or i is null").select(F.col("i").alias("j"), F.lit(True).alias("odd"))
        one = one.join(few(several, n), F.col("i").eqNullSafe(F.col("j")), "left")
        # rows of several texts are numbered, behind all ids
        one = saved(one.select("row", F.when(F.col("odd"), F.lit(1 << 62) + F.monotonically_increasing_id()).otherwise(F.col("i")).alias("id")))
        bare = some.filter("w is null").select("row", F.lit(None).cast("bigint").alias("id"))
        d = d.filter("again is null").select("row", F.col("i").alias("id")).unionByName(bare).unionByName(one)
    gone = classes(d.select(F.col("id").alias("doc_id"), "row.text")).filter("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct()
    return d.join(gone, F.col("id") == F.col("_gone"), "left_anti").select("row.*")
