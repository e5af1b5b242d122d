"""Language-model scoring by context-tree weighting over bytes.

A byte is eight binary decisions. Each decision (a node of the byte's binary tree) has its own
context tree over the ``DEPTH`` bytes before; a context's counts give a Krichevsky-Trofimov
estimate, and the weighting mixes the estimates of all depths: with weight one half a context
stands alone, else it is split by one more byte. What is learned are counts of byte strings of
``DEPTH + 1`` bytes over all training documents; they grow with the corpus and stay a table.

* Texts are dealt into blocks of about ``BLOCK`` bytes by hash. A block is counted once: its distinct
  byte strings and words, with their counts in training documents.
* The sums over blocks are dealt by the ``NEAR`` bytes before (hashed into buckets, more of them as
  there are more distinct strings). A bucket weights its contexts from the deepest up to ``NEAR``
  bytes, with sparse arrays of the decisions that occur. What is left goes up one depth by a
  Spark aggregate, and for depths 1 and 0 as at most 256 x 255 sums to the driver. It is handed
  down the same way, as a linear map for each decision of a ``NEAR``-byte context, to give every
  byte string its probability.
* Each block gets the values of its own strings and words back and scores its texts.

The text is scored as lower-cased UTF-8 bytes after ``DEPTH`` zero bytes and up to one zero
byte, its end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vectors as V
from .common import row_key, saved

DEPTH = 5
#: Bytes before that all strings of a bucket share; one more than the depth that a Spark aggregate weights.
NEAR = 3
#: Distinct byte strings to a bucket beyond 256 buckets.
BUCKET = 1 << 20
BLOCK = 32 << 20
#: Bytes of text whose byte strings are held as arrays at a time.
PIECE = 1 << 19
HALF = float(np.log(0.5))
#: Key of the token that ends a document (words have mixed fingerprints).
END = np.uint64(0)


def lgamma(x: np.ndarray) -> np.ndarray:
    """log Gamma for x > 0: Stirling's series after eight steps up."""
    x = np.asarray(x, np.float64)
    down = np.zeros_like(x)
    for i in range(8):
        down += np.log(x + i)
    z = x + 8
    return (z - 0.5) * np.log(z) - z + 0.9189385332046727 + (1 / 12 - (1 / 360 - 1 / (1260 * z * z)) / (z * z)) / z - down


_SMALL = np.arange(4096.0)
_TABLES = {plus: lgamma(_SMALL + plus) for plus in (0.5, 1.0)}


def _log_gamma(n: np.ndarray, plus: float) -> np.ndarray:
    """log Gamma(n + plus) of whole numbers: small ones by table."""
    n = np.asarray(n, np.float64)
    out = np.array(_TABLES[plus][np.minimum(n, len(_SMALL) - 1).astype(np.int64)])
    large = n >= len(_SMALL)
    if large.any():
        out[large] = lgamma(n[large] + plus)
    return out


def kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """log of the Krichevsky-Trofimov probability of n0 zeros and n1 ones."""
    return _log_gamma(n0, 0.5) + _log_gamma(n1, 0.5) - 1.1447298858494002 - _log_gamma(n0 + n1, 1.0)


def _weighted(n: np.ndarray, children: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log weighted probability of a context, and the weight of its own estimate."""
    own = HALF + kt(n[..., 0], n[..., 1])
    w = np.logaddexp(own, HALF + children)
    return w, np.exp(own - w)


def _estimate(n: np.ndarray) -> np.ndarray:
    return (n[..., 1] + 0.5) / (n.sum(-1) + 1.0)


def _backward(grams: np.ndarray) -> np.ndarray:
    """The contexts of byte strings with the nearest byte first, so that a shift leaves a shorter one."""
    out = np.zeros_like(grams)
    for i in range(1, DEPTH + 1):
        out = out << 8 | (grams >> (8 * i) & 255)
    return out


class Level:
    """The decisions of one level (0..7) of the byte's tree in all contexts of a bucket: for each
    depth from ``DEPTH`` to ``NEAR`` their counts, estimates and weights, where they occur."""

    def __init__(self, context: np.ndarray, byte: np.ndarray, n: np.ndarray, level: int):
        self.bit = (byte >> (7 - level) & 1).astype(bool)
        key, at = np.unique(context << 8 | (1 << level) | byte >> (8 - level), return_inverse=True)
        n0, n1 = (np.bincount(at, weights=np.where(self.bit == one, n, 0), minlength=len(key)) for one in (False, True))
        log = kt(n0, n1)
        self.at, self.deep, self.up = at, _estimate(np.stack([n0, n1], -1)), []
        for _ in range(DEPTH - NEAR):
            key, at = np.unique(key >> 16 << 8 | key & 255, return_inverse=True)
            n0, n1, below = (np.bincount(at, weights=x, minlength=len(key)) for x in (n0, n1, log))
            both = np.stack([n0, n1], -1)
            log, weight = _weighted(both, below)
            self.up.append((at, weight, _estimate(both)))
        self.key, self.n0, self.n1, self.log = key, n0, n1, log

    def score(self, key: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """log10 probability of this decision in each byte string; a + b p is the probability of a
        one at a decision (sorted ``key``) whose contexts from ``NEAR`` bytes on give p."""
        p, places = self.deep, np.arange(len(self.deep))
        for at, weight, estimate in self.up:
            places = at[places]
            p = weight[places] * estimate[places] + (1 - weight[places]) * p
        x = np.searchsorted(key, self.key)[places]
        p = (a[x] + b[x] * p)[self.at]
        return np.log10(np.where(self.bit, p, 1 - p))


def _units(text: np.ndarray, off: np.ndarray, i: int, j: int):
    """Of the texts i..j: byte strings and word keys with the text each is in."""
    low = V.lower(text[off[i] : off[j]])
    o = off[i : j + 1] - off[i]
    s, e = V.runs(~V.is_space(low), o[:-1])
    words = V.spans_hash(V.prefix(low), s, e)
    word_doc = np.searchsorted(o, s, side="right") - 1
    # DEPTH zero bytes before each text; the first of them is also the end of the text before
    n = np.diff(o)
    at = np.arange(len(low)) + DEPTH * (np.repeat(np.arange(j - i), n) + 1)
    padded = np.zeros(len(low) + DEPTH * (j - i) + 1, np.uint8)
    padded[at] = low
    doc = np.repeat(np.arange(j - i), n + 1)
    pos = np.repeat(o[:-1] + DEPTH * (np.arange(j - i) + 1), n + 1) + np.arange(len(doc)) - np.repeat(np.cumsum(n + 1) - (n + 1), n + 1)
    grams = np.zeros(len(pos), np.int64)
    for back in range(DEPTH, -1, -1):
        grams = grams << 8 | padded[pos - back]
    return grams, doc, words, word_doc


def _merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k = np.concatenate(keys) if keys else np.zeros(0, np.int64)
    n = np.concatenate(counts) if counts else np.zeros(0, np.int64)
    order = np.argsort(k)
    k = k[order]
    first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]][: len(k)])
    return k[first], np.add.reduceat(n[order], first) if len(first) else n


_COUNTS = "block int, word boolean, key bigint, n bigint"


def _count(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """One block: its distinct keys with their counts in training documents."""
    block = table["block"][0].as_py()
    data, off = V.raw(table["text"])
    learn = table["learn"].combine_chunks().to_numpy(zero_copy_only=False)
    got = {True: ([], []), False: ([], [])}
    for i, j in V.blocks(off, PIECE):
        grams, doc, words, word_doc = _units(data, off, i, j)
        for word, k, d in ((True, words.view(np.int64), word_doc), (False, grams, doc)):
            keys, counts = got[word]
            k, n = _merge([k], [learn[i:j][d].astype(np.int64)])
            keys.append(k)
            counts.append(n)
            # the sums so far come first; pieces are added to them when they outweigh them
            if sum(map(len, keys[1:])) > max(len(keys[0]), PIECE):
                got[word] = tuple([x] for x in _merge(keys, counts))
    got[True][0].append(np.array([END], np.uint64).view(np.int64))
    got[True][1].append(np.array([learn.sum()], np.int64))
    out = []
    for word, (keys, counts) in got.items():
        k, n = _merge(keys, counts)
        out.append(pa.table({"block": pa.array(np.full(len(k), block, np.int32)), "word": pa.array(np.full(len(k), word)), "key": pa.array(k), "n": pa.array(n)}))
    return pa.concat_tables(out)


def _levels(table: pa.Table) -> Iterator[Level]:
    grams, n = table["key"].to_numpy(), table["n"].to_numpy()
    context, byte = _backward(grams), grams & 255
    for level in range(8):
        yield Level(context, byte, n, level)


_SUMMARY = "bucket int, context int, node int, n0 double, n1 double, log double"


def _summaries(table: pa.Table) -> pa.Table:
    """Counts and log weighted probability of the decisions in contexts of ``NEAR`` bytes."""
    levels = list(_levels(table))
    key, n0, n1, log = (np.concatenate([getattr(x, k) for x in levels]) for k in ("key", "n0", "n1", "log"))
    bucket = np.full(len(key), table["bucket"][0].as_py(), np.int32)
    return pa.table({"bucket": pa.array(bucket), "context": pa.array((key >> 8).astype(np.int32)), "node": pa.array((key & 255).astype(np.int32)), "n0": pa.array(n0), "n1": pa.array(n1), "log": pa.array(log)})


_WEIGHED = "context int, node int, n0 double, n1 double, log double, weight double, estimate double"


def _weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(context, node, n0, n1, log below) -> with the log, weight and estimate of the context itself."""
    for t in batches:
        n = np.stack([t.column(2).to_numpy(), t.column(3).to_numpy()], -1)
        log, weight = _weighted(n, t.column(4).to_numpy())
        yield pa.RecordBatch.from_arrays([*t.columns[:4], pa.array(log), pa.array(weight), pa.array(_estimate(n))], names=["context", "node", "n0", "n1", "log", "weight", "estimate"])


def _maps(shallow):
    """The linear map of each decision in contexts of two bytes, from depths 0 to 2."""
    w0, e0, w1, e1 = shallow

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            context, node, w2, e2 = (t.column(i).to_numpy() for i in range(4))
            c1 = context >> 8
            u0, u1 = w0[node], w1[c1, node]
            a = u0 * e0[node] + (1 - u0) * (u1 * e1[c1, node] + (1 - u1) * w2 * e2)
            b = (1 - u0) * (1 - u1) * (1 - w2)
            yield pa.RecordBatch.from_arrays([t.column(0), t.column(1), pa.array(a), pa.array(b)], names=["context", "node", "a", "b"])

    return work


def _values(left: pa.Table, right: pa.Table) -> pa.Table:
    """The byte strings of a bucket and the maps of its contexts -> the strings' log10 probabilities."""
    key = right["context"].to_numpy().astype(np.int64) << 8 | right["node"].to_numpy()
    order = np.argsort(key)
    key, a, b = key[order], right["a"].to_numpy()[order], right["b"].to_numpy()[order]
    value = sum(level.score(key, a, b) for level in _levels(left))
    return pa.table({"word": pa.array(np.zeros(len(value), bool)), "key": left["key"], "value": pa.array(value)})


def _shallow(rows) -> tuple[np.ndarray, ...]:
    """Weights and estimates of depths 0 and 1 (at most 256 x 255 rows)."""
    n, below = np.zeros((256, 256, 2)), np.zeros((256, 256))
    for r in rows:
        n[r["c1"], r["node"]] = r["n0"], r["n1"]
        below[r["c1"], r["node"]] = r["log"]
    log1, w1 = _weighted(n, below)
    n_all = n.sum(0)
    _, w0 = _weighted(n_all, np.where(n.sum(-1) > 0, log1, 0.0).sum(0))
    return w0, _estimate(n_all), w1, _estimate(n)


_SCORES = "_id bigint, _row bigint, n_tokens bigint, n_known bigint, n_bytes bigint, base_score double, score double"


def _scores(total: int, distinct: int):
    floor = float(total + 0.5 * (distinct + 1))

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        data, off = V.raw(left["text"])
        is_word = right["word"].combine_chunks().to_numpy(zero_copy_only=False)
        key, value = right["key"].to_numpy(), right["value"].to_numpy()
        model = []
        for w in (True, False):
            k, v = key[is_word == w], value[is_word == w]
            order = np.argsort(k)
            model.append((k[order], v[order]))
        (wk, wv), (gk, gv) = model
        wl = np.log10((wv + 0.5) / floor)
        end = int(np.searchsorted(wk, np.int64(END)))
        out = np.zeros((5, left.num_rows))
        for i, j in V.blocks(off, PIECE):
            grams, doc, words, word_doc = _units(data, off, i, j)
            u, at = np.unique(words.view(np.int64), return_inverse=True)
            x = np.searchsorted(wk, u)[at]
            m = j - i
            out[0, i:j] = np.bincount(word_doc, minlength=m) + 1
            out[1, i:j] = np.bincount(word_doc, weights=wv[x] > 0, minlength=m) + (wv[end] > 0)
            out[2, i:j] = np.bincount(doc, minlength=m) - 1
            out[3, i:j] = np.bincount(word_doc, weights=wl[x], minlength=m) + wl[end]
            u, at = np.unique(grams, return_inverse=True)
            out[4, i:j] = np.bincount(doc, weights=gv[np.searchsorted(gk, u)][at], minlength=m)
        ints = [pa.array(x.astype(np.int64)) for x in out[:3]]
        return pa.Table.from_arrays([left["_id"], left["_row"], *ints, pa.array(out[3]), pa.array(out[4])], names=["_id", "_row", "n_tokens", "n_known", "n_bytes", "base_score", "score"])

    return work


def score(docs: DataFrame, learn_if=None) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score
    (log10 probability of the text), n_bytes, bits_per_byte (of the score; its end included).

    Learned from documents for which ``learn_if`` holds (default: crc32 of ``doc_id`` as text, mod
    5, is not 1; a null id counts as empty text). Null text is empty: it has the end alone.
    Repeated rows count each time. Without training documents counts are 0 and the model is
    uniform."""
    if learn_if is None:
        learn_if = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 != 1
    d = docs.select(F.col("doc_id").cast("bigint").alias("_id"), F.coalesce("text", F.lit("")).alias("text"), learn_if.alias("learn"), row_key().alias("_row"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    d = d.withColumn("block", F.pmod(F.xxhash64("_row"), F.lit(max(-(-size // BLOCK), 1))).cast("int"))
    per = saved(d.select("block", "text", "learn").groupBy("block").applyInArrow(_count, _COUNTS))
    sums = saved(per.groupBy("word", "key").agg(F.sum("n").alias("n")))
    words = sums.filter("word")
    total, distinct, strings = sums.agg(F.sum(F.when(F.col("word"), F.col("n"))), F.count(F.when(F.col("word") & (F.col("n") > 0), 1)), F.count(F.when(~F.col("word"), 1))).first()
    total, distinct = total or 0, distinct or 0
    bucket = F.expr(f"cast(pmod(xxhash64((key div 256) % {1 << 8 * NEAR}), {max(256, -(-strings // BUCKET))}) as int)").alias("bucket")
    grams = sums.filter("not word").select("key", "n", bucket)
    near = saved(grams.groupBy("bucket").applyInArrow(_summaries, _SUMMARY))
    sum_up = [F.sum(c).alias(c) for c in ("n0", "n1", "log")]
    up = lambda t: t.groupBy(F.shiftright("context", 8).alias("context"), "node").agg(*sum_up)
    low = saved(up(near).mapInArrow(_weigh, _WEIGHED))
    shallow = _shallow(up(low).select(F.col("context").alias("c1"), "node", "n0", "n1", "log").collect())
    maps = low.select("context", "node", "weight", "estimate").mapInArrow(_maps(shallow), "context int, node int, a double, b double")
    at = near.select("bucket", F.col("context").alias("whole"), F.shiftright("context", 8).alias("context"), "node")
    maps = at.join(maps, ["context", "node"]).select("bucket", F.col("whole").alias("context"), "node", "a", "b")
    values = grams.groupBy("bucket").cogroup(maps.groupBy("bucket")).applyInArrow(_values, "word boolean, key bigint, value double")
    values = values.unionByName(words.select("word", "key", F.col("n").cast("double").alias("value")))
    back = per.select("block", "word", "key").join(values, ["word", "key"]).select("block", "word", "key", "value")
    s = d.select("block", "text", "_id", "_row").groupBy("block").cogroup(back.groupBy("block")).applyInArrow(_scores(total, distinct), _SCORES)
    held = ~(F.crc32(F.coalesce(F.col("_id").cast("string"), F.lit("")).cast("binary")) % 5 != 1)
    return s.select(
        F.col("_id").alias("doc_id"),
        held.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(total).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        "n_bytes",
        (-F.col("score") * F.lit(float(np.log2(10.0))) / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )
