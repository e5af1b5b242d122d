"""Near-duplicate lines by an exact set-similarity join.

A line is the set of its words. In every line the words are ordered by rarity; two lines of
similarity ``t`` or more share a word among the first ``size - ceil(t * size) + 1`` of both (prefix
filter), their sizes differ by at most a factor ``t`` (length filter), and the words from the first
shared one on must be able to make up the overlap (positional filter). Words of parities for
each line, more for long ones, bound from below how many words are in one of the two only. Pairs that
pass are verified on the lines' words, and the later line goes.

Any fixed order of words is exact; rarity only keeps prefixes selective. It comes from counts of
words over all texts, folded into ``BUCKETS`` counters (4 MB, whatever the corpus). Lines of equal
sets are one line with its earliest place before any pair is made, so frequent lines cost one
row each, and sets are numbered by that place. A line needs only one earlier partner, so pairs are
never listed:

1. Prefix words at which a line has a fitting partner are found by a semi join, which yields each word
   of a line once, however many partners there are. Lines without one are done; the rest is small.
2. A round on those holds each line against the earliest line of two of its rarest such words. Lines
   that it settles look for no partner again: they only serve as earlier lines of others.
3. At the words that are left, by a semi join again, each unsettled line is held against the leaders of
   the word (grouped minima), and verified against the one it meets most often.
4. Lines that are left are held against all others at those words, on all their words, by semi joins
   again. Nothing is capped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import vectors as V
from .common import row_key, saved

PERCENT = 75
BUCKETS, CHUNK = 1 << 20, 1 << 16
#: Lines of so many words or more have 256 parities besides the 128 of all lines.
LONG = 140
#: Documents whose lines are found by a bitmap of eight bits each (4 MB); beyond, by a shuffle join.
FEW = 1 << 22
#: Rarest words, by twos of which lines are first held against the earliest line that has both.
LEADING = 4


def _words(data: np.ndarray, off: np.ndarray, i: int, j: int):
    """Of the texts i..j: word fingerprints, the text and line each is in (lines from 0)."""
    b = data[off[i] : off[j]]
    o = off[i : j + 1] - off[i]
    s, e = V.runs(~V.is_space(b), o[:-1])
    h = V.spans_hash(V.prefix(b), s, e)
    doc = np.searchsorted(o, s, side="right") - 1
    feeds = np.concatenate([[0], np.cumsum(b == 10)])
    return h, doc, feeds[s] - feeds[o[doc]]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        data, off = V.raw(batch.column(0))
        for i, j in V.blocks(off):
            h, _, _ = _words(data, off, i, j)
            total += np.bincount((h & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
    for c in range(0, BUCKETS, CHUNK):
        yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([total[c : c + CHUNK].tobytes()], pa.binary())], names=["at", "n"])


def _summed(t: pa.Table) -> pa.Table:
    n = np.sum([np.frombuffer(x, np.int64) for x in t["n"].to_pylist()], axis=0)
    return pa.table({"at": t["at"][:1], "n": pa.array([n.tobytes()], pa.binary())})


def rarity(docs: DataFrame) -> np.ndarray:
    """Words counted over all texts, folded into BUCKETS counters; a task sends its counters in chunks,
    and those of one chunk are summed in groups of tasks first."""
    t = docs.select("text").mapInArrow(_count, "at int, n binary").withColumn("g", F.pmod(F.spark_partition_id(), F.lit(64)))
    t = t.groupBy("at", "g").applyInArrow(lambda x: _summed(x), "at int, n binary").groupBy("at").applyInArrow(lambda x: _summed(x), "at int, n binary").toArrow()
    out = np.zeros(BUCKETS, np.int32)
    for at, n in zip(t["at"].to_pylist(), t["n"].to_pylist()):
        out[at : at + CHUNK] = np.minimum(np.frombuffer(n, np.int64), 2**31 - 1)
    return out


def _prefix(size: np.ndarray) -> np.ndarray:
    return size + (-PERCENT * size) // 100 + 1  # size - ceil(t * size) + 1


def _parities(h: np.ndarray, no: np.ndarray, n: int, longs: int) -> np.ndarray:
    """``longs`` numbers of parities for each of ``n`` lines, of the words ``h`` in lines ``no``."""
    place = ((h >> np.uint64(20)) % np.uint64(64 * longs)).astype(np.int64)
    odd = (np.bincount(no * 64 * longs + place, minlength=n * 64 * longs) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64).reshape(n, longs)


def _arrays(x: np.ndarray, has: np.ndarray | None = None) -> pa.Array:
    """The rows of ``x`` as lists; with ``has``, those of the places where it holds, and null elsewhere."""
    has = np.ones(len(x), bool) if has is None else has
    off = np.concatenate([[0], np.cumsum(has)]).astype(np.int32) * np.int32(x.shape[1])
    return pa.ListArray.from_arrays(pa.array(off), pa.array(x.ravel()), mask=pa.array(~has))


def _order(h: np.ndarray, c: np.ndarray, no: np.ndarray) -> np.ndarray:
    """Order by line ``no`` (ascending), count ``c`` below 2048 and fingerprint ``h``. One key holds 17 bits of
    the line and 36 of the fingerprint; where that is not enough, all of both are compared."""
    if int(no[-1]) < 1 << 17:
        key = (no.astype(np.uint64) << np.uint64(47)) | (c.astype(np.uint64) << np.uint64(36)) | (h >> np.uint64(28))
        order = np.argsort(key, kind="stable")  # (the lines are in order, so runs are short)
        key, h2 = key[order], h[order]
        if not ((key[1:] == key[:-1]) & (h2[1:] != h2[:-1])).any():
            return order
    return np.lexsort((h, c, no))


_LINES = "doc_id bigint, row bigint, line int, s1 bigint, s2 bigint, size int, sketch bigint, sketch2 bigint, wide array<bigint>, prefix array<int>"


def _lines(counts):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rare = (64 * np.log2(counts.value + 1.0)).astype(np.uint16)  # below 2048, in steps of 1 %
        for batch in batches:
            data, off = V.raw(batch.column(2))
            for i, j in V.blocks(off):
                h, doc, line = _words(data, off, i, j)
                if not len(h):
                    continue
                # number the lines with a word, order by rarity, drop repeated words of a line
                new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (line[1:] != line[:-1])])
                no = np.cumsum(new) - 1
                order = _order(h, rare[(h & np.uint64(BUCKETS - 1)).astype(np.int64)], no)
                h2, no2 = h[order], no[order]
                keep = np.concatenate([[True], (h2[1:] != h2[:-1]) | (no2[1:] != no2[:-1])])
                h2, no2 = h2[keep], no2[keep]
                start = np.flatnonzero(np.concatenate([[True], no2[1:] != no2[:-1]]))
                size = np.diff(np.concatenate([start, [len(h2)]]))
                s1 = np.add.reduceat(V.mix(h2 + V.BASE), start)
                s2 = np.add.reduceat(V.mix(h2 ^ V.BASE2), start)
                bit, low = np.uint64(1) << ((h2 >> np.uint64(57)) & np.uint64(63)), h2 >> np.uint64(63) == 0
                sketch, sketch2 = (np.bitwise_xor.reduceat(np.where(half, bit, np.uint64(0)), start) for half in (low, ~low))
                long = size >= LONG
                of = np.repeat(np.where(long, np.cumsum(long) - 1, -1), size)
                wide = _parities(h2[of >= 0], of[of >= 0], int(long.sum()), 4)
                n = _prefix(size)
                at = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())
                first = np.flatnonzero(new)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(doc[first] + i)),
                        batch.column(1).take(pa.array(doc[first] + i)),
                        pa.array(line[first].astype(np.int32)),
                        pa.array(s1.view(np.int64)),
                        pa.array(s2.view(np.int64)),
                        pa.array(size.astype(np.int32)),
                        pa.array(sketch.view(np.int64)),
                        pa.array(sketch2.view(np.int64)),
                        _arrays(wide, long),
                        pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array((h2[at] >> np.uint64(32)).astype(np.uint32).view(np.int32))),
                    ],
                    names=["doc_id", "row", "line", "s1", "s2", "size", "sketch", "sketch2", "wide", "prefix"],
                )

    return work


def _pick(bits):
    """The documents whose row may be among those wanted: (row, text)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = np.unpackbits(bits.value)
        for b in batches:
            yield b.filter(pa.array(have[b.column(0).to_numpy(zero_copy_only=False) & (len(have) - 1)] == 1))

    return work


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x, y = b.column(2).to_pylist(), b.column(3).to_pylist()
        ok = []
        for p, q in zip(x, y):
            p, q = set(p.encode("utf-8", "surrogatepass").split()), set(q.encode("utf-8", "surrogatepass").split())
            both = len(p & q)
            ok.append(100 * both >= PERCENT * (len(p) + len(q) - both))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))


def _sizes_fit(x: list[str], y: list[str], sx: Column, sy: Column) -> Column:
    """Length filter, and the words in one line only: at most (1 - t) / (1 + t) of the sizes, at
    least what the parities show (two words of 64 for each line)."""
    fit = F.lit(100) * F.least(sx, sy) >= F.lit(PERCENT) * F.greatest(sx, sy)
    odd = sum(F.bit_count(F.col(p).bitwiseXOR(F.col(q))) for p, q in zip(x, y))
    return fit & (odd * F.lit(100 + PERCENT) <= F.lit(100 - PERCENT) * (sx + sy))


def _wide_fit(x: str, y: str, longs: int, sx: Column, sy: Column) -> Column:
    """The same by ``longs`` more numbers of parities, where both lines have them."""
    odd = sum(F.coalesce(F.bit_count(F.get(x, F.lit(i)).bitwiseXOR(F.get(y, F.lit(i)))), F.lit(0)) for i in range(longs))
    return odd * F.lit(100 + PERCENT) <= F.lit(100 - PERCENT) * (sx + sy)


def _meet(x: str, y: str) -> Column:
    """Rows (token, id, sp, sketch, sketch2, wide) of two lines that can be partners from this
    shared word on. ``sp`` holds size (from bit 32), done (bit 31) and place of the word."""
    sx, sy = (F.expr(f"shiftright({t}.sp, 32)") for t in (x, y))
    px, py = (F.expr(f"{t}.sp & 2147483647") for t in (x, y))
    return (
        (F.col(f"{x}.token") == F.col(f"{y}.token"))
        # at the first shared word the overlap, t / (1 + t) of the sizes, is still to come
        & (F.least(sx - px, sy - py) * F.lit(100 + PERCENT) >= F.lit(PERCENT) * (sx + sy))
        & _sizes_fit([f"{x}.sketch", f"{x}.sketch2"], [f"{y}.sketch", f"{y}.sketch2"], sx, sy)
        & _wide_fit(f"{x}.wide", f"{y}.wide", 4, sx, sy)
    )


def _open(t: str) -> Column:
    return F.expr(f"(shiftright({t}.sp, 31) & 1) = 0")


def _filtered(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that pass the filters on sizes and parities."""
    of = sets.select("id", "size", "sketch", "sketch2")
    p = pairs.join(of.toDF("a", "sx", "kx", "lx"), "a").join(of.toDF("b", "sy", "ky", "ly"), "b")
    return p.filter(_sizes_fit(["kx", "lx"], ["ky", "ly"], F.col("sx"), F.col("sy"))).select("a", "b")


def _read(ids: DataFrame, d: DataFrame, sets: DataFrame) -> DataFrame:
    """(id, words) of the sets ``ids``: the lines are read again at the sets' first places."""
    spark = d.sparkSession
    need = saved(sets.select("id", "at").join(ids, "id", "left_semi").select("id", F.col("at.row").alias("row"), F.col("at.line").alias("line")))
    rows = need.select("row").distinct()
    n = rows.count()
    if n <= FEW:
        size = max(8, 1 << (8 * n - 1).bit_length())
        marks = rows.select(F.expr(f"row & {size - 1}").alias("bit")).distinct().toArrow()
        have = np.zeros(size, np.uint8)
        have[marks["bit"].to_numpy()] = 1
        picked = d.select("row", "text").mapInArrow(_pick(spark.sparkContext.broadcast(np.packbits(have))), "row bigint, text string")
    else:
        picked = d.select("row", "text").join(rows, "row", "left_semi")
    at_lines = picked.select("row", F.posexplode(F.split("text", "\n")).alias("line", "words"))
    return saved(at_lines.join(need, ["row", "line"]).select("id", "words").dropDuplicates(["id"]))


def _settled(pairs: DataFrame, d: DataFrame, sets: DataFrame) -> DataFrame:
    """Ids a of the pairs (a, b) that are verified on the lines' words."""
    pairs = saved(pairs)
    words = _read(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct(), d, sets)
    both = pairs.join(words.toDF("a", "wa"), "a").join(words.toDF("b", "wb"), "b").select("a", "b", "wa", "wb")
    return saved(both.mapInArrow(_verify, "a bigint, b bigint").select(F.col("a").alias("id")).distinct())


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, words) -> id, 512 parities of the distinct words, and those."""
    for b in batches:
        if not b.num_rows:
            continue
        sets = [sorted(set(t.encode("utf-8", "surrogatepass").split())) for t in b.column(1).to_pylist()]
        off = np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int64)
        data = pa.array([w for x in sets for w in x], pa.binary())
        raw, ends = V.raw(data)
        h = V.spans_hash(V.prefix(raw), ends[:-1], ends[1:])
        all_ = _parities(h, np.repeat(np.arange(len(sets)), np.diff(off)), len(sets), 8)
        yield pa.RecordBatch.from_arrays([b.column(0), _arrays(all_), pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), data.cast(pa.string()))], names=["id", "all", "words"])


def _partnered(left: DataFrame, fit: DataFrame, d: DataFrame, sets: DataFrame) -> DataFrame:
    """Ids of the rows ``left`` that have an earlier partner among the rows ``fit``, on all words: held
    against each other where they meet, no pair is listed."""
    x, y = left.alias("x"), fit.alias("y")
    both = saved(y.join(x, _meet("y", "x") & (F.col("x.id") > F.col("y.id")), "left_semi").withColumn("own", F.lit(False)).unionByName(left.withColumn("own", F.lit(True))))
    words = _read(both.select("id").distinct(), d, sets).mapInArrow(_whole, "id bigint, all array<bigint>, words array<string>")
    both = saved(both.join(words, "id"))
    x, y = both.filter("own").alias("x"), both.filter("not own").alias("y")
    sx, sy = F.size("x.words"), F.size("y.words")
    n = F.size(F.array_intersect("x.words", "y.words"))
    same = F.lit(100) * n >= F.lit(PERCENT) * (sx + sy - n)
    near = _meet("x", "y") & (F.col("x.id") > F.col("y.id")) & _wide_fit("x.all", "y.all", 8, sx, sy) & same
    return saved(x.join(y, near, "left_semi").select("id").distinct())


def _number(d: DataFrame, lines: DataFrame) -> Column | None:
    """A bigint in order of the lines' places, from ``doc_id`` and ``line``; None if a ``doc_id`` has several
    rows or the numbers don't fit (places are sorted then)."""
    low, high, rows = d.groupBy("doc_id").count().agg(F.min("doc_id"), F.max("doc_id"), F.max("count")).first()
    low, high, line = low or 0, high or 0, lines.agg(F.max("line")).first()[0] or 0
    if (rows or 0) > 1 or (high - low + 2) * (line + 1) >= 1 << 63:
        return None
    return F.coalesce(F.col("doc_id") - F.lit(low), F.lit(high - low + 1)) * F.lit(line + 1).cast("bigint") + F.col("line")


def later_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, row, line, equal) of the lines to remove: an earlier line, by ``doc_id`` (null last),
    row and place, has a similarity of PERCENT or more; ``equal`` if one has the same set.
    ``row`` tells rows of one ``doc_id`` with different texts apart; lines count from 0, split
    at line feeds. Lines without a word are never removed. Rows equal in ``doc_id`` and text
    are one document."""
    spark = docs.sparkSession
    counts = spark.sparkContext.broadcast(rarity(docs))
    d = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), row_key().alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    lines = saved(d.mapInArrow(_lines(counts), _LINES))
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row", "line")
    # numbered in order of their first places: of two lines the one of the greater id is the later
    if (number := _number(d, lines)) is not None:
        at = lines.withColumn("id", number)
        first = at.groupBy("s1", "s2").agg(F.min("id").alias("id"), F.count("*").alias("n")).select("id", "n")
        sets = at.join(first, "id").select("s1", "s2", place.alias("at"), "n", "size", "sketch", "sketch2", "wide", "prefix", "id")
    else:
        sets = lines.groupBy("s1", "s2").agg(F.min(place).alias("at"), F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("size", "sketch", "sketch2", "wide", "prefix")])
        sets = sets.orderBy("at").withColumn("id", F.monotonically_increasing_id())
    sets = saved(sets)

    # prefix words of the lines at which another line may be a partner
    index = sets.select("id", "size", "sketch", "sketch2", "wide", F.posexplode("prefix").alias("pos", "token"))
    # one number for size, done (not yet) and place: a smaller shuffle row
    index = index.select("token", "id", "sketch", "sketch2", "wide", F.expr("size * 4294967296L + pos").alias("sp"))
    x, y = index.alias("x"), index.alias("y")
    fit = saved(x.join(y, _meet("x", "y") & (F.col("x.id") != F.col("y.id")), "left_semi"))
    # those lines, with their rarest such words; all others have no partner
    rarest = F.slice(F.sort_array(F.collect_list(F.struct(F.expr("sp & 2147483647").alias("pos"), "token"))), 1, LEADING)["token"]
    of = fit.groupBy("id").agg(F.first(F.expr("shiftright(sp, 32)")).alias("size"), F.first("sketch").alias("sketch"), F.first("sketch2").alias("sketch2"), rarest.alias("prefix"))
    some = saved(sets.select("id", "at").join(of, "id"))

    # most near copies fall to the earliest line that shares two of those words
    rare = [f"get(prefix, {k})" for k in range(LEADING)]
    two = [f"if(size(prefix) > {k}, xxhash64({rare[i]}, {rare[k]}), null)" for k in range(LEADING) for i in range(k)]
    keys = F.expr(f"if(size(prefix) = 1, array(xxhash64({rare[0]})), array({', '.join(two)}))")
    head = some.select("id", F.explode(keys).alias("key")).filter("key is not null")
    # (a running window: one shuffle, and no group is held)
    first = F.first("id").over(Window.partitionBy("key").orderBy("id"))
    pairs = head.withColumn("b", first).filter("id > b").select(F.col("id").alias("a"), "b").distinct()
    gone = _settled(_filtered(pairs, some), d, some)

    # words at which one of the two lines, the later one, is not settled
    done = fit.join(gone.withColumn("g", F.lit(True)), "id", "left")
    done = done.withColumn("sp", F.expr("if(g, sp + 2147483648L, sp)")).select(fit.columns)
    x, y = done.alias("x"), done.alias("y")
    # (one condition on both sides: one shuffle serves them)
    later = F.when(F.col("x.id") > F.col("y.id"), _open("x")).when(F.col("x.id") < F.col("y.id"), _open("y")).otherwise(F.lit(False))
    fit = saved(x.join(y, _meet("x", "y") & later, "left_semi"))

    # each line first against the leader it meets most often
    by = lambda k: F.min(F.struct(F.xxhash64("id", F.lit(k)).alias("h"), "id"))["id"]
    lead = fit.groupBy("token").agg(F.array_distinct(F.array(F.min("id"), by(1), by(2))).alias("lead"))
    stars = fit.alias("x").filter(_open("x")).join(lead, "token").select("id", F.explode("lead").alias("b")).filter("id > b")
    stars = stars.groupBy(F.col("id").alias("a"), "b").agg(F.count("*").alias("n"))
    stars = stars.join(_filtered(stars.select("a", "b"), some), ["a", "b"], "left_semi")
    most = _settled(stars.groupBy("a").agg(F.max(F.struct("n", "b")).alias("m")).select("a", "m.b"), d, some)
    left = saved(fit.alias("x").filter(_open("x")).join(most, "id", "left_anti").select(fit.columns))
    gone = gone.unionByName(most).unionByName(_partnered(left, fit, d, some))

    # every line but the first of its set, and the firsts that have an earlier partner
    mark = sets.join(gone.withColumn("g", F.lit(True)), "id", "left").filter("n > 1 or g").select("s1", "s2", "at", "g")
    out = lines.select("doc_id", "row", "line", "s1", "s2").withColumn("here", place).join(mark, ["s1", "s2"])
    return out.select("doc_id", "row", "line", (F.col("here") != F.col("at")).alias("equal"), "g").filter("equal or g").select("doc_id", "row", "line", "equal")


def clean(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc`` (a struct of its columns), ``kept`` (the text without the
    lines of :func:`later_lines`; null stays null), n_lines, n_removed, n_equal. A text that
    loses no line is kept byte for byte."""
    gone = later_lines(docs).distinct().groupBy("doc_id", "row").agg(F.collect_list("line").alias("gone"), F.count(F.when(F.col("equal"), 1)).alias("n_equal"))
    d = docs.select(F.struct("*").alias("doc"), F.col("doc_id").cast("bigint").alias("id"), row_key().alias("row"))
    # by the id too: a hash alone would meet another document's at some 10^10 rows
    gone = gone.withColumnRenamed("row", "r")
    d = d.join(gone, (F.col("row") == F.col("r")) & F.col("id").eqNullSafe(F.col("doc_id")), "left")
    parts = F.split("doc.text", "\n")
    d = d.select("doc", "gone", "n_equal", parts.alias("parts"))
    stay = F.expr("filter(parts, (x, i) -> not array_contains(gone, i))")
    return d.select(
        "doc",
        F.when(F.col("gone").isNull(), F.col("doc.text")).otherwise(F.array_join(stay, "\n")).alias("kept"),
        F.coalesce(F.size("parts"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_equal", F.lit(0)).cast("long").alias("n_equal"),
    )


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_lines, n_removed, n_equal, kept_sha256 (null text: empty)."""
    c = clean(docs.select("doc_id", "text"))
    return c.select(F.col("doc.doc_id").alias("doc_id"), "n_lines", "n_removed", "n_equal", F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"))


def keep(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with the lines removed; a document that loses all its lines with a word
    goes with them."""
    c = clean(docs)
    left = F.length(F.trim(F.translate("kept", "\t\n\x0b\x0c\r", "     ")))
    c = c.filter((F.col("n_removed") == 0) | (left > 0))
    return c.select(*[F.col("kept").alias(n) if n == "text" else F.col(f"doc.`{n}`") for n in c.schema["doc"].dataType.names])
