"""Mixing sources to target weights by a time-varying curriculum.

Each source has a weight and a schedule of that weight over training time 0..1. The weights
share out the words the mix takes; a target stops at ``cap`` times its source's words and the
excess is shared again by weight. A schedule is integrated to the source's cumulative demand;
inverting that demand gives every copy of a document its training position, and the mix is
range-sorted by position. DataFrame functions only.

Scale: a source is cut into 4,096 slices by a hash of ``doc_id`` and text, so rows without an id are
spread too; only wholly equal rows share one. Rows are windowed inside (source, slice); what crosses
slices is carried by a table of at most 4,096 rows a source. No source, however large, is in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD

WEIGHTS = (3, 1, 2)
#: Schedules of the sources in turn: (time, relative weight) knots, linear in between.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 0.5), (1.0, 2.0)))
SHARE, CAP = 1.5, 2.0
SLICES = 4096


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def position(u: Column, knots: Sequence[tuple[float, float]]) -> Column:
    """The time at which a source has met the share ``u`` (0..1) of its demand: the inverse of
    the integral of its piecewise linear schedule, in closed form."""
    area = [0.0]
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        area.append(area[-1] + (w0 + w1) / 2 * (t1 - t0))
    want = u * F.lit(area[-1])
    out = F.lit(float(knots[-1][0]))
    for i in reversed(range(len(knots) - 1)):
        (t0, w0), (t1, w1) = knots[i], knots[i + 1]
        rest = F.greatest(want - F.lit(area[i]), F.lit(0.0))
        slope = (w1 - w0) / (t1 - t0)
        under = F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2 * slope) * rest, F.lit(0.0))) + F.lit(float(w0))
        t = F.when(under > 0, F.lit(float(t0)) + F.lit(2.0) * rest / under).otherwise(F.lit(float(t0)))
        out = F.when(want <= F.lit(area[i + 1]), F.least(t, F.lit(float(t1)))).otherwise(out)
    return out


def targets(sizes: DataFrame, share: float = SHARE, cap: float = CAP, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """``sizes(source, source_size)``, one row a source -> with ``turn`` (place in code point
    order, null last) and ``target``. Sources in order of cap per weight are capped as long as
    the level that the others would get exceeds their own; then the level is final."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    s = sizes.withColumn("turn", F.row_number().over(by_name) - 1)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("turn") % len(weights) + 1).cast("int"))
    s = s.withColumn("_w", w).withColumn("_c", F.col("source_size") * F.lit(float(cap)))
    order = Window.orderBy(F.col("_c") / F.col("_w"), "turn")
    everything = Window.partitionBy()
    s = (
        s.withColumn("_t", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("_before", F.coalesce(F.sum("_c").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("_rest", F.sum("_w").over(order.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("_full", (F.col("_t") - F.col("_before")) * F.col("_w") >= F.col("_c") * F.col("_rest"))
    )
    open_w = F.sum(F.when(~F.col("_full"), F.col("_w"))).over(everything)
    capped = F.coalesce(F.sum(F.when(F.col("_full"), F.col("_c"))).over(everything), F.lit(0.0))
    level = (F.col("_t") - capped) / open_w
    return s.withColumn("target", F.when(F.col("_full"), F.col("_c")).otherwise(F.least(level * F.col("_w"), F.col("_c")))).select(
        "source", "source_size", "turn", "target"
    )


def assign(
    docs: DataFrame,
    payload: Sequence[Column] | None = None,
    share: float = SHARE,
    cap: float = CAP,
    weights: Sequence[int] = WEIGHTS,
    schedules: Sequence[Sequence[tuple[float, float]]] = SCHEDULES,
) -> DataFrame:
    """One row per document: ``payload`` (default ``row``, a struct of all its columns) with
    size, source, source_size, turn, target, copies and ``at``, the words of its source before
    it in the order of its slice, then of a hash of ``doc_id``, then of the text.

    Every document of a source is taken in each whole pass over it; in the last, partial pass
    those are taken whose middle lies before the target, so a source misses its target by
    half a document at most. Null text: size 0. Null source: a source of its own, the last.
    Repeated rows are separate documents; an empty table gives no rows."""
    who = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    slice_ = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.col("text")), F.lit(SLICES)).cast("int")
    rows = docs.select(
        *(payload or [F.struct("*").alias("row")]),
        F.struct(F.col("source")).alias("_s"),
        n_words().alias("size"),
        F.md5(who).alias("_o1"),
        F.md5(F.coalesce(F.col("text"), F.lit(""))).alias("_o2"),
        slice_.alias("_slice"),
    )
    per = (
        docs.select(F.struct(F.col("source")).alias("_s"), n_words().alias("size"), slice_.alias("_slice"))
        .groupBy("_s", "_slice")
        .agg(F.sum("size").alias("_n"))
    )
    # one row a (source, slice), 4,096 a source at most
    over = Window.partitionBy("_s").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carry = per.withColumn("_off", F.coalesce(F.sum("_n").over(over), F.lit(0)))
    wanted = targets(per.groupBy("_s").agg(F.sum("_n").alias("source_size")).select(F.col("_s.source").alias("source"), "source_size"), share, cap, weights)
    wanted = wanted.select(F.struct("source").alias("_s"), "source_size", "turn", "target")
    carry = carry.join(wanted, "_s").select("_s", "_slice", "_off", "source_size", "turn", "target")
    inside = Window.partitionBy("_s", "_slice").orderBy("_o1", "_o2", "size").rowsBetween(Window.unboundedPreceding, -1)
    d = rows.withColumn("_in", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(carry, ["_s", "_slice"])
    at = F.col("_off") + F.col("_in")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(1)).cast("long")
    d = d.withColumn("at", at).withColumn("_passes", passes)
    extra = F.lit(2) * F.col("at") + F.col("size") <= F.lit(2.0) * (F.col("target") - F.col("_passes") * F.col("source_size"))
    copies = F.col("_passes") + F.when(extra & (F.col("size") > 0), F.lit(1)).otherwise(F.lit(0))
    return d.withColumn("copies", copies.cast("int")).withColumn("source", F.col("_s.source")).drop(
        "_s", "_slice", "_o1", "_o2", "_in", "_off", "_passes"
    )


def at_position(assigned: DataFrame, copy: Column, schedules=SCHEDULES) -> Column:
    """Training position (0..1) of one copy (from 0) of a row of :func:`assign`."""
    middle = copy * F.col("source_size") + F.col("at") + F.col("size") / F.lit(2.0)
    u = F.when(F.col("target") > 0, F.least(middle / F.col("target"), F.lit(1.0))).otherwise(F.lit(0.0))
    out = position(u, schedules[-1])
    for i in reversed(range(len(schedules) - 1)):
        out = F.when(F.col("turn") % len(schedules) == i, position(u, schedules[i])).otherwise(out)
    return out


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix: the columns of ``docs``, a row for each copy taken, range-sorted by training
    position (ties by ``doc_id``)."""
    a = assign(docs, **options)
    schedules = options.get("schedules", SCHEDULES)
    taken = a.filter("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    taken = taken.withColumn("_at", at_position(a, F.col("_copy"), schedules))
    return taken.select("row", "_at").repartitionByRange("_at").sortWithinPartitions("_at", "row.doc_id").select("row.*")


def report(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, copies, position (of
    its first copy; null if none is taken)."""
    a = assign(docs, payload=[F.col("doc_id")], **options)
    first = F.when(F.col("copies") > 0, at_position(a, F.lit(0), options.get("schedules", SCHEDULES)))
    return a.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"), "copies", first.alias("position")
    )
