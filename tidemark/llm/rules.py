"""Quality rules: a learned decision list over plain counts of a text.

Sequential covering: a rule is a conjunction of threshold conditions that rejects. It is grown
condition by condition on the growing part of the labelled documents, pruned on the other
part, and kept if it is precise there; the documents it covers leave, and the next rule is
grown. What comes out is an ordered list, applied as one Spark CASE expression. All counts
come from grouped aggregates over all labelled documents; only those of a fixed grid
(features x bins) reach the driver. DataFrame functions only.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, saved

SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANKS = " \t\n\x0b\x0c\r"
BINS = 64

#: Features on a fixed grid of 0..64: shares in 64ths, sizes in quarters of a power of two.
FEATURES = ("length", "word_length", "symbols", "dup_lines", "repeats", "upper", "digits", "marks", "distinct")


def _share(part: Column, whole: Column) -> Column:
    return F.least(F.floor(F.lit(BINS) * part / F.greatest(whole, F.lit(1))), F.lit(BINS)).cast("int")


def _without(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def counts(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` with word and line counts of the whole text (null: no
    words) and the features in bins, as ``b_<feature>``. One pass over the texts, no shuffle."""
    t = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select(F.struct(*keep).alias("_row"), t.alias("_t"), F.array_remove(F.split(t, SPACE), "").alias("_w"))
    d = d.withColumn("n_words", F.size("_w").cast("long"))
    lines = F.filter(F.split("_t", "\n"), lambda x: F.length(F.translate(x, BLANKS, "")) > 0)
    d = d.withColumn("_lines", lines)
    # windows of three words as hashes; those found twice or more, by their places
    three = F.when(
        F.size("_w") >= 3,
        F.expr("transform(slice(_w, 1, size(_w) - 2), (x, i) -> xxhash64(x, get(_w, i + 1), get(_w, i + 2)))"),
    ).otherwise(F.array().cast("array<bigint>"))
    d = d.withColumn("_h", three)
    some = F.size("_h") > F.size(F.array_distinct("_h"))
    d = d.withColumn("_s", F.when(some, F.expr("sort_array(transform(_h, (x, i) -> named_struct('h', x, 'i', i)))")))
    d = d.withColumn(
        "_p",
        F.expr("sort_array(transform(filter(_s, (x, j) -> coalesce(get(_s, j - 1).h = x.h, false) or coalesce(get(_s, j + 1).h = x.h, false)), x -> x.i))"),
    )
    covered = F.expr("aggregate(transform(_p, (x, j) -> least(3, coalesce(get(_p, j + 1) - x, 3))), 0, (a, x) -> a + x)")
    chars = F.length(F.translate("_t", BLANKS, ""))
    n = F.col("n_words")
    d = d.select(
        "_row",
        "n_words",
        chars.cast("long").alias("word_chars"),
        _without(F.col("_t"), SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("_lines").alias("_n_lines"),
        F.size(F.array_distinct("_w")).alias("_distinct"),
        _without(F.col("_t"), UPPER).alias("_upper"),
        _without(F.col("_t"), "0123456789").alias("_digits"),
        _without(F.col("_t"), "!?;:").alias("_marks"),
    )
    bins = {
        "length": F.least(F.floor(F.lit(4) * F.log2(n + 1)), F.lit(BINS)).cast("int"),
        "word_length": F.least(F.floor(F.lit(4) * F.col("word_chars") / F.greatest(n, F.lit(1))), F.lit(BINS)).cast("int"),
        "symbols": _share(F.col("n_symbols"), n),
        "dup_lines": _share(F.col("n_dup_lines"), F.col("_n_lines")),
        "repeats": _share(F.col("n_repeat_words"), n),
        "upper": _share(F.col("_upper"), F.col("word_chars")),
        "digits": _share(F.col("_digits"), F.col("word_chars")),
        "marks": _share(F.col("_marks"), n),
        "distinct": _share(F.col("_distinct"), n),
    }
    return d.select("_row.*", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *[b.alias(f"b_{k}") for k, b in bins.items()])


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.lit(100) * F.col("n_repeat_words") > F.lit(50) * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    bin: int

    def column(self) -> Column:
        c = F.col(f"b_{self.feature}")
        return c >= self.bin if self.at_least else c < self.bin

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.bin}"


Rule = tuple[Condition, ...]


def _holds(rule: Rule) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.column()
    return out


def verdict(rules: list[Rule]) -> Column:
    """The number (from 1) of the first rule that holds; null if none does."""
    out = None
    for i, r in enumerate(rules):
        out = F.when(_holds(r), F.lit(i + 1)) if out is None else out.when(_holds(r), F.lit(i + 1))
    return out if out is not None else F.lit(None).cast("int")


def _table(labelled: DataFrame) -> dict[str, list[tuple[int, int]]]:
    """By feature, for each bin: how many bad and good rows."""
    cells = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f"b_{f}").alias("b")) for f in FEATURES])).alias("c")
    got = labelled.select("bad", cells).groupBy("c.f", "c.b").agg(F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n")).collect()
    out = {f: [(0, 0)] * (BINS + 1) for f in FEATURES}
    for r in got:
        if r["b"] is not None:
            out[r["f"]][r["b"]] = (r["p"], r["n"])
    return out


def _best(table: dict[str, list[tuple[int, int]]], p0: int, n0: int) -> tuple[float, Condition | None]:
    """The condition of the largest information gain over what is covered now."""
    before = math.log2(p0 / (p0 + n0))
    best, found = 1e-9, None
    for f in FEATURES:
        p = n = 0
        total_p, total_n = (sum(x[i] for x in table[f]) for i in (0, 1))
        for b in range(1, BINS + 1):
            p, n = p + table[f][b - 1][0], n + table[f][b - 1][1]
            for at_least, (q, m) in ((False, (p, n)), (True, (total_p - p, total_n - n))):
                if q and (gain := q * (math.log2(q / (q + m)) - before)) > best:
                    best, found = gain, Condition(f, at_least, b)
    return best, found


def learn(labelled: DataFrame, precision: float = 0.9, least: int = 3) -> list[Rule]:
    """The decision list from ``labelled`` (columns of :func:`counts` and ``bad`` 0/1, ``part``
    0 to prune by or 1, 2 to grow by). A rule grows as long as a condition gains information. It
    stays if, pruned, it covers ``least`` bad rows of either part together and is ``precision``
    precise on both parts. The rows of one that fails are set aside while the next is grown, and the
    list ends when fewer than ``least`` bad rows are left to grow by or no condition gains: there
    is no limit on rules or conditions. No labels, or none bad: no rules."""
    rules: list[Rule] = []
    aside: list[Rule] = []
    grow, prune = labelled.filter("part <> 0"), labelled.filter("part = 0")
    while True:
        left = verdict(rules).isNull()
        rule: Rule = ()
        g = grow.filter(left & verdict(aside).isNull())
        p0 = least
        while p0 >= least:
            table = _table(g.filter(_holds(rule)))
            p0, n0 = (sum(x[i] for x in table[FEATURES[0]]) for i in (0, 1))
            if p0 < least or not n0 and rule:
                break
            _, found = _best(table, p0, n0)
            if found is None:
                break
            rule = (*rule, found)
        if not rule:
            return rules
        # prune: the shortest prefix that is at least as good on rows the rule was not grown on
        prefixes = [rule[: k + 1] for k in range(len(rule))]
        sums = [F.sum(F.when(_holds(x), v)).alias(f"{name}{k}") for k, x in enumerate(prefixes) for name, v in (("p", F.col("bad")), ("n", 1 - F.col("bad")))]
        seen, own = prune.filter(left).agg(*sums).first(), grow.filter(left).agg(*sums).first()
        score = [((seen[f"p{k}"] or 0) + 1) / ((seen[f"p{k}"] or 0) + (seen[f"n{k}"] or 0) + 2) for k in range(len(rule))]
        k = max(range(len(rule)), key=lambda i: (score[i], -i))
        p, n, q, m = (x or 0 for x in (seen[f"p{k}"], seen[f"n{k}"], own[f"p{k}"], own[f"n{k}"]))
        good = p + q >= least and q >= precision * (q + m) and p >= precision * (p + n)
        rules.append(prefixes[k]) if good else aside.append(rule)


def labelled(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Features of the documents that ``labels(doc_id, quality)`` covers, with ``bad`` and
    ``part``. Rows of base failures need no rule and are left out; null labels are too."""
    lab = labels.filter(F.col("quality").isNotNull()).select("doc_id", F.when(F.col("quality") == 0, 1).otherwise(0).alias("bad")).distinct()
    part = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3).cast("int").alias("part")
    return features.filter(~base_failed()).join(lab, "doc_id").select("bad", part, *[f"b_{f}" for f in FEATURES])


def judge(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, list[Rule]]:
    """doc_id, ``_key`` (of the row), the counts, base_failed, ``rule`` (number of the first rule
    that holds) and kept, one row per document; and the rules. Null, empty and short texts
    are base failures; documents that no rule covers are kept; repeated rows are judged
    alike; a null ``doc_id`` has no label."""
    f = saved(counts(docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("_key")), ["doc_id", "_key"]))
    rules = learn(saved(labelled(f, labels)))
    out = f.withColumn("base_failed", base_failed()).withColumn("rule", F.when(~F.col("base_failed"), verdict(rules)))
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()), rules


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass. The list is learned from thin counts; the texts are
    then judged row by row where they are, without a shuffle."""
    _, rules = judge(docs, labels)
    good = counts(docs.select(F.struct("*").alias("row"), "text"), ["row"])
    # a filter on plain columns would be pushed below the counts, with all of them written out in it
    good = good.withColumn("_n", F.monotonically_increasing_id())
    return good.filter((F.col("_n") >= 0) & ~base_failed() & verdict(rules).isNull()).select("row.*")
