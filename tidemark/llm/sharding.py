"""K-d tree sharding: nearly equal bytes a shard.

The table is split recursively at a weighted median (more exactly the quantile that gives
either side its number of shards) along the dimension of metadata that is widest in the
node. All nodes of a level are worked on in the same jobs; medians are found by refining
histograms of 1,024 bins, so the driver sees at most shards x bins sums a job. A row's node is an
expression over its coordinates: nothing is rewritten between levels.

A coordinate is a whole number: the value, then bits of the text's hash, then bits of the
row's. So values may tie without limit, and equal texts, which take their group's first
metadata, are neighbours on every axis; a cut goes through a group only if the group
outweighs the tolerance.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import row_key, saved, text_key

SHARDS, BINS, SLICES = 40, 1024, 1024
#: A cut is near enough if what lies in its bin is at most this part of a shard.
TOLERANCE = 0.002
DIMENSIONS = ("size", "source", "lang", "content")


@dataclass
class Node:
    first: int
    shards: int
    cut: tuple[str, int] | None = None


class Tree:
    """Nodes by number: the root is 1, the parts of n are 2n and 2n + 1."""

    def __init__(self, shards: int):
        self.nodes = {1: Node(0, shards)}

    def _array(self, value, kind: str = "bigint") -> Column:
        """``value(node)`` by node number, as a literal array."""
        top = max(self.nodes)
        return F.array(*[F.lit(value(self.nodes[i]) if i in self.nodes else None) for i in range(top + 1)]).cast(f"array<{kind}>")

    def node(self) -> Column:
        """The number of the node that a row is in now: one step a level, down the cuts."""
        cut, axis = self._array(lambda n: n.cut and n.cut[1]), self._array(lambda n: n.cut and DIMENSIONS.index(n.cut[0]), "int")
        steps = F.sequence(F.lit(1), F.lit(max(self.nodes).bit_length()))

        def step(at: Column, _: Column) -> Column:
            down = F.lit(2) * at + (F.get("_x", F.get(axis, at)) > F.get(cut, at)).cast("int")
            return F.when(F.get(axis, at).isNull(), at).otherwise(down)

        return F.aggregate(steps, F.lit(1), step)

    def place(self) -> Column:
        return F.get(self._array(lambda n: n.first, "int"), self.node())


def prepare(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, _slice, coordinates; a thin table, saved. Columns ``source`` and
    ``lang`` are used if present."""
    t = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    have = {c.lower() for c in docs.columns}
    meta = {c: (F.col(c) if c in have else F.lit("")) for c in ("source", "lang")}
    d = saved(
        docs.select(
            "doc_id",
            (F.length(t) + 16).cast("long").alias("size"),
            F.crc32(t).alias("text_crc32"),
            text_key().alias("_key"),
            row_key().alias("_row"),
            *[F.coalesce(m.cast("string"), F.lit("")).alias(c) for c, m in meta.items()],
        )
    )
    group = d.groupBy("_key").agg(F.min("source").alias("source"), F.min("lang").alias("lang"))
    d = d.drop("source", "lang").join(group, "_key")
    low = F.shiftleft(F.pmod(F.xxhash64("_key"), F.lit(1 << 23)), 20) + F.pmod(F.col("_row"), F.lit(1 << 20))
    at = lambda value: F.shiftleft(value.cast("long"), 43) + low
    name = lambda c: F.crc32(F.col(c).cast("binary")) % 1024
    return saved(
        d.select(
            "doc_id",
            "size",
            "text_crc32",
            F.pmod(F.xxhash64("_row", F.lit(7)), F.lit(SLICES)).cast("int").alias("_slice"),
            "_row",
            F.array(at(F.floor(F.lit(16) * F.log2(F.col("size")))), at(name("source")), at(name("lang")), low).alias("_x"),
        )
    )


def tree(thin: DataFrame, shards: int = SHARDS) -> Tree:
    t = Tree(shards)
    level, spread = [1], None
    while level := [i for i in level if t.nodes[i].shards > 1]:
        at = thin.select("size", "_x", t.node().alias("_node")).filter(F.col("_node").isin(level))
        ends = [f(F.get("_x", F.lit(k))).alias(f"{g}_{x}") for k, x in enumerate(DIMENSIONS) for g, f in (("lo", F.min), ("hi", F.max))]
        seen = {r["_node"]: r for r in at.groupBy("_node").agg(F.sum("size").alias("bytes"), *ends).collect()}
        if spread is None:  # of the whole table, to compare dimensions by
            r = seen.get(1)
            spread = {x: max((r[f"hi_{x}"] >> 43) - (r[f"lo_{x}"] >> 43), 1) if r else 1 for x in DIMENSIONS}
        state: dict[int, dict] = {}
        for i in level:
            n, r = t.nodes[i], seen.get(i)
            if r is None:  # no rows: its shards stay empty
                n.cut = ("content", 0)
                continue
            wide = {x: ((r[f"hi_{x}"] >> 43) - (r[f"lo_{x}"] >> 43)) / spread[x] for x in DIMENSIONS[:-1]}
            x = max(wide, key=wide.get) if max(wide.values()) > 0 else "content"
            state[i] = {"axis": DIMENSIONS.index(x), "lo": r[f"lo_{x}"], "hi": r[f"hi_{x}"], "below": 0, "want": r["bytes"] * (n.shards // 2) / n.shards, "near": TOLERANCE * r["bytes"] / n.shards}
        open_ = sorted(state)
        while open_:
            for i in open_:
                state[i]["step"] = -(-(state[i]["hi"] - state[i]["lo"] + 1) // BINS)
            of = {k: F.get(F.array(*[F.lit(state[i][k] if i in open_ else None) for i in range(max(open_) + 1)]).cast("array<bigint>"), F.col("_node")) for k in ("axis", "lo", "hi", "step")}
            cells = at.select("_node", "size", F.get("_x", of["axis"].cast("int")).alias("_c"), of["lo"].alias("_lo"), of["hi"].alias("_hi"), of["step"].alias("_step"))
            got: dict[int, list[tuple[int, int]]] = {}
            for r in cells.filter("_c between _lo and _hi").groupBy("_node", F.expr("(_c - _lo) div _step").alias("b")).agg(F.sum("size").alias("w")).collect():
                got.setdefault(r["_node"], []).append((r["b"], r["w"]))
            still = []
            for i in open_:
                s = state[i]
                for b, w in sorted(got[i]):
                    if s["below"] + w >= s["want"]:
                        break
                    s["below"] += w
                start, end = s["lo"] + b * s["step"], min(s["lo"] + (b + 1) * s["step"] - 1, s["hi"])
                if s["step"] > 1 and w > s["near"]:
                    s["lo"], s["hi"] = start, end
                    still.append(i)
                else:  # the nearer side of the bin
                    t.nodes[i].cut = (DIMENSIONS[s["axis"]], end if s["below"] + w - s["want"] <= s["want"] - s["below"] else start - 1)
            open_ = still
        for i in level:
            n, half = t.nodes[i], t.nodes[i].shards // 2
            t.nodes[2 * i], t.nodes[2 * i + 1] = Node(n.first, half), Node(n.first + half, n.shards - half)
        level = [c for i in level for c in (2 * i, 2 * i + 1)]
    return t


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per document: doc_id, size (UTF-8 bytes and 16), text_crc32, law, shard, slot
    (gapless from 0 in its shard), grown_shard (null: only a law by key has one).

    Null text: no bytes. Null metadata: as an empty name. Repeated rows are separate documents
    of one group; with fewer groups than shards some shards are empty, as all are of an
    empty table."""
    thin = prepare(docs)
    d = thin.withColumn("shard", tree(thin, shards).place())
    per = d.groupBy("shard", "_slice").agg(F.count("*").alias("_n"))
    over = Window.partitionBy("shard").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    off = per.select("shard", "_slice", F.coalesce(F.sum("_n").over(over), F.lit(0)).alias("_off"))
    inside = Window.partitionBy("shard", "_slice").orderBy("_row", "doc_id")
    d = d.withColumn("_i", F.row_number().over(inside) - 1).join(off, ["shard", "_slice"])
    return d.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int"), (F.col("_off") + F.col("_i")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
