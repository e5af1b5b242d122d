"""Tokens of two tokenizers over the same bytes, aligned by merging their ends along a merge path.

The merge of the A ends and the B ends of a text is a path of n_a + n_b steps, A first on ties. It is
cut at equal distances: on each cutting diagonal a binary search finds how many A ends and how
many B ends lie before it, so that the pieces between are of equal work and need nothing of each
other. A piece takes its own ends and the one A and B token that reach over its last step; each of
its steps is a link (the A and the B token over the bytes that end there; a tie is one step), marked
where a new A token and where a new B token begins. Where both begin, a group begins, so pieces
put together in order give the text's groups, also those that a border cut.

Links as Spark work: tasks write blocks of about ``BLOCK`` steps with the distinct id pairs of each
block, the number of documents that hold them, and the links as places in that list. Counts of an
id pair are a sum over blocks (a document in several pieces counts once, by its key), the best of
each A id a maximum over the pairs. Counts come back to the blocks by a join on the pair; a pair
has one row a block, however many documents link it, so a frequent pair is no hot key. Then
each block is finished beside its counts, and pieces of one text are put together.

Null and empty texts, and texts whose tokens do not spell space+text, have no tokens: zeros, and an
empty string of groups. Repeated rows, also of one doc_id, are documents of their own (each
counts). An empty table gives no row. Other columns are left out. A text is tokenized whole in one
task (some 150 bytes a byte of text there); all behind that works on pieces, but for the groups of
one text, which are one value.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vectors as V
from . import vocabularies
from .common import saved

#: Steps of a piece and of a block.
PIECE, BLOCK = 1 << 17, 1 << 19
#: The sentencepiece model has no piece with a space behind another character, so a text can be parted
#: before such a space; here between printable ASCII, in plain texts behind all but white space.
_SEGMENTS, _PLAIN_SEGMENTS = re.compile(rb"(?<=[!-~]) (?=[!-~])").split, re.compile(rb"(?<=[^\t-\r ]) (?!\Z)").split
_RUNS = [bytes([c, 32]) for c in (*range(9, 14), 32)]


def segments(text: bytes) -> list[bytes]:
    if not vocabularies.plain(text):
        return _SEGMENTS(text)
    if text[:1] == b" " or text[-1:] == b" " or any(r in text for r in _RUNS):
        return _PLAIN_SEGMENTS(text)
    return text.split(b" ")


_SCHEMA = "block bigint, parted boolean, key bigint, doc_id bigint, piece int, pieces int, n_a int, n_b int, steps int, at int, a int, b int, n bigint, links binary"
_FIELDS = pa.schema(
    [("block", pa.int64()), ("parted", pa.bool_()), ("key", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("pieces", pa.int32()), ("n_a", pa.int32()), ("n_b", pa.int32())]
    + [("steps", pa.int32()), ("at", pa.int32()), ("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64()), ("links", pa.binary())]
)
#: In a link's number: its place in the block's list of pairs, then whether A, and whether B begin.
_A, _B = np.uint32(2), np.uint32(1)


def diagonals(a: np.ndarray, b: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """How many of the ends ``a`` and of the ends ``b`` lie before each piece of ``step`` steps, and after the
    last; found for all diagonals at once by halving. Equal ends stay in one piece."""
    d = np.arange(step, len(a) + len(b), step)
    lo, hi = np.maximum(d - len(b), 0), np.minimum(d, len(a))
    while (open_ := lo < hi).any():
        mid = (lo + hi) // 2
        first = open_ & (a[np.minimum(mid, len(a) - 1)] <= b[np.clip(d - 1 - mid, 0, len(b) - 1)])
        lo, hi = np.where(first, mid + 1, lo), np.where(open_ & ~first, mid, hi)
    i, j = lo, d - lo
    j = j + ((i > 0) & (j < len(b)) & (a[np.maximum(i - 1, 0)] == b[np.minimum(j, len(b) - 1)]))
    return np.concatenate([[0], i, [len(a)]]), np.concatenate([[0], j, [len(b)]])


def overlaps(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of one piece, from its ends ``a`` and ``b`` with those that reach over its last step
    behind them: the step's end, and the places of its A and B token."""
    last = min(a[-1], b[-1])
    ends = np.concatenate([a, b])
    ends.sort(kind="stable")  # a merge: both runs are in order
    ends = ends[np.concatenate([[True], ends[1:] != ends[:-1]])]
    ends = ends[: np.searchsorted(ends, last, "right")]
    return ends, np.searchsorted(a, ends), np.searchsorted(b, ends)


class _Texts:
    """Both tokenizers, and the lengths of their tokens."""

    def __init__(self, json: bytes, pattern: str, model: bytes):
        spelled = vocabularies.json_bytes(json), vocabularies.model_bytes(model)
        if any(b" " in x.lstrip(b" ") for x in spelled[1]):
            raise ValueError("the model has pieces with a space behind another character")
        self.size = [np.array([len(x) for x in s], np.int64) for s in spelled]
        self.dtype = ["<u2" if len(s) <= 1 << 16 else "<u4" for s in spelled]
        self.spelled = spelled[0]
        self.a, self.b = vocabularies.spaced(json, pattern, self.dtype[0]), vocabularies.pieces(model, self.dtype[1])

    def ids(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """The A and the B ids of each text and the ends of both in bytes; none where they do not spell it."""
        cut = [segments(t) if t else [] for t in texts]
        self.b.learn(s for c in cut for s in c)
        for t, c in zip(texts, cut):
            a = np.frombuffer(self.a(t) if t else b"", self.dtype[0])
            b = np.frombuffer(b"".join(map(self.b.__getitem__, c)), self.dtype[1])
            ends = self.size[0][a].cumsum(), self.size[1][b].cumsum()
            # B's segments are checked one by one, A's pieces are of a byte-level vocabulary
            if not t or ends[0][-1] != len(t) + 1 or not len(b) or ends[1][-1] != len(t) + 1 or not self._spells(a, t):
                a, b, ends = a[:0], b[:0], (ends[0][:0], ends[1][:0])
            yield a, b, *ends
        self.b.forget(s for c in cut for s in c)

    def _spells(self, a: np.ndarray, text: bytes) -> bool:
        return vocabularies.plain(text) or b"".join(map(self.spelled.__getitem__, a.tolist())) == b" " + text


@lru_cache(maxsize=2)
def _texts(json: bytes, pattern: str, model: bytes) -> _Texts:
    return _Texts(json, pattern, model)


class _Block:
    """Pieces until they have ``BLOCK`` steps; those of texts in several pieces have blocks of their own."""

    def __init__(self, number: int, parted: bool):
        self.number, self.parted, self.rows, self.links, self.steps = number, parted, [], [], 0

    def add(self, row: tuple, pairs: np.ndarray, marks: np.ndarray) -> None:
        self.rows.append((*row, len(pairs)))
        self.links.append((pairs, marks))
        self.steps += len(pairs)

    def batch(self) -> pa.RecordBatch:
        key, doc_id, piece, pieces, n_a, n_b, steps = map(list, zip(*self.rows))
        pairs, marks = (np.concatenate(x) for x in zip(*self.links))
        at, known = pd.factorize(pairs)
        # rows that hold a pair: once a piece
        row = np.repeat(np.arange(len(steps)), steps)
        held = row * len(known) + at
        held.sort()
        held = held[np.concatenate([[True], held[1:] != held[:-1]])] if len(held) else held
        row, place = np.divmod(held, max(len(known), 1))
        if self.parted:  # a text's pieces may hold the same pair: told apart by its key
            key_of, count = np.array(key)[row].tolist(), np.ones(len(row), np.int64)
        else:
            n = np.bincount(place, minlength=len(known))
            place = np.arange(len(known))
            key_of, count = [None] * len(known), n
        blob = zstandard.ZstdCompressor(level=3).compress((at.astype(np.uint32) << np.uint32(2) | marks).view(np.uint8).reshape(-1, 4).T.tobytes())
        none = lambda k: [None] * k
        k, m = len(steps), len(place)
        cols = {
            "block": [self.number] * (k + m + 1),
            "parted": [self.parted] * (k + m + 1),
            "key": key + key_of + none(1),
            "doc_id": doc_id + none(m + 1),
            "piece": piece + none(m + 1),
            "pieces": pieces + none(m + 1),
            "n_a": n_a + none(m + 1),
            "n_b": n_b + none(m + 1),
            "steps": steps + none(m + 1),
            "at": none(k) + place.tolist() + none(1),
            "a": none(k) + (known[place] >> np.uint64(32)).tolist() + none(1),
            "b": none(k) + (known[place] & np.uint64(0xFFFFFFFF)).tolist() + none(1),
            "n": none(k) + count.tolist() + none(1),
            "links": none(k + m) + [blob],
        }
        return pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) for f in _FIELDS], schema=_FIELDS)


def _blocks(json, model, pattern: str, piece: int, block: int):
    @vocabularies.uncollected
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = _texts(json.value, pattern, model.value)
        task = TaskContext.get().partitionId() << 36
        made, docs, out = 2, 0, [_Block(task, False), _Block(task + 1, True)]
        for batch in batches:
            data, off = V.raw(batch.column(1))
            ids = batch.column(0).to_pylist()
            for i, j in V.blocks(off):
                for d, (a, b, end_a, end_b) in zip(range(i, j), texts.ids([data[off[d] : off[d + 1]].tobytes() for d in range(i, j)])):
                    at_a, at_b = diagonals(end_a, end_b, piece) if len(a) + len(b) > piece else (np.array([0, len(a)]), np.array([0, len(b)]))
                    for p in range(len(at_a) - 1):
                        a0, a1, b0, b1 = at_a[p], at_a[p + 1], at_b[p], at_b[p + 1]
                        row = (task + docs, ids[d], p, len(at_a) - 1, int(a1 - a0), int(b1 - b0))
                        x = out[len(at_a) > 2]
                        x.add(row, *_piece(a[a0 : a1 + 1], b[b0 : b1 + 1], end_a[a0 : a1 + 1], end_b[b0 : b1 + 1], end_a[a0 - 1] if a0 else 0, end_b[b0 - 1] if b0 else 0, a1 - a0, b1 - b0))
                        if x.steps >= block:
                            yield x.batch()
                            out[x.parted] = _Block(task + made, x.parted)
                            made += 1
                    docs += 1
        for x in out:
            if x.rows:
                yield x.batch()

    return work


def _piece(a, b, end_a, end_b, from_a, from_b, own_a, own_b) -> tuple[np.ndarray, np.ndarray]:
    """The piece's id pairs in order, and where A and where B begin."""
    if not own_a + own_b:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    ends, i, j = overlaps(end_a, end_b)
    # steps of the piece: up to its own last end
    n = np.searchsorted(ends, max(end_a[own_a - 1] if own_a else 0, end_b[own_b - 1] if own_b else 0), "right")
    i, j = i[:n], j[:n]
    pairs = a[i].astype(np.uint64) << np.uint64(32) | b[j].astype(np.uint64)
    new_a = np.concatenate([[from_a >= from_b], i[1:] != i[:-1]])
    new_b = np.concatenate([[from_b >= from_a], j[1:] != j[:-1]])
    return pairs, new_a * _A | new_b * _B


@lru_cache(maxsize=4)
def _decimal(most: int) -> tuple[np.ndarray, np.ndarray]:
    """The decimal digits of 0 to most - 1, each in a row with room for a separator behind, and their number."""
    width = 1 + sum(((np.arange(most) >= 10**k).astype(np.int64) for k in range(1, len(str(most)))), np.zeros(most, np.int64))
    rows = np.zeros((most, len(str(most)) + 1), np.uint8)
    for k in range(len(str(most))):
        rows[:, k] = 48 + np.arange(most) // 10 ** np.maximum(width - 1 - k, 0) % 10
    return rows, width


def rendered(a: np.ndarray, b: np.ndarray, marks: np.ndarray, texts: np.ndarray) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3`` of each text: ids in order, groups parted by semicolons. ``texts``: steps of each."""
    new_a, new_b = (marks & _A) > 0, (marks & _B) > 0
    group = np.cumsum(new_a & new_b)
    ids = np.concatenate([a[new_a], b[new_b]])
    groups = np.concatenate([group[new_a], group[new_b]])
    side = np.repeat([0, 1], [int(new_a.sum()), int(new_b.sum())])
    order = np.argsort(groups * 2 + side, kind="stable")
    ids, groups, side = ids[order], groups[order], side[order]
    same = groups[1:] == groups[:-1]
    sep = np.concatenate([np.where(same, np.where(side[1:] == side[:-1], ord(","), ord("|")), ord(";")), [ord(";")]])[: len(ids)]
    digits, width = _decimal(1 << int(ids.max(initial=1)).bit_length())
    width = width[ids]
    out = digits[ids]
    out[np.arange(len(ids)), width] = sep
    out = out[np.arange(out.shape[1]) <= width[:, None]]
    ends = np.cumsum(width + 1)
    # bytes up to the end of each text: its tokens are all those that begin in its steps
    done = np.concatenate([[0], np.cumsum(new_a.astype(np.int64) + new_b)])[np.concatenate([[0], np.cumsum(texts)])]
    at = np.concatenate([[0], ends])[done]
    raw = out.tobytes()
    return [raw[s : max(e - 1, s)] for s, e in zip(at.tolist(), at[1:].tolist())]


_LONGS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
_WHOLE = pa.schema([("doc_id", pa.int64())] + [(c, pa.int64()) for c in _LONGS] + [("groups", pa.string())])
_PARTS = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32())] + [(c, pa.int64()) for c in _LONGS] + [("links", pa.binary())])
_TYPES = {pa.int64(): "bigint", pa.int32(): "int", pa.string(): "string", pa.binary(): "binary"}
_WHOLE_SCHEMA, _PARTS_SCHEMA = (", ".join(f"{f.name} {_TYPES[f.type]}" for f in s) for s in (_WHOLE, _PARTS))


def _finish(parted: bool):
    """A block's pieces with the counts of their pairs. Texts in one piece get their groups."""
    schema = _PARTS if parted else _WHOLE

    def work(block: pa.Table, counts: pa.Table) -> pa.Table:
        blob = next((x for x in block["links"].to_pylist() if x is not None), None)
        rows = block.filter(pc.is_valid(block["steps"]))
        if not rows.num_rows:
            return schema.empty_table()
        steps = rows["steps"].to_numpy()
        links = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()
        at, marks = (links >> np.uint32(2)).astype(np.int64), links & np.uint32(3)
        ends = np.concatenate([[0], np.cumsum(steps)])
        places, most = counts["at"].to_numpy(), int(at.max(initial=-1)) + 1

        def of_links(column: str, dtype) -> np.ndarray:
            table = np.zeros(most, dtype)
            table[places] = counts[column].to_numpy()
            return table[at]

        sums = lambda x: np.diff(np.concatenate([[0], np.cumsum(x, dtype=np.int64)])[ends])
        a, b = of_links("a", np.int32), of_links("b", np.int32)
        cols = {
            **{c: rows[c].combine_chunks() for c in ("key", "doc_id", "piece")},
            "n_a": rows["n_a"].cast(pa.int64()).combine_chunks(),
            "n_b": rows["n_b"].cast(pa.int64()).combine_chunks(),
            "n_groups": pa.array(sums(marks == 3)),
            "n_links": pa.array(steps.astype(np.int64)),
            "n_best": pa.array(sums(of_links("best", bool))),
            "count_sum": pa.array(sums(of_links("n", np.int64))),
        }
        if parted:
            both = np.stack([a, b, marks.astype(np.int32)], 1).astype("<u4")
            cols["links"] = pa.array([both[s:e].tobytes() for s, e in zip(ends, ends[1:])], pa.binary())
        else:
            cols["groups"] = pa.array(rendered(a, b, marks, steps), pa.binary()).cast(pa.string())
        return pa.Table.from_arrays([cols[f.name] for f in schema], schema=schema)

    return work


def _stitch(pieces: pa.Table) -> pa.Table:
    """One text's pieces in order, its groups drawn over their borders."""
    t = pieces.sort_by("piece")
    links = np.frombuffer(b"".join(t["links"].to_pylist()), "<u4").reshape(-1, 3)
    groups = rendered(links[:, 0], links[:, 1], links[:, 2], np.array([len(links)]))[0].decode()
    return pa.Table.from_pylist([{"doc_id": t["doc_id"][0].as_py(), "groups": groups} | {c: pc.sum(t[c]).as_py() for c in _LONGS}], schema=_WHOLE)


def align(docs: DataFrame, json: str, pattern: str, model: str, piece: int = PIECE, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Aligns A, a byte-level vocabulary of the tokenizers library (file ``json``, and the
    ``pattern`` by which the library splits texts for it), over space+text with
    B, a sentencepiece ``model`` that adds the space. Two tables: for each document doc_id, n_a, n_b,
    n_groups, n_links, n_best (links whose pair's count is the highest of its A id, ties too),
    count_sum (of the pairs' counts over the links) and groups; and for each id pair a, b, n
    (documents that hold it linked) and best."""
    spark = docs.sparkSession
    sent = [spark.sparkContext.broadcast(vocabularies.read(p)) for p in (json, model)]
    made = saved(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(_blocks(*sent, pattern, piece, block), _SCHEMA))
    held = made.filter("at is not null")
    once = held.filter("key is not null").select("key", "a", "b").distinct().select("a", "b", F.lit(1).cast("bigint").alias("n"))
    n = held.filter("key is null").select("a", "b", "n").unionByName(once).groupBy("a", "b").agg(F.sum("n").alias("n"))
    n = saved(n)
    most = n.groupBy("a").agg(F.max("n").alias("most"))
    counts = n.join(most, "a").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))
    of_block = held.select("block", "parted", "at", "a", "b").distinct().join(counts, ["a", "b"]).select(F.col("block").alias("of"), F.col("parted").alias("p"), "at", "a", "b", "n", "best")
    rest = made.filter("at is null").select("block", "parted", "key", "doc_id", "piece", "n_a", "n_b", "steps", "links")

    def finished(parted: bool, schema: str) -> DataFrame:
        x, y = rest.filter(F.col("parted") == parted), of_block.filter(F.col("p") == parted)
        return x.groupBy("block").cogroup(y.groupBy("of")).applyInArrow(_finish(parted), schema)

    parts = finished(True, _PARTS_SCHEMA).groupBy("key").applyInArrow(_stitch, _WHOLE_SCHEMA)
    return finished(False, _WHOLE_SCHEMA).unionByName(parts), counts
