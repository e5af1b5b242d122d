"""Byte-level BPE encoding and decoding as a monoid tree reduction.

A text is halved until a part is short; parts are encoded and neighbours joined up the tree.

* Text level: a part is split by the pattern. Joining re-splits from the first match of the
  left part that could see past its end (it touches the end, or starts in the last three
  characters: the longest lookahead of the pattern's alternatives) until a match begins where
  one of the right part begins; splitting is deterministic from there on.
* Piece level (long matches only): bytes are halved, the halves' tokens joined by re-encoding
  a window of the last k tokens of the left and the first k of the right, k doubling until
  the window's first and last token come out unchanged. Then nothing outside can change:
  tokens t1..tn are the encoding of their bytes if and only if every neighbouring pair is the
  encoding of its own bytes. (If: look at the first merge across a border ti|ti+1. Until
  then what happens inside ti ti+1 is what happens when the pair is encoded alone, so that
  run would merge across the border too. Only if: a run that never crosses the pair's outer
  borders is the pair's own run.) The window's pairs hold as it is an encoding, the outer
  ones hold as they stood before.

Decoding concatenates the tokens' bytes.
"""

from __future__ import annotations

import base64
import heapq
import sys
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PART, PIECE = 4096, 48
#: Matches in each of the two generations of a worker's cache: some 20 MB each.
CACHE = 100_000
#: Rows, and characters of text, encoded at a time, as far as a row allows.
ROWS, CHARS = 512, 1 << 22
NONE = 1 << 60


class Encoder:
    """Ranks from a file of ``base64 rank`` lines; see the module text."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.bytes_of = [b""] * (max(self.ranks.values()) + 1)
        for k, v in self.ranks.items():
            self.bytes_of[v] = k
        self.pattern = regex.compile(pattern)
        self.packed = _Packed(self)

    def split(self, text: str) -> list[str]:
        """The pattern's matches of the whole text."""
        return self._split(text, 0, len(text))

    def _split(self, text: str, lo: int, hi: int) -> list[str]:
        if hi - lo <= PART:
            return self.pattern.findall(text[lo:hi])
        mid = (lo + hi) // 2
        return self._join_parts(text, hi, self._split(text, lo, mid), mid, self._split(text, mid, hi))

    def _join_parts(self, text: str, hi: int, left: list[str], mid: int, right: list[str]) -> list[str]:
        at = mid
        while left and (at == mid or at - len(left[-1]) + 3 > mid):
            at -= len(left.pop())
        i, edge = 0, mid  # edge: where right[i] begins
        while at != edge or at < mid:
            m = self.pattern.match(text, at, hi)
            left.append(m[0])
            at = m.end()
            while edge < at:
                edge += len(right[i])
                i += 1
            if at == hi:
                break
        return left + right[i:]

    def tokens(self, piece: bytes) -> list[int]:
        """Token ids of one match."""
        if len(piece) <= PIECE:
            return self.merge(piece)
        mid = len(piece) // 2
        return self._join_tokens(self.tokens(piece[:mid]), self.tokens(piece[mid:]))

    def _join_tokens(self, a: list[int], b: list[int]) -> list[int]:
        k = 1
        while True:
            i, j = max(len(a) - k, 0), min(k, len(b))
            w = self.merge(b"".join([self.bytes_of[t] for t in a[i:]] + [self.bytes_of[t] for t in b[:j]]))
            if (i == 0 or w[0] == a[i]) and (j == len(b) or w[-1] == b[j - 1]):
                return a[:i] + w + b[j:]
            k *= 2

    def merge(self, piece: bytes) -> list[int]:
        """Merges of the lowest rank first, the leftmost of equals, until none is left."""
        ranks = self.ranks
        if (whole := ranks.get(piece)) is not None:
            return [whole]
        if len(piece) > 2 * PIECE:
            return self._merge_long(piece)
        get = ranks.get
        parts = [piece[i : i + 1] for i in range(len(piece))]
        pairs = [get(piece[i : i + 2], NONE) for i in range(len(piece) - 1)]
        while pairs and (best := min(pairs)) != NONE:
            i = pairs.index(best)
            whole = parts[i] + parts.pop(i + 1)
            parts[i] = whole
            del pairs[i]
            if i < len(pairs):
                pairs[i] = get(whole + parts[i + 1], NONE)
            if i:
                pairs[i - 1] = get(parts[i - 1] + whole, NONE)
        return [ranks[p] for p in parts]

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same with a heap over linked parts."""
        n, ranks = len(piece), self.ranks
        end, prev = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        dead = bytearray(n + 1)
        while heap:
            _, i, e = heapq.heappop(heap)
            mid = end[i]
            if dead[i] or mid >= n or end[mid] != e:
                continue
            end[i] = e
            dead[mid] = 1
            if e < n:
                prev[e] = i
                if (r := ranks.get(piece[i : end[e]])) is not None:
                    heapq.heappush(heap, (r, i, end[e]))
            if (p := prev[i]) >= 0 and (r := ranks.get(piece[p:e])) is not None:
                heapq.heappush(heap, (r, p, e))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : end[i]]])
            i = end[i]
        return out

    def encode(self, text: str) -> bytes:
        """Token ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.packed.__getitem__, self.split(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class _Packed(dict):
    """Packed ids by match, in two generations of ``CACHE`` at most: when the young one is full it
    becomes the old one, and what is asked for again comes back from there. So frequent
    matches stay; what is forgotten is encoded again."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder
        self.old: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        out = self.old.get(piece)
        if out is None:
            raw = piece.encode("utf-8", "surrogatepass")
            ids = array("I", self.encoder.tokens(raw))
            if sys.byteorder == "big":
                ids.byteswap()
            out = ids.tobytes()
            if len(raw) > 64:
                return out
        if len(self) >= CACHE:
            self.old = dict(self)
            self.clear()
        self[piece] = out
        return out


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = Encoder(path, pattern)
    return _ENCODERS[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str, payload: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The ``payload`` columns with n_tokens, ids (binary, four little-endian bytes a token) and
    decoded (the ids' bytes again), one row per row of ``docs``. Null text is empty: no
    tokens. Repeated rows and other columns make no difference. No shuffle."""
    payload = list(payload)
    d = docs.select(*payload, F.col("text").alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema.fields[:-1])
    names = [*payload, "n_tokens", "ids", "decoded"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pattern)
        for b in batches:
            size = np.cumsum(pc.fill_null(pc.utf8_length(b.column(len(payload))), 0).to_numpy(zero_copy_only=False)) // CHARS
            cuts = sorted({*range(0, b.num_rows, ROWS), *(np.flatnonzero(np.diff(size)) + 1).tolist()})
            for at, to in zip(cuts, [*cuts[1:], b.num_rows]):
                part = b.slice(at, to - at)
                ids = [enc.encode(t) if t else b"" for t in part.column(len(payload)).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns[: len(payload)],
                        pa.array([len(x) // 4 for x in ids], pa.int64()),
                        pa.array(ids, pa.binary()),
                        pa.array([enc.decode(x) for x in ids], pa.binary()),
                    ],
                    names=names,
                )

    return d.mapInArrow(work, f"{schema}, n_tokens bigint, ids binary, decoded binary")
