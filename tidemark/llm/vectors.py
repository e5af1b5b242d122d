"""Whole Arrow batches of texts as byte arrays: words, lines and their 64-bit fingerprints
computed for all bytes of a block at once with numpy.

The fingerprint of a byte string s0..sk is a polynomial in an odd base modulo 2^64, made
position independent with the base's inverse and then mixed. It serves to find equal strings;
operators confirm links on the strings themselves where their contract asks for it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
BASE2 = np.uint64(0xC2B2AE3D27D4EB4F | 1)
BLOCK = 1 << 20
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, base: np.uint64 = BASE) -> tuple[np.ndarray, np.ndarray]:
    """base^0..base^n and the inverses, modulo 2^64."""
    have = _POWERS.get(int(base))
    if have is None or len(have[0]) <= n:
        size = max(n + 1, BLOCK + 4096)
        inv = pow(int(base), -1, 1 << 64)
        out = []
        for b in (int(base), inv):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            np.multiply.accumulate(p, out=p)
            out.append(p)
        have = _POWERS[int(base)] = (out[0], out[1])
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (shifts and odd multiplications)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def raw(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary array; null as empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type):
        arr = arr.cast(pa.binary())
    if arr.null_count:
        arr = arr.cast(pa.binary()).fill_null(b"")
    _, offsets, data = arr.buffers()
    off = np.frombuffer(offsets, np.int32)[arr.offset : arr.offset + len(arr) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), off


def blocks(off: np.ndarray, size: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``size`` bytes together; a longer text is a range of its own."""
    i, n = 0, len(off) - 1
    while i < n:
        j = int(np.searchsorted(off, off[i] + size, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def lower(b: np.ndarray) -> np.ndarray:
    """A-Z in lower case."""
    return b + (((b >= 65) & (b <= 90)).astype(np.uint8) << 5)


def is_space(b: np.ndarray) -> np.ndarray:
    return (b == 32) | ((b >= 9) & (b <= 13))


def runs(inside: np.ndarray, starts_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True, cut at the positions ``starts_at``."""
    n = len(inside)
    before = np.empty(n, bool)
    before[:1] = False
    before[1:] = inside[:-1]
    cut = starts_at[starts_at < n]
    before[cut] = False
    after = np.empty(n, bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    after[cut[cut > 0] - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def prefix(b: np.ndarray, base: np.uint64 = BASE) -> np.ndarray:
    """P[i]: sum of (b[j] + 1) * base^j over j < i, modulo 2^64."""
    p = np.empty(len(b) + 1, np.uint64)
    p[0] = 0
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * powers(len(b), base)[0][: len(b)], out=p[1:])
    return p


def spans_hash(p: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: np.uint64 = BASE) -> np.ndarray:
    return mix((p[ends] - p[starts]) * powers(len(p), base)[1][starts])
