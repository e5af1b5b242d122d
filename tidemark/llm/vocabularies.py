"""Public tokenizers inside tasks: built once a worker from their files' bytes (sent as one broadcast,
bounded by the file), and asked for each distinct short piece of many texts only once.
"""

from __future__ import annotations

import gc
import os
import re
from collections.abc import Callable, Iterable
from functools import lru_cache
from json import loads
from typing import AnyStr

import numpy as np

#: Pieces of a generation that a worker keeps, and the longest of them: some 40 MB.
MOST, LONGEST = 1 << 18, 64


class Remembered(dict):
    """segment -> ids in little-endian bytes, asked of ``encode`` for a block of segments at once."""

    def __init__(self, encode: Callable[[list[bytes]], list[bytes]]):
        super().__init__()
        self.encode = encode

    def learn(self, segments: Iterable[bytes]) -> None:
        """Makes every segment of the block known; what earlier blocks left may go."""
        block = set(segments)
        if len(self) > MOST:
            self.clear()
        new = list(block.difference(self))
        self.update(zip(new, self.encode(new)))

    def forget(self, segments: Iterable[bytes]) -> None:
        """Drops the long ones."""
        for s in segments:
            if len(s) > LONGEST:
                self.pop(s, None)


def read(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def uncollected(work):
    """``work`` over batches without searches for reference cycles: it makes none, and the many small
    values that are kept would be walked again and again (a sixth of the time)."""

    def run(batches):
        gc.disable()
        try:
            yield from work(batches)
        finally:
            gc.enable()

    return run


def text_of(segment: bytes) -> str:
    return segment.decode("utf-8", "replace")


@lru_cache(maxsize=4)
def library(json: bytes, special: bool):
    """The tokenizers library's encoder of a vocabulary file; with ``special`` the strings of special
    tokens in a text are these tokens, else plain text."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(json.decode("utf-8"))
    t.encode_special_tokens = not special
    return t


class Direct:
    """Ids of whole texts, in little-endian bytes.

    Texts of plain characters (printable ASCII, white space, Latin letters that no normalization
    changes but for case) are split by the vocabulary's own pattern, and the library's model is asked for
    each distinct piece; a piece is kept until two generations of others came. Any other text is
    encoded by the library whole. ``before`` is put in front of every text."""

    def __init__(self, json: bytes, dtype: str, find, special: bool, lower: bool, before: bytes = b""):
        self.library, self.dtype, self.find, self.lower, self.before = library(json, special), dtype, find, lower, before
        self.model = self.library.model
        self.marks = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()] if special else []
        self.letters = {c: "".join(_SHOWN[b] for b in chr(c).encode()) for c in (*range(0x21), *range(0xC0, 0x180))}
        self.bytes_of = [np.array([i], dtype).tobytes() for i in range(self.library.get_vocab_size())]
        self.known = _Pieces(self._piece)

    def _piece(self, piece: str) -> bytes:
        if not piece.isascii():
            piece = (piece.lower() if self.lower else piece).translate(self.letters)
        elif not piece.isprintable():
            piece = piece.translate(self.letters)
        else:
            piece = piece.replace(" ", self.letters[32])
        of = self.bytes_of
        return b"".join([of[t.id] for t in self.model.tokenize(piece)])

    def _whole(self, data: bytes) -> bytes:
        return np.array(self.library.encode(text_of(data), add_special_tokens=False).ids, self.dtype).tobytes()

    def __call__(self, data: bytes) -> bytes:
        data = self.before + data
        if self.find is None or not plain(data) or any(m in data for m in self.marks):
            return self._whole(data)
        if self.lower:
            data = data.lower()  # the others in their pieces
        return b"".join(map(self.known.__getitem__, self.find(data.decode())))


class Dropping(Direct):
    """Of a vocabulary that drops white space: in a text that is not plain, words go one by one and one that
    was met before is only looked up, as no token and no normalization crosses ASCII white space, which is
    neither composed nor cased. Pieces are bytes here."""

    def __init__(self, json: bytes):
        super().__init__(json, "<u4", _dropping_pattern(loads(json)), True, True)
        self.words = _Pieces(self._word)

    def _piece(self, piece: bytes) -> bytes:
        return super()._piece(piece.decode())

    def _word(self, data: bytes) -> bytes:
        return b"".join(map(self.known.__getitem__, self.find(data.lower()))) if plain(data) else self._whole(data)

    def __call__(self, data: bytes) -> bytes:
        if self.find is None or any(m in data for m in self.marks):
            return self._whole(data)
        return self._word(data) if plain(data) else b"".join(map(self.words.__getitem__, data.split()))


def plain(data: bytes) -> bool:
    """Printable ASCII, white space and U+00C0 to U+017F but U+0130, whose lower case has two characters."""
    return not data.translate(None, _PLAIN) and b"\xc4\xb0" not in data


_PLAIN = bytes([*range(9, 14), *range(0x20, 0x7F), *range(0x80, 0xC0), 0xC3, 0xC4, 0xC5])


class _Pieces(dict):
    """piece or word -> ids; what two generations of others have not asked for goes."""

    def __init__(self, make: Callable[[AnyStr], bytes]):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, piece: AnyStr) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self.make(piece)
        if len(piece) <= LONGEST:
            if len(self) >= MOST:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids


def plain_pattern(pattern: str):
    """All matches of a pattern with classes of letters and numbers, in plain text."""
    some = [chr(c) for c in (*range(0x21, 0x7F), *range(0xC0, 0x180))]
    for name, holds in {"\\p{L}": str.isalpha, "\\p{N}": str.isdigit}.items():
        inside = "".join(re.escape(c) for c in some if holds(c))
        pattern = re.sub(r"(\[[^]]*\])|" + re.escape(name), lambda m, n=name, i=inside: m[1].replace(n, i) if m[1] else f"[{i}]", pattern)
    return None if "\\p" in pattern else re.compile(pattern).findall


def _dropping_pattern(spec: dict):
    """All matches of the vocabulary's splitting pattern in the bytes of a plain text, where its steps are
    those known here; else None, and the library does all."""
    normal, split = spec["normalizer"] or {}, spec["pre_tokenizer"] or {}
    steps = [n["type"] for n in normal.get("normalizers", [])]
    spaces = [n for n in normal.get("normalizers", []) if n["type"] == "Replace"]
    parts = split.get("pretokenizers", [])
    if steps != ["NFC", "Replace", "Lowercase"] or spaces[0]["pattern"] != {"Regex": "\\s+"} or spaces[0]["content"] != " ":
        return None
    if [p["type"] for p in parts] != ["Split", "ByteLevel"] or parts[1]["add_prefix_space"] or parts[1]["use_regex"]:
        return None
    pattern = parts[0]["pattern"].get("Regex")
    if pattern is None or parts[0]["behavior"] != "Removed" or not parts[0]["invert"]:
        return None
    found = plain_pattern(pattern)
    if found is None:
        return None
    by_pattern = lambda data: [p.encode() for p in found(data.decode())]
    return by_pattern if pattern != CONTRACTED else lambda data: by_pattern(data) if any(x in data for x in _NO_LETTERS) else contracted(data)


#: Contractions, runs of letters, single digits, runs of all others but white space.
CONTRACTED = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
#: The signs of multiplication and division: no letters, but spelled like them.
_NO_LETTERS = (b"\xc3\x97", b"\xc3\xb7")
_SPACE, _LETTER, _DIGIT, _OTHER = range(4)
_KIND = np.array([_SPACE if b == 32 or 9 <= b <= 13 else _LETTER if b >= 128 or chr(b).isalpha() else _DIGIT if chr(b).isdigit() else _OTHER for b in range(256)], np.uint8)
_ONE, _TWO = np.isin(np.arange(256), list(b"stmd")), (b"re", b"ve", b"ll")


def contracted(data: bytes) -> list[bytes]:
    """All matches of CONTRACTED in a plain text in lower case without _NO_LETTERS: the text is cut
    wherever a match ends."""
    b = np.frombuffer(data, np.uint8)
    kind = _KIND[b]
    ends = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)  # of a match, behind each byte but the last
    if b"'" in data:
        at = np.flatnonzero((b[:-1] == 39) & np.concatenate([[True], kind[:-1] != _OTHER])[:-1])
        one = _ONE[b[at + 1]]
        for q, n in [(at[one], 1)] + [(at[~one][[data.startswith(_TWO, q + 1) for q in at[~one].tolist()]], 2)]:
            ends[q] = False
            ends[(q + n)[q + n < len(ends)]] = True
    ends &= (kind[1:] != _SPACE) & (kind[:-1] != _SPACE)
    at = np.flatnonzero(ends)
    if not len(at):
        return data.split()
    out, use = np.full(len(b) + len(at), 32, np.uint8), np.ones(len(b) + len(at), bool)
    use[at + np.arange(1, len(at) + 1)] = False
    out[use] = b
    return out.tobytes().split()


def _shown() -> dict[int, str]:
    """How a byte-level vocabulary spells each byte: the printable ones of Latin-1 as themselves, the
    others, in order, from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_SHOWN = _shown()


@lru_cache(maxsize=4)
def dropping(json: bytes) -> Dropping:
    return Dropping(json)


@lru_cache(maxsize=4)
def spaced(json: bytes, pattern: str, dtype: str) -> Direct:
    """A byte-level vocabulary over space+text, special tokens' strings as plain text; ``pattern``: the one by
    which the library splits for it (checked on a few texts; if another, the library does all)."""
    d = Direct(json, dtype, plain_pattern(pattern), False, False, b" ")
    for t in ("a  b\t\n c", "it's 'll 12x! é--Ö \r\n", "  ", "x\n\ny  "):
        if d(t.encode()) != d._whole(b" " + t.encode()):
            d.find = None
    return d


@lru_cache(maxsize=4)
def _pieces(model: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model)


@lru_cache(maxsize=4)
def pieces(model: bytes, dtype: str) -> Remembered:
    """Segments as ids of a sentencepiece model, which puts the space before each itself; nothing where the
    ids do not spell it."""
    p = _pieces(model)
    spelled = model_bytes(model)
    bytes_of = [np.array([i], dtype).tobytes() for i in range(len(spelled))]

    def encode(segments: list[bytes]) -> list[bytes]:
        ids = p.encode([text_of(s) for s in segments], num_threads=1)
        return [b"".join([bytes_of[k] for k in i]) if b"".join([spelled[k] for k in i]) == b" " + s else b"" for s, i in zip(segments, ids)]

    return Remembered(encode)


def json_bytes(json: bytes) -> list[bytes]:
    """Bytes of every id of a byte-level vocabulary."""
    byte_of = {c: b for b, c in _SHOWN.items()}
    vocabulary = library(json, False).get_vocab(with_added_tokens=False)
    out = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        out[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else b""
    return out


def model_bytes(model: bytes) -> list[bytes]:
    """Bytes of every id of a sentencepiece model: U+2581 is a space, a byte piece its byte, a control
    or unknown piece nothing."""
    p = _pieces(model)
    out = []
    for i in range(p.get_piece_size()):
        piece = p.id_to_piece(i)
        if p.is_byte(i):
            out.append(bytes([int(piece[3:-1], 16)]))
        else:
            out.append(b"" if p.is_control(i) or p.is_unknown(i) else piece.replace("▁", " ").encode())
    return out
