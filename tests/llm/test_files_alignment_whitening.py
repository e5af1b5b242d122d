"""Token files, alignment and whitening against plain Python versions, with hard rows and planted damage."""

import bisect
import collections
import glob
import math
import random
import tempfile
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import alignment, common, token_files, vocabularies, whitening

SF = "/root/testdata/sf0.001"
WORDS, JSON, MODEL = (public_tokenizers.path(p) for p in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))
PATTERN = public_tokenizers.PATTERN
HARD = [
    (9001, None), (9002, ""), (9003, " "), (9004, "  a  b \n\t c"), (9005, "é日本語 ﬁx ①▁x y z\u0085q\x1cw"), (9006, "<|endoftext|> <s> hi<|startoftext|>x"),
    (9007, "a" * 3000), (9007, "a" * 3000), (None, "x y"), (None, None), (9008, " a   b 'll don't  's ΣΑΣ ς İi é"), (9009, "abc \r\n\r\n  def " * 200),
]


@pytest.fixture(scope="module")
def docs(spark):
    base = common.documents(spark, SF).select("doc_id", "text").limit(60)
    out = base.unionByName(spark.createDataFrame(HARD, "doc_id bigint, text string"))
    for clash in ("block", "key", "shard", "ids", "part", "n", "a", "_t", "start"):
        out = out.withColumn(clash, F.lit("clash"))
    return common.saved(out)


@pytest.fixture(scope="module")
def rows(docs):
    return [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]


def long_text(n):
    rng = random.Random(3)
    return " ".join("".join(rng.choices("abcdefghié", k=rng.randint(1, 9))) for _ in range(n // 6))


# token files


def word_ids(text):
    return Tokenizer.from_file(WORDS).encode(text, add_special_tokens=False).ids


def plain_files(rows):
    tok = Tokenizer.from_file(WORDS)
    ids = [(d, np.array(tok.encode(t, add_special_tokens=False).ids + [1], "<u4").tobytes()) for d, t in rows]
    return sorted(ids, key=lambda x: (x[0] is None, x[0] or 0))


def test_token_files(spark, docs, rows):
    folder = tempfile.mkdtemp(prefix="run-") + "/files"
    listed = token_files.write(docs, folder, WORDS, 1, 1 << 14).orderBy("shard").collect()
    got = token_files.read(spark, folder).orderBy("start").collect()
    want = plain_files(rows)
    assert [r["doc_id"] for r in got] == [d for d, _ in want]
    assert collections.Counter((r["doc_id"], bytes(r["ids"])) for r in got) == collections.Counter(want)
    at = 0
    for r in got:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"]) // 4
        at += r["n_tokens"]
    assert len(listed) > 5 and sum(r["n_docs"] for r in listed) == len(rows) and sum(r["n_tokens"] for r in listed) == at
    # any zstandard reader reads the files in order
    whole = b""
    for f in sorted(glob.glob(f"{folder}/shard=*/**/part-*", recursive=True)):
        with open(f, "rb") as h:
            whole += _frames(h.read())
    assert whole == b"".join(bytes(r["ids"]) for r in got)


def _frames(data):
    out, d = b"", zstandard.ZstdDecompressor()
    while data:
        if data[:4][1:] == b"\x2a\x4d\x18":  # skippable
            data = data[8 + int.from_bytes(data[4:8], "little") :]
            continue
        o = d.decompressobj()
        out += o.decompress(data)
        data = o.unused_data
    return out


def test_words_are_cut_and_asked_for_once(monkeypatch):
    """Plain texts are cut into pieces without the pattern, and a repeated word that is not plain is encoded once."""
    encode, rng = vocabularies.Dropping(vocabularies.read(WORDS)), random.Random(5)
    found = vocabularies.plain_pattern(vocabularies.CONTRACTED)
    for n in range(3000):
        text = "".join(rng.choices("'''strevlmdzSTz9 0,-\n\t\x0bñſŉĸ_×÷", k=n % 17))
        if not {"×", "÷"} & set(text):
            assert vocabularies.contracted(text.lower().encode()) == [p.encode() for p in found(text.lower())], text
        assert encode(text.encode()) == np.array(word_ids_of(text), "<u4").tobytes(), text
    asked, whole = [], encode._whole
    monkeypatch.setattr(encode, "_whole", lambda data: asked.append(data) or whole(data))
    text = "日本 дом, it's ﬁx дом, 日本 \u0301x дом, " * 50
    assert encode(text.encode()) == np.array(word_ids_of(text), "<u4").tobytes()
    assert sorted(asked) == sorted({w.encode() for w in "日本 дом, ﬁx \u0301x".split()})


def word_ids_of(text, tok=Tokenizer.from_file(WORDS)):
    return tok.encode(text, add_special_tokens=False).ids


def test_fetch_opens_only_what_is_asked_for(spark, docs):
    folder = tempfile.mkdtemp(prefix="run-") + "/files"
    token_files.write(docs, folder, WORDS, 1, 1 << 14)
    ids = sorted(r["doc_id"] for r in docs.filter("doc_id < 9000").select("doc_id").collect())
    # damage the frame of the file's first document: others are read, this one is refused
    path = sorted(glob.glob(f"{folder}/shard=*/**/part-*", recursive=True))[0]
    data = bytearray(open(path, "rb").read())
    data[12] ^= 0xFF
    with open(path, "wb") as f:
        f.write(data)
    import os

    crc = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")
    if os.path.exists(crc):
        os.unlink(crc)
    got = token_files.fetch(spark, folder, [ids[1], ids[-1], 9007, 77777]).collect()
    assert sorted(r["doc_id"] for r in got) == [ids[1], ids[-1], 9007, 9007]
    text = docs.filter(F.col("doc_id") == ids[1]).first()["text"]
    assert next(np.frombuffer(r["ids"], "<u4").tolist() for r in got if r["doc_id"] == ids[1]) == [*word_ids(text), 1]
    with pytest.raises(Exception, match="checksum|decompress|zstd"):
        token_files.fetch(spark, folder, [ids[0]]).collect()
    assert token_files.fetch(spark, folder, [77777]).count() == 0


def test_token_files_of_nothing_and_of_a_very_long_text(spark):
    folder = tempfile.mkdtemp(prefix="run-")
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert token_files.write(empty, folder + "/none", WORDS, 1).count() == 0
    assert token_files.read(spark, folder + "/none").count() == 0
    text = long_text(3 << 20)
    token_files.write(spark.createDataFrame([(2, text), (1, "x")], "doc_id bigint, text string"), folder + "/long", WORDS, 1)
    got = token_files.read(spark, folder + "/long", F.crc32("ids").alias("c")).orderBy("start").collect()
    assert [tuple(r) for r in got][1] == (2, 2, len(i := [*word_ids(text), 1]), zlib.crc32(np.array(i, "<u4").tobytes()))


SOME = st.lists(st.sampled_from([*"ab's .\n\t\r\x0b\x0c\x1c", " ", " ", "é", "é", "́", "日", " ", " ", "\u0085", "Σ", "1", "①", "ﬁ", "▁", "<|endoftext|>", "<|startoftext|>", "'ll", "İ", "​"]), max_size=40).map("".join)
TOK = {p: Tokenizer.from_file(p) for p in (WORDS, JSON)}
TOK[JSON].encode_special_tokens = True
SP = sentencepiece.SentencePieceProcessor(model_file=MODEL)


PLAIN = st.text(st.sampled_from([*map(chr, (*range(9, 14), *range(32, 127), *range(0xC0, 0x180)))]), max_size=60)


@settings(max_examples=600, deadline=None)
@given(st.one_of(SOME, PLAIN, st.text(max_size=30)))
def test_segments_encode_as_the_whole_text_does(text):
    ids = vocabularies.dropping(vocabularies.read(WORDS))(text.encode())
    assert np.frombuffer(ids, "<u4").tolist() == TOK[WORDS].encode(text, add_special_tokens=False).ids
    a, b, *_ = next(alignment._texts(vocabularies.read(JSON), PATTERN, vocabularies.read(MODEL)).ids([text.encode()]))
    if len(a):
        assert a.tolist() == TOK[JSON].encode(" " + text, add_special_tokens=False).ids and b.tolist() == SP.encode(text)
    else:  # only where the tokens do not spell the text
        assert not text or "▁" in text


# alignment


def plain_alignment(rows):
    spelled = vocabularies.json_bytes(vocabularies.read(JSON)), vocabularies.model_bytes(vocabularies.read(MODEL))
    docs, count = [], collections.Counter()
    for d, t in rows:
        a = TOK[JSON].encode(" " + t, add_special_tokens=False).ids if t else []
        b = SP.encode(t) if t else []
        if any(b"".join(s[i] for i in x) != b" " + t.encode() for s, x in zip(spelled, (a, b))):
            a, b = [], []
        spans = []
        for s, x in zip(spelled, (a, b)):
            ends = np.cumsum([0] + [len(s[i]) for i in x]).tolist()
            spans.append(list(zip(ends, ends[1:])))
        links = _links(a, b, *spans)
        both = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups = [[[], []] for _ in both]
        for k, x in enumerate((a, b)):
            for i, (s, _) in zip(x, spans[k]):
                groups[bisect.bisect_right(both, s)][k].append(str(i))
        groups = ["|".join(map(",".join, g)) for g in groups]
        count.update(set(links))
        docs.append((d, len(a), len(b), len(both), links, ";".join(groups)))
    most = collections.Counter()
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    return [(d, na, nb, ng, len(li), sum(count[p] == most[p[0]] for p in li), sum(count[p] for p in li), g) for d, na, nb, ng, li, g in docs], count, most


def _links(a, b, sa, sb):
    out, j = [], 0
    for i, (s, e) in enumerate(sa):
        while sb[j][1] <= s:
            j += 1
        k = j
        while k < len(sb) and sb[k][0] < e:
            out.append((a[i], b[k]))
            k += 1
    return out


@pytest.mark.parametrize("piece,block", [(alignment.PIECE, alignment.BLOCK), (64, 1000), (7, 50)])
def test_alignment(spark, docs, rows, piece, block):
    want, count, most = plain_alignment(rows)
    got, pairs = alignment.align(docs, JSON, PATTERN, MODEL, piece, block)
    cols = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    got = collections.Counter(tuple(r) for r in got.select(*cols).collect())
    assert got == collections.Counter(want)
    assert {(r["a"], r["b"]): (r["n"], r["best"]) for r in pairs.collect()} == {p: (n, n == most[p[0]]) for p, n in count.items()}


def test_alignment_of_nothing_and_of_a_very_long_text(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert alignment.align(empty, JSON, PATTERN, MODEL)[0].count() == 0
    text = long_text(2 << 20)
    want, _, _ = plain_alignment([(1, text)])
    got, _ = alignment.align(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), JSON, PATTERN, MODEL)
    r = got.first()
    assert tuple(r[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")) == want[0]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 6), min_size=1, max_size=60), st.integers(1, 9), st.randoms())
def test_pieces_are_equal_and_independent(sizes, step, rng):
    a = np.cumsum(sizes)
    b = np.array(sorted({int(a[-1]), *rng.sample(range(1, int(a[-1]) + 1), rng.randint(0, int(a[-1]) - 1))}))
    i, j = alignment.diagonals(a, b, step)
    work = np.diff(i) + np.diff(j)
    assert i[-1] == len(a) and j[-1] == len(b) and (work >= 0).all() and (work <= step + 1).all()
    for p, q in zip(i[1:-1], j[1:-1]):  # what lies before a border ends before what lies behind it
        assert max(a[p - 1] if p else 0, b[q - 1] if q else 0) < min(a[p] if p < len(a) else math.inf, b[q] if q < len(b) else math.inf)


# whitening


def plain_whitening(rows, most=16):
    x = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows]
    fit = np.array(sorted({tuple(v) for _, v in x}), object)
    n, total = len(fit), fit.sum(0)
    centre = (fit * n - total).astype(float) / n
    cov = centre.T @ centre / n
    values, z = np.linalg.eigh(cov)
    values, z = values[::-1][:most], z[:, ::-1][:, :most]
    out = {}
    for i, v in x:
        off = np.array(v, object) * n - total
        out[i] = (int((off * off).sum()), (off.astype(float) / n) @ z / np.sqrt(values))
    return n, values / np.trace(cov), out


@pytest.fixture(scope="module")
def vectors(spark):
    v = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding")
    some = v.first()["embedding"]
    nan, inf = [float("nan")] + some[1:], [float("-inf")] + some[1:]
    hard = [(9001, None), (9002, []), (9003, nan), (9004, inf), (9005, [None] + some[1:]), (9006, some), (9006, some), (None, some), (9007, some[:10])] + [(9100 + k, some) for k in range(300)]
    return v.unionByName(spark.createDataFrame(hard, "vec_id bigint, embedding array<float>")).withColumn("x", F.lit("clash")).withColumn("n", F.lit(1))


def test_whitening(spark, vectors):
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    ok = [(i, v) for i, v in rows if v and len(v) == 64 and None not in v and np.isfinite(v).all()]
    n, explained, want = plain_whitening(ok)
    got = whitening.whiten(vectors).collect()
    assert len(got) == 16 * len(ok) and {r["n"] for r in got} == {n}
    assert max(r["identity_error"] for r in got) < 1e-9
    assert collections.Counter(r["vec_id"] for r in got) == collections.Counter({i: 16 * m for i, m in collections.Counter(i for i, _ in ok).items()})
    sign = {}
    for r in got:
        dev, w = want[r["vec_id"]]
        c = r["component"]
        assert r["deviation"] == dev and abs(r["explained"] - explained[c - 1]) < 1e-9
        if abs(w[c - 1]) > 1e-3:
            sign.setdefault(c, math.copysign(1, w[c - 1] * r["whitened"]))
            assert abs(r["whitened"] - sign[c] * w[c - 1]) < 1e-7


def test_whitening_trees_of_triangles(spark, vectors, monkeypatch):
    monkeypatch.setattr(whitening, "STACK", 1)  # two triangles a task
    many = vectors.filter("size(embedding) = 64").repartition(11)
    assert max(r["identity_error"] for r in whitening.whiten(many).select("identity_error").distinct().collect()) < 1e-9


def test_whitening_of_little(spark):
    made = lambda rows: whitening.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")).collect()
    assert made([]) == [] and made([(1, None)]) == [] and made([(1, [0.5, 0.5]), (2, [0.5, 0.5])]) == []
    got = made([(1, [0.0, 0.0, 1.0]), (2, [1.0, 0.0, 1.0]), (3, [1e30, 0.0, 1.0])])  # far entries are cut, flat dimensions give nothing
    assert {r["component"] for r in got} == {1} and {r["n"] for r in got} == {3} and [r["deviation"] for r in got] == [None] * 3
    assert {round(r["explained"], 9) for r in got} == {1.0}


@pytest.mark.parametrize("d,kind", [(1, "free"), (2, "free"), (16, "free"), (130, "free"), (20, "equal"), (40, "close"), (40, "nearly"), (64, "flat")])
def test_bidiagonal_solver(d, kind):
    rng = np.random.default_rng(d)
    turn = np.linalg.qr(rng.standard_normal((d, d)))[0]
    x = {
        "free": lambda: rng.standard_normal((500, d)) * 10 ** rng.uniform(-2, 2, d),
        "equal": lambda: np.eye(d) * 5,
        "close": lambda: np.diag([1.0] * (d // 4) + [1 + 1e-9] * (d // 4) + [1e-5] * (d - d // 4 * 2)) @ turn,
        "nearly": lambda: np.diag(np.linspace(1, 1 + 1e-12, d)) @ turn,
        "flat": lambda: np.hstack([y := rng.standard_normal((500, d // 2)), 2 * y]),
    }[kind]()
    values, z = whitening.principal(whitening._triangle(x), d)
    ref = np.linalg.svd(x, compute_uv=False) ** 2
    ref = ref[ref > 1e-24 * ref[0]]
    assert len(values) == len(ref) and np.abs(values - ref).max() <= 1e-12 * ref[0]
    w = x @ z / np.sqrt(values)
    assert np.abs(z.T @ z - np.eye(len(ref))).max() < 1e-11 and np.abs(w.T @ w - np.eye(len(ref))).max() < 1e-8
