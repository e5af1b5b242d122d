"""Documents as token ids in seekable files: independent zstandard frames with a trailing seek table.

One file holds, in ascending order of ``doc_id`` (null last, then by text):

* one zstandard frame a document (its ids as little-endian unsigned 32-bit integers, the end id
  last), with the frame's own checksum,
* one skippable frame (magic 184D2A50) with the ids of the documents: their number as 4 bytes, 8 bytes
  each, then one byte each that is 1 where the id is null,
* the seek table of the public zstandard seekable format (skippable frame 184D2A5E): compressed size,
  size and the low 32 bits of the XXH64 of the contents for each frame before it, the number of
  frames, a flag byte, and the magic number 8F92EAB1 as the file's last four bytes.

Any zstandard reader reads such a file whole; :func:`read` and :func:`fetch` go by the table, check
every frame that they open, and open no others.

Rows are range-partitioned by (doc_id, a hash of the text, a random number), so neither a null id
nor a text that repeats is one task's; texts are shuffled once, then encoded and framed in one
pass that holds one file (``FILE_BYTES``, or one document) in memory. Files are written by Spark's
text writer, one record a file, its line separator being the format's last four bytes: tasks that
run twice commit once, on any store that Spark writes to. Files are numbered by (range partition,
number in it), which is the order of their documents.

Null texts are empty and have the end id only. Repeated rows are kept, each a frame of its own.
Ties of ``doc_id`` stand in order of the texts' hash. An empty table gives no file. Other columns are
left out, whatever their names. A text is one frame, so its ids must fit a Spark row (2 GB, some
500 million tokens); memory is some 20 bytes a byte of the longest text.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import vectors as V
from . import vocabularies

#: Compressed bytes after which a file is closed.
FILE_BYTES = 8 << 20
#: Files whose list is sent to every executor: some 60 bytes each.
FEW_FILES = 200_000
LEVEL = 3
#: Fixed values of the zstandard seekable format.
SKIP, TABLE, SEEKABLE, CHECKSUMS = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80
LAST = struct.pack("<I", SEEKABLE)
ENTRY = np.dtype([("packed", "<u4"), ("size", "<u4"), ("check", "<u4")])


def _check(ids: bytes) -> int:
    return xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF


class _File:
    """Frames of a file that is being filled."""

    def __init__(self):
        self.frames: list[bytes] = []
        self.entries: list[tuple[int, int, int]] = []
        self.ids: list[int | None] = []
        self.bytes = 0

    def add(self, doc_id: int | None, ids: bytes, frame: bytes) -> None:
        self.frames.append(frame)
        self.entries.append((len(frame), len(ids), _check(ids)))
        self.ids.append(doc_id)
        self.bytes += len(frame)

    def body(self) -> bytes:
        """All of the file but its last four bytes."""
        n = len(self.ids)
        docs = struct.pack("<I", n) + np.array([i or 0 for i in self.ids], "<i8").tobytes() + bytes(i is None for i in self.ids)
        docs = struct.pack("<II", SKIP, len(docs)) + docs
        table = np.array([*self.entries, (len(docs), 0, 0)], ENTRY).tobytes()
        foot = struct.pack("<IB", n + 1, CHECKSUMS)
        return b"".join([*self.frames, docs, struct.pack("<II", TABLE, len(table) + len(foot) + len(LAST)), table, foot])


def _pack(vocabulary, end_id: int, file_bytes: int):
    @vocabularies.uncollected
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = vocabularies.dropping(vocabulary.value)
        end = struct.pack("<I", end_id)
        press = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True).compress
        part, k, out = TaskContext.get().partitionId(), 0, _File()
        for batch in batches:
            data, off = V.raw(batch.column(1))
            ids = batch.column(0).to_pylist()
            for d, doc_id in enumerate(ids):
                tokens = encode(data[off[d] : off[d + 1]].tobytes()) + end
                out.add(doc_id, tokens, press(tokens))
                if out.bytes >= file_bytes:
                    yield _row(part, k, out)
                    k, out = k + 1, _File()
        if out.ids:
            yield _row(part, k, out)

    return work


def _row(part: int, k: int, f: _File) -> pa.RecordBatch:
    have = [i for i in f.ids if i is not None]
    row = {"shard": f"{part:08d}-{k:08d}", "n_docs": len(f.ids), "n_tokens": sum(e[1] for e in f.entries) // 4, "first": min(have, default=None), "last": max(have, default=None), "body": f.body()}
    return pa.RecordBatch.from_pylist([row], schema=pa.schema([("shard", pa.string())] + [(c, pa.int64()) for c in _NUMBERS] + [("body", pa.binary())]))


_NUMBERS = ("n_docs", "n_tokens", "first", "last")


def write(docs: DataFrame, folder: str, vocabulary: str, end_id: int, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes ``docs`` (doc_id, text) as files under ``folder`` and their list beside them, and returns
    the list: shard, n_docs, n_tokens, first and last doc_id (null where a file holds null ids only;
    all these also stand in the file's path), and start (ids in all files before). ``vocabulary`` is a
    file of the tokenizers library whose vocabulary drops white space; special tokens are not added."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(vocabularies.read(vocabulary))
    d = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("_t"), F.rand(11).alias("_r"))
    order = [F.col("doc_id").asc_nulls_last(), F.col("_t").asc(), F.col("_r").asc()]
    ranged = d.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    numbers = [f"{c} bigint" for c in _NUMBERS]
    files = ranged.mapInArrow(_pack(sent, end_id, file_bytes), f"shard string, {', '.join(numbers)}, body binary")
    w = files.select("shard", *_NUMBERS, F.col("body").cast("string").alias("value")).write.partitionBy("shard", *_NUMBERS)
    w.option("maxRecordsPerFile", 1).option("encoding", "ISO-8859-1").option("lineSep", LAST.decode("latin-1")).text(folder)
    number = lambda c: F.regexp_extract("path", f"/{c}=([0-9-]+)/", 1)
    listed = _found(spark, folder).select(number("shard").alias("shard"), *[F.nullif(number(c), F.lit("")).cast("bigint").alias(c) for c in _NUMBERS])
    listed = listed.withColumn("part", F.substring("shard", 1, 8))
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # one row a range partition goes through one task, one row a file through its partition's
    parts = listed.groupBy("part").agg(F.sum("n_tokens").alias("n")).withColumn("base", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    start = (F.col("base") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).cast("bigint")
    listed.join(parts.select("part", "base"), "part").select("shard", *_NUMBERS, start.alias("start")).write.parquet(f"{folder}/_list")
    return files_of(spark, folder)


def files_of(spark: SparkSession, folder: str) -> DataFrame:
    """The list that :func:`write` leaves, one row a file."""
    return spark.read.schema(f"shard string, {', '.join(f'{c} bigint' for c in _NUMBERS)}, start bigint").parquet(f"{folder}/_list")


def _found(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(paths)


def _files(spark: SparkSession, folder: str, shards: list[str] | None = None) -> DataFrame:
    f = _found(spark, folder if shards is None else [f"{folder}/shard={s}" for s in shards])
    return f.select(F.regexp_extract("path", "/shard=([0-9-]+)/", 1).alias("shard"), "content")


def _table(name: str, f: memoryview) -> tuple[np.ndarray, list[int | None]]:
    """The seek table's entries of the documents, and the documents' ids."""
    if bytes(f[-4:]) != LAST:
        raise ValueError(f"file {name} does not end with a seek table")
    n, flags = struct.unpack("<IB", f[-9:-4])
    at = len(f) - 9 - n * ENTRY.itemsize
    if at < 8 or flags != CHECKSUMS or struct.unpack("<II", f[at - 8 : at]) != (TABLE, len(f) - at):
        raise ValueError(f"file {name} has a broken seek table")
    entries = np.frombuffer(f[at : at + n * ENTRY.itemsize], ENTRY)
    docs = f[at - 8 - int(entries["packed"][-1]) : at - 8]
    if struct.unpack("<III", docs[:12]) != (SKIP, len(docs) - 8, n - 1):
        raise ValueError(f"file {name} has a broken list of documents")
    ids, null = np.frombuffer(docs[12 : 12 + 8 * (n - 1)], "<i8").tolist(), docs[12 + 8 * (n - 1) :]
    return entries[:-1], [None if z else i for i, z in zip(ids, null)]


_DOCS = "shard string, doc_id bigint, before bigint, n_tokens bigint, ids binary"
_SCHEMA = pa.schema([("shard", pa.string()), ("doc_id", pa.int64()), ("before", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


def _open(wanted: frozenset | None = None):
    """Documents of the files, all or those of the wanted ids; frames of others stay closed."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor().decompress
        for b in batches:
            for k in range(b.num_rows):
                name, f = b.column(0)[k].as_py(), memoryview(b.column(1)[k].as_buffer())
                entries, doc_ids = _table(name, f)
                ends, before = np.cumsum(entries["packed"].astype(np.int64)), np.cumsum(entries["size"].astype(np.int64)) // 4
                rows, size = [], 0
                for i, doc_id in enumerate(doc_ids):
                    if wanted is not None and doc_id not in wanted:
                        continue
                    ids = expand(f[ends[i] - entries["packed"][i] : ends[i]])
                    if len(ids) != entries["size"][i] or _check(ids) != entries["check"][i]:
                        raise ValueError(f"document {doc_id} in file {name} does not match its checksum")
                    rows.append({"shard": name, "doc_id": doc_id, "before": int(before[i]) - len(ids) // 4, "n_tokens": len(ids) // 4, "ids": ids})
                    size += len(ids)
                    if size > V.BLOCK or len(rows) == 4096:
                        yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)

    return work


def read(spark: SparkSession, folder: str, digest: Column | None = None) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ``digest`` (a column made of ``ids``,
    by default the ids) of every document in the files."""
    listed = files_of(spark, folder).select("shard", "start")
    if listed.count() <= FEW_FILES:
        listed = F.broadcast(listed)
    d = _files(spark, folder).mapInArrow(_open(), _DOCS).select("shard", "doc_id", "before", "n_tokens", F.col("ids") if digest is None else digest)
    return d.join(listed, "shard").withColumn("start", F.col("start") + F.col("before")).select("doc_id", "start", "n_tokens", d.columns[-1])


def fetch(spark: SparkSession, folder: str, doc_ids: list[int]) -> DataFrame:
    """doc_id, n_tokens and ids of the documents of a caller's list. Only files whose range of ids
    holds one of them are read, and only their frames are decompressed."""
    wanted = spark.createDataFrame([(i,) for i in set(doc_ids)], "id bigint")
    hit = files_of(spark, folder).join(wanted, F.col("id").between(F.col("first"), F.col("last")), "left_semi")
    shards = [r["shard"] for r in hit.select("shard").collect()]  # at most the files; bounded by their number
    if not shards:
        return spark.createDataFrame([], "doc_id bigint, n_tokens bigint, ids binary")
    return _files(spark, folder, shards).mapInArrow(_open(frozenset(doc_ids)), _DOCS).select("doc_id", "n_tokens", "ids")
