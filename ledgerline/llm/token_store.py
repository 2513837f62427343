"""Operator 13: token ids in binary files with one shared zstandard dictionary.

A store is a folder: the dictionary, files of documents in ascending id order, and a manifest.

* **Dictionary.**  Trained on serialized id arrays of a bounded sample: a Bernoulli sample of about
  ``SAMPLE_DOCS`` documents is encoded, cut into arrays of at most ``SAMPLE_IDS`` ids, of which the
  ``SAMPLE_ARRAYS`` lowest by hash reach the driver (8 MB at most).  It affects sizes, never ids.
* **Files.**  ``header | frames | index | footer``.  The header holds the id width and the dictionary's
  SHA-256; each document is a zstandard frame of its own; the index holds every document's id, the end of its frame and
  its number of ids; the footer says where the index begins and has its checksum.  One document can so be read by
  itself: footer, index, one frame.  A file is closed at ``FILE_BYTES`` and a new one begun.
* **Order.**  Documents are encoded and compressed once, written to the checkpoint folder, then dealt out by
  a range sort on (id, hash): a hot id is split, and each task writes its range as a stream of frames.
* **Lost executors.**  A task names its files anew at each attempt; only those that Spark's committed
  manifest lists belong to the store, so a failed or repeated attempt leaves nothing but unlisted files.

Files are written and read through Arrow's file systems (file, hdfs, s3, gs) by the path that the cluster's
checkpoint folder or the caller names; it must be shared.

Odd rows: NULL and empty texts are the end id alone.  NULL ids come last, repeated ids next to each other in
an order that is fixed by their content.  An empty table gives an empty store, which reads as an empty table."""

from __future__ import annotations

import hashlib
import posixpath
import struct
import uuid
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.library_ids import id_width, library_ids
from ledgerline.llm.text import blocks, text_bytes
from ledgerline.session import ensure_checkpoint_dir, freeze

SAMPLE_DOCS, SAMPLE_IDS, SAMPLE_ARRAYS = 4000, 2048, 2000
DICTIONARY_BYTES, LEVEL = 64 << 10, 3
FILE_BYTES = 256 << 20
#: Texts that are encoded at a time, in bytes and rows: a word that they repeat is encoded once.
BLOCK_BYTES, BLOCK_ROWS = 16 << 20, 10_000
#: Bytes of frames that a reader takes at a time.
READ_BYTES = 1 << 20
MAGIC = b"IDSTORE1"
HEADER, FOOTER = struct.Struct("<8sB7x32s"), struct.Struct("<QQI4x8s")
_MANIFEST = "shard int, part int, file string, docs bigint, ids bigint, first bigint, last bigint, width int, dictionary string"


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """Arrow's file system of a path or URI, and the path inside it."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


def train(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary for such arrays; where there are too few to train on, their own bytes."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-size:].ljust(8, b"\0")


@lru_cache(maxsize=2)
def dictionary(root: str, sha: str) -> zstandard.ZstdCompressionDict:
    """The store's dictionary, checked against its hash (one per worker)."""
    system, at = file_system(root)
    with system.open_input_file(posixpath.join(at, f"dictionary-{sha}.zdict")) as f:
        data = f.read()
    if hashlib.sha256(data).hexdigest() != sha:
        raise ValueError("the store's dictionary does not have the hash that its files name")
    return zstandard.ZstdCompressionDict(data)


class FileWriter:
    """One file of a store."""

    def __init__(self, root: str, name: str, width: int, sha: str):
        system, at = file_system(root)
        self.name, self.out = name, system.open_output_stream(posixpath.join(at, name))
        self.out.write(HEADER.pack(MAGIC, width, bytes.fromhex(sha)))
        self.ids, self.known, self.ends, self.sizes, self.at = [], [], [], [], HEADER.size

    def add(self, doc_id: int | None, n: int, frame: bytes) -> None:
        self.out.write(frame)
        self.at += len(frame)
        self.ids.append(0 if doc_id is None else doc_id)
        self.known.append(doc_id is not None)
        self.ends.append(self.at)
        self.sizes.append(n)

    def close(self) -> dict:
        index = b"".join(np.array(x, kind).tobytes() for x, kind in (
            (self.ids, "<i8"), (self.ends, "<u8"), (self.sizes, "<u8"), (self.known, "u1")))
        self.out.write(index + FOOTER.pack(self.at, len(self.ids), zlib.crc32(index), MAGIC))
        self.out.close()
        there = [i for i, k in zip(self.ids, self.known) if k]
        return {"file": self.name, "docs": len(self.ids), "ids": sum(self.sizes), "first": min(there, default=None),
                "last": max(there, default=None)}


class FileReader:
    """One file of a store: its index, and frames by position."""

    def __init__(self, root: str, name: str):
        system, at = file_system(root)
        self.file = system.open_input_file(posixpath.join(at, name))
        magic, self.width, sha = HEADER.unpack(self.file.read_at(HEADER.size, 0))
        size = self.file.size()
        begin, n, crc, end_magic = FOOTER.unpack(self.file.read_at(FOOTER.size, size - FOOTER.size))
        index = self.file.read_at(max(0, size - FOOTER.size - begin), begin)
        if magic != MAGIC or end_magic != MAGIC or len(index) != 25 * n or zlib.crc32(index) != crc:
            raise ValueError(f"{name} is not a whole file of a token store")
        self.ids, self.ends, self.sizes = (np.frombuffer(index, k, n, 8 * n * i) for i, k in enumerate(("<i8", "<u8", "<u8")))
        self.known = np.frombuffer(index, "u1", n, 24 * n).astype(bool)
        self.starts = np.concatenate([[HEADER.size], self.ends[:-1]]).astype(np.int64) if n else self.ends
        self.decompress = zstandard.ZstdDecompressor(dict_data=dictionary(root, sha.hex())).decompress

    def arrays(self, first: int, last: int) -> list[bytes]:
        """The ids of documents ``first`` to ``last - 1``, 4 bytes each."""
        at = int(self.starts[first])
        data = self.file.read_at(int(self.ends[last - 1]) - at, at)
        frames = [data[int(self.starts[i]) - at:int(self.ends[i]) - at] for i in range(first, last)]
        return [np.frombuffer(self.decompress(f), f"<u{self.width}").astype("<u4").tobytes() for f in frames]

    def steps(self, size: int = READ_BYTES):
        """Neighbouring documents, as (first, last), of about so many bytes of frames."""
        first = 0
        while first < len(self.ids):
            last = max(first + 1, int(np.searchsorted(self.ends, self.starts[first] + size, "right")))
            yield first, min(last, first + 5000)
            first = min(last, first + 5000)


def write_tokens(df: DataFrame, vocabulary: str, path: str | None = None, id_col: str = "doc_id",
                 text_col: str = "text", end_id: int = 2, file_bytes: int = FILE_BYTES) -> str:
    """Write the ids of every row's text, ``end_id`` behind them, to a new store; returns its path."""
    spark = df.sparkSession
    path = path or f"{ensure_checkpoint_dir(spark).rstrip('/')}/ledgerline-tokens-{uuid.uuid4().hex}"
    width = id_width(vocabulary)
    end = end_id.to_bytes(width, "little")
    held = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))

    def arrays(batches):
        """(ids of the rows, their serialized id arrays)"""
        encode = library_ids(vocabulary)
        for b in blocks(batches, BLOCK_BYTES, BLOCK_ROWS):
            yield b.column(0), [x + end for x in encode([t.decode("utf-8", "replace") for t in text_bytes(b.column(1))])]

    def sample(batches):
        step = SAMPLE_IDS * width
        for _, data in arrays(batches):
            yield pa.RecordBatch.from_pydict({"data": pa.array([x[i:i + step] for x in data for i in range(0, len(x), step)], pa.binary())})
    share = min(1.0, SAMPLE_DOCS / max(1, df.count()))
    samples = [bytes(r.data) for r in held.sample(share, 13).mapInArrow(sample, "data binary")
               .orderBy(F.xxhash64("data")).limit(SAMPLE_ARRAYS).collect()]
    trained = train(samples)
    sha = hashlib.sha256(trained).hexdigest()
    system, at = file_system(path)
    system.create_dir(at, recursive=True)
    with system.open_output_stream(posixpath.join(at, f"dictionary-{sha}.zdict")) as f:
        f.write(trained)

    def compress(batches):
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary(path, sha))
        for ids, data in arrays(batches):
            yield pa.RecordBatch.from_pydict({"doc_id": ids, "n": pa.array([len(x) // width for x in data], pa.int64()),
                                              "frame": pa.array([compressor.compress(x) for x in data], pa.binary())})

    def write(batches):
        shard, part, file = TaskContext.get().partitionId(), 0, None

        def listed():
            return pa.RecordBatch.from_pylist([{**file.close(), "shard": shard, "part": part, "width": width, "dictionary": sha}], schema=manifest)
        for b in batches:
            for i in range(b.num_rows):
                if file is None:
                    file = FileWriter(path, f"ids-{shard:06d}-{part:04d}-{uuid.uuid4().hex}.bin", width, sha)
                file.add(b.column(0)[i].as_py(), b.column(1)[i].as_py(), b.column(2)[i].as_py())
                if file.at >= file_bytes:
                    yield listed()
                    part, file = part + 1, None
        if file:
            yield listed()
    manifest = pa.schema([("shard", pa.int32()), ("part", pa.int32()), ("file", pa.string()), ("docs", pa.int64()), ("ids", pa.int64()),
                          ("first", pa.int64()), ("last", pa.int64()), ("width", pa.int32()), ("dictionary", pa.string())])
    frames = freeze(held.mapInArrow(compress, "doc_id bigint, n bigint, frame binary"), "frames")
    ordered = frames.orderBy(F.col("doc_id").asc_nulls_last(), F.xxhash64("frame"))
    ordered.mapInArrow(write, _MANIFEST).write.parquet(f"{path}/manifest")
    return path


def manifest_of(spark: SparkSession, path: str) -> DataFrame:
    """One row per file, with ``start``: the ids of all files before it."""
    before = Window.orderBy("shard", "part").rowsBetween(Window.unboundedPreceding, -1)
    return spark.read.parquet(f"{path}/manifest").withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document of a store: ``start`` is the ids of all documents
    before it, ``ids`` are unsigned little-endian 32-bit numbers.  One file is one task's work."""
    def task(batches):
        for b in batches:
            for name, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                file = FileReader(path, name)
                sizes = file.sizes.astype(np.int64)
                starts = start + np.cumsum(sizes) - sizes
                for first, last in file.steps():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(file.ids[first:last], pa.int64(), mask=~file.known[first:last]), pa.array(starts[first:last]),
                         pa.array(sizes[first:last]), pa.array(file.arrays(first, last), pa.binary())],
                        ["doc_id", "start", "n_tokens", "ids"])
    files = freeze(manifest_of(spark, path).select("file", "start"), "files")
    return files.repartition(max(1, files.count())).mapInArrow(task, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def fetch_documents(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """``doc_id, n_tokens, ids`` (array) of a few documents: of each file whose id range holds one, the index and
    the wanted frames are read, nothing else.  Ids that the store doesn't hold have no row."""
    wanted = sorted(set(doc_ids))

    def task(batches):
        for b in batches:
            for name in b.column(0).to_pylist():
                file = FileReader(path, name)
                for i in np.flatnonzero(np.isin(file.ids, wanted) & file.known).tolist():
                    ids = np.frombuffer(file.arrays(i, i + 1)[0], "<u4").astype(np.int32)
                    yield pa.RecordBatch.from_pydict({"doc_id": pa.array([int(file.ids[i])], pa.int64()), "n_tokens": pa.array([len(ids)], pa.int64()),
                                                      "ids": pa.array([ids], pa.list_(pa.int32()))})
    files = spark.read.parquet(f"{path}/manifest")
    asked = F.exists(F.array([F.lit(i).cast("bigint") for i in wanted]), lambda i: i.between(F.col("first"), F.col("last")))
    return files.filter(asked).select("file").mapInArrow(task, "doc_id bigint, n_tokens bigint, ids array<int>")
