"""Token ids in sorted-string-table shards (operator 2).

A shard holds documents in ascending key order. File layout, integers little-endian unless said otherwise:

    blocks   entries of varint shared, varint rest, varint size, the last `rest` bytes of the key, then size bytes: the ids'
             width in bytes, 2 or 4, and the ids (unsigned); `shared` leading bytes are those of the entry before, 0 for the first of a block
    index    for each block: its first key, 8-byte offset, 4-byte size
    bloom    bits of all keys, 10 a key, 7 probes
    footer   8-byte offsets of index and bloom and end of bloom, documents, tokens, and the magic `MLLSST01`

A key is one byte (0: null doc_id, 1: other) and the doc_id as a big-endian 64-bit integer with its sign bit flipped. Shards
are written by tasks through pyarrow.fs into the shared folder, under a temporary name first, so a repeated task replaces its
own file; they are read through Spark's binaryFile source.

Defined cases: a null text is an empty one and holds just the end id; a null doc_id sorts first; repeated doc_ids are all kept,
in order of their texts; a document larger than a block or shard gets a block or shard of its own; extra columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import bytesops as B
from .scratch import pieces, scratch_path, stored, text_bytes
from .tokens import WordEncoder, default_vocabulary, with_end

END_ID = 1
BLOCK_BYTES = 64 << 10
SHARD_BYTES = 4 << 20
#: Text bytes of one range partition.
PART_BYTES = 16 << 20
MAGIC = b"MLLSST01"
FOOTER = struct.Struct("<QQQQQ8s")
BLOCK = struct.Struct("<9sQI")
SHARDS = "part int, shard int, file string, documents long, tokens long, first long, last long"


def key_of(doc_id: int | None) -> bytes:
    return b"\0" * 9 if doc_id is None else b"\1" + ((doc_id + (1 << 63)) & ((1 << 64) - 1)).to_bytes(8, "big")


def id_of(key: bytes) -> int | None:
    return None if key[0] == 0 else int.from_bytes(key[1:], "big") - (1 << 63)


def varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def read_varint(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        byte = data[at]
        n |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return n, at


def probes(key: bytes, bits: int) -> list[int]:
    a = zlib.crc32(key) | zlib.crc32(key, 0x5EED) << 32
    step = zlib.adler32(key) * 2 + 1
    return [(a + i * step) % bits for i in range(7)]


class ShardWriter:
    """Builds one shard in memory: entries in ascending key order."""

    def __init__(self):
        self.body, self.block, self.index, self.keys = bytearray(), bytearray(), [], []
        self.first = self.before = b""
        self.tokens = 0

    def add(self, key: bytes, ids: np.ndarray) -> None:
        self.tokens += len(ids)
        width = 2 if not len(ids) or ids.max() < 1 << 16 else 4
        ids = bytes([width]) + ids.astype(f"<u{width}").tobytes()
        if self.block and len(self.block) + len(ids) > BLOCK_BYTES:
            self.close_block()
        shared = 0
        if self.block:
            while shared < 9 and key[shared] == self.before[shared]:
                shared += 1
        else:
            self.first = key
        self.block += varint(shared) + varint(9 - shared) + varint(len(ids)) + key[shared:] + ids
        self.before = key
        self.keys.append(key)

    def close_block(self) -> None:
        self.index.append(BLOCK.pack(self.first, len(self.body), len(self.block)))
        self.body += self.block
        self.block = bytearray()

    def size(self) -> int:
        return len(self.body) + len(self.block)

    def finish(self) -> bytes:
        if self.block:
            self.close_block()
        bits = max(64, -(-len(self.keys) * 10 // 8) * 8)
        bloom = np.zeros(bits, bool)
        for key in self.keys:
            bloom[probes(key, bits)] = True
        index = b"".join(self.index)
        at = len(self.body)
        packed = np.packbits(bloom, bitorder="little").tobytes()
        ends = (at, at + len(index), at + len(index) + len(packed))
        return bytes(self.body) + index + packed + FOOTER.pack(*ends, len(self.keys), self.tokens, MAGIC)


class Shard:
    """A shard's bytes: iterate over (key, ids), or look a key up."""

    def __init__(self, data: bytes):
        self.data = data
        at, bloom, end, self.documents, self.tokens, magic = FOOTER.unpack(data[-FOOTER.size :])
        if magic != MAGIC:
            raise ValueError("not a shard of this format")
        self.index = [BLOCK.unpack_from(data, i) for i in range(at, bloom, BLOCK.size)]
        self.bloom = data[bloom:end]

    def entries(self, block: int):
        _, at, size = self.index[block]
        end, key = at + size, b""
        while at < end:
            shared, at = read_varint(self.data, at)
            rest, at = read_varint(self.data, at)
            n, at = read_varint(self.data, at)
            key = key[:shared] + self.data[at : at + rest]
            at += rest
            yield key, np.frombuffer(self.data, f"<u{self.data[at]}", (n - 1) // self.data[at], at + 1).astype("<u4").tobytes()
            at += n

    def __iter__(self):
        for block in range(len(self.index)):
            yield from self.entries(block)

    def get(self, doc_id: int | None) -> list[bytes]:
        """The ids of each document of that key: Bloom filter, binary search for the block, then its entries."""
        key = key_of(doc_id)
        if not all(self.bloom[p >> 3] >> (p & 7) & 1 for p in probes(key, len(self.bloom) * 8)):
            return []
        low, high = 0, len(self.index)
        while low < high:
            mid = (low + high) // 2
            low, high = (mid + 1, high) if self.index[mid][0] < key else (low, mid)
        found = []
        for block in range(max(0, low - 1), len(self.index)):
            if self.index[block][0] > key:
                break
            found += [ids for k, ids in self.entries(block) if k == key]
        return found


def write_shards(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Encode docs (doc_id, text) and write their shards under path; a stored table with a row per shard."""
    vocabulary = vocabulary or default_vocabulary()

    def write(batches):
        from pyarrow import fs

        encoder, task = WordEncoder.of(vocabulary), TaskContext.get().partitionId()
        where, root = fs.FileSystem.from_uri(path)
        where.create_dir(root, recursive=True)
        writer, number, span = ShardWriter(), 0, []

        def flush():
            name = f"{root}/part-{task:07d}-{number:05d}.sst"
            temporary = f"{name}.{uuid.uuid4().hex}.tmp"
            with where.open_output_stream(temporary) as out:
                out.write(writer.finish())
            where.move(temporary, name)
            return pa.record_batch({"part": pa.array([task], pa.int32()), "shard": pa.array([number], pa.int32()), "file": pa.array([name.rpartition("/")[2]]), "documents": pa.array([len(writer.keys)]), "tokens": pa.array([writer.tokens]), "first": pa.array([span[0]], pa.int64()), "last": pa.array([span[-1]], pa.int64())})

        for b in B.slices(batches):
            ids, off = with_end(*encoder.encode(*B.raw(b.column("text"))), end_id)
            for k, doc_id in enumerate(b.column("doc_id").to_pylist()):
                value = ids[off[k] : off[k + 1]]
                if writer.keys and writer.size() + value.nbytes > SHARD_BYTES:
                    yield flush()
                    writer, number, span = ShardWriter(), number + 1, []
                span = [*span[:1], doc_id]
                writer.add(key_of(doc_id), value)
        if writer.keys:
            yield flush()

    n = pieces(text_bytes(docs), PART_BYTES, 8)
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    return stored(ordered.mapInArrow(write, SHARDS), "shards")


def shard_starts(shards: DataFrame) -> DataFrame:
    """file and the tokens of all shards before it, summed over a thousand parts, within them, and within a part."""
    group = F.floor(F.col("part") / 1024)
    before = lambda w: F.coalesce(F.sum("tokens").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = shards.groupBy("part").agg(F.sum("tokens").alias("tokens")).withColumn("g", group)
    groups = parts.groupBy("g").agg(F.sum("tokens").alias("tokens"))
    groups = groups.select("g", before(Window.partitionBy().orderBy("g")).alias("a"))
    parts = parts.select("part", "g", before(Window.partitionBy("g").orderBy("part")).alias("b"))
    own = shards.select("file", "part", before(Window.partitionBy("part").orderBy("shard")).alias("c"))
    return own.join(parts, "part").join(groups, "g").select("file", (F.col("a") + F.col("b") + F.col("c")).alias("base"))


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """file, doc_id, start (ids before it in its shard), ids (packed) of every document, read from the files."""

    def read(batches):
        for b in batches:
            for file, content in zip(b.column("path").to_pylist(), b.column("content")):
                keys, starts, values, at = [], [], [], 0
                for key, ids in Shard(content.as_py()):
                    keys.append(id_of(key))
                    starts.append(at)
                    values.append(ids)
                    at += len(ids) // 4
                yield pa.record_batch({"file": pa.array([file.rpartition("/")[2]] * len(keys)), "doc_id": pa.array(keys, pa.int64()), "start": pa.array(starts, pa.int64()), "ids": pa.array(values, pa.binary())})

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.sst").load(path).select("path", "content").mapInArrow(read, "file string, doc_id long, start long, ids binary")


def lookup(shards: DataFrame, path: str, keys: DataFrame) -> DataFrame:
    """doc_id, ids of the documents with the doc_ids of `keys`. All files are read by Spark; of those whose range holds a key the index, the
    Bloom filter and single blocks are searched, the others are dropped unparsed."""
    spark = shards.sparkSession
    wanted = shards.join(keys.select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), F.col("doc_id").between(F.col("first"), F.col("last")))
    wanted = wanted.groupBy("file").agg(F.collect_list("doc_id").alias("keys"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.sst").load(path).select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")

    def find(batches):
        for b in batches:
            for content, ks in zip(b.column("content"), b.column("keys").to_pylist()):
                shard = Shard(content.as_py())
                rows = [(k, ids) for k in ks for ids in shard.get(k)]
                yield pa.record_batch({"doc_id": pa.array([k for k, _ in rows], pa.int64()), "ids": pa.array([v for _, v in rows], pa.binary())})

    return files.join(wanted, "file").select("content", "keys").mapInArrow(find, "doc_id long, ids binary")


def encode_documents(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the shards written and read back."""
    spark = docs.sparkSession
    path = scratch_path(spark, "sst")
    shards = write_shards(docs, path, vocabulary)
    if shards.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    found = read_shards(spark, path).select("file", "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
    return found.join(shard_starts(shards), "file").select("doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")


def op2_token_shards(spark, sf_dir: str) -> DataFrame:
    return encode_documents(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
