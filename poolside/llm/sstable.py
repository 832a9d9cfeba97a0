"""Token ids of documents in sorted-string-table shards.

A shard holds documents in ascending id order::

    blocks   zstd frames of about block_bytes: for each document the length of the
             key prefix shared with the key before, the rest of the key, the number
             of ids, and the ids
    index    for each block: its last key, place, stored and plain length, documents, ids
    bloom    a Bloom filter over the keys
    footer   fixed size: where index and bloom lie, counts, width of an id, magic

A lookup reads the footer, asks the Bloom filter, finds the block by binary search
in the index, and reads that block alone.
"""

from __future__ import annotations

import bisect
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh_path, keyed_texts, partitions, slices
from .files import make_folder, open_input, open_output, rename
from .tokens import TOKEN_SLICE, encoder

MAGIC = b"PSST0001"
FOOTER = struct.Struct("<QQQQQQIIq8s")
ENTRY = struct.Struct("<BBI")
INDEX = struct.Struct("<QIIIQ9s")
BITS_A_KEY, PROBES = 10, 7
#: Text of a shard; its tokens take less.
SHARD_BYTES = 256_000_000
MANIFEST = "path string, shard long, documents long, tokens long, bytes long"


def key_bytes(doc_id: int | None) -> bytes:
    """Nine bytes that sort as ids do, null first."""
    return bytes(9) if doc_id is None else b"\1" + struct.pack(">Q", (doc_id + (1 << 63)) & ((1 << 64) - 1))


def key_id(key: bytes) -> int | None:
    return None if key[0] == 0 else struct.unpack(">Q", key[1:])[0] - (1 << 63)


def _probes(key: bytes, bits: int) -> list[int]:
    return _places(xxhash.xxh64_intdigest(key), bits)


def _places(h: int, bits: int) -> list[int]:
    a, b = h & 0xFFFFFFFF, (h >> 32) | 1
    return [(a + i * b) % bits for i in range(PROBES)]


class ShardWriter:
    """Writes one shard; keys must come in ascending order (equal keys may repeat)."""

    def __init__(self, stream, width: int, block_bytes: int = 65536):
        self.stream, self.width, self.block_bytes = stream, width, block_bytes
        self.zip = zstandard.ZstdCompressor(level=1)
        self.block, self.filled, self.in_block, self.ids_in_block = [], 0, 0, 0
        self.last, self.at, self.documents, self.ids = b"", 0, 0, 0
        self.index: list[bytes] = []
        self.hashes = array("Q")  # eight bytes a document, for the Bloom filter

    def add(self, doc_id: int | None, ids: bytes) -> None:
        key = key_bytes(doc_id)
        if key < self.last:
            raise ValueError("keys must ascend")
        shared = 0
        if self.in_block:
            while shared < 9 and key[shared] == self.last[shared]:
                shared += 1
        n = len(ids) // self.width
        self.block += [ENTRY.pack(shared, 9 - shared, n), key[shared:], ids]
        self.filled += len(ids) + 15 - shared
        self.in_block += 1
        self.ids_in_block += n
        self.last = key
        self.hashes.append(xxhash.xxh64_intdigest(key))
        if self.filled >= self.block_bytes:
            self.close_block()

    def close_block(self) -> None:
        if not self.in_block:
            return
        plain = b"".join(self.block)
        stored = self.zip.compress(plain)
        self.stream.write(stored)
        self.index.append(INDEX.pack(self.at, len(stored), len(plain), self.in_block, self.ids_in_block, self.last))
        self.at += len(stored)
        self.documents += self.in_block
        self.ids += self.ids_in_block
        self.block, self.filled, self.in_block, self.ids_in_block = [], 0, 0, 0

    def close(self) -> None:
        self.close_block()
        bits = max(64, BITS_A_KEY * len(self.hashes))
        bloom = np.zeros(-(-bits // 8), np.uint8)
        for h in self.hashes:
            for p in _places(h, bits):
                bloom[p >> 3] |= 1 << (p & 7)
        index = b"".join(self.index)
        self.stream.write(index)
        self.stream.write(bloom.tobytes())
        at = self.at
        self.stream.write(FOOTER.pack(at, len(index), at + len(index), len(bloom), self.documents, self.ids, self.width, zlib.crc32(index), bits, MAGIC))


class ShardReader:
    """Reads a shard from a file object with seek and read."""

    def __init__(self, file, size: int | None = None):
        self.file = file
        size = file.size() if size is None else size
        footer = FOOTER.unpack(self._at(size - FOOTER.size, FOOTER.size))
        at, length, self._bloom_at, self._bloom_bytes, self.documents, self.ids, self.width, check, self.bits, magic = footer
        if magic != MAGIC:
            raise ValueError("not a shard")
        raw = self._at(at, length)
        if zlib.crc32(raw) != check:
            raise ValueError("damaged index")
        self.index = [INDEX.unpack_from(raw, i) for i in range(0, length, INDEX.size)]
        self.last_keys = [x[5] for x in self.index]
        self.unzip = zstandard.ZstdDecompressor()
        self._bloom: bytes | None = None

    def _at(self, place: int, length: int) -> bytes:
        self.file.seek(place)
        return self.file.read(length)

    def may_hold(self, doc_id: int | None) -> bool:
        if self._bloom is None:
            self._bloom = self._at(self._bloom_at, self._bloom_bytes)
        return all(self._bloom[p >> 3] >> (p & 7) & 1 for p in _probes(key_bytes(doc_id), self.bits))

    def block(self, number: int) -> Iterator[tuple[int | None, bytes]]:
        place, stored, plain, count = self.index[number][:4]
        data = self.unzip.decompress(self._at(place, stored), max_output_size=plain)
        at, key = 0, b""
        for _ in range(count):
            shared, rest, n = ENTRY.unpack_from(data, at)
            at += ENTRY.size
            key = key[:shared] + data[at : at + rest]
            at += rest
            yield key_id(key), data[at : at + n * self.width]
            at += n * self.width

    def get(self, doc_id: int | None) -> list[bytes]:
        """The ids of each document with this id; none if the shard has none."""
        if not self.may_hold(doc_id):
            return []
        key, found = key_bytes(doc_id), []
        for number in range(bisect.bisect_left(self.last_keys, key), len(self.index)):
            hits = [ids for k, ids in self.block(number) if k == doc_id]
            found += hits
            if self.last_keys[number] > key:
                break
        return found

    def __iter__(self) -> Iterator[tuple[int | None, bytes]]:
        for number in range(len(self.index)):
            yield from self.block(number)


def write_shards(
    docs: DataFrame, tokenizer: str, folder: str, *, end_id: int = 2, shards: int | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode and write all documents; the manifest, one row for each shard file.

    There is a shard for every :data:`SHARD_BYTES` of text, and as many as Spark has shuffle
    partitions at least. Shards are ranges of ids, so their order is the order of ids; rows with a null
    id come first, and rows with one id stay together in any order. A null text has
    the end id alone. An empty table gives an empty manifest. The manifest is
    written when all shards are, and names only files of tasks that succeeded.
    """
    spark = docs.sparkSession
    texts = keyed_texts(docs, id_col, text_col)
    if shards is None:
        total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        shards = max(partitions(spark), -(-total // SHARD_BYTES))
    ordered = texts.repartitionByRange(shards, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoder(tokenizer)
        end = np.array([end_id], codec.dtype).tobytes()
        shard = TaskContext.get().partitionId()
        writer, stream, part = None, None, f"{folder}/.{shard}-{uuid.uuid4().hex}"
        for batch in batches:
            for rows in slices(batch, "text", TOKEN_SLICE):
                if writer is None:
                    make_folder(folder)
                    stream = open_output(part)
                    writer = ShardWriter(stream, codec.dtype.itemsize)
                for doc_id, ids in zip(rows.column(0).to_pylist(), codec.encode(rows.column(1).to_pylist()), strict=True):
                    writer.add(doc_id, ids + end)
        if writer is None:
            return
        writer.close()
        size = stream.tell()
        stream.close()
        path = f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex[:8]}.sst"
        rename(part, path)
        yield pa.RecordBatch.from_pydict({"path": [path], "shard": [shard], "documents": [writer.documents], "tokens": [writer.ids], "bytes": [size]})

    manifest = f"{folder}/manifest"
    ordered.mapInArrow(write, MANIFEST).write.parquet(manifest)
    return spark.read.schema(MANIFEST).parquet(manifest)


def read_shards(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the shard files.

    start counts the ids of all documents before it. Only the manifest, a row for
    each shard, is summed up in one task.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = manifest.select("path", "shard", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("start"))
    spark = manifest.sparkSession

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with open_input(row["path"]) as file:
                    yield from _digests(ShardReader(file), row["start"])

    # one file a task, as far as partitions go round
    return starts.repartition(partitions(spark), "shard").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _digests(shard: Iterable[tuple[int | None, bytes]], start: int) -> Iterator[pa.RecordBatch]:
    out: dict[str, list] = {"doc_id": [], "start": [], "n_tokens": [], "ids_crc32": []}
    width = shard.width
    for doc_id, ids in shard:
        n = len(ids) // width
        wide = ids if width == 4 else np.frombuffer(ids, f"<u{width}").astype("<u4").tobytes()
        for c, v in zip(out, (doc_id, start, n, zlib.crc32(wide)), strict=True):
            out[c].append(v)
        start += n
        if len(out["start"]) >= 10_000:
            yield _longs(out)
            for v in out.values():
                v.clear()
    if out["start"]:
        yield _longs(out)


def _longs(columns: dict[str, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({c: pa.array(v, pa.int64()) for c, v in columns.items()})


def token_shards(docs: DataFrame, tokenizer: str, folder: str | None = None, **options) -> DataFrame:
    """Write the shards (to a new shared folder unless one is named) and read them back."""
    return read_shards(write_shards(docs, tokenizer, folder or fresh_path(docs.sparkSession, "shards"), **options))
