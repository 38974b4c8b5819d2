"""Token ids in a binary format of fixed-width fields.

A shard image is, in little-endian order: the 40-byte header `HEADER` (magic, version, bits per id, documents,
ids, ids per block, blocks), a null flag (u8) and an id (i64) per document, the number of shard ids up to and
including each document (u64), the byte offset of each block and of the end (u64), and the blocks. Each id takes
the least number of bits that holds the vocabulary's largest id; a block starts on a byte, so the offsets give
random access to any id, and numpy unpacks any stretch of blocks at once.

Images are rows of a Parquet table written by Spark's committer below the shared folder (a lost executor's
shards are written again); `save` and `open_shard` work on single images. Shards hold about `SHARD` ids and
follow each other in (part, seq) order, which is ascending doc_id order.

Edge cases: a null or empty text has the end id only. Null ids sort first. Rows with equal ids are ordered by
the hash of their text. An empty table gives no shards. Extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slowtide.llm.common import pick
from slowtide.llm.tokens import encoded, encoder
from slowtide.session import materialize, ship

MAGIC = b"FWIDS\x00\x00\x01"
HEADER = struct.Struct("<8sHHIQQII")
SHARD = 1 << 20
BLOCK = 4096
END = 2

WRITTEN = "part int, seq int, before long, n_docs long, n_ids long, image binary"


def width(size: int) -> int:
    """Bits that hold every id below `size`."""
    return max(1, int(size - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Fields of `bits` bits, least significant first; the last byte is filled with zeros."""
    octets = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if bits % 8 == 0:
        return octets[:, : bits // 8].tobytes()
    return np.packbits(np.unpackbits(octets, axis=1, bitorder="little")[:, :bits], bitorder="little").tobytes()


def unpack(data: np.ndarray, bits: int, n: int) -> np.ndarray:
    """The first n fields of the bytes `data`."""
    octets = np.zeros((n, 4), np.uint8)
    if bits % 8 == 0:
        octets[:, : bits // 8] = data[: n * bits // 8].reshape(n, bits // 8)
    else:
        fields = np.zeros((n, 32), np.uint8)
        fields[:, :bits] = np.unpackbits(data, count=n * bits, bitorder="little").reshape(n, bits)
        octets[:] = np.packbits(fields, axis=1, bitorder="little")
    return octets.view("<u4")[:, 0]


def image(doc_ids: list[int | None], ids: np.ndarray, ends: np.ndarray, bits: int) -> bytes:
    """One shard of documents whose ids end at `ends`."""
    blocks = [pack(ids[a : a + BLOCK], bits) for a in range(0, len(ids), BLOCK)]
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in blocks])]).astype("<u8")
    nulls = np.array([d is None for d in doc_ids], np.uint8)
    numbers = np.array([d or 0 for d in doc_ids], "<i8")
    head = HEADER.pack(MAGIC, 1, bits, 0, len(doc_ids), len(ids), BLOCK, len(blocks))
    return b"".join([head, nulls.tobytes(), numbers.tobytes(), ends.astype("<u8").tobytes(), offsets.tobytes(), *blocks])


class Shard:
    """Reads an image; `ids(a, b)` touches only the blocks of that stretch."""

    def __init__(self, data: bytes):
        magic, version, self.bits, _, docs, self.n_ids, self.block, blocks = HEADER.unpack_from(data)
        if magic != MAGIC or version != 1:
            raise ValueError("not a shard of this format")
        at = HEADER.size
        self.nulls = np.frombuffer(data, np.uint8, docs, at).astype(bool)
        self.doc_ids = np.frombuffer(data, "<i8", docs, at := at + docs)
        self.ends = np.frombuffer(data, "<u8", docs, at := at + 8 * docs).astype(np.int64)
        self.offsets = np.frombuffer(data, "<u8", blocks + 1, at := at + 8 * docs).astype(np.int64)
        self.payload = np.frombuffer(data, np.uint8, -1, at + 8 * (blocks + 1))
        if len(self.payload) != self.offsets[-1]:
            raise ValueError("shard is cut short")

    def ids(self, start: int, stop: int) -> np.ndarray:
        if stop <= start:
            return np.zeros(0, "<u4")
        first, last = start // self.block, -(-stop // self.block)
        data = self.payload[self.offsets[first] : self.offsets[last]]
        n = min(last * self.block, self.n_ids) - first * self.block
        per_block = self.block * self.bits
        if per_block % 8:  # each block ends with a filled byte
            parts = [unpack(self.payload[self.offsets[k] : self.offsets[k + 1]], self.bits, min(self.block, self.n_ids - k * self.block)) for k in range(first, last)]
            found = np.concatenate(parts)
        else:
            found = unpack(data, self.bits, n)
        return found[start - first * self.block : stop - first * self.block]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.ends[k - 1]) if k else 0, int(self.ends[k]))


def save(path: str, data: bytes) -> None:
    with open(path, "wb") as out:
        out.write(data)


def open_shard(path: str) -> Shard:
    with open(path, "rb") as source:
        return Shard(source.read())


def write_shards(docs: DataFrame, tokenizer: str, end: int = END, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Encode every text and write the shards; returns the written table (`WRITTEN`)."""
    ship(docs.sparkSession)
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    # rows under one id, or without any, may be dealt to several tasks, and so may equal rows
    order = [F.col("doc_id").asc_nulls_first(), F.col("code"), F.col("salt")]
    marked = source.select("doc_id", "text", F.xxhash64("text").alias("code"), F.monotonically_increasing_id().alias("salt"))
    ordered = marked.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")

    def rows(batches):
        bits = width(max(encoder(tokenizer).size, end + 1))
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        names, held, ends, size = [], [], [], 0

        def flush():
            nonlocal seq, before, names, held, ends, size
            row = [[part], [seq], [before], [len(names)], [size], [image(names, np.concatenate(held), np.concatenate(ends), bits)]]
            seq, before = seq + 1, before + size
            names, held, ends, size = [], [], [], 0
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(row, (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)],
                names=["part", "seq", "before", "n_docs", "n_ids", "image"],
            )

        for batch in batches:
            ids = batch.column("doc_id")
            for a, b, found, stops in encoded(batch.column("text"), encoder(tokenizer), end):
                names += ids.slice(a, b - a).to_pylist()
                held.append(found)
                ends.append(stops + size)
                size += len(found)
                if size >= SHARD:
                    yield flush()
        if names:
            yield flush()

    return materialize(ordered.mapInArrow(rows, WRITTEN), "shards")


def read_shards(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the images.

    Where a part starts follows from one row per part, of which there are as many as writing tasks.
    """
    ship(shards.sparkSession)
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    placed = shards.join(F.broadcast(parts), "part").select((F.col("base") + F.col("before")).alias("start"), "image")

    def rows(batches):
        for batch in batches:
            for start, data in zip(batch.column("start").to_pylist(), batch.column("image"), strict=True):
                shard = Shard(data.as_buffer().to_pybytes())
                first = np.concatenate([[0], shard.ends[:-1]]).astype(np.int64)
                ids = np.ascontiguousarray(shard.ids(0, shard.n_ids))
                crc = [zlib.crc32(ids[i:j]) for i, j in zip(first.tolist(), shard.ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.doc_ids, mask=shard.nulls), pa.array(first + start), pa.array(shard.ends - first), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return placed.mapInArrow(rows, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op6_binary_ids(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = pick(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "text")
    return read_shards(write_shards(docs, public_tokenizers.path("byte_bpe_50k.json")))
