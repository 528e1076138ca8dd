"""Token ids as fixed-width bit-packed files.

Each id takes the minimum number of bits of the vocabulary.  Ids are laid out
in blocks of ``BLOCK_IDS``; a block's bits start at a byte boundary, so any
block is found by one multiplication, and numpy unpacks it at once.

A file image is: magic ``BPK1``, one byte for the width, then little-endian
unsigned 64-bit counts of ids, blocks and documents; the block table (byte
offset of each block, and one past the last); for each document its
identifier, its first id's place and its number of ids; then the packed
blocks.  Images are rows of a Parquet dataset ``(shard, file_no, n_docs, n_ids,
image)``: Spark's commit protocol writes them, so a retried task leaves no
half-written file, and any store that Spark writes to will do.

Shards are ranges of ascending identifiers; files inside a shard follow in
order.  ``read_documents`` reads the images back, whole; ``read_range`` decodes
any run of ids of one image through the block table.

Defined cases: null text counts as empty; an empty text holds the end id only;
a null identifier sorts first and is stored as the least
long, which therefore stands for none; repeated identifiers
are stored one after the other, ordered by text; an empty table gives no file;
further columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .frames import map_texts
from .tokens import ENCODE_BYTES, encoder
from .words import slices, text_buffer

BLOCK_IDS = 4096
FILE_IDS = 1 << 20
_MAGIC = b"BPK1"
_HEAD = struct.Struct("<4sBQQQ")
_NO_ID = np.iinfo(np.int64).min      # stands for a null identifier

FILES = "shard long, file_no int, n_docs long, n_ids long, image binary"


def id_bits(vocabulary: int) -> int:
    """Minimum bits for ids 0 to ``vocabulary - 1``."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Concatenate the low ``bits`` bits of each id, least significant bit first."""
    if bits == 16:
        return ids.astype("<u2").tobytes()
    if bits == 32:
        return ids.astype("<u4").tobytes()
    spread = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(spread.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes | memoryview, bits: int, count: int) -> np.ndarray:
    """The first ``count`` ids of packed bytes."""
    if bits == 16:
        return np.frombuffer(data, "<u2", count).astype(np.uint32)
    if bits == 32:
        return np.frombuffer(data, "<u4", count).copy()
    flat = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little", count=count * bits)
    weights = np.uint32(1) << np.arange(bits, dtype=np.uint32)
    return (flat.reshape(count, bits).astype(np.uint32) * weights).sum(axis=1, dtype=np.uint32)


def encode_image(doc_ids: np.ndarray, lengths: np.ndarray, ids: np.ndarray, bits: int) -> bytes:
    blocks = [pack(ids[i:i + BLOCK_IDS], bits) for i in range(0, len(ids), BLOCK_IDS)]
    table = np.zeros(len(blocks) + 1, "<u8")
    table[1:] = np.cumsum([len(b) for b in blocks]) if blocks else []
    place = np.zeros(len(lengths), "<u8")
    place[1:] = np.cumsum(lengths)[:-1]
    return b"".join([_HEAD.pack(_MAGIC, bits, len(ids), len(blocks), len(doc_ids)), table.tobytes(),
                     doc_ids.astype("<i8").tobytes(), place.tobytes(), lengths.astype("<u8").tobytes(), *blocks])


class Image:
    """Random access to one file image."""

    def __init__(self, data: bytes):
        magic, self.bits, self.n_ids, n_blocks, n_docs = _HEAD.unpack_from(data)
        if magic != _MAGIC:
            raise ValueError("not a bit-packed id file")
        at = _HEAD.size
        self.table = np.frombuffer(data, "<u8", n_blocks + 1, at)
        at += self.table.nbytes
        self.doc_ids = np.frombuffer(data, "<i8", n_docs, at)
        at += self.doc_ids.nbytes
        self.place = np.frombuffer(data, "<u8", n_docs, at)
        at += self.place.nbytes
        self.lengths = np.frombuffer(data, "<u8", n_docs, at)
        self._blocks = memoryview(data)[at + self.lengths.nbytes:]

    def block(self, k: int) -> np.ndarray:
        count = min(BLOCK_IDS, self.n_ids - k * BLOCK_IDS)
        return unpack(self._blocks[int(self.table[k]):int(self.table[k + 1])], self.bits, count)

    def read_range(self, start: int, count: int) -> np.ndarray:
        """Ids ``start`` to ``start + count`` of this image; only the blocks they lie in are unpacked."""
        if count <= 0:
            return np.zeros(0, np.uint32)
        first, last = start // BLOCK_IDS, (start + count - 1) // BLOCK_IDS
        ids = np.concatenate([self.block(k) for k in range(first, last + 1)])
        return ids[start - first * BLOCK_IDS:][:count]

    def document(self, k: int) -> np.ndarray:
        return self.read_range(int(self.place[k]), int(self.lengths[k]))


def write_ids(df: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
              end_id: int = 1) -> None:
    """Encode every text, append ``end_id``, and write the images below ``path`` in ascending identifier order."""
    def images(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc = encoder(tokenizer)
        bits = id_bits(max(enc.vocabulary(), end_id + 1))
        end = np.asarray([end_id], "<u4").tobytes()
        shard, file_no = TaskContext.get().partitionId(), 0
        names: list[np.ndarray] = []
        parts: list[bytes] = []
        held = 0

        def image() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(parts), "<u4")
            lengths = np.asarray([len(p) // 4 for p in parts], np.int64)
            doc_ids = np.concatenate(names)
            data = encode_image(doc_ids, lengths, ids, bits)
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int64()), pa.array([file_no], pa.int32()), pa.array([len(doc_ids)], pa.int64()),
                 pa.array([len(ids)], pa.int64()), pa.array([data], pa.binary())],
                ["shard", "file_no", "n_docs", "n_ids", "image"])

        for part in slices(batches, "text", ENCODE_BYTES):
            raw, offsets = text_buffer(part.column("text"))
            whole = raw.tobytes()
            encoded = enc.encode([whole[a:b] for a, b in zip(offsets[:-1], offsets[1:])])
            parts += [e + end for e in encoded]
            names.append(part.column("id").fill_null(_NO_ID).to_numpy(zero_copy_only=False))
            held += sum(map(len, encoded)) // 4 + len(encoded)
            if held >= FILE_IDS:
                yield image()
                file_no, held, names, parts = file_no + 1, 0, [], []
        if parts:
            yield image()

    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    (rows.repartitionByRange("id").sortWithinPartitions("id", "text")
     .transform(map_texts, images, FILES).write.mode("overwrite").option("compression", "uncompressed").parquet(path))


def read_documents(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per stored document, decoded from the files: id, ``start`` (ids of all before it), ``n_tokens``,
    ``ids_crc32`` and, if asked for, the ids themselves."""
    files = spark.read.schema(FILES).parquet(path)
    # one small row for each shard goes to the window that adds up the shards before it; a shard's files
    # are added up within the shard
    shards = files.groupBy("shard").agg(F.sum("n_ids").alias("ids")).withColumn(
        "shard_base", F.coalesce(F.sum("ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    bases = (files.select("shard", "file_no", "n_ids").join(F.broadcast(shards.select("shard", "shard_base")), "shard")
             .withColumn("base", F.col("shard_base") + F.coalesce(F.sum("n_ids").over(
                 Window.partitionBy("shard").orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
             .select("shard", "file_no", "base"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, file_no, data in zip(*(batch.column(c).to_pylist() for c in ("shard", "file_no", "image"))):
                image = Image(data)
                ids = image.read_range(0, image.n_ids).astype("<u4").tobytes()
                cut = [ids[4 * int(p):4 * int(p + n)] for p, n in zip(image.place, image.lengths)]
                names = image.doc_ids
                cols = [pa.array([shard] * len(names), pa.int64()), pa.array([file_no] * len(names), pa.int32()),
                        pa.array(names, pa.int64(), mask=names == _NO_ID), pa.array(image.place.astype(np.int64)),
                        pa.array(image.lengths.astype(np.int64)), pa.array([zlib.crc32(c) for c in cut], pa.int64())]
                kinds = ["shard", "file_no", "doc_id", "place", "n_tokens", "ids_crc32"]
                if with_ids:
                    cols.append(pa.array([np.frombuffer(c, "<u4").astype(np.int32) for c in cut], pa.list_(pa.int32())))
                    kinds.append("ids")
                yield pa.RecordBatch.from_arrays(cols, kinds)

    schema = "shard long, file_no int, doc_id long, place long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    docs = files.select("shard", "file_no", "image").transform(map_texts, decode, schema)
    return docs.join(bases, ["shard", "file_no"]).withColumn("start", F.col("base") + F.col("place")).select(
        "doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids)
