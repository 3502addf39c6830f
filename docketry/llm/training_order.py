"""Training-order materialisation: token shards in a keyed random order.

Documents are encoded once and laid end to end, partition by partition, into sequences of a fixed
number of ids; only the last sequence of a partition is padded. That table is written once. Every
sequence has a dense index, its place in the table; a keyed Feistel network over the smallest
even-bit domain that holds all indexes, walked until it lands inside (cycle walking), maps the index
to a global slot, so the slots are a permutation without any table of it. Sequences then move to the
range of slots that is their shard, in compressed groups, and each shard is laid out in memory and
written as fixed-stride records: record ``slot - first slot`` starts at that number times the
stride, so a reader resumes anywhere by arithmetic.

The index of a sequence follows the order in which the scan deals out the documents: the same files,
read in the same partitions, give the same order for a key.

Edge cases: a null or empty text is the end id alone; very long texts are encoded in bounded pieces;
equal documents (ties, repeated rows) are encoded each; an empty table gives no sequences and no
shards; input columns other than id and text are left out, so no name clashes.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written
from .tokens import token_ids, vocabulary_path

_ROUNDS = 6
#: Bytes of sequences that a task gathers before it sends a group to each shard.
_GROUP = 32 << 20


def _round_keys(key: int) -> np.ndarray:
    return np.random.default_rng([key, 0xFE15]).integers(0, 1 << 63, _ROUNDS, np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    """An integer hash of 64-bit words (xor-shift and multiply)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def feistel_slots(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """The slots of ``index`` under a permutation of ``range(n)`` chosen by ``key``."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask, width, keys = np.uint64((1 << half) - 1), np.uint64(half), _round_keys(key)
    out = np.asarray(index, np.uint64).copy()
    walking = np.ones(len(out), bool)
    while walking.any():
        x = out[walking]
        left, right = x >> width, x & mask
        for k in keys:
            left, right = right, left ^ (_mix(right + k) & mask)
        out[walking] = (left << width) | right
        walking[walking] = out[walking] >= np.uint64(n)
    return out.astype(np.int64)


class Materialised(NamedTuple):
    """What was written: a row for each piece of a document in a sequence, and the layout of the files."""

    index: DataFrame
    sequences: int
    stride: int
    shards: int


def _narrow(ids: np.ndarray) -> np.ndarray:
    if len(ids) and int(ids.max()) > 0xFFFF:
        raise ValueError("an id above 65,535 doesn't fit a 16-bit record")
    return ids.astype("<u2")


def sequence_table(docs: DataFrame, id_col: str, text_col: str, length: int, vocabulary: str, end_id: int) -> DataFrame:
    """(ids, pieces): the ids of a partition's documents end to end, in runs of ``length``; ids are 16-bit."""
    id_type = docs.schema[id_col].dataType
    piece = T.StructType([T.StructField("id", id_type), T.StructField("start", T.LongType()), T.StructField("length", T.IntegerType()), T.StructField("offset", T.IntegerType())])
    schema = T.StructType([T.StructField("ids", T.BinaryType()), T.StructField("pieces", T.ArrayType(piece))])

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[bytes] = []
        pieces: list[list[dict]] = []
        open_ids, open_pieces, filled = [], [], 0
        kind = None

        def send() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(pieces, kind)], ["ids", "pieces"])
            ids.clear()
            pieces.clear()
            return out

        for batch in batches:
            if kind is None:
                kind = pa.list_(pa.struct([("id", batch.column("id").type), ("start", pa.int64()), ("length", pa.int32()), ("offset", pa.int32())]))
            for doc, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                all_ids, at = _narrow(token_ids(text, vocabulary, end_id)), 0
                while at < len(all_ids):
                    part = all_ids[at : at + length - filled]
                    open_ids.append(part.tobytes())
                    open_pieces.append({"id": doc, "start": at, "length": len(part), "offset": filled})
                    at, filled = at + len(part), filled + len(part)
                    if filled == length:
                        ids.append(b"".join(open_ids))
                        pieces.append(open_pieces)
                        open_ids, open_pieces, filled = [], [], 0
                        if len(ids) >= 2048:
                            yield send()
        if filled:
            ids.append(b"".join(open_ids))
            pieces.append(open_pieces)
        if ids:
            yield send()

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(lay, schema)


def materialise(
    docs: DataFrame,
    path: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = 1024,
    shard_sequences: int | None = None,
    key: int = 20_231,
    vocabulary: str | None = None,
    end_id: int = 0,
) -> Materialised:
    """Write the shards below ``path`` (skipped if None) and return the index of all pieces.

    The index has the id, ``start``, ``length``, ``ids`` (little-endian unsigned 16-bit), ``slot``,
    ``offset`` in the sequence, ``shard`` and ``byte_offset`` of the record. A record is the number
    of ids (two bytes), the ids padded with zeros to ``length``, and a line feed. A shard of
    ``shard_sequences`` records is what one task holds in memory; by default 8192, doubled while
    there are more than 4096 shards, up to 65,536. An id above 65,535 is an error.
    """
    spark = docs.sparkSession
    table = written(sequence_table(docs, id_col, text_col, length, vocabulary or vocabulary_path(), end_id), "sequences", "zstd")
    placed = table.select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    counts = sorted(placed.groupBy("file").count().collect())  # a row for each file written
    total = sum(r["count"] for r in counts)
    if shard_sequences is None:
        shard_sequences = 8192
        while shard_sequences < 65_536 and total > 4096 * shard_sequences:
            shard_sequences *= 2
    bases, at = [], 0
    for r in counts:
        bases.append((r["file"], at))
        at += r["count"]
    base = F.broadcast(spark.createDataFrame(bases, "of string, base long"))
    numbered = placed.join(base, F.col("file") == F.col("of")).withColumn("at", F.col("base") + F.col("row")).select("ids", "pieces", "at")

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = feistel_slots(batch.column("at").to_numpy(zero_copy_only=False), total, key)
            yield pa.RecordBatch.from_arrays([batch.column("ids"), batch.column("pieces"), pa.array(slot)], ["ids", "pieces", "slot"])

    slotted = numbered.mapInArrow(slots, T.StructType([*table.schema.fields, T.StructField("slot", T.LongType())]))
    if path is not None:
        write_shards(slotted.select("slot", "ids"), path, total, length, shard_sequences)
    stride = 2 * length + 3
    index = slotted.select("ids", "slot", F.explode("pieces").alias("p")).select(
        F.col("p.id").alias(id_col), "p.start", "p.length", F.expr("substring(ids, 2 * p.offset + 1, 2 * p.length)").alias("ids"), "slot", "p.offset",
        F.expr(f"cast(slot div {shard_sequences} as int)").alias("shard"), (F.col("slot") % shard_sequences * stride).alias("byte_offset"),
    )
    return Materialised(index, total, stride, -(-total // shard_sequences))


def write_shards(slotted: DataFrame, path: str, total: int, length: int, shard_sequences: int) -> None:
    """Fixed-stride files, one in each folder ``shard=N``; the file system's commit makes them whole.

    Sequences travel in groups, one for each task and shard, compressed together. The text sink
    writes bytes as they are, ends every record with a line feed, and works on any store that Spark
    writes to.
    """
    stride = 2 * length + 2

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[int, bytes]]] = {}
        size = 0
        packer = zstandard.ZstdCompressor(level=6)

        def send() -> Iterator[pa.RecordBatch]:
            for shard, rows in held.items():
                slots = np.array([r[0] for r in rows], "<i8")
                counts = np.array([len(r[1]) for r in rows], "<i4")
                blob = packer.compress(slots.tobytes() + counts.tobytes() + b"".join(r[1] for r in rows))
                yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([len(rows)], pa.int32()), pa.array([blob], pa.binary())], ["shard", "n", "blob"])
            held.clear()

        for batch in batches:
            for slot, ids in zip(batch.column("slot").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                held.setdefault(slot // shard_sequences, []).append((slot, ids))
                size += len(ids)
            if size >= _GROUP:
                yield from send()
                size = 0
        yield from send()

    def lay_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        current, records = -1, np.empty(0)

        def send() -> Iterator[pa.RecordBatch]:
            if current >= 0:
                first = current * shard_sequences
                n = min(shard_sequences, total - first)
                for lo in range(0, n, 1024):
                    values = [r.tobytes() for r in records[lo : min(lo + 1024, n)]]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), current, np.int32)), pa.array(values, pa.binary())], ["shard", "record"])

        for batch in batches:
            for shard, n, blob in zip(*(batch.column(c).to_pylist() for c in ("shard", "n", "blob")), strict=True):
                if shard != current:
                    yield from send()
                    current, records = shard, np.zeros((shard_sequences, stride), np.uint8)
                data = unpacker.decompress(blob)
                slots, counts = np.frombuffer(data, "<i8", n), np.frombuffer(data, "<i4", n, 8 * n)
                at = 12 * n
                for slot, size in zip((slots - shard * shard_sequences).tolist(), counts.tolist(), strict=True):
                    records[slot, :2] = np.frombuffer(struct.pack("<H", size // 2), np.uint8)
                    records[slot, 2 : 2 + size] = np.frombuffer(data, np.uint8, size, at)
                    at += size
        yield from send()

    shards = max(1, -(-total // shard_sequences))
    groups = slotted.mapInArrow(group, "shard int, n int, blob binary").repartitionById(shards, F.col("shard")).sortWithinPartitions("shard")
    rows = groups.mapInArrow(lay_out, "shard int, record binary").select("shard", F.col("record").cast("string").alias("value"))
    rows.write.partitionBy("shard").option("lineSep", "\n").text(path)


def read_record(data: bytes, record: int, length: int) -> np.ndarray:
    """Ids of one record of a shard file."""
    stride = 2 * length + 3
    n = struct.unpack_from("<H", data, record * stride)[0]
    return np.frombuffer(data, "<u2", n, record * stride + 2)


def digest(docs: DataFrame, path: str | None, **options) -> DataFrame:
    """The index with a CRC-32 in place of the ids."""
    made = materialise(docs, path, **options).index
    return made.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
