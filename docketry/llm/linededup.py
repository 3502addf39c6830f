"""Line dedup with two Bloom filters.

Pass one reads the texts and keeps 16 bytes for each long line of a document. Two Bloom filters,
one of keys seen at least once and one of keys seen at least twice, are cut into segments by the
leading bits of the digests; both bits of a key are in its segment. The documents of a task are a
block, or several of bounded size. A block sends each segment the distinct positions that it sets,
four bytes each, and which of them it sets more than once, so that a line that every document holds
moves once a block. A task a segment merges these: a bit that two blocks set, or one block sets
twice, is a twice-seen bit, so no repeated key is missed. Each block gets back the twice-seen ones of
its own positions, where its keys are probed. The keys stay where they were written, in buckets by
block. Only keys that the twice-seen filter holds are shuffled, grouped by their full digest, counted
exactly, and given the document that keeps them. Pass two rewrites the documents that lose a line.

This is the way at every size: nothing is broadcast, and no task holds more than a segment, with four
bytes for each block that sets a position of it, or a block.

Edge cases: a null text is one empty line; very long texts are read whole; equal lines (ties) of the
keeping document all stay; a document is a row, so repeated rows count each; of
rows with the largest id all keep their lines; a null id is smaller than any other, and rows equal
in id and text are treated alike; an empty table gives an empty result; input columns named like
an output column are replaced.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import parts, shared_dir, utf8_bytes, written

OUTPUTS = ("n_lines", "n_dropped")
_DIGEST = 16
_PROBES = 2
#: log2 of the bits of a filter segment.
_SEGMENT = 20
#: Buckets of a table, as many as Spark allows unless told otherwise; more blocks share them.
_BUCKETS = 100_000


def line_key(line: bytes) -> bytes:
    """The line as compared: ASCII white space stripped at both ends, A-Z lower-cased."""
    return line.strip().lower()


def _long_enough(key: bytes, least: int) -> bool:
    if len(key) < least:
        return False
    return len(key) >= 4 * least or len(key.decode("utf-8", "replace")) >= least


def _digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=_DIGEST).digest()


def _segments(digests: np.ndarray, segments: int) -> np.ndarray:
    """The segment of each digest, by its leading bits."""
    return (digests[:, 0] >> np.uint64(40)).astype(np.int64) * segments >> 24


def _positions(digests: np.ndarray) -> np.ndarray:
    """(probes, digests): the bits of each digest within its segment; double hashing over a power of two."""
    first, step = digests[:, 0], digests[:, 1] | np.uint64(1)
    return np.stack([(first + np.uint64(i) * step) & np.uint64((1 << _SEGMENT) - 1) for i in range(_PROBES)])


def _words(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, "<u8").reshape(-1, 2)


def _line_digests(docs: DataFrame, least: int, block_keys: int) -> DataFrame:
    """Per document with a long line: its block, id, digest of the text, and the distinct digests of its long lines, packed."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            packed, blocks, rows = [], [], []
            for row, text in enumerate(utf8_bytes(batch.column("text"))):
                keys = {k for k in map(line_key, (text or b"").split(b"\n")) if _long_enough(k, least)}
                if not keys:
                    continue
                if held >= block_keys:
                    block, held = block + 1, 0
                held += len(keys)
                packed.append(b"".join(sorted(map(_digest, keys))))
                blocks.append(block)
                rows.append(row)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks, pa.int64()), batch.column("id").take(at), batch.column("mark").take(at), pa.array(packed, pa.binary())],
                ["block", "id", "mark", "lines"],
            )

    id_type = docs.schema["id"].dataType
    fields = [("block", T.LongType()), ("id", id_type), ("mark", T.BinaryType()), ("lines", T.BinaryType())]
    return docs.mapInArrow(scan, T.StructType([T.StructField(*f) for f in fields]))


def _in_buckets(lines: DataFrame, buckets: int) -> tuple[DataFrame, str]:
    """``lines`` written once below the shared folder in buckets by block, so that a meeting by block doesn't move them; the table's name."""
    spark, name = lines.sparkSession, f"docketry_lines_{uuid.uuid4().hex}"
    lines.write.bucketBy(buckets, "block").option("path", f"{shared_dir(spark)}/{name}").saveAsTable(name)
    return spark.table(name), name


def set_positions(lines: DataFrame, segments: int) -> DataFrame:
    """(segment, block, bits): the distinct positions that a block sets in a segment, as 32-bit numbers.

    The low bit tells a position that the block sets more than once.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        current = None

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held
            if held:
                once, count = np.unique(np.concatenate(held), return_counts=True)
                local = ((once & ((1 << _SEGMENT) - 1)) << 1 | (count > 1)).astype("<u4")
                segment = once >> _SEGMENT
                cuts = np.flatnonzero(np.diff(segment)) + 1
                parts = [p.tobytes() for p in np.split(local, cuts)]
                heads = segment[np.concatenate([[0], cuts])].astype(np.int32)
                for lo in range(0, len(parts), 4096):
                    bits = pa.array(parts[lo : lo + 4096], pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(heads[lo : lo + 4096]), pa.array([current] * len(bits), pa.int64()), bits], ["segment", "block", "bits"])
            held = []

        for batch in batches:
            for block, blob in zip(batch.column("block").to_pylist(), batch.column("lines").to_pylist(), strict=True):
                if block != current:
                    yield from flush()
                    current = block
                digests = _words(blob)
                held.append((_segments(digests, segments) << _SEGMENT | _positions(digests).astype(np.int64)).ravel())
        yield from flush()

    return lines.select("block", "lines").mapInArrow(build, "segment int, block long, bits binary")


def twice_seen(positions: DataFrame, tasks: int) -> DataFrame:
    """(block, segment, bits): of the positions that a block sets, those of the twice-seen filter."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = -1, []

        def done() -> Iterator[pa.RecordBatch]:
            once, twice = np.zeros(1 << _SEGMENT, bool), np.zeros(1 << _SEGMENT, bool)
            for _, blob in held:
                local = np.frombuffer(blob, "<u4")
                at = local >> 1
                twice[at] |= once[at] | (local & 1).astype(bool)
                once[at] = True
            answers = []
            for block, blob in held:
                at = np.frombuffer(blob, "<u4") >> 1
                if len(at := at[twice[at]]):
                    answers.append((block, at.tobytes()))
            for lo in range(0, len(answers), 4096):
                blocks, bits = zip(*answers[lo : lo + 4096], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array([current] * len(bits), pa.int32()), pa.array(bits, pa.binary())], ["block", "segment", "bits"])

        for batch in batches:
            for segment, block, blob in zip(*(batch.column(c).to_pylist() for c in ("segment", "block", "bits")), strict=True):
                if segment != current:
                    yield from done()
                    current, held = segment, []
                held.append((block, blob))
        yield from done()

    return positions.repartition(tasks, "segment").sortWithinPartitions("segment").mapInArrow(merge, "block long, segment int, bits binary")


def suspected(lines: DataFrame, twice: DataFrame, segments: int) -> DataFrame:
    """(digest, id, mark) of the keys that the twice-seen filter holds, probed block by block."""
    schema = T.StructType([T.StructField("digest", T.BinaryType()), lines.schema["id"], T.StructField("mark", T.BinaryType())])

    def probe(rows: pa.Table, answers: pa.Table) -> pa.Table:
        blobs = rows.column("lines").to_pylist()
        digests = _words(b"".join(blobs))
        found = [np.frombuffer(b, "<u4").astype(np.int64) | s << _SEGMENT for s, b in zip(answers.column("segment").to_pylist(), answers.column("bits").to_pylist(), strict=True)]
        held = np.concatenate([np.empty(0, np.int64), *found])
        at = _segments(digests, segments) << _SEGMENT | _positions(digests).astype(np.int64)
        hit = np.isin(at, held).all(axis=0)
        of = pa.array(np.repeat(np.arange(len(blobs)), [len(b) // _DIGEST for b in blobs])[hit])
        keys = np.ascontiguousarray(digests[hit]).tobytes()
        found = pa.array([keys[i : i + _DIGEST] for i in range(0, len(keys), _DIGEST)], pa.binary())
        return pa.table([found, rows.column("id").take(of), rows.column("mark").take(of)], names=["digest", "id", "mark"])

    return lines.groupBy("block").cogroup(twice.groupBy("block")).applyInArrow(probe, schema)


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_chars: int = 20,
    least_docs: int = 3,
    bits_per_key: int = 16,
    block_keys: int = 1 << 21,
) -> DataFrame:
    """Rows of ``docs`` with the repeated lines gone from the text, and ``n_lines`` and ``n_dropped``.

    A key of at least ``least_chars`` code points found in at least ``least_docs`` documents stays
    only in the document with the largest id. ``least_docs`` must be two or more. ``block_keys`` keys,
    of 16 bytes, are held by a task at once, or those of one document.
    """
    if least_docs < 2:
        raise ValueError("a repeated line is in two documents at least")
    docs = docs.drop(*[c for c in OUTPUTS if c in docs.columns])
    mark = F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit(""))))
    chosen = docs.select(F.col(id_col).alias("id"), mark.alias("mark"), F.col(text_col).alias("text"))
    lines, name = _in_buckets(_line_digests(chosen, least_chars, block_keys), min(_BUCKETS, parts(docs, 1 << 30)))
    n_keys = (lines.agg(F.sum(F.octet_length("lines"))).first()[0] or 0) // _DIGEST
    segments = min(1 << 24, max(1, -(-bits_per_key * n_keys >> _SEGMENT)))
    tasks = max(n_keys * 4 * _PROBES >> 26, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    suspects = written(suspected(lines, twice_seen(set_positions(lines, segments), tasks), segments), "suspects")
    docs.sparkSession.sql(f"DROP TABLE {name}")  # the catalog's entry
    confirmed = (
        suspects.groupBy("digest")
        .agg(F.count("*").alias("n"), F.max("id").alias("keeper"))
        .where(F.col("n") >= least_docs)
        .select(F.col("digest").alias("key"), "keeper")
    )
    # Written, so that the joins below have plain sides: broadcast where small, split where skewed.
    confirmed = written(confirmed, "confirmed")
    drops = (
        suspects.join(confirmed, F.col("digest") == F.col("key"))
        .where(~F.col("id").eqNullSafe(F.col("keeper")))
        .groupBy("id", "mark")
        .agg(F.collect_set("digest").alias("__dk_drop"))
        .select(F.col("id").alias("__dk_id"), F.col("mark").alias("__dk_of"), "__dk_drop")
    )
    drops = written(drops, "drops")
    joined = (
        docs.withColumn("__dk_mark", mark)
        .join(drops, F.col(id_col).eqNullSafe(F.col("__dk_id")) & (F.col("__dk_mark") == F.col("__dk_of")), "left")
        .drop("__dk_id", "__dk_of", "__dk_mark")
    )
    names = docs.columns

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, n_lines, n_dropped = [], [], []
            for text, drop in zip(utf8_bytes(batch.column(text_col)), batch.column("__dk_drop").to_pylist(), strict=True):
                text = text or b""
                n_lines.append(text.count(b"\n") + 1)
                if not drop:
                    kept.append(text)
                    n_dropped.append(0)
                    continue
                drop = set(drop)
                split = text.split(b"\n")
                left = [x for x in split if not (_long_enough(k := line_key(x), least_chars) and _digest(k) in drop)]
                kept.append(b"\n".join(left))
                n_dropped.append(len(split) - len(left))
            arrays = {n: batch.column(n) for n in names}
            arrays[text_col] = pa.array(kept, pa.binary()).cast(pa.string())
            arrays |= {"n_lines": pa.array(n_lines, pa.int64()), "n_dropped": pa.array(n_dropped, pa.int64())}
            yield pa.RecordBatch.from_arrays(list(arrays.values()), list(arrays))

    schema = T.StructType([*docs.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    return joined.mapInArrow(rewrite, schema)
