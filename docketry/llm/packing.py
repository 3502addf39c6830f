"""Packing by power-of-two decomposition.

A document's ids are cut into pieces whose lengths are powers of two: as many of the full length as
fit, then the binary digits of what is left, largest first. Each piece is a sequence of its own in
the bucket of its length, so no sequence crosses documents and none is padded.

Edge cases: a null or empty text is the end id alone, one piece of one token; rows with a null id are
packed like any other; repeated rows are packed each; equal lengths (ties) are sequences of one bucket
with numbers of their own; an empty table gives an empty result; very long texts are encoded in bounded
pieces; only the id and the text are read, so other columns can't clash with those of the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tokens import token_ids, vocabulary_path


def piece_lengths(n: int, longest: int = 1024) -> list[int]:
    """Powers of two that add up to ``n``, none above ``longest``, in falling order."""
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest length must be a power of two")
    rest = n % longest
    return [longest] * (n // longest) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    longest: int = 1024,
    vocabulary: str | None = None,
    end_id: int = 0,
) -> DataFrame:
    """Sequences: ``id_col``, ``start``, ``length``, ``ids`` (little-endian unsigned 32-bit), ``doc_tokens``, ``bucket``, ``sequence_id``, ``offset``.

    ``bucket`` is log2 of the length. ``sequence_id`` is unique and made without a shuffle; its
    upper bits are the input's partition, so a task that is run again gives the same ids.
    """
    piece_lengths(0, longest)
    path = vocabulary or vocabulary_path()
    id_type = docs.schema[id_col].dataType

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row: list[int] = []
            start: list[int] = []
            length: list[int] = []
            ids: list[bytes] = []
            tokens: list[int] = []

            def flush(batch: pa.RecordBatch = batch) -> pa.RecordBatch:
                lengths = np.array(length, np.int64)
                out = pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(pa.array(row, pa.int32())),
                        pa.array(start, pa.int64()),
                        pa.array(lengths),
                        pa.array(ids, pa.binary()),
                        pa.array(tokens, pa.int64()),
                        pa.array(np.log2(lengths).astype(np.int32)),
                    ],
                    ["id", "start", "length", "ids", "doc_tokens", "bucket"],
                )
                for held in (row, start, length, ids, tokens):
                    held.clear()
                return out

            for i, text in enumerate(batch.column("text").to_pylist()):
                all_ids = token_ids(text, path, end_id)
                at = 0
                for n in piece_lengths(len(all_ids), longest):
                    row.append(i)
                    start.append(at)
                    length.append(n)
                    ids.append(all_ids[at : at + n].tobytes())
                    tokens.append(len(all_ids))
                    at += n
                    if len(row) >= 8192:
                        yield flush()
            if row:
                yield flush()

    schema = T.StructType(
        [
            T.StructField("id", id_type),
            T.StructField("start", T.LongType(), False),
            T.StructField("length", T.LongType(), False),
            T.StructField("ids", T.BinaryType(), False),
            T.StructField("doc_tokens", T.LongType(), False),
            T.StructField("bucket", T.IntegerType(), False),
        ]
    )
    pieces = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(cut, schema)
    return pieces.select(
        F.col("id").alias(id_col), "start", "length", "ids", "doc_tokens", "bucket",
        F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )


def write_buckets(sequences: DataFrame, path: str) -> None:
    """Write sequences as parquet with a folder for each length, so that a batch reads one length only."""
    sequences.write.partitionBy("bucket").parquet(path)
