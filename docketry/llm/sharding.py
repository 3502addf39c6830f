"""Sharding by a two-pass external shuffle.

Pass one scatters every record by a seeded hash of its content into one of many small cells; equal
runs of cells form buckets that fit in memory. Pass two shuffles each bucket with Fisher-Yates
and writes it. Because the bucket is uniform given the seed and the order inside it is a uniform
permutation, the whole order is one. Shards are equal runs of that order.

Edge cases: a null text is a record like any other, and so is a very long one, which may make its
bucket as large as itself; rows equal in every hashed column share a
cell, and a cell beyond the memory bound is shuffled in bounded pieces (its rows are
interchangeable); an empty table gives an empty result; input columns named like an output column
are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written

_CELL, _ORDER = "__dk_cell", "__dk_order"
#: Cells of the scatter, whose counts are a table: finer than the buckets of any input below 500 TB.
_CELLS = 1 << 24
OUTPUTS = ("position", "shard", "slot")


def _fisher_yates(n: int, rng: np.random.Generator) -> np.ndarray:
    """A uniform permutation of ``n`` places; numpy's in-place shuffle is the Fisher-Yates loop."""
    order = np.arange(n)
    rng.shuffle(order)
    return order


def external_shuffle(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int = 16,
    seed: int = 7,
    bucket_bytes: int = 32 << 20,
    task_bytes: int = 128 << 20,
) -> DataFrame:
    """All rows of ``df`` with ``position`` (global, gapless), ``shard`` and ``slot`` (gapless in its shard).

    Shard row counts differ by at most one. The order depends on the seed, ids and texts alone, not
    on the input's partitions. Buckets and tasks follow the bytes of the texts: the driver gets a number
    for each bucket of ``bucket_bytes``, and a task has buckets of ``task_bytes`` together.
    """
    if shards < 1:
        raise ValueError("there must be a shard")
    df = df.drop(*[c for c in OUTPUTS if c in df.columns])
    content = F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    order = F.xxhash64(F.lit(seed), F.col(id_col), content, F.octet_length(F.col(text_col)))
    cell = F.pmod(F.xxhash64(F.lit(seed + 1), order), F.lit(_CELLS)).cast("int")
    size = F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long") + 1
    counted = df.select(cell.alias(_CELL), size.alias("n")).groupBy(_CELL).agg(F.count("*").alias("rows"), F.sum("n").alias("bytes"))
    counted = written(counted, "cells")
    total, n_bytes = (int(x or 0) for x in counted.agg(F.sum("rows"), F.sum("bytes")).first())
    n_buckets = min(_CELLS, max(1, -(-n_bytes // bucket_bytes)))
    bucket = F.expr(f"cast({_CELL} * {n_buckets}L div {_CELLS}L as int)")
    filled = counted.groupBy(bucket.alias("bucket")).agg(F.sum("rows").alias("rows")).toPandas()
    starts = np.concatenate([[0], np.cumsum(np.bincount(filled["bucket"].to_numpy(np.int64), filled["rows"].to_numpy(float), n_buckets))]).astype(np.int64)
    shared = df.sparkSession.sparkContext.broadcast(starts)
    tasks = max(-(-n_bytes // task_bytes), min(n_buckets, 2 * df.sparkSession.sparkContext.defaultParallelism))
    names = df.columns
    schema = T.StructType(
        [*df.schema.fields, T.StructField("position", T.LongType(), False), T.StructField("shard", T.IntegerType(), False), T.StructField("slot", T.LongType(), False)]
    )

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = shared.value
        held: list[pa.RecordBatch] = []
        current, held_bytes, done = -1, 0, 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held, held_bytes, done
            if not held:
                return
            table = pa.Table.from_batches(held)
            rng = np.random.default_rng([seed, current, done])
            table = table.take(pa.array(_fisher_yates(len(table), rng)))
            position = starts[current] + done + np.arange(len(table), dtype=np.int64)
            shard = position * shards // total
            first = -(-shard * total // shards)
            done += len(table)
            held, held_bytes = [], 0
            table = table.select(names)
            for name, values in (("position", position), ("shard", shard.astype(np.int32)), ("slot", position - first)):
                table = table.append_column(name, pa.array(values))
            yield from table.combine_chunks().to_batches(max_chunksize=4096)

        for batch in batches:
            of = batch.column(_CELL).to_numpy(zero_copy_only=False).astype(np.int64) * n_buckets // _CELLS
            cuts = np.flatnonzero(np.diff(of)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(of)], strict=True):
                if hi == lo:
                    continue
                if of[lo] != current:
                    yield from flush()
                    current, done = int(of[lo]), 0
                piece = batch.slice(lo, hi - lo)
                held.append(piece)
                held_bytes += piece.nbytes
                if held_bytes > 4 * bucket_bytes:
                    yield from flush()
        yield from flush()

    return (
        df.withColumn(_ORDER, order)
        .withColumn(_CELL, cell)
        .repartitionById(tasks, F.expr(f"cast(({_CELL} * {n_buckets}L div {_CELLS}L) * {tasks}L div {n_buckets}L as int)"))
        .sortWithinPartitions(_CELL, _ORDER, id_col, text_col)
        .mapInArrow(fill, schema)
    )


def write_shards(df: DataFrame, path: str) -> None:
    """Write shuffled rows as parquet, a folder for each shard.

    Tasks have runs of positions in order, so a shard's files, by name, hold its rows in slot order.
    """
    df.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
