"""Shared plumbing of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import materialised as written
from ..sources.shared import shared_dir

__all__ = ["WORD", "checkpoint", "parts", "shared_dir", "text_size", "utf8_bytes", "written"]

WORD = r"[^\x20\x09-\x0D]+"


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` by writing it to the shared checkpoint folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def parts(df: DataFrame, task_bytes: int = 64 << 20) -> int:
    """Partitions for a shuffle of ``df``: by its size as the optimizer knows it, at least as many as the session asks for."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    known = size if size < 1 << 60 else 0  # beyond that the optimizer doesn't know
    return max(-(-known // task_bytes), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def utf8_bytes(column: pa.ChunkedArray | pa.Array) -> list[bytes | None]:
    """A string column's values as UTF-8 bytes, without decoding them."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist() if not pa.types.is_binary(column.type) else column.to_pylist()


def text_size() -> Callable[[Column], Column]:
    """Number of words of a text, natively: null and blank texts have none."""
    return lambda text: F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
