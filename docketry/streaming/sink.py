"""A sink that has every row of a stream once, however often a batch is run.

A batch writes its rows into a folder of its own and then publishes a manifest under its number, by a
rename that fails if there is one. Readers take the folders that manifests name: what a killed batch
left is in none, and a batch that is run again after its manifest was published does nothing.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

_MANIFESTS = "_manifests"


def _path(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _manifest(base: str, number: int) -> str:
    return f"{base}/{_MANIFESTS}/{number:012d}.json"


def publish(spark: SparkSession, base: str, number: int, folder: str) -> bool:
    """Name a folder as the rows of a batch; False where the batch already has one."""
    files, final = _path(spark, _manifest(base, number))
    _, draft = _path(spark, f"{base}/{_MANIFESTS}/.{uuid4().hex}")
    out = files.create(draft, False)
    out.write(bytearray(json.dumps({"batch": number, "folder": folder}).encode() + b"\n"))
    out.close()
    done = not files.exists(final) and files.rename(draft, final)
    if not done:
        files.delete(draft, False)
    return bool(done)


def write_once(base: str) -> Callable[[DataFrame, int], None]:
    """A function for ``foreachBatch`` that writes each batch below ``base`` once."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        files, done = _path(spark, _manifest(base, number))
        if files.exists(done):
            return
        folder = f"batch-{number:012d}-{uuid4().hex}"
        batch.write.parquet(f"{base}/{folder}")
        publish(spark, base, number, folder)

    return write


def committed(spark: SparkSession, base: str) -> list[str]:
    """Folders of the batches that are complete, in their order: one name a batch."""
    files, top = _path(spark, f"{base}/{_MANIFESTS}")
    if not files.exists(top):
        return []
    rows = spark.read.schema("batch long, folder string").json(f"{base}/{_MANIFESTS}").collect()
    return [f"{base}/{r['folder']}" for r in sorted(rows, key=lambda r: r["batch"])]


def read_once(spark: SparkSession, base: str, schema: T.StructType, last: bool = False) -> DataFrame:
    """The rows of all complete batches, or of the last one (for a stream that gives its whole result each time)."""
    folders = committed(spark, base)
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*(folders[-1:] if last else folders))


def sweep(spark: SparkSession, base: str) -> int:
    """Delete what killed batches left; only while no stream writes there. Returns the number of folders."""
    named, n = {folder.rsplit("/", 1)[1] for folder in committed(spark, base)}, 0
    files, top = _path(spark, base)
    for status in files.listStatus(top) if files.exists(top) else []:
        if status.getPath().getName().startswith("batch-") and status.getPath().getName() not in named:
            files.delete(status.getPath(), True)
            n += 1
    return n


def start(stream: DataFrame, base: str, mode: str = "append", every: str | None = None) -> StreamingQuery:
    """Run a stream into the sink at ``base``: over what is there now, or ``every`` so often until it is stopped."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return stream.writeStream.outputMode(mode).option("checkpointLocation", f"{base}/_state").trigger(**trigger).foreachBatch(write_once(base)).start()
