"""A stream over files that grow: every whole line once, by byte offsets.

Offsets are bytes by file and always stand behind a line break, so a last line that is still being
written waits until it is whole. A micro-batch reads byte ranges, cut into parts that tasks read
side by side; a line belongs to the part in which it begins. Offsets are in the stream's checkpoint:
a query that is started again, or a batch that is run again, reads the very same bytes.

Files are opened with pyarrow's file systems (local paths, ``file://``, ``hdfs://``, ``s3://``, ``gs://``) and
must only be appended to. Names that begin with a dot or an underscore are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..sources import evidence

NAME = "docketry_tail"
SCHEMA = "path string, offset bigint, line string"
PART_BYTES = 64 << 20
_BLOCK = 1 << 20
_SCHEMA = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("line", pa.string())])


def _files(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def grown(path: str) -> dict[str, int]:
    """By file below ``path`` (or of the file ``path``): where its last whole line ends."""
    files, root = _files(path)
    found = files.get_file_info(root)
    infos = files.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True)) if found.type == pafs.FileType.Directory else [found]
    out = {}
    for info in infos:
        below = info.path.removeprefix(root).strip("/") or info.base_name
        if info.type == pafs.FileType.File and not any(name.startswith((".", "_")) for name in below.split("/")):
            out[info.path] = _last_break(files, info.path, info.size)
    return out


def _last_break(files: pafs.FileSystem, path: str, size: int) -> int:
    """The place after the last line break before ``size``, looked for from there backwards."""
    with files.open_input_file(path) as f:
        end = size
        while end > 0:
            begin = max(0, end - _BLOCK)
            at = f.read_at(end - begin, begin).rfind(b"\n")
            if at >= 0:
                return begin + at + 1
            end = begin
    return 0


class Part(InputPartition):
    """The lines of a file that begin at ``lo`` or later and before ``hi``; ``first`` says that a line begins at ``lo``."""

    def __init__(self, path: str, lo: int, hi: int, first: bool):
        super().__init__(None)
        self.path, self.lo, self.hi, self.first = path, lo, hi, first


def parts(start: dict[str, int], end: dict[str, int], part_bytes: int) -> list[Part]:
    """What was added to each file, in parts of at most ``part_bytes``."""
    out = []
    for path, to in sorted(end.items()):
        since = start.get(path, 0)
        if to < since:
            raise ValueError(f"{path} got shorter: {since} bytes were read of it, now its lines end at {to}")
        out += [Part(path, lo, min(lo + part_bytes, to), lo == since) for lo in range(since, to, part_bytes)]
    return out


def read_lines(files: pafs.FileSystem, part: Part) -> Iterator[tuple[int, bytes]]:
    """(offset, line) of a part; its last line may end in a later one."""
    with files.open_input_file(part.path) as f:
        at = part.lo if part.first else part.lo - 1
        held, skip = b"", not part.first  # a line that begins before the part is another part's
        f.seek(at)
        while at < part.hi:
            block = f.read(_BLOCK)
            if not block:
                return
            *lines, rest = block.split(b"\n")
            for line in lines:
                line = held + line
                held = b""
                if not skip and at < part.hi:
                    yield at, line
                skip = False
                at += len(line) + 1
                if at >= part.hi:
                    return
            held += rest


class TailReader(DataSourceStreamReader):
    """Offsets and parts of the files below a path."""

    def __init__(self, path: str, part_bytes: int):
        self.path, self.part_bytes = path, part_bytes

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return grown(self.path)

    def partitions(self, start: dict, end: dict) -> list[Part]:
        return parts(start, end, self.part_bytes)

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        files, _ = _files(self.path)
        rows: list[tuple[int, str]] = []
        size = 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"path": [partition.path] * len(rows), "offset": [r[0] for r in rows], "line": [r[1] for r in rows]}, _SCHEMA)

        for offset, line in read_lines(files, partition):
            rows.append((offset, line.decode("utf-8", "replace")))
            size += len(line)
            if len(rows) >= 4096 or size > 4 << 20:
                yield out()
                rows, size = [], 0
        if rows:
            yield out()


class Tail(DataSource):
    """``spark.readStream.format("docketry_tail")``; options ``path`` and ``partBytes``."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema: T.StructType) -> TailReader:
        return TailReader(self.options["path"], int(self.options.get("partBytes", PART_BYTES)))


def tail(spark: SparkSession, path: str, part_bytes: int = PART_BYTES) -> DataFrame:
    """(path, offset, line): a stream of the lines of a file, or of all files below a folder, and of what is added to them."""
    spark.dataSource.register(Tail)
    return spark.readStream.format(NAME).option("partBytes", part_bytes).load(path)


def tail_records(spark: SparkSession, path: str, part_bytes: int = PART_BYTES) -> DataFrame:
    """Records (case_id, pages) of an evidence cache that is still being written; blank and broken lines are skipped."""
    schema = T.StructType([*evidence.CACHE.fields, T.StructField("__dk_broken", T.StringType())])
    read = F.from_json("line", schema, {"columnNameOfCorruptRecord": "__dk_broken"})
    lines = tail(spark, path, part_bytes).where(F.trim("line") != "")
    return lines.select(read.alias("r")).where("r.__dk_broken is null and r.case_id is not null").select("r.case_id", "r.pages")


def tail_cache(spark: SparkSession, path: str, part_bytes: int = PART_BYTES) -> DataFrame:
    """Pages of an evidence cache that is still being written."""
    return evidence.pages_of(tail_records(spark, path, part_bytes))
