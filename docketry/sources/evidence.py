"""Readers and writers around case packets: evidence caches, label files, scans, predictions."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from uuid import uuid4

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed
from ..operators.output import problems, to_json_lines

PAGE = T.StructType(
    [
        T.StructField("number", T.IntegerType()),
        T.StructField("doc_type", T.StringType()),
        T.StructField("lines", T.ArrayType(T.StringType())),
        T.StructField("source", T.StringType()),
        T.StructField("ocr_lines", T.ArrayType(T.StringType())),
        T.StructField("hidden_text", T.StringType()),
        T.StructField("second_lines", T.ArrayType(T.StringType())),
    ]
)
CACHE = T.StructType([T.StructField("case_id", T.StringType()), T.StructField("pages", T.ArrayType(PAGE))])
PAGES = T.StructType([T.StructField("case_id", T.StringType()), *PAGE.fields])
LABELS = T.StructType([T.StructField(c, T.StringType()) for c in ("case_id", *fixed.SCORED[:7], "risk_flags", "fee_status", "adjudication")])


def pages_of(cache: DataFrame) -> DataFrame:
    """A row a page of cached records; missing fields are empty."""
    pages = cache.where("case_id is not null").select("case_id", F.explode("pages").alias("p")).select("case_id", "p.*")
    empty = F.array().cast("array<string>")
    return pages.withColumns({"hidden_text": F.coalesce("hidden_text", F.lit(""))} | {c: F.coalesce(c, empty) for c in ("lines", "ocr_lines", "second_lines")})


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """Pages of an evidence cache of JSON lines; missing fields are empty, a truncated last line is skipped."""
    return pages_of(spark.read.schema(CACHE).option("mode", "DROPMALFORMED").json(path))


def stream_cache(spark: SparkSession, folder: str, files_per_trigger: int = 16) -> DataFrame:
    """The same pages as a stream over a folder to which cache files are added."""
    return pages_of(spark.readStream.schema(CACHE).option("mode", "DROPMALFORMED").option("maxFilesPerTrigger", files_per_trigger).json(folder))


def write_cache(pages: DataFrame, path: str, mode: str = "append") -> None:
    """Write pages as a cache, one line a case, pages in order of their number; pages without one come first."""
    page = F.struct(*[F.col(f.name) for f in PAGE.fields])
    cases = pages.groupBy("case_id").agg(F.array_sort(F.collect_list(page)).alias("pages"))
    cases.write.mode(mode).json(path)


#: Bytes of a row group of a table for lookups: what one lookup reads, if the case is not large.
LOOKUP_GROUP = 4 << 20


def write_case_table(pages: DataFrame, path: str, mode: str = "overwrite", group_bytes: int = LOOKUP_GROUP) -> None:
    """Write pages as a table for lookups: cases lie together in order, row groups are small and have Bloom filters of their cases."""
    dealt = pages.repartitionByRange("case_id", "number").sortWithinPartitions("case_id", "number")
    options = {"parquet.bloom.filter.enabled#case_id": "true", "parquet.block.size": str(group_bytes)}
    dealt.write.mode(mode).options(**options).parquet(path)


def find_case(spark: SparkSession, path: str, case: str) -> DataFrame:
    """The pages of a case; files and row groups whose statistics or Bloom filters exclude it are not read."""
    return spark.read.parquet(path).where(F.col("case_id") == F.lit(case))


def find_cases(spark: SparkSession, path: str, cases: DataFrame) -> DataFrame:
    """The pages of the cases of a table ``cases`` of any size."""
    return spark.read.parquet(path).join(cases.select("case_id").distinct(), "case_id", "left_semi")


def not_yet_cached(cases: DataFrame, cache: DataFrame) -> DataFrame:
    """Cases that the cache doesn't hold: where an interrupted run goes on."""
    return cases.join(cache.select("case_id").distinct(), "case_id", "left_anti")


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """A label file with a header, all columns text; of repeated cases the last row stays."""
    rows = spark.read.option("header", True).csv(path)
    place = F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("r"))
    last = rows.withColumn("__dk_place", place).groupBy("case_id").agg(F.max_by(F.struct(*rows.columns), "__dk_place").alias("__dk_row"))
    return last.select("__dk_row.*")


def discover(spark: SparkSession, folder: str, glob: str = "*.pdf", recursive: bool = True) -> DataFrame:
    """(case_id, path, content) of scanned files; the case is the file's stem. ``repeated_cases`` reports stems that occur twice."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower()).load(folder)
    stem = F.regexp_replace(F.regexp_extract("path", r"([^/]+)$", 1), r"\.[^.]+$", "")
    return files.select(stem.alias("case_id"), "path", "content")


def repeated_cases(files: DataFrame) -> DataFrame:
    """Cases that more than one file claims: an error to report, not to resolve by chance."""
    return files.groupBy("case_id").agg(F.count("*").alias("files"), F.min("path").alias("first")).where("files > 1")


Engine = Callable[[str, bytes], list[dict]]
#: The engines that this worker has made, by scan.
_ENGINES: dict[str, Engine] = {}


def scan(files: DataFrame, make_engine: Callable[[], Engine]) -> DataFrame:
    """Pages of scanned files through a page engine that each Python worker makes once, when first needed.

    The engine maps a case and a file's bytes to page rows. ``error`` tells what a file failed of;
    such a file gives one row without a page. Where no engine can be made, every row says so.
    """
    schema = T.StructType([*PAGES.fields, T.StructField("engine_available", T.BooleanType()), T.StructField("error", T.StringType())])
    names, token = [f.name for f in PAGES.fields], uuid4().hex

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        engine, missing = _ENGINES.get(token), None
        for batch in batches:
            rows = []
            if engine is None and missing is None:
                try:
                    engine = _ENGINES[token] = make_engine()
                except Exception as e:  # an engine that isn't installed is a fact about the run
                    missing = f"{type(e).__name__}: {e}"
            for case, content in zip(batch["case_id"], batch["content"], strict=True):
                blank = dict.fromkeys(names) | {"case_id": case, "engine_available": engine is not None, "error": missing}
                if engine is None:
                    rows.append(blank)
                    continue
                try:
                    rows += [blank | page for page in engine(case, bytes(content))]
                except Exception as e:
                    rows.append(blank | {"error": f"{type(e).__name__}: {e}"})
            yield pd.DataFrame(rows, columns=[*names, "engine_available", "error"])

    return files.select("case_id", "content").mapInPandas(run, schema)


def write_predictions(predictions: DataFrame, path: str) -> DataFrame:
    """Write valid predictions as JSON lines in order of their case; returns the invalid ones with their problems."""
    columns = ["case_id", *fixed.SCORED[:7], "risk_flags", "fee_status", "adjudication", "confidence"]
    checked = predictions.withColumn("problems", problems({c: F.col(c) for c in columns}))
    valid = checked.where(F.size("problems") == 0).orderBy("case_id")
    to_json_lines(valid, columns).write.mode("overwrite").text(path)
    return checked.where(F.size("problems") > 0)


def subset(cases: DataFrame, labels: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """The first ``n`` cases in order of their id, and the labels of those cases alone."""
    few = first_cases(cases, n)
    return few, labels.join(few.select("case_id"), "case_id", "left_semi")


def first_cases(cases: DataFrame, n: int) -> DataFrame:
    """The first ``n`` cases in order of their id, as a subset to work on."""
    return cases.orderBy("case_id").limit(n)
