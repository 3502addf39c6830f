"""Registered queries of what is written and read again: caches, label files, predictions, calibration tables."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..operators import calibrate
from ..sources import evidence
from ..sources.shared import shared_dir
from ..sources.tables import table
from . import bindings

#: Cases of a subset to work on.
FEW = 50


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/docketry-{name}-{uuid4().hex}"


def cached_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns written as an evidence cache and read again, each with the number of its pages before it."""
    pages = bindings.conversation_pages(spark, sf_dir).withColumns({"case_id": F.col("case_id").cast("string"), "number": F.col("number").cast("int")})
    path = _folder(spark, "cache")
    evidence.write_cache(pages.where("source = 'text'"), path)
    evidence.write_cache(pages.where("source = 'ocr'"), path)
    read = evidence.read_cache(spark, path)
    return read.select(F.col("case_id").cast("long").alias("conv_id"), F.col("number").cast("long").alias("turn"), F.col("doc_type").alias("role"), F.md5(F.array_join("lines", "\n")).alias("text_md5"))


def _label_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels written with a header, every case twice, the valid row last, and read again."""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("case_id"), "quality", "toxic")
    drafts = labels.select("case_id", (1 - F.col("quality")).alias("quality"), F.lit(None).cast("int").alias("toxic"), F.lit(0).alias("edition"))
    rows = drafts.unionByName(labels.withColumn("edition", F.lit(1))).repartition("case_id").sortWithinPartitions("case_id", "edition")
    path = _folder(spark, "labels")
    rows.drop("edition").write.option("header", True).csv(path)
    return evidence.read_labels(spark, path)


def label_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last label of every case of a file that has two."""
    return _label_file(spark, sf_dir)


def label_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels of the first cases in order of their id: a subset to work on."""
    cases = table(spark, sf_dir, "documents").select(F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("case_id"))
    _, labels = evidence.subset(cases, _label_file(spark, sf_dir).withColumn("case_id", F.lpad("case_id", 12, "0")), FEW)
    return labels.select("case_id", "quality")


def prediction_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions as the file has them, and what kept the others out of it."""
    k = F.col("k")
    made = {
        "adjudication": F.when(k % 13 == 0, "MAYBE").otherwise("DENIED"), "fee_status": F.when(k % 17 == 0, "free").otherwise("paid"), "risk_flags": F.when(k % 19 == 0, "").otherwise("none"),
        "confidence": F.when(k % 23 == 0, 1.5).otherwise(k % 1000 / 1000.0),
    }
    path = _folder(spark, "predictions")
    invalid = evidence.write_predictions(bindings.made_cases(spark, sf_dir).withColumns(made), path)
    columns = [*fixed.SCORED[:7], "risk_flags", "fee_status", "adjudication"]
    schema = ", ".join(f"{c} string" for c in ("case_id", *columns)) + ", confidence double"
    written = spark.read.schema(schema).json(path)
    stated = written.select("case_id", F.concat_ws("|", *columns).alias("stated"), "confidence", F.lit("").alias("problems"))
    return stated.unionByName(invalid.select("case_id", F.array_join("problems", "; ").alias("problems")), allowMissingColumns=True)


def saved_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fitted calibration table, saved and loaded."""
    path = _folder(spark, "calibration")
    calibrate.save_table(calibrate.fit(bindings.judged_orders(spark, sf_dir)), path)
    return calibrate.load_table(spark, path)
