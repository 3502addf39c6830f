"""A training-data pipeline: quality rules, line dedup, near-dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of ``docs``. An operator sees the columns it works on; all others pass under names of their own and
come back as they were, whatever they are called.

Edge cases, by stage: quality_rules drops null, empty and short texts with the base rule; line_dedup
gives a null text back as an empty one; near_dedup keeps one of all null and blank texts; mixing
gives documents without words no copy in a source without words; packing makes a null text one piece
of its end id. Ties and repeated rows are treated as the stage's operator says; very long texts are
read whole; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.llm.common import written
from docketry.llm.linededup import dedup_lines
from docketry.llm.minhash import keep_one_similar
from docketry.llm.mixing import emit, mix
from docketry.llm.packing import pack
from docketry.llm.perplexity import judge


def _apart(docs: DataFrame, needed: tuple[str, ...], operator: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The operator's rows with the columns of ``docs``: those it doesn't need can't clash with its own."""
    carried = {c: c if c in needed else f"__dk_carried_{i}" for i, c in enumerate(docs.columns)}
    done = operator(docs.select(*[F.col(f"`{c}`").alias(name) for c, name in carried.items()]))
    return done.select(*[F.col(name).alias(c) for c, name in carried.items()])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and their language's perplexity band."""
    return _apart(docs, ("text", "lang"), lambda rows: judge(rows).where("kept"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that repeat; ``n_chars`` follows the text."""
    done = _apart(docs, ("doc_id", "text"), dedup_lines)
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return done


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of documents whose five-word shingles are alike to 0.8 or more."""
    return _apart(docs, ("doc_id", "text"), keep_one_similar)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's rate and its draw say."""
    return _apart(docs, ("doc_id", "text", "source"), lambda rows: emit(mix(rows)))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, each a sequence of a power-of-two length, with their ids."""
    return pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: SQL has neither the language model, XXH64 with a seed, nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
