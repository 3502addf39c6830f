"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and near-duplicate component."""
    from .simhash import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text statistics, perplexity, and the verdict of its language's band."""
    from .perplexity import judge

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return judge(docs, carry=["doc_id"])


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document in its sequence."""
    from .packing import pack

    packed = pack(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's lines before dropping, dropped lines, and digest of what stays."""
    from .linededup import dedup_lines

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard and slot after the two-pass shuffle."""
    from .sharding import external_shuffle

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return external_shuffle(docs).select(
        "doc_id",
        (F.octet_length(data) + 1).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "position",
    )


def op6_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sequence's slot, shard and byte offset in the shards written below the shared folder."""
    from uuid import uuid4

    from .common import shared_dir
    from .training_order import digest

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return digest(docs, f"{shared_dir(spark)}/docketry-shards-{uuid4().hex}")


def _fold(modulus: int):
    """crc32 of the id as text, modulo ``modulus``; a null id is as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % modulus


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality, learned from the labels of four folds of five."""
    from .linecrf import fit, score

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").where(_fold(5) != 0).select(F.col("doc_id").alias("id"), F.col("quality").alias("label")).distinct()
    field = fit(labels, texts=docs.select(F.col("doc_id").alias("id"), "text"))
    scored = score(docs.withColumn("held_out", _fold(5) == 0), field)
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's predicted language, learned from the documents of three folds of four."""
    from .langid import fit, identify

    docs = _table(spark, sf_dir, "documents")
    model = fit(docs.where(_fold(4) != 2).select("text", "lang"))
    return identify(docs.select("doc_id", (_fold(4) == 2).alias("held_out"), "text"), model)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's share of the mix."""
    from .mixing import decide

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return decide(docs).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"))


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth vector."""
    from .nearest import nearest

    return nearest(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 100 == 0)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged by rule: its faults, and the cheapest edits that mend its roles."""
    from .conversations import damaged, repair

    return repair(damaged(_table(spark, sf_dir, "conversations")), present=F.col("present"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fill-in-middle form, its cuts, and digests of the output and of the text rebuilt from it."""
    from .infill import fill_in_middle, restored

    made = fill_in_middle(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    rebuilt = restored(F.col("text"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("text"), 256).alias("output_sha256"), F.sha2(rebuilt, 256).alias("restored_sha256")
    )


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's group of equal texts, and the one that stays of it."""
    from .exact import owners

    return owners(_table(spark, sf_dir, "documents").select("doc_id", "text"))
