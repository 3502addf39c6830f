"""Registered queries of the streams: a cache that grows is tailed, sunk once and watched; polls are rated with state."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import evidence
from ..sources.shared import shared_dir
from ..sources.tables import table
from ..streaming import monitor, rates, sink, tail
from . import bindings

#: Events a minute that an alert is measured from.
USUAL = 0.046


def _cache_grows(spark: SparkSession, sf_dir: str, base: str):
    """Write the conversations as a cache in two steps; yields after each."""
    pages = bindings.conversation_pages(spark, sf_dir).withColumn("number", F.col("number").cast("int"))
    for part in (0, 1):
        some = pages.where(F.pmod(F.coalesce("case_id", F.lit(0)), F.lit(2)) == part).withColumn("case_id", F.col("case_id").cast("string"))
        evidence.write_cache(some, f"{base}/cache")
        yield


def _sunk(spark: SparkSession, sf_dir: str, stream, mode: str, last: bool) -> DataFrame:
    """What a stream over the growing cache has put in its sink, after two runs of it."""
    base, schema = f"{shared_dir(spark)}/docketry-tailed-{uuid4().hex}", None
    for _ in _cache_grows(spark, sf_dir, base):
        made = stream(f"{base}/cache")
        schema = made.schema
        sink.start(made, f"{base}/sink", mode).awaitTermination()
    return sink.read_once(spark, f"{base}/sink", schema, last)


def tailed_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drift of the running profile of a cache that is tailed while it grows."""
    totals = _sunk(spark, sf_dir, lambda path: monitor.running_profile(tail.tail_records(spark, path)), "complete", True)
    return monitor.drifts(totals).select("name", F.round("value", 4).alias("value"), F.round("gap", 4).alias("gap"), "alert")


def tailed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of a tailed cache that the sink has, by type."""
    pages = _sunk(spark, sf_dir, lambda path: tail.tail_cache(spark, path, part_bytes=1 << 16), "append", False)
    totals = monitor.totals_by_type(pages)
    return totals.join(pages.groupBy("doc_type").agg(F.count_distinct("case_id", "number").alias("places")), "doc_type")


def streamed_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events a minute over the last sixty of a kind, with alerts, from a stream that keeps them as state."""
    schema = T.StructType(table(spark, sf_dir, "events").schema.fields)
    events = spark.readStream.schema(schema).parquet(f"{sf_dir.rstrip('/')}/events.parque[t]")
    rated = rates.trailing_rates(events, "ts", "event_type", "event_id", reference=USUAL)
    base = f"{shared_dir(spark)}/docketry-rates-{uuid4().hex}"
    sink.start(rated, base).awaitTermination()
    found = sink.read_once(spark, base, rated.schema)
    return found.select("event_id", "n", F.round("per_minute", 4).alias("per_minute"), "alert", "changed", "late")
