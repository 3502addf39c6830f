"""Calibration: counts of true decisions by evidence bucket, and confidence from the finest bucket that has enough."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed, values
from ..sources.shared import materialised

#: Buckets, of some 200 bytes each, whose table is broadcast; keys of a case.
BROADCAST_BUCKETS, KEYS = 50_000, 6


def evidence_keys(reason: Column, fee: Column, visa: Column, flags: Column, reviews: Column, approvals: Column) -> Column:
    """Six bucket names of a case, the most specific first; they overlap and are no rollup."""
    way = values.route(reason)
    fee, visa = (F.coalesce(F.nullif(x, F.lit("")), F.lit("none")) for x in (fee, visa))
    risk = F.when(F.size(flags) > 0, "flagged").otherwise("clear")
    counts = F.concat(F.lit("|support="), F.least(F.size(approvals), F.lit(4)), F.lit("|doubts="), F.least(F.size(reviews), F.lit(3)))
    of_fee, of_visa, of_risk = F.concat(F.lit("|fee="), fee), F.concat(F.lit("|visa="), visa), F.concat(F.lit("|risk="), risk)
    return F.array(F.concat(way, of_fee, of_visa, of_risk), F.concat(way, of_fee, counts), F.concat(way, of_visa, of_risk), F.concat(way, counts), F.concat(way, of_risk), way)


TABLE = "schema int, min_observations int, min_margin double, buckets map<string,map<string,bigint>>"


def save_table(table: DataFrame, path: str, least: int = fixed.LEAST_OBSERVATIONS, margin: float = fixed.LEAST_MARGIN) -> None:
    """Write a fitted table as one JSON record: its version, its settings, and the counts of each truth by bucket."""
    truths = table.groupBy("bucket").agg(F.map_from_entries(F.collect_list(F.struct("truth", "n"))).alias("by_truth"))
    record = truths.agg(F.map_from_entries(F.collect_list(F.struct("bucket", "by_truth"))).alias("buckets"))
    record = record.select(F.lit(1).alias("schema"), F.lit(least).alias("min_observations"), F.lit(float(margin)).alias("min_margin"), "buckets")
    record.coalesce(1).write.mode("overwrite").json(path)


def load_table(spark: SparkSession, path: str) -> DataFrame | None:
    """(bucket, truth, n) of a saved table; None where there is none, it can't be read, or its version is another."""
    try:
        record = spark.read.schema(TABLE).option("multiLine", True).json(path).where("schema = 1 and buckets is not null")
        if record.isEmpty():
            return None
    except AnalysisException:
        return None
    return record.select(F.explode("buckets").alias("bucket", "by_truth")).select("bucket", F.explode("by_truth").alias("truth", "n"))


def fit(cases: DataFrame, keys: str = "keys", truth: str = "truth", reason: str = "reason") -> DataFrame:
    """(bucket, truth, n) of cases that no note settled; each case feeds all its buckets."""
    open_ = cases.where(values.route(F.col(reason)) != "adjudicator_note")
    return open_.select(F.explode(keys).alias("bucket"), F.col(truth).alias("truth")).groupBy("bucket", "truth").agg(F.count("*").alias("n"))


def confidence(cases: DataFrame, table: DataFrame, least: int = fixed.LEAST_OBSERVATIONS, case: str = "case_id") -> DataFrame:
    """``cases`` with ``confidence``: the share of the first bucket with enough cases, else the route's, else the default.

    The decision never changes. A case that a note settled takes its route's confidence. While there
    are at most ``BROADCAST_BUCKETS`` buckets with enough cases, which is counted, cases don't move.
    """
    settled = values.route(F.col("reason")) == "adjudicator_note"
    routes = F.create_map(*[F.lit(x) for pair in fixed.ROUTE_CONFIDENCE.items() for x in pair])
    fallback = F.coalesce(F.try_element_at(routes, values.route(F.col("reason"))), F.lit(fixed.DEFAULT_CONFIDENCE))
    counts = table.groupBy("bucket").agg(F.sum("n").alias("total"), F.map_from_entries(F.collect_list(F.struct("truth", "n"))).alias("by_truth"))
    counts = materialised(counts.where(F.col("total") >= least), "buckets")
    share = lambda by_truth, total: F.coalesce(F.try_element_at(by_truth, F.col("decision")), F.lit(0)) / total
    if counts.count() <= BROADCAST_BUCKETS:
        found = cases
        for i in range(KEYS):
            of = F.broadcast(counts.select(F.col("bucket").alias(f"__b{i}"), F.struct("by_truth", "total").alias(f"__c{i}")))
            found = found.join(of, F.get("keys", F.lit(i)) == F.col(f"__b{i}"), "left")
        shares = [share(F.col(f"__c{i}.by_truth"), F.col(f"__c{i}.total")) for i in range(KEYS)]
        judged = found.withColumn("confidence", F.coalesce(F.when(~settled, F.coalesce(*shares)), fallback))
        return judged.drop(*[f"__{x}{i}" for i in range(KEYS) for x in "bc"])
    keyed = cases.where(~settled).select(F.col(case).alias("__case"), "decision", F.posexplode("keys").alias("pos", "bucket"))
    hit = keyed.join(counts, "bucket").withColumn("share", share(F.col("by_truth"), F.col("total")))
    first = hit.groupBy("__case").agg(F.min_by("share", "pos").alias("__share"))
    return cases.join(first, F.col(case) == F.col("__case"), "left").withColumn("confidence", F.coalesce("__share", fallback)).drop("__case", "__share")


def points(decision: Column, truth: Column) -> Column:
    """What a decision scores against the truth."""
    return outcome_points(outcome(truth, decision))


def outcome(truth: Column, decision: Column) -> Column:
    """The kind of hit or miss, in order of precedence."""
    return (
        F.when(truth == decision, "correct")
        .when(decision == "NEEDS_REVIEW", "to_review")
        .when(truth == "NEEDS_REVIEW", "missed_review")
        .when((decision == "APPROVED") & (truth == "DENIED"), "false_approval")
        .otherwise("wrong")
    )


def outcome_points(kind: Column) -> Column:
    """Points of a kind of outcome."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in fixed.OUTCOME_POINTS.items() for x in pair]), kind)


def expected_scores(table: DataFrame) -> DataFrame:
    """(bucket, decision, expected): the mean points of each decision in each bucket."""
    decisions = table.select("*", F.explode(F.array(*map(F.lit, fixed.DECISIONS))).alias("decision"))
    return decisions.groupBy("bucket", "decision").agg((F.sum(points(F.col("decision"), F.col("truth")) * F.col("n")) / F.sum("n")).alias("expected"))


def smoothed_rate(correct: Column, n: Column) -> Column:
    """A rate under a Beta(2, 2) prior."""
    return (correct + 2) / (n + 4)
