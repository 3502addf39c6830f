"""Scoring of decisions and fields against truth: cohorts, routes, fields, confusion, ablation, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed, values
from .calibrate import outcome, outcome_points, smoothed_rate


def population_rates(cases: DataFrame, keys: list[str], flag: Column) -> DataFrame:
    """(keys, n, flagged, rate, smoothed): how often a flag holds in each population."""
    counts = cases.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if(flag).alias("flagged"))
    return counts.withColumns({"rate": F.col("flagged") / F.col("n"), "smoothed": smoothed_rate(F.col("flagged"), F.col("n"))})


def top_values(rows: DataFrame, column: str, k: int) -> DataFrame:
    """(column, n): the ``k`` most frequent values, ties to the smaller one."""
    return rows.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column).limit(k)


def modal_value(rows: DataFrame, group: str, column: str) -> DataFrame:
    """(group, modal, n): the most frequent value of each group, ties to the smaller one."""
    counts = rows.groupBy(group, column).agg(F.count("*").alias("n"))
    return counts.groupBy(group).agg(F.min_by(column, F.struct(-F.col("n"), column)).alias("modal"), F.max("n").alias("n"))


def brier(confidence: Column, correct: Column) -> Column:
    """The squared gap between a confidence and what happened."""
    return F.pow(confidence - correct.cast("double"), F.lit(2.0))


def scored(cases: DataFrame, truth: str = "truth", decision: str = "decision", confidence: str = "confidence") -> DataFrame:
    """``cases`` with ``outcome``, ``points`` and ``brier``."""
    kind = outcome(F.col(truth), F.col(decision))
    return cases.withColumn("outcome", kind).withColumn("points", outcome_points(kind)).withColumn("brier", brier(F.col(confidence), kind == "correct"))


def cohort_report(cases: DataFrame, cohort: str = "cohort", raw: str = "ext_raw", most: str = "ext_max") -> DataFrame:
    """A row for each cohort and one for all: extraction, classification and calibration points, and false approvals."""
    both = cases.select("*", F.explode(F.array(F.lit("all"), F.col(cohort))).alias("group"))
    return both.groupBy("group").agg(
        F.count("*").alias("n"),
        (50.0 * F.sum(raw) / F.greatest(F.sum(most), F.lit(1))).alias("extraction"),
        (80.0 * F.sum("points") / (8 * F.count("*"))).alias("classification"),
        (20.0 * F.greatest(F.lit(0.0), 1 - 2 * F.avg("brier"))).alias("calibration"),
        F.count_if(F.col("outcome") == "false_approval").alias("catastrophic"),
    )


def route_report(cases: DataFrame) -> DataFrame:
    """(route, n, correct): accuracy of each reason's route."""
    return cases.groupBy(values.route(F.col("reason")).alias("route")).agg(F.count("*").alias("n"), F.count_if(F.col("outcome") == "correct").alias("correct"))


def field_report(pairs: DataFrame, weights: dict[str, int] = fixed.FIELD_WEIGHTS) -> DataFrame:
    """(field, ok, wrong, blank, accuracy, lost) from rows (case_id, field, truth, read): fields stacked, not one by one."""
    weight = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in weights.items() for x in p]), F.col("field")), F.lit(1))
    blank = F.coalesce(F.col("read"), F.lit("")) == ""
    same = F.coalesce(F.lower(F.trim("truth")) == F.lower(F.trim("read")), F.lit(False))
    return pairs.groupBy("field").agg(
        F.count_if(same).alias("ok"), F.count_if(~same & ~blank).alias("wrong"), F.count_if(~same & blank).alias("blank"),
        (F.count_if(same) / F.count("*")).alias("accuracy"), F.sum(F.when(~same, weight).otherwise(0)).cast("long").alias("lost"),
    )


def confusion(pairs: DataFrame, truth: str, read: str) -> DataFrame:
    """Counts of (truth, read)."""
    return pairs.groupBy(F.col(truth).alias("truth"), F.col(read).alias("read")).agg(F.count("*").alias("n"))


def ablation(cases: DataFrame, scenarios: dict[str, Column], truth: str = "truth") -> DataFrame:
    """Classification points of each scenario's decision; all scenarios in one pass over the cases."""
    rows = F.array(*[F.struct(F.lit(name).alias("scenario"), decision.alias("decision")) for name, decision in scenarios.items()])
    each = cases.select(F.col(truth).alias("truth"), F.explode(rows).alias("s")).select("truth", "s.*")
    return each.groupBy("scenario").agg(F.sum(outcome_points(outcome(F.col("truth"), F.col("decision")))).cast("long").alias("points"), F.count("*").alias("n"))


def flag_coverage(cases: DataFrame) -> DataFrame:
    """(flag, truth, emitted, printed_missed, absent_missed, false_positive) from arrays ``truth``, ``read`` and ``printed`` of flags."""
    flags = cases.select("*", F.explode(F.array_distinct(F.concat("truth", "read"))).alias("flag"))
    has = lambda c: F.array_contains(c, F.col("flag"))
    missed = has("truth") & ~has("read")
    return flags.groupBy("flag").agg(
        F.count_if(has("truth")).alias("truth"), F.count_if(has("truth") & has("read")).alias("emitted"),
        F.count_if(missed & has("printed")).alias("printed_missed"), F.count_if(missed & ~has("printed")).alias("absent_missed"),
        F.count_if(~has("truth") & has("read")).alias("false_positive"),
    )


def recovered_and_invented(cases: DataFrame) -> DataFrame:
    """(flag, recovered, invented): what a second reading adds beyond the first, right and wrong."""
    added = cases.select("truth", F.explode(F.array_except("second", "first")).alias("flag"))
    return added.groupBy("flag").agg(F.count_if(F.array_contains("truth", F.col("flag"))).alias("recovered"), F.count_if(~F.array_contains("truth", F.col("flag"))).alias("invented"))


def cued(field: Column, blob: Column, cues: dict[str, str] = fixed.EVIDENCE_CUES) -> Column:
    """Whether a packet's text holds what a field could have been read from; false for null and for other fields."""
    shown = F.lit(False)
    for name, pattern in cues.items():
        shown = F.when(field == name, F.coalesce(blob.rlike(pattern), F.lit(False))).otherwise(shown)
    return shown


def recoverable_share(pairs: DataFrame) -> DataFrame:
    """(field, right, cued, share): of fields whose cue is on the page, how many are right; others leave both sides."""
    cued = pairs.where("cued")
    return cued.groupBy("field").agg(F.count_if(F.col("truth") == F.col("read")).alias("right"), F.count("*").alias("cued")).withColumn("share", F.col("right") / F.col("cued"))


def first_n_cohort(cases: DataFrame, n: int, order: str, first: str = "fit", rest: str = "holdout") -> DataFrame:
    """``cases`` with ``cohort``: the first ``n`` by a unique order column, found by a top-n instead of a global rank."""
    edge = cases.select(order).orderBy(order).limit(n).agg(F.max(order).alias("__edge"))
    joined = cases.crossJoin(F.broadcast(edge))  # one row
    return joined.withColumn("cohort", F.when(F.col(order) <= F.col("__edge"), first).otherwise(rest)).drop("__edge")


def unpivot(cases: DataFrame, key: str, fields: dict[str, tuple[Column, Column]]) -> DataFrame:
    """(key, field, truth, read), a row for each field of a case."""
    rows = F.array(*[F.struct(F.lit(n).alias("field"), t.cast("string").alias("truth"), r.cast("string").alias("read")) for n, (t, r) in fields.items()])
    return cases.select(key, F.explode(rows).alias("f")).select(key, "f.*")


def first_k(rows: DataFrame, group: str, order: list[Column | str], k: int) -> DataFrame:
    """The first ``k`` rows of each group as examples; the limit is pushed below the shuffle."""
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("place") <= k)
