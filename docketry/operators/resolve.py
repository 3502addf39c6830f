"""Conflict resolution: the best reading by authority, the spelling that sources agree on, clean over damaged."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed, fuzzy, text
from ..functions.values import lexicon_support
from ..sources.shared import tasks_for
from .candidates import CORRECTION

#: Fields whose spelling is voted on; flags keep the single best reading.
VOTED = tuple(f for f in fixed.SCORED if f != "risk_flags")


def _order(rank="rank", exact="exact", page="page", seq="seq") -> Column:
    return F.struct(F.col(rank), ~F.col(exact), F.col(page), F.col(seq))


def best_by_authority(found: DataFrame) -> DataFrame:
    """One reading for each case and field: lowest rank, then exact, then first page, then first seen."""
    fields = F.struct("value", "rank", "exact", "page", "doc_type", "seq")
    return found.groupBy("case_id", "field").agg(F.min_by(fields, _order()).alias("best")).select("case_id", "field", "best.*")


def _similar(found: DataFrame, chosen: DataFrame, approximate: bool) -> DataFrame:
    """Readings that are the chosen value of their case and field, or near enough to it."""
    picked = chosen.select("case_id", "field", F.col("value").alias("chosen"))
    near = found.join(picked, ["case_id", "field"])
    a, b = text.squash_lower(F.col("value")), text.squash_lower(F.col("chosen"))
    if not approximate:
        return near.where(a == b)
    return near.where((a == b) | ((fuzzy.ratio_bound(a, b) >= fixed.SAME_AT) & (fuzzy.ratio_udf(a, b) >= fixed.SAME_AT)))


def consensus(found: DataFrame, chosen: DataFrame) -> DataFrame:
    """``chosen`` with the reading that the similar ones agree on: vocabulary, votes, exactness, rank, first seen."""
    similar = _similar(found.where(F.col("field").isin(*VOTED)), chosen.where(F.col("doc_type") != CORRECTION), True)
    return _replace(chosen, vote(similar))


def vote(similar: DataFrame) -> DataFrame:
    """(case_id, field, votes, won): the reading most agreed on, of cases and fields with two readings or more."""
    fields = F.struct("value", "rank", "exact", "page", "doc_type", "seq")
    tally = similar.groupBy("case_id", "field", "value").agg(
        F.count("*").alias("votes"), F.max("exact").alias("any_exact"), F.min("rank").alias("low"), F.min("seq").alias("first"), F.min_by(fields, "seq").alias("reading")
    )
    order = F.struct(-lexicon_support(F.col("field"), F.col("value")), -F.col("votes"), ~F.col("any_exact"), F.col("low"), F.col("first"))
    return tally.groupBy("case_id", "field").agg(F.sum("votes").alias("votes"), F.min_by("reading", order).alias("won")).where("votes > 1")


def prefer_clean(found: DataFrame, chosen: DataFrame, approximate: bool = True) -> DataFrame:
    """``chosen`` with damaged readings replaced by the first exact reading of the same value."""
    damaged = chosen.where((F.col("doc_type") != CORRECTION) & ~F.col("exact") & F.col("field").isin(*VOTED))
    fields = F.struct("value", "rank", "exact", "page", "doc_type", "seq")
    clean = _similar(found.where("exact"), damaged, approximate).groupBy("case_id", "field").agg(F.min_by(fields, "seq").alias("won"))
    return _replace(chosen, clean)


def best_and_clean(found: DataFrame) -> DataFrame:
    """``prefer_clean(found, best_by_authority(found), approximate=False)`` with one shuffle of the readings and no join.

    A twin has the key of the chosen value, so it is enough to keep of each key its best reading and its
    first exact one; the key with the best reading of all is the chosen one's.
    """
    inexact, has_seq = ~F.col("exact"), F.col("seq").isNotNull()
    best = F.struct("rank", inexact.alias("inexact"), "page", "seq", "value", "doc_type")
    clean = F.when(F.col("exact") & has_seq, F.struct("seq", "value", "rank", "page", "doc_type"))
    dealt = found.repartition("case_id", "field").withColumn("key", text.squash_lower(F.col("value")))
    keyed = dealt.groupBy("case_id", "field", "key").agg(F.min(best).alias("best"), F.min(clean).alias("clean"))
    chosen = keyed.groupBy("case_id", "field").agg(F.min(F.struct("best", "key", "clean")).alias("won")).select("case_id", "field", "won.*")
    damaged = (F.col("best.doc_type") != CORRECTION) & F.col("best.inexact") & F.col("field").isin(*VOTED)
    taken = damaged & F.col("case_id").isNotNull() & F.col("key").isNotNull() & F.col("clean").isNotNull()
    of = lambda c: F.when(taken, F.col(f"clean.{c}")).otherwise(F.col(f"best.{c}")).alias(c)
    exact = F.when(taken, F.lit(True)).otherwise(~F.col("best.inexact")).alias("exact")
    return chosen.select("case_id", "field", of("value"), of("rank"), exact, of("page"), of("doc_type"), of("seq"))


def _replace(chosen: DataFrame, won: DataFrame) -> DataFrame:
    joined = chosen.join(won.select("case_id", "field", "won"), ["case_id", "field"], "left")
    columns = ("value", "rank", "exact", "page", "doc_type", "seq")
    return joined.select("case_id", "field", *[F.when(F.col("won").isNotNull(), F.col(f"won.{c}")).otherwise(F.col(c)).alias(c) for c in columns])


def resolve(found: DataFrame) -> DataFrame:
    """One reading for each case and field after all three steps: ``prefer_clean(found, consensus(found, best_by_authority(found)))``.

    Readings move once, to their case, and are one row for each value from there on, which moves once
    more after each approximate match: what is near the chosen reading is so by its value, so each step
    is a window over the case's values of a field, and nothing is joined.
    """
    fields, order = F.struct("value", "rank", "exact", "page", "doc_type", "seq"), _order()
    seen_clean = F.when(F.col("exact"), F.col("seq"))
    tally = found.repartition(tasks_for(found), "case_id").groupBy("case_id", "field", "value").agg(
        F.count("*").alias("votes"), F.max("exact").alias("any_exact"), F.min("rank").alias("low"), F.min("seq").alias("first"), F.min_by(fields, "seq").alias("reading"),
        F.min(order).alias("order"), F.min_by(fields, order).alias("best"), F.min(seen_clean).alias("clean_at"), F.min_by(fields, seen_clean).alias("clean"),
    )
    of_field = Window.partitionBy("case_id", "field")
    voted = F.col("field").isin(*VOTED) & F.col("case_id").isNotNull()

    def near(chosen: Column, also: Column) -> Column:
        a, b = F.col("key"), text.squash_lower(chosen["value"])
        open_ = voted & (chosen["doc_type"] != CORRECTION) & also
        ratio = fuzzy.ratio_udf(F.when(open_ & (a != b) & (fuzzy.ratio_bound(a, b) >= fixed.SAME_AT), a), b)
        return open_ & ((a == b) | (ratio >= fixed.SAME_AT))

    keyed = tally.withColumn("key", text.squash_lower(F.col("value"))).withColumn("chosen", F.min_by("best", "order").over(of_field))
    support = F.struct(-lexicon_support(F.col("field"), F.col("value")), -F.col("votes"), ~F.col("any_exact"), F.col("low"), F.col("first"))
    agreed = keyed.withColumn("near", near(F.col("chosen"), F.lit(True)))
    agreed = agreed.withColumns({"total": F.sum(F.when(F.col("near"), F.col("votes"))).over(of_field), "won": F.min_by("reading", F.when(F.col("near"), support)).over(of_field)})
    agreed = agreed.withColumn("chosen", F.when((F.col("total") > 1) & F.col("won").isNotNull(), F.col("won")).otherwise(F.col("chosen")))
    clean = agreed.withColumn("near", near(F.col("chosen"), ~F.col("chosen.exact") & F.col("clean_at").isNotNull()))
    last = clean.groupBy("case_id", "field").agg(F.any_value("chosen").alias("chosen"), F.min_by("clean", F.when(F.col("near"), F.col("clean_at"))).alias("won"))
    return last.select("case_id", "field", F.when(F.col("won").isNotNull(), F.col("won")).otherwise(F.col("chosen")).alias("best")).select("case_id", "field", "best.*")


def records(resolved: DataFrame, fields: tuple[str, ...] = fixed.SCORED) -> DataFrame:
    """A row a case with a column for each field; unread fields are null."""
    return resolved.groupBy("case_id").pivot("field", list(fields)).agg(F.first("value"))


def count_identities(rows: DataFrame, case: str, order: str, name: str, at: float = fixed.IDENTITY_AT) -> DataFrame:
    """(case, n_names): how many different names each case has; every name is compared with the first of each one before it.

    Of spellings that are equal squashed the first stays, by a partial aggregate: another one can't differ
    from all before it. The rest is sorted by case and order and streamed; a task holds the first names of
    the case that it is at, nothing else, however many rows the case has. Null names are left out.
    """
    kind = rows.schema[case].dataType
    named = rows.where(F.col(name).isNotNull()).select(F.col(case).alias("case"), F.col(order).alias("order"), F.col(name).alias("name"), text.squash_lower(F.col(name)).alias("key"))
    firsts = named.groupBy("case", "key").agg(F.min("order").alias("order"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, found, done = None, [], []
        for batch in batches:
            kinds = batch.column("case").type
            for of, key in zip(batch.column("case").to_pylist(), batch.column("key").to_pylist(), strict=True):
                if not found or of != now:
                    if found:
                        done.append((now, len(found)))
                    now, found = of, []
                if all(fuzzy.ratio(key, first) < at for first in found):
                    found.append(key)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], kinds), pa.array([d[1] for d in done], pa.int32())], [case, "n_names"])
                done = []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([now], kinds), pa.array([len(found)], pa.int32())], [case, "n_names"])

    schema = T.StructType([T.StructField(case, kind), T.StructField("n_names", T.IntegerType())])
    return firsts.repartition("case").sortWithinPartitions("case", "order").select("case", "key").mapInArrow(run, schema)


def identity_conflict(found: DataFrame) -> DataFrame:
    """(case_id, n_names, conflict): labelled names of the case, clustered in the order they are seen."""
    names = found.where((F.col("field") == "applicant_name") & (F.col("seq.step") == 1) & (F.col("doc_type") != CORRECTION))
    return count_identities(names, "case_id", "seq", "value").withColumn("conflict", F.col("n_names") > 1)
