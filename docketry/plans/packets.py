"""From pages to predictions: the whole decision plan over case packets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, text
from ..operators import calibrate, candidates, fees, output, resolve, rules, typing
from ..sources.shared import materialised, tasks_for


def typed_pages(pages: DataFrame) -> DataFrame:
    """Pages without injected lines on scanned pages, typed anew from what is left."""
    scanned = typing.strip_injected(pages.where("source = 'ocr'"))
    return typing.classify(scanned.unionByName(pages.where("source <> 'ocr' or source is null")))


def record_facts(pages: DataFrame) -> DataFrame:
    """One row a case: resolved fields, fee state, note, biohazard, registry, and which flags were seen."""
    pages = materialised(pages, "typed")
    found = materialised(candidates.candidates(pages), "candidates")
    record = resolve.records(resolve.resolve(found))
    said = {**fees.case_aggregates(), **rules.case_signals()}
    facts = fees.page_facts(rules.page_signals(pages.repartition(tasks_for(pages), "case_id"))).groupBy("case_id").agg(*[c.alias(name) for name, c in said.items()])
    cases = facts.join(record, "case_id", "left").withColumns({"note_decision": F.col("note.decision"), "note_text": F.col("note.page_text")}).drop("note")
    owed, code = fees.amount(F.col("blob")), fees.waiver_code(F.col("blob"))
    cases = cases.withColumn("waiver_visible", code.isNotNull())
    cases = cases.withColumn("fee", fees.ladder(F.col("stated"), F.col("unpaid_note"), owed, code, F.col("fee_status")))
    embargo = F.coalesce("embargo", F.lit(False))
    mined = F.coalesce(text.flags_in(F.col("note_text")), F.array().cast("array<string>"))
    added = F.when(embargo, F.array(F.lit("planetary_embargo"))).otherwise(F.array().cast("array<string>"))
    flags = F.array_sort(F.array_union(F.array_union(text.flag_set(F.coalesce("risk_flags", F.lit(""))), mined), added))
    return cases.withColumn("risk_known", F.col("risk_flags").isNotNull() | embargo).withColumn("risk_flags", flags)


def decide(pages: DataFrame, table: DataFrame | None = None) -> DataFrame:
    """A prediction for each case of typed pages; ``table`` is a fitted calibration table."""
    cases = materialised(record_facts(pages), "facts")
    reference = rules.reference_date(cases.withColumn("d", F.col("arrival_date").try_cast("date")), "d")
    cases = cases.crossJoin(F.broadcast(reference))  # one row
    record = {f: F.col(f) for f in fixed.SCORED if f != "fee_status"} | {"fee_status": F.col("fee.status")}
    decided = rules.apply_rules(
        cases, record, risk_known=F.col("risk_known"), fee_known=F.col("fee.known"), fee_contested=F.col("fee.contested"), reference=F.col("reference_date"),
        note=F.col("note_decision"), note_text=F.col("note_text"), biohazard_state=F.col("biohazard"), waiver_visible=F.col("waiver_visible"),
    )
    decided = decided.withColumn("fee_status", F.col("fee.status"))
    keys = calibrate.evidence_keys(F.col("reason"), F.col("fee_status"), F.col("visa_class"), F.col("risk_flags"), F.col("reviews"), F.col("approvals"))
    decided = decided.withColumn("keys", keys)
    if table is None:
        table = decided.sparkSession.createDataFrame([], "bucket string, truth string, n long")
    judged = calibrate.confidence(decided, table)
    flags = F.when(F.size("risk_flags") > 0, F.array_join("risk_flags", "|")).otherwise("none")
    filled = judged.withColumn("risk_flags", flags).withColumn("adjudication", F.col("decision"))
    blank = {f: F.coalesce(f, F.lit("")) for f in fixed.SCORED if f not in ("risk_flags", "fee_status")}
    columns = ["case_id", *fixed.SCORED[:7], "risk_flags", "fee_status", "adjudication", "confidence", "reason", "denials", "reviews", "approvals", "keys"]
    return output.finalize(filled.withColumns(blank)).select(*columns)
