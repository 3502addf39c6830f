"""The rule engine: every rule adds to denials, reviews or approvals; denials decide before doubts, doubts before approval."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, fuzzy, text, values
from .typing import authority, first_stated


def reference_date(dates: DataFrame, column: str, since: int = 2000, least: int = 20, share: float = 0.95) -> DataFrame:
    """One row (reference_date): the element at ``floor(n * share)`` of the usable dates in order, null below ``least``.

    Dates are counted by value first, so the order is taken over distinct days, not over rows.
    """
    days = dates.select(F.col(column).cast("date").alias("d")).where(F.year("d") >= since).groupBy("d").agg(F.count("*").alias("n"))
    days = days.agg(F.array_sort(F.collect_list(F.struct("d", "n"))).alias("days"), F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    rank = F.floor(F.col("total") * F.lit(share))
    start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("date").alias("at"))
    walked = F.aggregate(
        "days", start,
        lambda acc, x: F.struct((acc["seen"] + x["n"]).alias("seen"), F.when(acc["at"].isNull() & (acc["seen"] + x["n"] > rank), x["d"]).otherwise(acc["at"]).alias("at")),
        lambda acc: acc["at"],
    )
    return days.select(F.when(F.col("total") >= least, walked).alias("reference_date"))


def note_on_page(all_lines: Column, page_text: Column) -> dict[str, Column]:
    """Columns that together tell what a note decides: a labelled decision, a damaged one, a bare one.

    A labelled decision counts on any note, a damaged one too; a bare decision word only where the
    page bears no mark of a sample or copy.
    """
    labelled = values.decision_word(F.regexp_extract(page_text, fixed.FINDING_PATTERN, 1))
    bare = F.element_at(F.concat(F.filter(all_lines, lambda x: x.rlike(fixed.BARE_DECISION_PATTERN)), F.array(F.lit(None).cast("string"))), 1)
    bare = F.when(~page_text.rlike(fixed.DECOY_PATTERN), values.decision_word(F.trim(bare)))
    return {"__labelled": labelled, "__bare": bare}


def _all_lines() -> Column:
    return text.all_lines(F.col("lines"), F.col("ocr_lines"), F.col("second_lines"))


def page_signals(pages: DataFrame) -> DataFrame:
    """Pages with ``all_lines``, ``page_text`` and what each says: ``decision`` (of a note), ``hazard`` and ``embargoed``."""
    whole = pages.withColumn("all_lines", _all_lines()).withColumn("page_text", F.array_join("all_lines", " "))
    is_note = F.col("doc_type") == "adjudicator_note"
    notes = {name: F.when(is_note, c) for name, c in note_on_page(F.col("all_lines"), F.col("page_text")).items()}
    noted = whole.withColumns(notes).withColumn("__damaged", fuzzy.decision_udf(F.when(is_note & F.col("__labelled").isNull(), F.col("page_text"))))
    word = F.nullif(F.lower(F.regexp_extract("page_text", fixed.BIOHAZARD_PATTERN, 1)), F.lit(""))
    clean = F.exists(F.array(*map(F.lit, fixed.BIOHAZARD_CLEAN)), lambda p: F.startswith(word, p))
    red = F.contains(F.translate(F.lower("page_text"), " ", "_"), F.lit("biohazard_red"))
    status = F.upper(F.regexp_extract("page_text", fixed.REGISTRY_STATUS_PATTERN, 1))
    said = {
        "decision": F.coalesce("__labelled", "__damaged", "__bare"),
        "hazard": F.when(red, "adverse").when(word.isNotNull(), F.when(clean, "clean").otherwise("adverse")),
        "embargoed": F.startswith(status, F.lit("EMBARGO")),
    }
    return noted.withColumns(said).drop("__labelled", "__bare", "__damaged")


def case_signals() -> dict[str, Column]:
    """Aggregates over the signals of a case's pages: the first note by number, the most trusted word on the hazard, any embargo."""
    decided = F.col("decision").isNotNull()
    return {
        "note": F.min_by(F.struct("decision", "page_text"), F.when(decided, F.col("number"))),
        "biohazard": first_stated(F.col("hazard"), authority(F.col("doc_type")), "number"),
        "embargo": F.bool_or("embargoed"),
    }


def _of_case(pages: DataFrame, name: str) -> DataFrame:
    return page_signals(pages).groupBy("case_id").agg(case_signals()[name].alias(name))


def note_decision(pages: DataFrame) -> DataFrame:
    """(case_id, note_decision, note_text): the first page by number, typed a note, that states a decision."""
    noted = _of_case(pages, "note").where("note is not null")
    return noted.select("case_id", F.col("note.decision").alias("note_decision"), F.col("note.page_text").alias("note_text"))


def biohazard(pages: DataFrame) -> DataFrame:
    """(case_id, biohazard): clean or adverse by the most trusted page that says."""
    return _of_case(pages, "biohazard").where("biohazard is not null")


def registry_embargo(pages: DataFrame) -> DataFrame:
    """(case_id, embargo): whether any page states a registry status of embargo."""
    return _of_case(pages, "embargo")


def _given(value: Column) -> Column:
    return F.coalesce(value, F.lit("")) != ""


def _pick(*rules: tuple[Column, Column | str]) -> Column:
    """Names of the rules that hold, in this order."""
    return F.array_compact(F.array(*[F.when(when, F.lit(name) if isinstance(name, str) else name) for when, name in rules]))


def apply_rules(
    cases: DataFrame,
    record: dict[str, Column],
    *,
    risk_known: Column,
    fee_known: Column,
    fee_contested: Column,
    reference: Column,
    note: Column | None = None,
    note_text: Column | None = None,
    biohazard_state: Column | None = None,
    waiver_visible: Column | None = None,
    revoked: Column | None = None,
    stale_days: int = fixed.STALE_DAYS,
) -> DataFrame:
    """``cases`` with decision, reason, denials, reviews and approvals.

    The buckets are columns of their own before the decision reads them, so none is computed twice.
    ``record`` maps visa_class, fee_status, sponsor_id, home_world, arrival_date, risk_flags (an
    array) and the required fields to columns. The order of the rules is the order of the reasons.
    """
    null = F.lit(None).cast("string")
    note, note_text = (null if x is None else x for x in (note, note_text))
    biohazard_state = null if biohazard_state is None else biohazard_state
    waiver_visible = F.lit(False) if waiver_visible is None else F.coalesce(waiver_visible, F.lit(False))
    visa, fee, world = (F.coalesce(record[x], F.lit("")) for x in ("visa_class", "fee_status", "home_world"))
    sponsor, flags, arrival = record["sponsor_id"], F.coalesce(record["risk_flags"], F.array().cast("array<string>")), record["arrival_date"].try_cast("date")
    revoked = sponsor.isin(*fixed.REVOKED_SPONSORS) if revoked is None else revoked
    revoked, has_sponsor = F.coalesce(revoked, F.lit(False)), _given(sponsor)
    diplomatic, embargoed = visa == fixed.DIPLOMATIC, world.isin(*fixed.EMBARGOED)
    readable = ~fee_contested & fee_known
    verified = diplomatic | waiver_visible
    stale = F.coalesce(F.datediff(reference, arrival) > stale_days, F.lit(False))
    dated = arrival.isNotNull() & reference.isNotNull()
    claims_waiver = F.coalesce(note_text.rlike("(?i)waiver"), F.lit(False))

    def each(names: tuple[str, ...], prefix: str) -> Column:
        return F.transform(F.filter(flags, lambda f: f.isin(*names)), lambda f: F.concat(F.lit(prefix), f))

    denials = F.concat(
        each(fixed.DISQUALIFYING, "disqualifying_flag:"),
        _pick(
            (visa == fixed.TRANSIT, "transit_visa"),
            (embargoed, "embargoed_home_world"),
            (~embargoed & world.isin(*fixed.EMBARGOED_UNLESS_DIPLOMATIC) & (visa != "") & ~diplomatic, "embargoed_home_world_nondip"),
            (revoked, "revoked_sponsor"),
            ((visa == fixed.MEDICAL) & F.coalesce(biohazard_state == "adverse", F.lit(False)), "med3_biohazard_adverse"),
            (readable & (fee == "unpaid") & ~claims_waiver, "unpaid_fee"),
            (~has_sponsor & ~diplomatic, "missing_sponsor"),
            (dated & stale & ~diplomatic, "stale_application"),
        ),
    )
    reviews = F.concat(
        _pick(
            (fee_contested, "fee_contested"),
            (~fee_contested & ~fee_known, "fee_unknown"),
            (readable & (fee == "unpaid") & claims_waiver, "unpaid_fee_with_waiver_claim"),
            (readable & (fee == "waived") & ~verified, "waiver_unverified"),
            (readable & fee.isin("unknown", ""), "fee_unknown"),
            (arrival.isNull(), "arrival_date_missing"),
        ),
        each(fixed.REVIEWING, "review_flag:"),
        _pick((~risk_known, "risk_unobserved"), *[(~_given(record[f]), f"missing:{f}") for f in fixed.REQUIRED if f in record]),
    )
    approvals = _pick(
        (~revoked & has_sponsor, "sponsor_present"),
        (readable & (fee == "paid"), "fee_paid"),
        (readable & (fee == "waived") & verified, "valid_fee_waiver"),
        (diplomatic, "diplomatic_sponsor_exemption"),
        (dated & stale & diplomatic, "stale_diplomatic_exemption"),
        (dated & ~stale, "application_current"),
        (risk_known & (F.size(flags) == 0), "no_visible_risk"),
    )
    none = F.array().cast("array<string>")
    settled = F.coalesce(note.isin(*fixed.DECISIONS), F.lit(False))
    listed = cases.withColumns({"denials": denials, "reviews": reviews, "approvals": approvals, "__settled": settled, "__note": note})
    denied, doubted = F.size("denials") > 0, F.size("reviews") > 0
    settled = F.col("__settled")
    decision = F.when(settled, F.col("__note")).when(denied, "DENIED").when(doubted, "NEEDS_REVIEW").otherwise("APPROVED")
    reason = F.when(settled, "adjudicator_note").when(denied, F.get("denials", F.lit(0))).when(doubted, F.get("reviews", F.lit(0))).otherwise("clean")
    decided = listed.withColumns({"decision": decision, "reason": reason})
    kept = {b: F.when(settled, none).otherwise(F.col(b)) for b in ("denials", "reviews")}
    kept["approvals"] = F.when(settled, F.array(F.lit("adjudicator_note"))).otherwise(F.col("approvals"))
    return decided.withColumns(kept).drop("__settled", "__note")
