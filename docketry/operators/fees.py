"""The fee ladder: what a case's pages say of its fee, whether that is known, and whether it is contested."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, text
from .typing import authority, first_stated


def amount(blob: Column) -> Column:
    """The first stated amount, thousands marks removed, or null."""
    digits = F.regexp_replace(F.regexp_extract(blob, fixed.AMOUNT_PATTERN, 1), ",", "")
    return F.nullif(digits, F.lit("")).try_cast("double")


def waiver_code(blob: Column) -> Column:
    """The first stated waiver code that isn't a word for none, or null."""
    code = F.regexp_replace(F.upper(F.regexp_extract(blob, fixed.WAIVER_PATTERN, 1)), r"\.+$", "")
    return F.when(~code.isin(*fixed.NO_WAIVER), code)


def page_facts(pages: DataFrame) -> DataFrame:
    """Pages with their whole text (``page_text``, made unless it is there) and what each states: a fee, an unpaid note."""
    if "page_text" not in pages.columns:
        lines = text.all_lines(F.col("lines"), F.col("ocr_lines"), F.col("second_lines"))
        pages = pages.withColumn("page_text", F.array_join(lines, " "))
    facts = pages.withColumn("authority", authority(F.col("doc_type")))
    stated = F.nullif(F.lower(F.regexp_extract("page_text", fixed.STATED_FEE_PATTERN, 1)), F.lit(""))
    note = (F.col("doc_type") == "adjudicator_note") & F.col("page_text").rlike(fixed.UNPAID_PATTERN)
    return facts.withColumn("stated_fee", stated).withColumn("unpaid_note", note)


def case_aggregates() -> dict[str, Column]:
    """Aggregates over ``page_facts`` of a case: text of all pages in order, the most trusted stated fee, the unpaid note."""
    texts = F.transform(F.array_sort(F.collect_list(F.struct("number", "page_text"))), lambda p: p["page_text"])
    return {
        "blob": F.array_join(texts, " "),
        "stated": first_stated(F.col("stated_fee"), "authority", "number"),
        "unpaid_note": F.coalesce(F.bool_or("unpaid_note"), F.lit(False)),
    }


def case_facts(facts: DataFrame) -> DataFrame:
    """One row a case of ``case_aggregates``."""
    return facts.groupBy("case_id").agg(*[c.alias(name) for name, c in case_aggregates().items()])


def ladder(stated: Column, unpaid_note: Column, owed: Column, code: Column, literal: Column) -> Column:
    """A struct of the fee's status, whether anything readable supports it, and whether evidence conflicts.

    In order: a stated fee (a waiver of nothing without a code is contested), an unpaid note, the
    amount and code, a literal reading, and at last the modal guess, which is not known.
    """

    def state(status: Column | str, known: bool, contested: bool) -> Column:
        status = F.lit(status) if isinstance(status, str) else status
        return F.struct(status.alias("status"), F.lit(known).alias("known"), F.lit(contested).alias("contested"))

    hollow = (stated == "waived") & F.coalesce(owed == 0, F.lit(False)) & code.isNull()
    return (
        F.when(hollow, state("unknown", True, True))
        .when(stated.isNotNull(), state(stated, True, False))
        .when(unpaid_note, state("unpaid", True, False))
        .when(owed > 0, state("paid", True, False))
        .when(owed.isNotNull() & code.isNotNull(), state("waived", True, False))
        .when(owed.isNotNull(), state("unknown", True, True))
        .when(F.coalesce(literal, F.lit("")) != "", state(literal, True, False))
        .otherwise(state(fixed.MODAL_FEE, False, False))
    )
