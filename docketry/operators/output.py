"""The output contract: validation, sentinels for what couldn't be read, and the prediction record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed


def problems(columns: dict[str, Column]) -> Column:
    """What is wrong with a record, in order: id, decision, fee, confidence, flags."""
    confidence = columns["confidence"]
    empty = lambda c: F.coalesce(c, F.lit("")) == ""
    outside = lambda c, of: ~F.coalesce(c.isin(*of), F.lit(False))
    return F.array_compact(
        F.array(
            F.when(empty(columns["case_id"]), "empty case_id"),
            F.when(outside(columns["adjudication"], fixed.DECISIONS), "bad adjudication"),
            F.when(outside(columns["fee_status"], fixed.FEES), "bad fee_status"),
            F.when(confidence.isNull() | F.isnan(confidence), "confidence not numeric").when(~confidence.between(0.0, 1.0), "confidence out of range"),
            F.when(empty(columns["risk_flags"]), "risk_flags empty"),
        )
    )


def finalize(df: DataFrame) -> DataFrame:
    """Sentinels for sponsors and dates that the contract wouldn't take; run after deciding."""
    date = F.coalesce(F.col("arrival_date"), F.lit(""))
    real = date.rlike(fixed.DATE_FORMAT) & F.try_to_date(date, "yyyy-MM-dd").isNotNull()
    sponsor = F.coalesce(F.col("sponsor_id").rlike(fixed.SPONSOR_FORMAT), F.lit(False))
    return df.withColumn("sponsor_id", F.when(sponsor, F.col("sponsor_id")).otherwise(fixed.SENTINEL_SPONSOR)).withColumn(
        "arrival_date", F.when(real, date).otherwise(fixed.SENTINEL_DATE)
    )


def to_json_lines(df: DataFrame, columns: list[str]) -> DataFrame:
    """One compact JSON text a row, confidence rounded to four places."""
    fields = [F.round(c, 4).alias(c) if c == "confidence" else F.col(c) for c in columns]
    return df.select(F.to_json(F.struct(*fields)).alias("value"))
