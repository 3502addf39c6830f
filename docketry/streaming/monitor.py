"""Live figures of a growing evidence cache: totals, page types, rates, drift.

Totals are those of the batch plan on the same rows. The event-time windows with a watermark are an
addition; the original figures know only arrival order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed, text
from ..operators.order import numbered

_EMPTY = "array<string>"


def page_marks(pages: DataFrame) -> DataFrame:
    """What counts on each page: scanned, empty, with hidden text."""
    none = F.array().cast(_EMPTY)
    lines = F.size(text.all_lines(F.coalesce("lines", none), F.coalesce("ocr_lines", none), F.coalesce("second_lines", none)))
    return pages.select(
        "case_id", "doc_type", (F.col("source") == "ocr").cast("long").alias("ocr"), (lines == 0).cast("long").alias("empty"),
        (F.trim(F.coalesce("hidden_text", F.lit(""))) != "").cast("long").alias("hidden"),
    )


def totals_by_type(pages: DataFrame) -> DataFrame:
    """(doc_type, pages, ocr_pages, empty_pages): works on a stream in complete or update mode."""
    return page_marks(pages).groupBy("doc_type").agg(F.count("*").alias("pages"), F.sum("ocr").alias("ocr_pages"), F.sum("empty").alias("empty_pages"))


def totals_by_case(pages: DataFrame) -> DataFrame:
    """(case_id, pages, injected): the running state from which packet totals follow."""
    return page_marks(pages).groupBy("case_id").agg(F.count("*").alias("pages"), F.max("hidden").alias("injected"))


def profile(pages: DataFrame) -> DataFrame:
    """One row: packets, pages, scanned and empty pages, packets with hidden text."""
    by_case = page_marks(pages).groupBy("case_id").agg(F.count("*").alias("pages"), F.sum("ocr").alias("ocr"), F.sum("empty").alias("empty"), F.max("hidden").alias("hidden"))
    return by_case.agg(
        F.count("*").alias("packets"), F.sum("pages").alias("pages"), F.sum("ocr").alias("ocr_pages"), F.sum("empty").alias("empty_pages"), F.sum("hidden").alias("injected_packets")
    )


def running_profile(records: DataFrame) -> DataFrame:
    """``profile`` of records (case_id, pages), one a packet: one aggregate, so that a stream can keep it as its state."""
    pages = F.coalesce("pages", F.array().cast(records.schema["pages"].dataType))

    def count(of) -> Column:
        return F.sum(F.size(F.filter(pages, of)).cast("long"))

    empty = lambda p: F.size(text.all_lines(p["lines"], p["ocr_lines"], p["second_lines"])) == 0
    hidden = F.exists(pages, lambda p: F.trim(F.coalesce(p["hidden_text"], F.lit(""))) != "")
    return records.agg(
        F.count("*").alias("packets"), F.sum(F.size(pages).cast("long")).alias("pages"), count(lambda p: p["source"] == "ocr").alias("ocr_pages"),
        count(empty).alias("empty_pages"), F.count_if(hidden).alias("injected_packets"),
    )


def drift(value: Column, reference: float, at: float = fixed.DRIFT_AT) -> Column:
    """A struct of the relative gap to a reference value and whether it is an alert."""
    gap = (value - F.lit(float(reference))) / F.lit(float(reference))
    return F.struct(gap.alias("gap"), (F.abs(gap) > at).alias("alert"))


def drifts(profile_row: DataFrame, reference: dict[str, float] = fixed.PROFILE_REFERENCE) -> DataFrame:
    """(name, value, gap, alert) of a profile's ratios."""
    ratios = {"pages_per_packet": F.col("pages") / F.col("packets"), "ocr_share": F.col("ocr_pages") / F.col("pages"), "injected_share": F.col("injected_packets") / F.col("packets")}
    rows = [F.struct(F.lit(n).alias("name"), v.alias("value"), drift(v, reference[n]).alias("d")) for n, v in ratios.items()]
    return profile_row.select(F.explode(F.array(*rows)).alias("r")).select("r.name", "r.value", "r.d.gap", "r.d.alert")


def trailing_rate(polls: DataFrame, at: str, count: str | None = None, key: list[str] | None = None, polls_back: int = 60, ties: list[str] | None = None, block: int = 100_000) -> DataFrame:
    """``polls`` with ``per_minute``: growth of a running count over the last polls, null on the first.

    The count is a column, or the number of the poll. ``ties`` orders polls of one time. Polls are
    numbered by key in order of time and cut into blocks of equally many; each block also gets the last
    polls of the one before. So no task has more than a block, with one key as with many.
    """
    if not 1 <= polls_back <= block:
        raise ValueError("a block has at least as many polls as are looked back")
    keys, order, names = key or [], [at, *(ties or [])], polls.columns
    rows = numbered(polls, keys, order, "__dk_n").withColumn("__dk_block", F.expr(f"(__dk_n - 1) div {block}L"))
    lent = F.col("__dk_n") > (F.col("__dk_block") + 1) * block - (polls_back - 1)
    blocks = F.array_compact(F.array(F.struct(F.lit(0).alias("add")), F.when(lent, F.struct(F.lit(1).alias("add")))))
    dealt = rows.withColumn("__dk_to", F.explode(blocks)).withColumn("__dk_in", F.col("__dk_block") + F.col("__dk_to.add"))
    window = Window.partitionBy(*keys, "__dk_in").orderBy("__dk_n").rowsBetween(-(polls_back - 1), 0)
    seconds = (F.unix_micros(F.col(at).cast("timestamp")) - F.unix_micros(F.first(at).over(window).cast("timestamp"))) / 1e6
    counted = F.col(count or "__dk_n")
    rated = dealt.withColumn("per_minute", F.when(seconds > 0, (counted - F.first(counted).over(window)) / seconds * 60))
    return rated.where("__dk_to.add = 0").select(*[F.col(f"`{c}`") for c in names if c != "per_minute"], "per_minute")


def windowed_counts(events: DataFrame, at: str, key: str, width: str = "1 hour", slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """(start, key, n) of event-time windows behind a watermark; on a batch the watermark has no effect."""
    marked = events.withWatermark(at, late) if events.isStreaming else events
    window = F.window(at, width, slide) if slide else F.window(at, width)
    return marked.groupBy(window.alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), key, "n")
