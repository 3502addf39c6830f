"""Document typing: a cascade of heading, content, near heading, label vote and caption."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, fuzzy, text


def _unsquashed(pattern: str) -> str:
    """A pattern of whole squashed words as one of the lines that they are squashed from, so that no line need be squashed."""
    gap = "[^A-Za-z0-9]*+"
    words = (gap.join(f"[{c}{c.lower()}]" for c in word) for word in re.findall("[A-Z0-9]+", pattern))
    return rf"^{gap}(?:{'|'.join(words)}){gap}\z"


#: Lines that are nothing but a watermark.
WATERMARK_LINE = _unsquashed(fixed.WATERMARK_PATTERN)
#: Where a bar may not part a whole pattern: groups, escaped bars and quotes, bars in a class or beside one that is hard to read.
_BOUND = re.compile(r"\(|\\[|QE\]]|\[\^?\]|\[[^\]]*[|\[]")


def typing_lines(lines: Column, extra: Column | None = None, correction: str = fixed.CORRECTION_LINE_PATTERN) -> Column:
    """Lines that typing looks at: both readings, without watermarks and correction lines."""
    merged = lines if extra is None else F.concat(lines, F.array_except(F.coalesce(extra, F.array().cast("array<string>")), lines))
    return F.filter(merged, lambda x: ~x.rlike(WATERMARK_LINE) & ~x.rlike(correction))


def holds(value: Column, pattern: str) -> Column:
    """``rlike``, with the alternatives of a pattern looked for one by one, plain words without a regular expression.

    An expression engine tries all alternatives at every character; a single word is found several times as fast.
    """
    parts = [pattern] if _BOUND.search(pattern) else pattern.split("|")
    return reduce(or_, (F.contains(value, F.lit(p)) if re.fullmatch("[A-Z0-9]+", p) else value.rlike(p) for p in parts))


def _first(value: Column, patterns) -> Column:
    return F.coalesce(*[F.when(holds(value, pattern), F.lit(kind)) for kind, pattern in patterns])


def head_text(kept: Column, upper: Callable[[Column], Column] = text.loose_upper) -> Column:
    """What heading patterns are matched on: the first three lines."""
    return upper(F.array_join(F.slice(kept, 1, 3), ""))


def body_text(kept: Column, upper: Callable[[Column], Column] = text.loose_upper) -> Column:
    """What content and caption patterns are matched on: all lines."""
    return upper(F.array_join(kept, ""))


def by_heading(head: Column, patterns=fixed.HEADING_PATTERNS) -> Column:
    """The type that one of the first three lines heads."""
    return _first(head, patterns)


def by_content(body: Column, patterns=fixed.CONTENT_PATTERNS) -> Column:
    """The type whose phrases the page holds."""
    return _first(body, patterns)


def by_caption(body: Column) -> Column:
    """A page that is only a captioned image, or unknown."""
    return F.when(holds(body, fixed.CAPTION_PATTERN), "passport_image").otherwise("unknown")


def anchor_weights(body: Column, anchors: dict = fixed.ANCHORS) -> Column:
    """(kind, weight) of the labels that a squashed body holds exactly, an array of structs."""
    rows = []
    for kind, tokens in anchors.items():
        weight = sum((F.when(F.contains(body, F.lit(t)), F.lit(w)).otherwise(F.lit(0.0)) for t, w in tokens), F.lit(0.0))
        rows.append(F.struct(F.lit(kind).alias("kind"), weight.alias("weight")))
    return F.array(*rows)


def clear_winner(weights: Column) -> Column:
    """A struct of the heaviest of ``anchor_weights``, ties to the smaller name, its weight and its margin over the next.

    There is no kind unless the weight is enough and clear of the next.
    """
    ranked = F.array_sort(F.transform(weights, lambda x: F.struct((-x["weight"]).alias("less"), x["kind"].alias("kind"))))
    first, second = F.get(ranked, F.lit(0)), F.get(ranked, F.lit(1))
    weight, margin = -first["less"], second["less"] - first["less"]
    clear = (weight >= fixed.ANCHOR_LEAST) & (margin >= fixed.ANCHOR_MARGIN)
    return F.struct(F.when(clear, first["kind"]).alias("kind"), weight.alias("weight"), margin.alias("margin"))


def first_stated(value: Column, *order: Column | str) -> Column:
    """An aggregate: the value of the first row in that order that has one."""
    return F.min_by(value, F.when(value.isNotNull(), F.struct(*order)))


def classify(pages: DataFrame, out: str = "doc_type") -> DataFrame:
    """``pages`` with their type. Approximate stages run only on pages that the exact ones leave open."""
    kept = typing_lines(F.col("lines"), F.col("second_lines") if "second_lines" in pages.columns else None)
    marked = pages.withColumn("__kept", kept).withColumns({"__head": head_text(F.col("__kept")), "__body": body_text(F.col("__kept"))})
    marked = marked.withColumn("__type", F.coalesce(by_heading(F.col("__head")), by_content(F.col("__body"))))
    head = F.when(F.col("__type").isNull(), text.squash_upper(F.array_join(F.slice("__kept", 1, 5), "")))
    body = F.when(F.col("__near").isNull() & F.col("__type").isNull(), text.squash_upper(F.array_join("__kept", "")))
    near = marked.withColumn("__near", fuzzy.heading_udf(head))
    voted = near.withColumn("__vote", fuzzy.anchor_udf(body))
    found = voted.withColumn(out, F.coalesce("__type", "__near", "__vote", by_caption(F.col("__body"))))
    return found.drop("__kept", "__head", "__body", "__type", "__near", "__vote")


def blind_retyping(pages: DataFrame, truth: str = "doc_type") -> DataFrame:
    """Text pages of a known type, typed anew without their first line: ``truth`` and ``blind``.

    Pages of one line, of no type and of captions alone are left out, as are scanned ones.
    """
    known = pages.where((F.col("source") == "text") & (F.size("lines") >= 2) & ~F.coalesce(F.col(truth), F.lit("unknown")).isin("unknown", "passport_image"))
    return classify(known.withColumn("truth", F.col(truth)).withColumn("lines", F.slice("lines", 2, F.size("lines") - 1)), "blind")


def blind_report(retyped: DataFrame) -> DataFrame:
    """(truth, pages, typed, correct, coverage, precision) of each type; ``precision`` is null where nothing was typed."""
    typed = F.count_if(F.col("blind") != "unknown")
    counts = retyped.groupBy("truth").agg(F.count("*").alias("pages"), typed.alias("typed"), F.count_if(F.col("blind") == F.col("truth")).alias("correct"))
    return counts.withColumns({"coverage": F.col("typed") / F.col("pages"), "precision": F.col("correct") / F.nullif(F.col("typed"), F.lit(0))})


def strip_injected(pages: DataFrame) -> DataFrame:
    """Pages without lines that repeat an injected instruction or the page's hidden text.

    A page is judged by itself, whatever its number, and no page moves. Null lines count as empty ones
    and stay; null ``lines`` are none.
    """
    lines = F.coalesce("lines", F.array().cast("array<string>"))
    keys = F.transform(lines, lambda x: F.coalesce(text.squash_upper(x), F.lit("")))
    injected = fuzzy.injected_udf(keys, F.coalesce(text.squash_upper(F.col("hidden_text")), F.lit("")))
    marked = pages.withColumn("__injected", F.when(F.size(lines) > 0, injected))
    left = F.filter(lines, lambda _, i: ~F.coalesce(F.get("__injected", i), F.lit(False)))
    return marked.withColumn("lines", left).drop("__injected")


def authority(doc_type: Column) -> Column:
    """A type's rank of trust, lower first."""
    ranks = F.create_map(*[F.lit(x) for pair in fixed.AUTHORITY.items() for x in pair])
    return F.coalesce(F.try_element_at(ranks, doc_type), F.lit(8))
