"""Figures of page rasters, and choices between readings of a page.

A raster is a row with its case, page, height, width and pixels (bytes, row by row, three channels a
pixel for colour, one for grey). Pixels stay in the task that reads them: only counts, or one sum
for each task and shape, are shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, fuzzy, text

#: How far a channel must stand out, and when a grey pixel is ink.
STANDS_OUT, INK_BELOW, TEMPLATE_ABOVE, VARIABLE_ABOVE, RETRY_BELOW_CHARS = 60, 200, 0.9, 0.08, 40


def colour_counts(rasters: DataFrame) -> DataFrame:
    """(case_id, green, red): the most pixels on any page of a case whose green, or red, stands out."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for case, height, width, pixels in zip(batch["case_id"], batch["height"], batch["width"], batch["pixels"], strict=True):
                r, g, b = np.frombuffer(pixels, np.uint8).reshape(height, width, 3).astype(np.int16).transpose(2, 0, 1)
                green, red = (g - np.maximum(r, b) > STANDS_OUT).sum(), (r - np.maximum(g, b) > STANDS_OUT).sum()
                rows.append((case, int(green), int(red)))
            yield pd.DataFrame(rows, columns=["case_id", "green", "red"])

    pages = rasters.select("case_id", "height", "width", "pixels").mapInPandas(count, "case_id string, green long, red long")
    return pages.groupBy("case_id").agg(F.max("green").alias("green"), F.max("red").alias("red"))


def orientation(report: Column) -> Column:
    """A struct of the angle and confidence that an orientation report states; no angle is null, no confidence 0."""
    angle = F.nullif(F.regexp_extract(report, r"Rotate:\s*(\d+)", 1), F.lit("")).cast("int")
    sure = F.nullif(F.regexp_extract(report, r"Orientation confidence:\s*([\d.]+)", 1), F.lit("")).try_cast("double")
    return F.struct(angle.alias("angle"), F.coalesce(sure, F.lit(0.0)).alias("confidence"))


def best_rotation(readings: DataFrame, vocabulary: str) -> DataFrame:
    """(case_id, number, angle, score) of each page's reading with the most vocabulary; ties to the smaller angle.

    ``readings`` has a row for each angle with its lines; ``vocabulary`` is a pattern.
    """
    hits = F.regexp_extract_all(F.array_join("lines", " "), F.lit(f"({vocabulary})"), F.lit(1))
    score = F.aggregate(hits, F.lit(0).cast("long"), lambda a, x: a + F.char_length(x))
    scored = readings.withColumn("score", score)
    return scored.groupBy("case_id", "number").agg(F.max_by("angle", F.struct("score", -F.col("angle"))).alias("angle"), F.max("score").alias("score"))


def ink_frequency(rasters: DataFrame) -> DataFrame:
    """(height, width, pages, template, variable, frequency) of grey pages by shape.

    ``frequency`` is the share of pages with ink at each pixel, as packed 32-bit floats; template
    pixels nearly always have it, variable ones sometimes.
    """

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        pages: dict[tuple[int, int], int] = {}
        for batch in batches:
            for height, width, pixels in zip(batch["height"], batch["width"], batch["pixels"], strict=True):
                shape = (int(height), int(width))
                ink = np.frombuffer(pixels, np.uint8) < INK_BELOW
                sums[shape] = sums.get(shape, np.zeros(len(ink), np.int64)) + ink
                pages[shape] = pages.get(shape, 0) + 1
        yield pd.DataFrame([(*s, pages[s], v.tobytes()) for s, v in sums.items()], columns=["height", "width", "pages", "sums"])

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shape, pages, sums = None, 0, np.empty(0)

        def done() -> Iterator[pd.DataFrame]:
            if shape is not None:
                share = (sums / pages).astype(np.float32)
                template = int((share > TEMPLATE_ABOVE).sum())
                variable = int(((share > VARIABLE_ABOVE) & (share <= TEMPLATE_ABOVE)).sum())
                yield pd.DataFrame([(*shape, pages, template, variable, share.tobytes())], columns=["height", "width", "pages", "template", "variable", "frequency"])

        for batch in batches:
            for height, width, n, part_sums in batch.itertuples(index=False):
                if (height, width) != shape:
                    yield from done()
                    shape, pages, sums = (height, width), 0, np.zeros(height * width, np.int64)
                pages, sums = pages + n, sums + np.frombuffer(part_sums, np.int64)
        yield from done()

    parts = rasters.select("height", "width", "pixels").mapInPandas(part, "height int, width int, pages long, sums binary")
    ordered = parts.repartition("height", "width").sortWithinPartitions("height", "width")
    return ordered.mapInPandas(whole, "height int, width int, pages long, template long, variable long, frequency binary")


def cells(frequency: bytes, height: int, width: int, least: int = 150) -> list[tuple[int, int, int, int]]:
    """(x, y, width, height) of the connected variable regions of more than ``least`` pixels, top to bottom."""
    share = np.frombuffer(frequency, np.float32).reshape(height, width)
    open_ = (share > VARIABLE_ABOVE) & (share <= TEMPLATE_ABOVE)
    found = []
    while open_.any():
        y, x = np.unravel_index(int(open_.argmax()), open_.shape)
        region, edge = np.zeros_like(open_), np.zeros_like(open_)
        edge[y, x] = True
        while edge.any():
            region |= edge
            grown = np.pad(edge, 1)
            near = sum(grown[1 + dy : 1 + dy + height, 1 + dx : 1 + dx + width] for dy in (-1, 0, 1) for dx in (-1, 0, 1)) > 0
            edge = near & open_ & ~region
        open_ &= ~region
        ys, xs = np.nonzero(region)
        if len(ys) > least:
            found.append((int(xs.min()), int(ys.min()), int(np.ptp(xs)) + 1, int(np.ptp(ys)) + 1))
    return sorted(found, key=lambda c: (c[1], c[0]))


def shift(reference: np.ndarray, page: np.ndarray) -> tuple[int, int]:
    """(dx, dy) by which a page is moved against a reference, by phase correlation."""
    cross = np.fft.fft2(page.astype(np.float64)) * np.conj(np.fft.fft2(reference.astype(np.float64)))
    peak = np.abs(np.fft.ifft2(cross / np.maximum(np.abs(cross), 1e-12)))
    y, x = np.unravel_index(int(peak.argmax()), peak.shape)
    h, w = peak.shape
    return int(x - w if x > w // 2 else x), int(y - h if y > h // 2 else y)


def longer_reading(first: Column, again: Column) -> Column:
    """The lines of a page, or those of a second, finer scan where the first has few characters and it has more."""
    size = lambda lines: F.aggregate(lines, F.lit(0), lambda a, x: a + F.char_length(x))
    return F.when((size(first) < RETRY_BELOW_CHARS) & (size(again) > size(first)), again).otherwise(first)


def reread_panel(pages: DataFrame, read: Callable[[str, int, bool], list[str]]) -> DataFrame:
    """Scanned slips with a canonical line of the flags that a finer reading of their panel states.

    ``read`` maps a case, a page number (None where the page has none) and whether to use the second
    engine to lines; the second engine is asked only where the first finds no flag.
    """
    slips = (F.col("doc_type") == "biometric_slip") & (F.col("source") == "ocr")

    @F.pandas_udf("string")
    def panel(wanted: pd.Series, cases: pd.Series, numbers: pd.Series) -> pd.Series:
        def line(case: str, number: int | None) -> str | None:
            flags = fuzzy.panel_flags(read(case, number, False)) or fuzzy.panel_flags(read(case, number, True))
            return f"Observed flags: {', '.join(sorted(flags))}" if flags else None

        places = (None if pd.isna(n) else int(n) for n in numbers)
        return pd.Series([line(c, n) if w else None for w, c, n in zip(wanted, cases, places, strict=True)], dtype="object")

    found = pages.withColumn("__panel", panel(F.coalesce(slips, F.lit(False)), "case_id", "number"))
    return found.withColumn("lines", F.when(F.col("__panel").isNotNull(), F.array_append("lines", F.col("__panel"))).otherwise(F.col("lines"))).drop("__panel")


def header_gain(cases: DataFrame, fields: tuple[str, ...] = fixed.SCORED) -> DataFrame:
    """(field, held, gained): true values that a case's lines hold, and those that only a fresh reading does.

    ``cases`` has the arrays ``lines`` and ``fresh`` and a column of the truth for each field; values
    of fewer than four letters and digits say nothing.
    """
    rows = F.array(*[F.struct(F.lit(f).alias("field"), text.squash_upper(F.coalesce(f, F.lit(""))).alias("want")) for f in fields])
    held, fresh = (text.squash_upper(F.array_join(c, "")) for c in ("lines", "fresh"))
    each = cases.select(held.alias("held"), fresh.alias("fresh"), F.explode(rows).alias("r")).select("held", "fresh", "r.*").where(F.char_length("want") >= 4)
    inside = F.contains("held", F.col("want"))
    return each.groupBy("field").agg(F.count_if(inside).alias("held"), F.count_if(~inside & F.contains("fresh", F.col("want"))).alias("gained"))
