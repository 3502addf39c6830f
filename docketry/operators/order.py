"""Order over whole tables without a task that has them whole: running numbers, exact order statistics."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import materialised

#: Values by which a round of the selection cuts what is left.
PIVOTS = 31


def numbered(df: DataFrame, keys: list[str], order: list[str], out: str) -> DataFrame:
    """``df`` with the number (from 1) of each row among those of its keys, in order.

    Rows are dealt by range of key and order, so a key of any size lies in as many partitions as it
    needs. A row's number is its place in its partition, less that of its key's first row there, and the
    rows of the key in earlier partitions: prefix sums over one row a partition and key. The sorted
    rows are written once, since their places must not change.
    """
    names = df.columns
    carried = {c: f"__dk_c{i}" for i, c in enumerate(names)}
    by = [carried[c] for c in keys]
    plain = df.select(*[F.col(f"`{c}`").alias(n) for c, n in carried.items()])
    sort = [*by, *[carried[c] for c in order]]
    dealt = plain.repartitionByRange(*sort).sortWithinPartitions(*sort)
    placed = materialised(dealt.withColumn("__dk_place", F.monotonically_increasing_id()).withColumn("__dk_part", F.shiftright("__dk_place", 33)), "placed")
    runs = placed.groupBy(*by, "__dk_part").agg(F.min("__dk_place").alias("__dk_first"), F.count("*").alias("__dk_rows"))
    earlier = Window.partitionBy(*by).orderBy("__dk_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("__dk_before", F.coalesce(F.sum("__dk_rows").over(earlier), F.lit(0)))
    runs = materialised(runs.select(*[F.col(c).alias(f"{c}r") for c in by], F.col("__dk_part").alias("__dk_of"), "__dk_first", "__dk_before"), "runs")
    same = F.col("__dk_part") == F.col("__dk_of")
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"{c}r"))
    number = F.col("__dk_before") + F.col("__dk_place") - F.col("__dk_first") + 1
    return placed.join(runs, same).select(*[F.col(n).alias(c) for c, n in carried.items()], number.alias(out))


def _place(value: Column, pivots: list[Column], lo: int, hi: int) -> Column:
    """Twice the number of pivots below a value, and one more where it is a pivot; a search tree over ``lo`` to ``hi``."""
    if lo == hi:
        return F.lit(2 * lo)
    mid = (lo + hi) // 2
    below, above = _place(value, pivots, lo, mid), _place(value, pivots, mid + 1, hi)
    return F.when(value < pivots[mid], below).when(value == pivots[mid], F.lit(2 * mid + 1)).otherwise(above)


def order_statistic(df: DataFrame, column: str, share: float = 0.95, least: int = 1, pivots: int = PIVOTS) -> Any:
    """The value at ``floor(n * share)`` (from 0) of the column's values in order, for any type that has one; None below ``least``.

    Rounds of histograms: some of the values that are left, drawn at random, cut the rest into ranges; one
    partial aggregate counts these, and the range that holds the place is what is left. The driver sees
    the pivots and twice as many counts a round. What the first round leaves is written, so that later
    rounds read some hundredth of the rows. Nulls are left out. The result doesn't depend on the draws.
    """
    left = df.select(F.col(f"`{column}`").alias("v")).where("v is not null")
    kind, n, place, written = left.schema["v"].dataType, None, None, False
    while True:
        draw = F.xxhash64("v", F.monotonically_increasing_id())
        drawn = sorted({r["v"] for r in left.orderBy(draw).limit(pivots).collect()}, key=_sortable)
        if not drawn:
            return None
        bucket = _place(F.col("v"), [F.lit(x).cast(kind) for x in drawn], 0, len(drawn))
        counts = dict(left.groupBy(bucket.alias("b")).agg(F.count("*").alias("n")).collect())
        if n is None:
            n = sum(counts.values())
            if n < least:
                return None
            place = min(int(n * share), n - 1)
        for b in range(2 * len(drawn) + 1):
            if place < counts.get(b, 0):
                break
            place -= counts.get(b, 0)
        if b % 2:
            return drawn[b // 2]
        if b > 0:
            left = left.where(F.col("v") > F.lit(drawn[b // 2 - 1]).cast(kind))
        if b < 2 * len(drawn):
            left = left.where(F.col("v") < F.lit(drawn[b // 2]).cast(kind))
        if not written:
            left, written = materialised(left, "left"), True


def _sortable(value: Any) -> tuple:
    """Python's order as Spark's: not-a-number after all others, texts by their bytes."""
    if isinstance(value, float):
        return value != value, 0.0 if value != value else value
    return False, value.encode("utf-8", "surrogatepass") if isinstance(value, str) else value
