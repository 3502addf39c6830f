"""Similarity join of two tables of short texts by the Ratcliff-Obershelp ratio, exact.

The ratio of two texts is at most twice the characters that they share over all their characters. So a
pair at ``least`` shares a known number of characters, told apart by their occurrence (the second E is
another than the first). With a fixed order of these, rarer ones first, such a pair also shares
``COMBINE`` of the first few of each side. Combinations of so many of these are what the tables are
joined by; of the combinations that a pair shares only its first counts, so a pair comes up once and
nothing is made distinct. The shared characters of the whole texts are then counted natively, and the
ratio is taken for those pairs alone that it can still reach.

Short texts may have to share fewer characters than ``COMBINE``; they, and their possible partners,
also have the smaller combinations that this needs.

Edge cases: null and empty texts are like nothing; texts beyond letters and digits are compared
squashed (lower case, letters and digits only); repeated rows pair each; ties of the best entry fall
to the smallest order; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fuzzy, text

#: Characters that a join key combines.
COMBINE = 3
#: Bits of a character with its occurrence, and the most occurrences in a text that are told apart.
_BITS, _MOST = 20, 16_000
#: Rarer letters first; any order is right.
_RARITY = "qjzx0123456789wkvfbghmypducltsniroae"


def _tokens(key: Column) -> Column:
    """The characters of a squashed text, each with its occurrence, as numbers in the order of the index: repeats and rare letters first."""
    chars = F.split(key, "")
    seen = lambda c, i: F.size(F.filter(F.slice(chars, F.lit(1), i + 1), lambda d: d == c))
    return F.array_sort(F.transform(chars, lambda c, i: ((F.lit(_MOST) - seen(c, i)) * 64 + F.instr(F.lit(_RARITY), c)).cast("long")))


def _combinations(items: Column, n: int) -> Column:
    """All ways to take ``n`` of the items, in their order, each as one number."""
    if n == 1:
        return items
    rest = lambda i: F.slice(items, i + 2, F.size(items))
    return F.flatten(F.transform(items, lambda x, i: F.transform(_combinations(rest(i), n - 1), lambda y: x * (1 << (_BITS * (n - 1))) + y)))


def _packed(items: Column, n: int) -> Column:
    """The first ``n`` items as one number."""
    return sum((F.get(items, F.lit(i)) * (1 << (_BITS * (n - 1 - i))) for i in range(1, n)), F.get(items, F.lit(0)) * (1 << (_BITS * (n - 1))))


def _shared_at_least(least: float, chars: Column) -> Column:
    """Characters that a pair must share that has so many together."""
    return F.ceil(F.lit(least / 2) * chars - F.lit(1e-9)).cast("int")


def _way(level: int):
    return lambda part: F.struct(F.lit(level).alias("level"), part.alias("part"))


def _indexed(df: DataFrame, value: str, least: float, combine: int) -> DataFrame:
    """Rows with ``key``, ``tokens``, ``level`` and ``part``: one for each combination that they are found by."""
    n = F.col("n")
    keyed = df.withColumn("key", text.squash_lower(F.col(value))).where(F.col("key") != "").withColumns({"tokens": _tokens(F.col("key")), "n": F.char_length("key")})
    # The shortest partner that a text can have asks for the fewest shared characters.
    fewest = _shared_at_least(least, n + F.ceil(n * F.lit(least / (2 - least)) - F.lit(1e-9)))
    ways = []
    for level in range(1, combine + 1):
        head = F.when(n - F.greatest(fewest, F.lit(level)) + level > 0, n - F.greatest(fewest, F.lit(level)) + level).otherwise(0) if level == combine else n
        needed = F.lit(True) if level == combine else fewest <= level
        parts = F.transform(_combinations(F.slice("tokens", F.lit(1), head.cast("int")), level), _way(level))
        ways.append(F.when(needed & (head >= level), parts))
    return keyed.withColumn("way", F.explode(F.flatten(F.array_compact(F.array(*ways))))).select("*", "way.level", "way.part").drop("way")


def candidates(left: DataFrame, right: DataFrame, least: float, combine: int = COMBINE) -> DataFrame:
    """Pairs of rows (value, …) that share enough characters for a ratio of ``least``, once each; columns of the right end in ``_r``."""
    a, b = (_indexed(df, "value", least, combine) for df in (left, right))
    b = b.withColumnsRenamed({c: f"{c}_r" for c in b.columns if c not in ("level", "part")})
    met = a.join(b.hint("merge"), ["level", "part"])  # an index is larger than the optimizer can know: never broadcast
    must = _shared_at_least(least, F.col("n") + F.col("n_r"))
    met = met.where(F.col("level") == F.least(must, F.lit(combine)))
    shared = F.array_intersect("tokens", "tokens_r")
    first = F.coalesce(*[F.when(F.col("level") == level, _packed(F.col("__shared"), level)) for level in range(1, combine + 1)])
    return met.withColumn("__shared", shared).where((F.size("__shared") >= must) & (F.col("part") == first)).drop("__shared", "level", "part", "tokens", "tokens_r", "n", "n_r")


def similar_pairs(left: DataFrame, right: DataFrame, left_value: str, right_value: str, least: float, combine: int = COMBINE) -> DataFrame:
    """Pairs of rows whose values have a ratio of ``least`` or more: the columns of both, those of the right ending in ``_r``, and ``ratio``."""
    if not 0 < least <= 1 or not 1 <= combine <= 3:
        raise ValueError("least must be above 0 and at most 1, combine from 1 to 3")
    shaped = [df.select(F.col(v).alias("value"), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")) for df, v in ((left, left_value), (right, right_value))]
    pairs = candidates(*shaped, least, combine).withColumn("ratio", fuzzy.ratio_udf("key", "key_r")).where(F.col("ratio") >= least)
    of = lambda df, row, end: [F.col(f"{row}.`{c}`").alias(f"{c}{end}") for c in df.columns]
    return pairs.select(*of(left, "row", ""), *of(right, "row_r", "_r"), "ratio")


def nearest_entries(values: DataFrame, entries: DataFrame, value: str, entry: str, order: str, least: float, combine: int = COMBINE) -> DataFrame:
    """(value, entry, ratio) of the entry nearest to each distinct value, ties to the smallest ``order``; values without one are left out."""
    pairs = similar_pairs(values.select(F.col(value).alias("value")).distinct(), entries.select(F.col(entry).alias("entry"), F.col(order).alias("place")), "value", "entry", least, combine)
    best = pairs.groupBy("value").agg(F.max_by(F.struct("entry_r", "ratio"), F.struct("ratio", -F.col("place_r"))).alias("best"))
    return best.select("value", F.col("best.entry_r").alias("entry"), F.col("best.ratio").alias("ratio"))
