from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that clash with those of the operators' own columns.
        *[T.StructField(c, T.StringType()) for c in ("fp", "id", "mark", "key", "size", "score", "shard", "slot", "position", "kept", "n_lines", "copies", "fingerprint", "component_id", "label", "first")],
    ]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text, lang, source) rows, with extra columns of clashing names."""

    def make(rows, partitions=3):
        full = [(i, t, lang, source, None if t is None else len(t), *["x"] * 16) for i, t, lang, source in rows]
        return spark.createDataFrame(full, DOCS).repartition(partitions)

    return make


WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(n, seed):
    """Pseudo-random words."""
    import random

    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS)[:3] for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty, blank and long texts, ties, repeated rows, copies."""
    long_text = "\n".join(prose(12, i) for i in range(2000))
    base = prose(60, 1)
    return [
        (1, None, None, None), (2, "", "en", "a"), (3, " \t\n ", "en", "a"), (4, base, "en", "a"), (5, base, "fr", "b"), (6, base.upper(), None, "b"),
        (6, base, "en", "a"), (6, base, "en", "a"), (None, base, "en", None), (None, prose(30, 9), "en", "c"), (7, "one", "en", "a"), (8, long_text, "en", "c"),
        (9, "Ünïcödé ẞ \x85 \x0b zwei drei vier fünf sechs sieben acht neun zehn elf", "de", "c"), (10, "!!! 123 ...", "en", "a"), (2**62, "a|b|c\n" * 30, "en", "b"),
    ]
