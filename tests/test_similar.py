"""The similarity join against all pairs."""

from __future__ import annotations

import random
from collections import Counter
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from docketry.functions.fuzzy import squash
from docketry.operators import similar
from docketry.plans import bindings, packet_queries


def worn(rng, word, n):
    for _ in range(n):
        at = rng.randrange(len(word) + 1)
        word = word[:at] + rng.choice(["", "x", "0", "é", " "]) + word[at + rng.randrange(2) :]
    return word


@pytest.mark.parametrize("least", [0.4, 0.6, 0.8, 1.0])
@pytest.mark.parametrize("combine", [1, 3])
def test_pairs_against_all_pairs(spark, least, combine):
    rng = random.Random(int(least * 10) + combine)
    words = ["a", "ab", "abc", "aaa", "aab", "b", "ring", "bolt", "small ring", "red gizmo", "Cold-Anvil", "hot plate", "aaaaaaaaaaaa", "new widget 2000"]
    left = [(i, worn(rng, rng.choice(words), rng.randrange(4))) for i in range(50)] + [(50, None), (51, ""), (52, " - "), (53, "ring"), (53, "ring")]
    right = [(i, w) for i, w in enumerate(words)] + [(90, None), (91, ""), (92, "ring")]
    got = similar.similar_pairs(spark.createDataFrame(left, "id long, name string"), spark.createDataFrame(right, "id long, word string"), "name", "word", least, combine)
    assert got.columns == ["id", "name", "id_r", "word_r", "ratio"]
    keys = [[(i, v, squash(v or "")) for i, v in rows] for rows in (left, right)]
    want = Counter((i, v, j, w, r) for i, v, a in keys[0] for j, w, b in keys[1] if a and b and (r := SequenceMatcher(None, a, b).ratio()) >= least)
    assert Counter(tuple(r) for r in got.collect()) == want and want


def test_names_against_a_vocabulary_of_100_000(spark):
    """The nearest entry is that of a plain maximum; the ratio is taken for a small share of the pairs."""
    rng = random.Random(4)
    syllables = ["ka", "lo", "mir", "zu", "the", "ran", "vex", "qui", "dor", "sel", "pha", "ny", "bro", "gat", "ish", "ume"]
    words = sorted({" ".join("".join(rng.choice(syllables) for _ in range(rng.randrange(2, 5))) for _ in range(2)) for _ in range(101_000)})[:100_000]
    rng.shuffle(words)
    names = [worn(rng, rng.choice(words), 2) for _ in range(25)] + ["no such name at all"]
    entries = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "id long, entry string").repartition(8)
    values = spark.createDataFrame([(n,) for n in names], "name string")
    got = {r["value"]: (r["entry"], r["ratio"]) for r in similar.nearest_entries(values, entries, "name", "entry", "id", 0.75).collect()}
    keyed = [(squash(w), w) for w in words]
    letters = [Counter(k) for k, _ in keyed]
    for name in names:
        key, best = squash(name), (0.75 - 1e-12, None)
        have = Counter(key)
        for (k, w), c in zip(keyed, letters):
            if 2 * sum((have & c).values()) / (len(key) + len(k)) > best[0] and (r := SequenceMatcher(None, key, k).ratio()) > best[0]:
                best = r, w
        assert got.get(name, (None, None))[0] == best[1], name
    pairs = similar.candidates(values.select(F.col("name").alias("value")), entries.select(F.col("entry").alias("value")), 0.75).count()
    share = pairs / (len(names) * len(words))
    assert share < 0.02, share


def test_query_against_all_pairs(spark, sf_dir):
    rows = packet_queries.similar_names(spark, sf_dir).collect()
    names = [r["applicant_name"] for r in bindings.made_cases(spark, sf_dir).orderBy("k").collect()]
    keyed = list(dict.fromkeys((squash(n), n) for n in names))
    assert len(rows) == len(names)
    for r in rows:
        ratios = [(SequenceMatcher(None, squash(r["worn"]), k).ratio(), -i, n) for i, (k, n) in enumerate(keyed)]
        best = max(ratios)
        assert (r["entry"], r["ratio"]) == ((best[2], round(best[0], 4)) if best[0] >= 0.8 else (None, None)), r
    assert sum(r["entry"] is not None for r in rows) > 0.8 * len(rows)
