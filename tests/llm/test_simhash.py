from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from docketry.llm import simhash
from docketry.llm.components import connected_components


def brute_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("text", [None, "", " \n", "One", "one TWO", "a b c d", "x " * 700, "É é Z z \x85 q", "a\x0bb\x1cc d"])
def test_fingerprint(text):
    assert simhash.fingerprint(None if text is None else text.encode()) == brute_fingerprint(text)


def test_odd_rows_against_brute_force(make_docs, odd_rows):
    got = simhash.near_duplicates(make_docs(odd_rows)).collect()
    fps = [brute_fingerprint(t) for _, t, _, _ in odd_rows]
    comps = brute_components(fps)
    least = {}
    for (i, *_), c in zip(odd_rows, comps, strict=True):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    want = Counter((i, f"{f:016x}", least.get(c)) for (i, *_), f, c in zip(odd_rows, fps, comps, strict=True))
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == want


def test_empty_table(make_docs):
    assert simhash.near_duplicates(make_docs([])).count() == 0
    assert simhash.keep_one(make_docs([])).count() == 0


@pytest.mark.parametrize("bound", [16_384, 40])
def test_links_lose_no_component(spark, monkeypatch, bound):
    """Random, chained and crowded fingerprints, with and without buckets beyond the bound of a task."""
    monkeypatch.setattr(simhash, "_BUCKET", bound)
    rng = np.random.default_rng(0)
    centres = rng.integers(0, 1 << 63, 6, np.uint64)
    fps = set(rng.integers(0, 1 << 63, 150, np.uint64).tolist())
    for c in centres:
        at = int(c)
        for _ in range(90):
            flips = rng.choice(64, rng.integers(1, 4), replace=False)
            near = at
            for f in flips:
                near ^= 1 << int(f)
            fps.add(near)
            at = near if rng.random() < 0.2 else int(c)
    fps = sorted(fps)
    signed = [simhash._signed(f) for f in fps]
    edges = simhash.links(spark.createDataFrame([(s,) for s in signed], "fp long").repartition(5))
    label = {r["vertex"]: r["component"] for r in connected_components(edges).collect()}
    groups = {}
    for f, c in zip(signed, brute_components(fps), strict=True):
        groups.setdefault(c, set()).add(label.get(f, f))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 3 for a, b in edges.select("a", "b").collect())


def test_every_choice_of_differing_bits_shares_a_bucket():
    masks = simhash.bucket_masks()
    rng = np.random.default_rng(1)
    for _ in range(2000):
        diff = sum(1 << int(b) for b in rng.choice(64, 3, replace=False))
        assert any(diff & m == 0 for m in masks)


def test_keep_one(make_docs, odd_rows):
    kept = simhash.keep_one(make_docs(odd_rows)).collect()
    n = len(set(brute_components([brute_fingerprint(t) for _, t, _, _ in odd_rows])))
    assert len(kept) == n
    assert {r["doc_id"] for r in kept} == {1, 4, 7, 8, 9, 10, 2**62, None}


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    edges = spark.createDataFrame([*chain, *star, (5, 5), (-3, -7)], "a long, b long")
    got = {r["vertex"]: r["component"] for r in connected_components(edges).collect()}
    assert {got[i] for i in range(61)} == {0}
    assert {got[1000 + i] for i in range(200)} == {1000}
    assert got[-3] == got[-7] == -7
    assert connected_components(edges.where(F.lit(False))).count() == 0
