from __future__ import annotations

import random

import corpus_pipeline
import numpy as np
import pytest
from docketry.llm import minhash
from docketry.llm.simhash import RADIUS, fingerprint, fingerprint_of
from pyspark.sql import functions as F

from .conftest import prose


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def jaccard(a, b):
    a, b = (x if isinstance(x, set) else shingles(x) for x in (a, b))
    return len(a & b) / len(a | b) if a | b else 1.0


def survivors(rows, alike=0.8):
    """The smallest id of each component, by comparing all pairs."""
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = [shingles(text) for _, text, *_ in rows]
    for i in range(len(rows)):
        for j in range(i):
            if jaccard(sets[i], sets[j]) >= alike:
                root[find(i)] = find(j)
    least = {}
    for i, (doc, *_) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted(least.values())


def planted():
    """Texts with near copies between 0.6 and 0.99, a chain, and a crowd of copies of one text."""
    rng, rows = random.Random(5), []

    def damaged(text, times):
        words = text.split()
        for at in rng.sample(range(len(words)), times):
            words[at] = f"w{rng.random()}"
        return " ".join(words)

    for k in range(25):
        base = prose(100, 1000 + k)
        rows += [base, damaged(base, 1 + k % 5)]
    link = prose(150, 7)
    for _ in range(5):
        rows.append(link)
        link = damaged(link, 2)
    crowd = prose(120, 8)
    rows += [damaged(crowd, 1 + i % 3) for i in range(40)]
    return [(i, t, "en", "a") for i, t in enumerate(rows)]


def test_stage_against_all_pairs(spark, make_docs, sf_dir):
    rows = planted()
    between = [x for i in range(0, 50, 2) if 0.8 <= (x := jaccard(rows[i][1], rows[i + 1][1])) < 0.97]
    assert len(between) >= 5
    stage = dict(corpus_pipeline.STAGES)["near_dedup"]
    assert sorted(r["doc_id"] for r in stage(spark, make_docs(rows), sf_dir).collect()) == survivors(rows)


def test_stage_against_all_pairs_of_the_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = survivors([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    assert sorted(r["doc_id"] for r in dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, sf_dir).collect()) == want


def test_small_bounds_lose_nothing(make_docs):
    """Buckets of four sets, and of a few bytes: chunks meet in pairs and give the same rows."""
    rng, crowd = random.Random(3), prose(120, 8).split()
    rows = planted()
    for i in range(60):  # a crowd whose members are far from their original and from most others
        words = list(crowd)
        for at in rng.sample(range(len(words)), 5):
            words[at] = f"w{rng.random()}"
        rows.append((1000 + i, " ".join(words), "en", "a"))
    want = survivors(rows)
    for bounds in ({}, {"bucket": 4}, {"bucket_bytes": 4000}):
        assert sorted(r["doc_id"] for r in minhash.keep_one_similar(make_docs(rows), **bounds).collect()) == want


def test_shared_counts():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 20_000, n).astype(np.uint64)) for n in (0, 1, 500, 9000, 9000, 12_000)]
    want = [[len(np.intersect1d(a, b)) if len(a) and len(b) else 0 for b in sets] for a in sets]
    got = minhash.shared_counts(sets)
    assert all(got[i, j] == want[i][j] for i in range(6) for j in range(6) if i != j)


def test_rows_equal_in_id_and_text_are_chosen_alike(make_docs):
    rows = [(1, prose(40, 2), lang, source) for lang in ("en", "fr", None) for source in ("a", "b", None)]
    assert len({tuple(minhash.keep_one_similar(make_docs(rows[k:] + rows[:k], 1 + k % 4)).collect()) for k in range(4)}) == 1


def test_odd_rows(make_docs, odd_rows):
    kept = minhash.keep_one_similar(make_docs(odd_rows)).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept) == [(False, 1), (False, 4), (False, 7), (False, 8), (False, 9), (False, 10), (False, 2**62), (True, 0)]
    assert minhash.keep_one_similar(make_docs([])).count() == 0


@pytest.mark.parametrize("text", [None, "", "one", "one two three four five", "a b c d e f", "x " * 50])
def test_shingle_sets(text):
    assert len(minhash.shingle_set(text and text.encode())) == len(shingles(text))


def test_stage_links_fingerprints(spark, make_docs, monkeypatch):
    """SimHash finds what is within its radius by itself: with no MinHash bucket left, copies with small changes are still found."""
    base = prose(900, 31).split()
    rows = [(k, " ".join([*base[:400], f"w{k}", *base[401:]]), "en", "a") for k in range(6)] + [(10 + k, prose(60, 500 + k), "en", "a") for k in range(5)]
    sims = [fingerprint(t.encode(), minhash.WIDTH) for _, t, *_ in rows]
    assert any(0 < (sims[i] ^ sims[j]).bit_count() <= RADIUS for i in range(6) for j in range(i))
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (sims[i] ^ sims[j]).bit_count() <= RADIUS and jaccard(rows[i][1], rows[j][1]) >= 0.8:
                root = [root[j] if r == root[i] else r for r in root]
    want = sorted({min(rows[k][0] for k in range(len(rows)) if root[k] == r) for r in root})
    sketches = minhash._sketches
    monkeypatch.setattr(minhash, "_sketches", lambda *args: sketches(*args).withColumn("bands", F.array().cast("array<long>")))
    kept = sorted(r["doc_id"] for r in dict(corpus_pipeline.STAGES)["near_dedup"](spark, make_docs(rows), "").collect())
    assert kept == want and len(kept) < len(rows)


@pytest.mark.parametrize("text", [None, "", "one", "a b c d e f", "x " * 700])
def test_fingerprint_of_hashes(text):
    data = text and text.encode()
    assert fingerprint_of(minhash.shingle_hashes(data, 5)) == fingerprint(data, 5)
