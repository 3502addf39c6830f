"""Registered queries against plain forms of what they must return, on all of the given documents."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from docketry.llm import queries

from .test_models import brute_metrics
from .test_packing import reference_ids
from .test_simhash import brute_components, brute_fingerprint


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang").collect()
    return [tuple(r) for r in rows]


def test_fingerprints_and_components(spark, sf_dir, documents):
    fps = [brute_fingerprint(t) for _, t, _ in documents]
    comps, least = brute_components(fps), {}
    for (i, *_), c in zip(documents, comps, strict=True):
        least[c] = min(i, least.get(c, i))
    want = Counter((i, f"{f:016x}", least[c]) for (i, *_), f, c in zip(documents, fps, comps, strict=True))
    got = queries.op1_simhash(spark, sf_dir).select("doc_id", "fingerprint", "component_id").collect()
    assert Counter(map(tuple, got)) == want


def _band(bins, reach=3.0):
    """The band of a language from the bins of its distinct texts."""
    ordered = sorted(bins)
    q1, q3 = ((ordered[math.ceil(q * len(ordered)) - 1] + 0.5) / 1000 for q in (0.25, 0.75))
    spread = max(q3 - q1, 0.02)
    return q1 - reach * spread, q3 + reach * spread


def test_rules_and_bands(spark, sf_dir, documents):
    got = {r["doc_id"]: r for r in queries.op2_quality_rules(spark, sf_dir).collect()}
    assert len(got) == len(documents)
    bins = defaultdict(dict)
    for i, text, lang in documents:
        if got[i]["log_perplexity"] is not None:
            bins[lang][text] = math.floor(got[i]["log_perplexity"] * 1000)
    bands = {lang: _band(of.values()) for lang, of in bins.items()}
    for i, text, lang in documents:
        r, metrics = got[i], brute_metrics(text)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == tuple(metrics)
        failed = metrics[0] < 20 or 100 * metrics[4] > 30 * metrics[0]
        assert r["base_failed"] == failed
        if r["log_perplexity"] is not None:
            assert (r["low"], r["high"]) == pytest.approx(bands[lang], abs=1e-9)
        inside = r["log_perplexity"] is not None and bands[lang][0] <= r["log_perplexity"] <= bands[lang][1]
        assert r["kept"] == (not failed and inside)


def test_pieces(spark, sf_dir, documents):
    pieces = defaultdict(list)
    rows = queries.op3_packing(spark, sf_dir).collect()
    for r in rows:
        pieces[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
        assert r["offset"] == 0 and r["length"] <= 1024 and r["length"] & (r["length"] - 1) == 0
    assert len({r["sequence_id"] for r in rows}) == len(rows) and set(pieces) == {i for i, *_ in documents}
    for i, text, _ in documents:
        ids, at = np.array(reference_ids(text), "<u4"), 0
        for start, length, crc, total in sorted(pieces[i]):
            assert (start, total) == (at, len(ids)) and crc == zlib.crc32(ids[at : at + length].tobytes())
            at += length
        assert at == len(ids)


def test_shards(spark, sf_dir, documents):
    rows = queries.op5_sharding(spark, sf_dir).collect()
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in documents)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("rows", None)}
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert sorted(slots) == list(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    again = Counter((r["doc_id"], r["shard"], r["slot"]) for r in queries.op5_sharding(spark, sf_dir).collect())
    assert again == Counter((r["doc_id"], r["shard"], r["slot"]) for r in rows)
