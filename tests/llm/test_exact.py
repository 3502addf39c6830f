"""Exact dedup against plain grouping, and the trie against a dictionary."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docketry.llm import exact

from .conftest import prose


@given(st.lists(st.binary(max_size=6) | st.sampled_from([b"", b"a", b"ab", b"aba", b"a" * 300, b"a" * 299 + b"b"]), max_size=60), st.integers(0, 40))
@settings(max_examples=150, deadline=None)
def test_trie_is_a_dictionary(strings, spill_after):
    trie, known, gone = exact.Patricia(), {}, 0
    for i, s in enumerate(strings):
        leaf, new = trie.terminal(s)
        assert new == (s not in known) and leaf.string == s
        if new:
            leaf.value = known[s] = i
        assert leaf.value == known[s]
        assert trie.held == sum(map(len, known))
        if i == spill_after:
            out = trie.spill()
            assert out and all(known.pop(x.string) == x.value for x in out)
            gone += len(out)
    assert {x.string: x.value for x in trie.leaves(trie.root)} == known
    assert len(trie.spill_all()) == len(known) and trie.held == 0 and trie.root is None


@given(st.binary(max_size=40), st.binary(max_size=40))
def test_first_difference(a, b):
    want = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    assert exact.first_difference(a, b) == want


def brute(rows):
    groups = defaultdict(list)
    for n, (doc, text) in enumerate(rows):
        text = text or ""
        groups[re.sub(r"[\x20\x09-\x0D]", "", text)].append((-len(text), doc is None, doc or 0, n, doc))
    out = []
    for body, members in groups.items():
        best = min(members)
        sha = hashlib.sha256(body.encode()).hexdigest()
        out += [(m[4], best[4], len(members), m is best, sha) for m in members]
    return sorted(map(str, out))


def found(df):
    return sorted(str((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"])) for r in df.collect())


@pytest.mark.parametrize("trie_bytes", [exact.TRIE_BYTES, 2000, 1])
def test_owners_against_plain_grouping(make_docs, odd_rows, trie_bytes):
    rng = random.Random(3)
    copies = [prose(40, i % 7) for i in range(90)] + [prose(40, i % 7).replace(" ", "\n\t") for i in range(30)] + [prose(40, 1) + " " * (i % 3) for i in range(30)]
    rng.shuffle(copies)
    rows = odd_rows + [(1000 + i % 140, t, "en", "a") for i, t in enumerate(copies)]
    docs = make_docs(rows, partitions=5)
    assert found(exact.owners(docs, trie_bytes=trie_bytes)) == brute([(r[0], r[1]) for r in rows])
    assert exact.owners(docs.limit(0)).count() == 0


def test_one_group_holds_most_rows(make_docs):
    rows = [(i, prose(30, 1) if i % 3 else prose(30, 100 + i), "en", "a") for i in range(400)]
    got = exact.owners(make_docs(rows, partitions=8), trie_bytes=500)
    assert found(got) == brute([(r[0], r[1]) for r in rows])


def test_rows_that_stay_have_their_columns(make_docs, odd_rows):
    docs = make_docs(odd_rows)
    kept = exact.keep_owners(docs)
    assert kept.columns == docs.columns
    want = exact.owners(docs).where("kept").select("doc_id").collect()
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r["doc_id"]) for r in want)
    bodies = [re.sub(r"\s", "", r["text"] or "") for r in kept.collect()]
    assert len(set(bodies)) == len(bodies)
    assert exact.keep_owners(docs.limit(0)).count() == 0
