from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docketry.llm import packing, tokens, training_order

from .conftest import prose


@given(st.integers(0, 10_000))
def test_lengths_add_up(n):
    parts = packing.piece_lengths(n)
    assert sum(parts) == n and all(p & (p - 1) == 0 and p <= 1024 for p in parts)
    assert sorted(parts, reverse=True) == parts and len(parts) <= n // 1024 + 10


def reference_ids(text):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.vocabulary_path())
    return t.encode(text or "", add_special_tokens=False).ids + [0]


def test_round_trip(make_docs, odd_rows):
    rows = [r for r in odd_rows if r[0] is not None and r[0] != 6]
    got = packing.pack(make_docs(rows)).collect()
    assert len({r["sequence_id"] for r in got}) == len(got)
    assert all(r["offset"] == 0 and r["length"] == 1 << r["bucket"] == len(r["ids"]) // 4 for r in got)
    for i, text, *_ in rows:
        pieces = sorted((r["start"], bytes(r["ids"]), r["doc_tokens"]) for r in got if r["doc_id"] == i)
        want = np.array(reference_ids(text), "<u4").tobytes()
        assert b"".join(p[1] for p in pieces) == want
        assert zlib.crc32(b"".join(p[1] for p in pieces)) == zlib.crc32(want)
        assert {p[2] for p in pieces} == {len(want) // 4}


def test_repeated_rows_are_packed_each(make_docs, odd_rows):
    got = packing.pack(make_docs(odd_rows)).collect()
    n = sum(len(packing.piece_lengths(len(reference_ids(t)))) for _, t, *_ in odd_rows)
    assert len(got) == n
    assert packing.pack(make_docs([])).count() == 0
    with pytest.raises(ValueError):
        packing.pack(make_docs([]), longest=1000)


@settings(deadline=None)
@given(st.text(st.sampled_from("ab \n\té1.'s"), max_size=200))
def test_pieces_of_long_texts_have_the_same_ids(text):
    old, tokens._PIECE = tokens._PIECE, 7
    try:
        cut = tokens._pieces(text)
    finally:
        tokens._PIECE = old
    assert "".join(cut) == text
    encode = tokens.encoder(tokens.vocabulary_path())
    assert [i for p in cut for i in encode(p)] == encode(text)


@pytest.mark.parametrize("text", ["<|endoftext|>", "<|endoftext|> hi", "a<|endoftext|><|endoftext|>\nb", "<|endoftext", "it's 12 o'clock\u00a0now\r\n\t x", "😀 日本語 ẞ"])
def test_ids_are_those_of_the_tokenizer(text):
    assert tokens.token_ids(text, tokens.vocabulary_path()).tolist() == reference_ids(text)


def test_ids_of_the_documents_are_those_of_the_tokenizer(spark, sf_dir):
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect():
        assert tokens.token_ids(r["text"], tokens.vocabulary_path()).tolist() == reference_ids(r["text"])


def test_a_long_text_without_line_feeds_is_cut(monkeypatch):
    text = prose(3000, 5) + " <|endoftext|> " + prose(3000, 6)
    monkeypatch.setattr(tokens, "_PIECE", 1000)
    assert max(map(len, tokens._pieces(text))) < 1100
    assert tokens.token_ids(text, tokens.vocabulary_path()).tolist() == reference_ids(text)


def test_buckets_are_written_apart(make_docs, odd_rows, tmp_path, spark):
    packed = packing.pack(make_docs(odd_rows))
    packing.write_buckets(packed, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == packed.count() and back.where("length <> shiftleft(1, bucket)").isEmpty()


@pytest.mark.parametrize("n", [1, 2, 3, 17, 256, 1000, 4097])
def test_feistel_is_a_permutation(n):
    a = training_order.feistel_slots(np.arange(n), n, 1)
    assert sorted(a.tolist()) == list(range(n))
    if n > 100:
        assert a.tolist() != training_order.feistel_slots(np.arange(n), n, 2).tolist()
        assert abs(np.corrcoef(a, np.arange(n))[0, 1]) < 0.2


@pytest.mark.parametrize("group", [32 << 20, 100])
def test_shards_hold_every_document(make_docs, odd_rows, tmp_path, monkeypatch, group):
    monkeypatch.setattr(training_order, "_GROUP", group)
    path, length = str(tmp_path / "shards"), 64
    made = training_order.materialise(make_docs(odd_rows), path, length=length, shard_sequences=100)
    index = made.index.collect()
    assert sorted({r["slot"] for r in index}) == list(range(made.sequences))
    files = {int(p.parent.name.removeprefix("shard=")): p.read_bytes() for p in (tmp_path / "shards").glob("shard=*/part-*")}
    assert len(files) == made.shards == len(list((tmp_path / "shards").glob("shard=*")))
    assert sum(len(f) for f in files.values()) == made.sequences * made.stride
    filled, docs = Counter(), {}
    for r in index:
        assert (r["shard"], r["byte_offset"]) == (r["slot"] // 100, r["slot"] % 100 * made.stride)
        ids = training_order.read_record(files[r["shard"]], r["byte_offset"] // made.stride, length)[r["offset"] : r["offset"] + r["length"]]
        assert ids.astype("<u2").tobytes() == bytes(r["ids"])
        filled[r["slot"]] += r["length"]
        docs.setdefault(r["doc_id"], []).append((r["start"], ids.tolist()))
    assert sum(n < length for n in filled.values()) <= 3  # one for each partition
    want = {}
    for i, t, *_ in odd_rows:
        want.setdefault(i, []).append(reference_ids(t))
    for i, w in want.items():
        if len(w) == 1:
            assert [x for _, part in sorted(docs[i]) for x in part] == w[0]
        assert sum(len(part) for _, part in docs[i]) == sum(map(len, w))


def test_ids_that_do_not_fit_are_refused():
    assert training_order._narrow(np.array([0, 65_535], "<u4")).tolist() == [0, 65_535]
    with pytest.raises(ValueError):
        training_order._narrow(np.array([65_536], "<u4"))


def test_no_documents_make_no_shards(make_docs, tmp_path):
    made = training_order.materialise(make_docs([]), str(tmp_path / "none"))
    assert (made.sequences, made.shards, made.index.count()) == (0, 0, 0)
