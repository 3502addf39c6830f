"""Fill-in-middle against a plain reading of the texts."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docketry.llm import infill

from .conftest import prose

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc, text):
    text = text or ""
    digest = hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = UNIT.findall(text)
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc, len(units), "plain", None, None, text, text
    if h[3] % 100 < 80:
        return doc, len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}", text
    return doc, len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}", text


PIECES = st.sampled_from(["a", " ", "\n", "\x0b", "<", ">", "P", "<S>", "<<M", "ß", "€", "😀", "\x85", "\u00a0", "word " * 30, "\t" * 250, "x" * 254, "é" * 127])


@given(st.lists(st.lists(PIECES, max_size=14).map("".join), max_size=8))
@settings(max_examples=200, deadline=None)
def test_the_automaton_counts_and_finds(texts):
    """Units, code points, sentinels and every cut, with pieces of all lengths beside each other."""
    raw = [t.encode() for t in texts]
    ends = np.cumsum([0, *map(len, raw)])
    pieces = infill.Pieces(np.frombuffer(b"".join(raw), np.uint8), ends[:-1], ends[1:])
    units, points, sentinels = pieces.totals()
    assert units.tolist() == [len(UNIT.findall(t)) for t in texts]
    assert points.tolist() == [len(t) for t in texts]
    assert sentinels.tolist() == [len(re.findall("<[PSM]>", t)) for t in texts]
    wanted = [(i, k) for i, n in enumerate(units.tolist()) for k in range(n + 1)]
    text, k = (np.array([w[j] for w in wanted], np.int64) for j in (0, 1))
    place, before = pieces.locate(text, k, units, points)
    for i, n, at, chars in zip(text.tolist(), k.tolist(), place.tolist(), before.tolist()):
        prefix = "".join(UNIT.findall(texts[i])[:n])
        assert raw[i][: at - ends[i]].decode() == prefix and chars == len(prefix)


def test_texts_against_a_plain_reading(make_docs, odd_rows):
    rng = random.Random(5)
    parts = ["<P>", "<", "P>", "<S", " ", "\n\n", "wörter ", "word ", "😀", "\t"]
    rows = odd_rows + [(2000 + i, "".join(rng.choice(parts) for _ in range(rng.randrange(60))), "en", "a") for i in range(120)]
    rows += [(3000 + i, prose(40, i), "en", "a") for i in range(60)]
    docs = make_docs(rows)
    made = infill.fill_in_middle(docs)
    assert made.columns == [*docs.columns, *infill.OUTPUTS]
    got = made.withColumn("restored", infill.restored(F.col("text"), F.col("form"))).select("doc_id", *infill.OUTPUTS, "text", "restored").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str(brute(r[0], r[1])) for r in rows)
    assert {r["form"] for r in got} == {"plain", "spm", "psm"}
    assert made.where("size = 'x' and mark = 'x'").count() == len(rows)
    assert infill.fill_in_middle(docs.limit(0)).count() == 0


def test_rates(make_docs):
    docs = make_docs([(i, prose(10, i), "en", "a") for i in range(50)])
    assert {r["form"] for r in infill.fill_in_middle(docs, rate=0).collect()} == {"plain"}
    assert {r["form"] for r in infill.fill_in_middle(docs, rate=100, spm_rate=100).collect()} == {"spm"}
