from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from docketry.llm import linededup

BLANK = " \t\n\x0b\x0c\r"


def brute(rows, least_docs=3, least_chars=20):
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANK))
    seen = {}
    for n, (i, text, *_) in enumerate(rows):
        for k in {key(x) for x in (text or "").split("\n")}:
            if len(k) >= least_chars:
                seen.setdefault(k, set()).add((n, i))
    keeper = {k: max((i for _, i in s if i is not None), default=None) for k, s in seen.items() if len(s) >= least_docs}
    out = []
    for i, text, *_ in rows:
        lines = (text or "").split("\n")
        left = [x for x in lines if key(x) not in keeper or keeper[key(x)] == i]
        out.append((i, "\n".join(left), len(lines), len(lines) - len(left)))
    return Counter(out)


def result(df):
    return Counter((r["doc_id"], r["text"], int(r["n_lines"]), r["n_dropped"]) for r in df.collect())


LINE = "This is a line that repeats in the corpus"
ROWS = [
    (1, f"{LINE}\nunique one", "en", "a"), (2, f"  {LINE.upper()}\t\nshort", "en", "a"), (3, f"{LINE}\n{LINE}\nshort", "en", "a"), (4, "short", "en", "a"),
    (5, "äöü" * 6 + "xx", "de", "a"), (6, "äöü" * 6 + "xx", "de", "a"), (7, "äöü" * 6 + "xx", "de", "a"), (8, "äöü" * 6 + "x", "de", "a"), (9, "äöü" * 6 + "x\n", "de", "a"), (10, "äöü" * 6 + "x", "de", "a"),
    (11, "twice only in the whole set", "en", "a"), (12, "twice only in the whole set", "en", "a"),
]


@pytest.mark.parametrize("rows", [ROWS, []])
def test_small(make_docs, rows):
    assert result(linededup.dedup_lines(make_docs(rows))) == brute(rows)


def test_odd_rows(make_docs, odd_rows):
    assert result(linededup.dedup_lines(make_docs(odd_rows))) == brute(odd_rows)


def test_many_lines_and_a_hot_one(make_docs):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(300):
        lines = [f"this line has the number {int(n)} in its text" for n in rng.integers(0, 900, 12)]
        rows.append((i, "\n".join([LINE, *lines]), "en", "a"))
    assert result(linededup.dedup_lines(make_docs(rows, 7))) == brute(rows)


@pytest.mark.parametrize("bounds", [{"block_keys": 1}, {"block_keys": 20, "bits_per_key": 1 << 16}, {"bits_per_key": 1 << 16}, {"bits_per_key": 1}])
def test_blocks_and_segments_of_any_size_give_the_same(make_docs, bounds):
    rng = np.random.default_rng(0)
    rows = ROWS * 3 + [(100 + i, "\n".join(f"this line has the number {int(n)} in its text" for n in rng.integers(0, 400, 8)), "en", "a") for i in range(150)]
    assert result(linededup.dedup_lines(make_docs(rows, 5), **bounds)) == brute(rows)


def keyed(docs, block_keys):
    chosen = docs.select(F.col("doc_id").alias("id"), F.unhex(F.md5("text")).alias("mark"), "text")
    return linededup._in_buckets(linededup._line_digests(chosen, 20, block_keys), 32)[0]


def test_only_suspected_keys_move(make_docs):
    """The keys are read in place; of 2,000 that are there once hardly any is suspected."""
    rows = [(i, "\n".join([LINE, *(f"line {j} of document {i} is found nowhere else" for j in range(10))]), "en", "a") for i in range(200)]
    lines = keyed(make_docs(rows, 4), 300)
    found = linededup.suspected(lines, linededup.twice_seen(linededup.set_positions(lines, 1), 8), 1)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(block") == 1  # the answers; the other side is bucketed
    assert plan.count("Exchange hashpartitioning(segment") == 1
    assert 200 <= found.count() < 210


def test_a_line_of_all_documents_moves_once_a_block(make_docs):
    lines = keyed(make_docs([(i, LINE, "en", "a") for i in range(400)], 4), 50)
    sent = linededup.set_positions(lines, 1).collect()
    assert len(sent) == len({r["block"] for r in sent}) == 8
    assert sum(len(r["bits"]) for r in sent) == 8 * 2 * 4


def test_two_documents_are_the_least(make_docs):
    rows = ROWS[-2:]
    assert result(linededup.dedup_lines(make_docs(rows), least_docs=2)) == brute(rows, 2)
    with pytest.raises(ValueError):
        linededup.dedup_lines(make_docs(rows), least_docs=1)
