from __future__ import annotations

import random
from difflib import SequenceMatcher

import numpy as np
import pytest

from docketry.functions import fuzzy
from docketry.operators import containment
from docketry.operators.containment import held_passages
from docketry.plans import queries


def rows(seed=0):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice("ABCDEFGH") for _ in range(n))
    passages = [(i, text(40)) for i in range(6)] + [(6, ""), (7, None)]
    docs = []
    for i in range(40):
        body = text(120)
        if i % 3 == 0:
            damaged = list(passages[i % 6][1])
            for at in rng.sample(range(40), i % 9):
                damaged[at] = "Z"
            body = body[:50] + "".join(damaged) + body[50:]
        docs.append((i, body))
    return docs + [(100, None), (101, "")], passages


@pytest.mark.parametrize("near", [None, 0.75])
def test_against_brute_force(spark, near):
    docs, passages = rows()
    got = held_passages(spark.createDataFrame(docs, "d long, t string").repartition(3), spark.createDataFrame(passages, "p long, s string"), "d", "t", "p", "s", near)
    score = lambda t, s: float(s in t) if near is None else fuzzy.contains_score(t, s, near)
    want = {(d, p): x for d, t in docs for p, s in passages if t and s and (x := score(t, s)) > 0}
    assert {(r["d"], r["p"]): r["score"] for r in got.collect()} == pytest.approx(want)
    assert want


def test_no_passages_ties_and_repeated_rows(spark):
    docs, passages = rows()
    d, p = spark.createDataFrame(docs, "d long, t string"), spark.createDataFrame(passages, "p long, s string")
    assert held_passages(d, p.where("p < 0"), "d", "t", "p", "s").count() == 0
    assert held_passages(d.where("d < 0"), p, "d", "t", "p", "s").count() == 0
    once = sorted(tuple(r) for r in held_passages(d, p, "d", "t", "p", "s").collect())
    other = next(x for x in once if x[0] != 0)
    odd = d.unionByName(d).unionByName(spark.createDataFrame([(None, docs[0][1]), (0, docs[other[0]][1])], "d long, t string"))
    got = [tuple(r) for r in held_passages(odd.repartition(4), p.unionByName(p), "d", "t", "p", "s").collect()]
    more = [(None, *x[1:]) for x in once if x[0] == 0] + [(0, *x[1:]) for x in once if x[0] == other[0]]
    want = sorted([*once, *once, *more], key=str)
    assert sorted(got, key=str) == want and once[0][0] == 0


@pytest.mark.parametrize(("gram", "width"), [(1, 1), (3, 1), (4, 5), (8, 17), (2, 60)])
def test_shared_runs_share_a_seed(gram, width):
    """Also across blocks, and in texts of few letters, where all equal grams of a window are seeds."""
    rng = random.Random(gram)
    for letters in ("AB", "ABCDEFGH", "A"):
        text = lambda n, letters=letters: "".join(rng.choice(letters) for _ in range(n))
        for _ in range(20):
            run = text(gram + width - 1)
            one, two = text(rng.randrange(90)) + run + text(rng.randrange(90)), text(rng.randrange(90)) + run + text(rng.randrange(9))
            found = [{(h, p) for hs, ps in containment.seeds(t, gram, w, block=rng.choice([7, 1 << 20])) for h, p in zip(hs.tolist(), ps.tolist())} for t, w in ((one, width), (two, width), (one, max(1, width - 2)))]
            assert found[0] <= found[2]  # a wider window has fewer seeds
            shift = one.index(run) - two.index(run)
            assert {(h, p + shift) for h, p in found[1]} & found[0]
            plain = lambda t: {(p) for p in range(len(t) - gram + 1)}
            assert {p for _, p in found[0]} <= plain(one)


@pytest.mark.parametrize("near", [None, 0.75])
def test_short_and_many_passages(spark, near):
    """Passages of one letter and more, against plain search."""
    rng = random.Random(8)
    text = lambda n: "".join(rng.choice("ABCD") for _ in range(n))
    passages = [(i, text(1 + i % 30)) for i in range(60)]
    docs = [(i, text(rng.randrange(1, 200))) for i in range(30)]
    got = held_passages(spark.createDataFrame(docs, "d long, t string"), spark.createDataFrame(passages, "p long, s string"), "d", "t", "p", "s", near)
    score = lambda t, s: float(s in t) if near is None else fuzzy.contains_score(t, s, near)
    want = {(d, p): x for d, t in docs for p, s in passages if (x := score(t, s)) > 0}
    assert {(r["d"], r["p"]): r["score"] for r in got.collect()} == pytest.approx(want)


def test_no_passage_is_broadcast(spark, monkeypatch):
    """What goes to all tasks has a fixed size, and a full filter loses nothing."""
    docs, passages = rows(3)
    d, p = spark.createDataFrame(docs, "d long, t string"), spark.createDataFrame(passages, "p long, s string")
    want = sorted(tuple(r) for r in held_passages(d, p, "d", "t", "p", "s", 0.75).collect())
    sent = []
    context = type(spark.sparkContext)
    send = context.broadcast
    monkeypatch.setattr(context, "broadcast", lambda self, value: sent.append(value) or send(self, value))
    monkeypatch.setattr(containment, "_filter", lambda found, n: np.full(8, 255, np.uint8))
    assert sorted(tuple(r) for r in held_passages(d, p, "d", "t", "p", "s", 0.75).collect()) == want and want
    assert [x.nbytes for x in sent] == [8]


def test_near_finds_every_item_that_is_held_whole(spark, tmp_path):
    """Items of several lines, with a short first line and beyond 200 characters, exact and damaged after the first line."""
    rng = random.Random(4)
    line = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    items = [(0, line(12) + "\n" + line(60)), (1, line(50) + "\n" + line(300)), (2, line(60) + "\n" + line(60))]
    damaged = items[1][1][:200] + "z" * 20 + items[1][1][220:]
    docs = [(i, line(90) + " " + t + " " + line(90)) for i, t in items] + [(3, line(80) + damaged + line(80)), (4, items[2][1].split("\n")[0] + line(300))]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {(r["doc_id"], r["item_id"]) for r in queries.contamination_fuzzy(spark, str(tmp_path)).collect()}
    assert got == {(0, 0), (1, 1), (2, 2), (3, 1)}
    exact = {(r["doc_id"], r["item_id"]) for r in queries.contamination_filter(spark, str(tmp_path)).collect()}
    assert exact == {(0, 0), (1, 1), (2, 2)}


def test_scores_equal_those_of_all_windows():
    rng = random.Random(9)
    for n in (40, 90, 230):
        token = "".join(rng.choice("ABCDEFGH") for _ in range(n))
        near = list(token)
        for at in rng.sample(range(n), n // 12):
            near[at] = "Z"
        text = token[::-1] + "".join(near) + token[: n // 2]
        ratio = lambda w: SequenceMatcher(None, w, token, autojunk=False).ratio()
        want = max(ratio(text[i : i + n]) for i in range(len(text) - n + 1))
        got = fuzzy.contains_score(text, token, 0.5)
        assert got == want or (got > 0.97 and want > 0.97)
