"""Conversation repair against plain searches."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import sys
import zlib
from functools import lru_cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketry.llm import conversations as cv
from docketry.llm.earley import Parser

TURNS = T.StructType([T.StructField(c, t) for c, t in (("conv_id", T.LongType()), ("turn", T.LongType()), ("role", T.StringType()), ("text", T.StringType()), ("present", T.StringType()), ("conv", T.StringType()))])


def cheapest(tokens):
    """The best (cost, audit) by a plain recursion over what was read and how far the roles are."""

    @lru_cache(maxsize=None)
    def go(i, state, inserts):
        found = []
        if i == len(tokens) and state in ("", "a"):
            found.append((0, ""))
        if inserts < 2:
            cost, rest = go(i, "a" if state == "u" else "u", inserts + 1)
            found.append((cost + 2, "I" + rest))
        if i < len(tokens):
            letter, must_go, extra = tokens[i]
            cost, rest = go(i + 1, state, 0)
            found.append((cost + 3, "D" + rest))
            if not must_go:
                cost, rest = go(i + 1, "a" if state == "u" else "u", 0)
                found.append((cost + 2 + extra, "R" + rest))
                if letter in {"": "su", "s": "u", "u": "a", "a": "u"}[state] and letter:
                    cost, rest = go(i + 1, letter, 0)
                    found.append((cost + extra, "K" + rest))
        return min(found, default=(10**9, ""))

    return go(0, "", 0)


def every_edit(tokens):
    """The best (cost, audit) of all strings of edits with few insertions, by the rule for roles itself."""
    best = None
    for kinds in itertools.product("KRD", repeat=len(tokens)):
        for places in itertools.product((0, 1, 2), repeat=len(tokens) + 1):
            audit = "".join("I" * n + k for n, k in zip(places, (*kinds, "")))
            cost, letters, row, ok = 0, "", 0, True
            for edit in audit:
                if edit == "I":
                    cost, letters = cost + 2, letters + "?"
                    continue
                letter, must_go, extra = tokens[row]
                row += 1
                if edit == "D":
                    cost += 3
                    continue
                ok &= not must_go
                cost, letters = cost + extra + (2 if edit == "R" else 0), letters + ("?" if edit == "R" else letter or "x")
            free = [letters.replace("?", "{}").format(*fill) for fill in itertools.product("ua", repeat=letters.count("?"))] if ok and letters.count("?") < 7 else []
            if any(re.fullmatch("(s?(ua)+)?", x) for x in free) and (best is None or (cost, audit) < best):
                best = cost, audit
    return best


def parsed(tokens):
    parser = Parser(cv.GRAMMAR, cv.SLACK)
    told = "".join(parser.feed(t) for t in tokens)
    assert set(parser.sets) <= {0, len(tokens)}
    cost, rest = parser.finish()
    return cost, told + rest


TOKENS = st.tuples(st.sampled_from("suauaut") | st.just(""), st.booleans(), st.integers(0, 1)).map(lambda t: (t[0], t[1], 0 if t[1] else t[2]))


@given(st.lists(TOKENS, max_size=14))
@settings(max_examples=300, deadline=None)
def test_the_parse_is_the_cheapest(tokens):
    assert parsed(tokens) == cheapest(tokens)


@given(st.lists(TOKENS, max_size=3))
@settings(max_examples=40, deadline=None)
def test_the_parse_against_all_edits(tokens):
    assert parsed(tokens) == every_edit(tokens)


def replayed(turns, audit):
    left, lines, last = list(turns), [], ""
    for edit in audit:
        role, text = (None, "") if edit == "I" else left.pop(0)
        if edit == "D":
            continue
        if edit != "K":
            role = "assistant" if last == "u" else "user"
        last = role[:1]
        lines.append(f"{role}:{text}")
    assert not left
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.mark.parametrize("most", [1, 3, 64])
@pytest.mark.parametrize("pattern", ["ua", "u", "a", "s", "uua", "t", "sau"])
def test_a_long_conversation_takes_bounded_memory(monkeypatch, pattern, most):
    """What is held doesn't grow with the conversation, even where the last turn decides how the first is edited."""
    monkeypatch.setattr(cv, "MOST_TURNS", most)
    sys.setrecursionlimit(20_000)
    rng, repair, tokens, turns = random.Random(1), cv.Repair(), [], []
    for i in range(900):
        letter = rng.choice(pattern) if i % 5 == 0 else pattern[i % len(pattern)]
        tokens.append((letter, i % 17 == 0, int(i % 3 == 0 and i % 17 > 0)))
        turns.append(({"u": "user", "a": "assistant", "s": "system", "t": "tool"}[letter], f"Turn {i}"))
        repair.turn(*turns[-1], *tokens[-1][1:])
        assert len(repair.window) <= most and len(repair.paths) < 12
        assert all(len(audit) < 4 * most + 8 for (p, dot, origin), (_, audit) in repair.parser.sets[i + 1].items())
    cost, audit, sha = repair.end()
    assert (cost, audit) == cheapest(tuple(tokens))
    assert sha == replayed(turns, audit)


def test_long_texts_fold(monkeypatch):
    monkeypatch.setattr(cv, "MOST_CHARS", 50)
    repair, turns = cv.Repair(), [("user", f"{i}" * 40) for i in range(60)]
    for turn in turns:
        repair.turn(*turn, False, 0)
        assert repair.size <= 50 + 80
    cost, audit, sha = repair.end()
    assert (cost, audit) == cheapest((("u", False, 0),) * 60) and sha == replayed(turns, audit)


def brute(rows):
    """Rows (conv, turn, role, text) before damage, as the contract reads."""
    convs = {}
    for conv, turn, role, text in rows:
        kept = convs.setdefault(conv, [])
        told = [" " if x is None else x for x in (conv, turn)]
        kind = zlib.crc32(f"{told[0]}:{told[1]}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        kept += [(turn, role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv, turns in convs.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
        seen, tokens, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in turns:
            body = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            tokens.append((role[:1], fault in ("blank", "duplicate"), int(fault == "truncated")))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        numbers = [t[0] for t in turns if t[0] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        cost, audit = cheapest(tuple(tokens))
        out.append((conv, gaps, *counts.values(), illegal, cost, audit, replayed([t[1:] for t in turns], audit)))
    return sorted(map(str, out))


@pytest.fixture(scope="module")
def odd_turns():
    rng = random.Random(2)
    rows = [(None, None, None, None), (None, 1, "user", "Hi."), (7, None, "user", "a."), (7, None, None, "b."), (8, 0, "", "x"), (8, 0, "tool", "y."), (9, 5, "user", None), (9, 5, "user", "é\x0b "), (9, 2**40, "assistant", "z" * 100_000)]
    rows += [(11, i, "user", "same.") for i in range(20)] + [(12, 3, "user", "tie."), (12, 3, "assistant", "tie."), (12, 3, "assistant", "tie."), (12, 3, "user", "other")]
    texts = ["What is it?", "An answer.", "Half an ans", "", " \n", "Yes!", "No. And"]
    for conv in range(100, 260):
        rows += [(conv, t if rng.random() < 0.9 else None, rng.choice(["user", "assistant", "user", "assistant", "system"]), rng.choice(texts)) for t in range(rng.randrange(1, 12))]
    rows += [(301, i, "user", f"Turn {i}.") for i in range(700)]
    rows += [(300, i, ("user", "assistant")[i % 2], f"Turn {i}.") for i in range(700)]
    return rows


def test_conversations_against_a_plain_reading(spark, odd_turns):
    frame = spark.createDataFrame([(*r, "no", "x") for r in odd_turns], TURNS).repartition(5)
    got = cv.repair(cv.damaged(frame), present=F.col("present"))
    assert sorted(str(tuple(r)) for r in got.collect()) == brute(odd_turns)
    assert cv.repair(cv.damaged(frame.limit(0)), present=F.col("present")).count() == 0


def test_repaired_turns_are_those_of_the_digest(spark, odd_turns):
    frame = spark.createDataFrame([(*r, "no", "x") for r in odd_turns], TURNS)
    rows = cv.repaired(frame)
    lines = rows.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "role", "text"))), lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n").alias("all"))
    got = {r["conv_id"]: hashlib.sha256(r["all"].encode()).hexdigest() for r in lines.collect()}
    want = {r["conv_id"]: r["repaired_sha256"] for r in cv.repair(frame).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert {c: s for c, s in want.items() if s != empty} == got
    assert cv.repaired(frame.limit(0)).count() == 0
