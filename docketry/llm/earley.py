"""A weighted Earley parser that reads its input once and forgets what no derivation needs any more.

Productions have a cost and an audit letter where they edit; chart items are (production, dot,
origin) and keep the smallest (cost, audit) of what they span. Edits that take no token cost
something, so the items of a chart set are relaxed until none gets smaller.

The grammar's recursion must be on the left: what stands after the first place of a rule spans at
most a token. Then an item begins at the first, the last or the current chart set, and all others
are forgotten. Letters that all items from the start share are given out at once. Where derivations
stay apart for long, ``fold`` replaces what they begin with by one character each, so that items
stay short whatever the input's length.
"""

from __future__ import annotations

from collections.abc import Callable
from os.path import commonprefix
from typing import NamedTuple

#: The first of the characters that stand for folded beginnings.
FOLDED = 0xF0000


class Edit(NamedTuple):
    """A production without nonterminals: its letter, its cost, and whether it takes a token (by ``fits``) or none."""

    letter: str
    cost: int
    fits: Callable[[tuple], int | None] | None


class Grammar:
    """Rules by nonterminal: each a sequence of nonterminals, or one edit."""

    def __init__(self, start: str, rules: dict[str, list[tuple[str, ...] | Edit]]):
        self.start = start
        self.names: list[str] = []
        self.bodies: list[tuple[str, ...] | Edit] = []
        self.of: dict[str, list[int]] = {}
        for name, bodies in rules.items():
            for body in bodies:
                self.of.setdefault(name, []).append(len(self.names))
                self.names.append(name)
                self.bodies.append(body)
        #: Letters of edits that take no token.
        self.free = "".join({body.letter for body in self.bodies if isinstance(body, Edit) and body.fits is None})


class Parser:
    """Is fed tokens one by one, and gives out the letters that every derivation that is left begins with.

    ``slack`` bounds what going on from one derivation can cost more than from any other: derivations
    dearer than the cheapest by more than that can't win and are dropped. It follows from the grammar.
    """

    def __init__(self, grammar: Grammar, slack: int):
        self.grammar, self.slack, self.at = grammar, slack, 0
        self.sets: dict[int, dict[tuple[int, int, int], tuple[int, str]]] = {}
        #: By chart set: the items that wait for each nonterminal, and the edits that wait for a token.
        self.waiting: dict[int, dict[str, list[tuple[int, int, int]]]] = {}
        self.open: list[tuple[int, Edit]] = []
        self._close([((p, 0, 0), (0, "")) for p in grammar.of[grammar.start]])

    def feed(self, token: tuple) -> str:
        """Read a token; returns the letters that this settles."""
        last = self.at
        taken = [((p, 1, last), (edit.cost + more, edit.letter)) for p, edit in self.open if (more := edit.fits(token)) is not None]
        self.at += 1
        self._close(taken)
        for old in self.sets.keys() - {0, self.at}:
            del self.sets[old], self.waiting[old]
        return self._settle()

    def finish(self) -> tuple[int, str]:
        """Cost of the best derivation of all tokens, and its letters that were not given out."""
        names = self.grammar.names
        return min(value for (p, dot, origin), value in self.sets[self.at].items() if origin == 0 and names[p] == self.grammar.start and self._over(p, dot))

    def _over(self, p: int, dot: int) -> bool:
        body = self.grammar.bodies[p]
        return dot == (1 if isinstance(body, Edit) else len(body))

    def _close(self, todo: list[tuple[tuple[int, int, int], tuple[int, str]]]) -> None:
        """Make the current set from these items: predict and complete until none gets smaller."""
        grammar, at = self.grammar, self.at
        chart, waiting, ended = {}, {}, {}
        self.sets[at], self.waiting[at], self.open = chart, waiting, []
        while todo:
            key, value = todo.pop()
            known = chart.get(key)
            if known is not None and known <= value:
                continue
            chart[key] = value
            p, dot, origin = key
            body = grammar.bodies[p]
            if self._over(p, dot):
                name = grammar.names[p]
                if origin == at:
                    if name in ended and ended[name] <= value:
                        continue
                    ended[name] = value
                for parent in self.waiting[origin].get(name, ()):
                    cost, audit = self.sets[origin][parent]
                    todo.append(((parent[0], parent[1] + 1, parent[2]), (cost + value[0], audit + value[1])))
            elif isinstance(body, Edit):
                if body.fits is None:
                    todo.append(((p, 1, origin), (body.cost, body.letter)))
                else:
                    self.open.append((p, body))
            else:
                wanted = body[dot]
                if known is None:
                    waiting.setdefault(wanted, []).append(key)
                    todo += [((q, 0, at), (0, "")) for q in grammar.of[wanted] if (q, 0, at) not in chart]
                if wanted in ended:
                    cost, audit = ended[wanted]
                    todo.append(((p, dot + 1, origin), (value[0] + cost, value[1] + audit)))

    def _settle(self) -> str:
        """Drop the items that can't win; the letters that all items from the start begin with, which these lose."""
        chart = self.sets[self.at]
        whole = {key: value for key, value in chart.items() if key[2] == 0}
        most = min(cost for cost, _ in whole.values()) + self.slack
        left = {key: value for key, value in whole.items() if value[0] <= most}
        shared = commonprefix([audit for _, audit in left.values()])
        for key in whole.keys() - left.keys():
            del chart[key]
        chart.update({key: (cost, audit[len(shared) :]) for key, (cost, audit) in left.items()})
        self.waiting[self.at] = {name: [key for key in keys if key in chart] for name, keys in self.waiting[self.at].items()}
        return shared

    def fold(self, tokens: int) -> dict[str, str]:
        """Cut every derivation after so many more tokens; the characters that now stand for the beginnings, with these.

        A beginning starts with the character of an earlier fold if there was one that is not settled.
        Beginnings of equally many tokens that end with a token are never the start of one another, so
        the characters, in the order of the beginnings, compare as these do.
        """
        chart, cuts = self.sets[self.at], {}
        for key, (_, audit) in chart.items():
            if key[2] == 0:
                place, left = int(audit[0] >= chr(FOLDED)), tokens
                while left:
                    left -= audit[place] not in self.grammar.free
                    place += 1
                cuts[key] = place
        begun = sorted({chart[key][1][:place] for key, place in cuts.items()})
        sign = {beginning: chr(FOLDED + i) for i, beginning in enumerate(begun)}
        for key, place in cuts.items():
            cost, audit = chart[key]
            chart[key] = cost, sign[audit[:place]] + audit[place:]
        return {char: beginning for beginning, char in sign.items()}
