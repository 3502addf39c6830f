"""Conversation structure repair: the cheapest edits that make a conversation's roles alternate.

A well-formed conversation is empty, or an optional system turn and then pairs of a user's and an
assistant's turn. The grammar says so with productions that edit: a turn is kept, given another
role, deleted, or inserted. An error-correcting Earley parse (``earley``) finds the cheapest
derivation, the least audit of equals. Turns that are blank or repeat an earlier one must go; those
that break off cost one if they stay.

The rows of a conversation are sorted by Spark and streamed through one task, which holds the parser
and the last turns that the parser has not settled. Where derivations stay apart (a question of what
the last turn will be), each of the few that are left has a digest of its own and the turns behind it
are let go. So a conversation of any length takes bounded memory, but the audit, which is its result.
Its time is that of one task, since a digest of its whole text is made in order. Repeated turns are
found by a window over the same partitions, whose sort spills.

Edge cases: a null or blank text is blank; a null role is a role that can't be kept, and so is one
of another first letter than s, u or a; rows of one turn (ties) are ordered by role and text, null
turns come first; repeated rows are duplicates; very long texts are streamed like others; a null
conversation is one of its own; an empty table gives an empty result; other columns play no part,
whatever their names.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import parts
from .earley import Edit, Grammar, Parser

KEEP, REROLE, DELETE, INSERT = "KRDI"
ROLES = {"u": "user", "a": "assistant"}
#: Pairs of first letters of roles that may follow one another.
LEGAL = ("su", "ua", "au")
_BLANKS = " \t\n\x0b\x0c\r"
_ENDS = ".!?"
#: Turns, and characters of turns, that a parse holds before it folds derivations that stay apart.
MOST_TURNS, MOST_CHARS = 256, 4 << 20
OUTPUTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")

# A token is (first letter of the role, whether the turn must go, what it costs more if it stays).


def _kept(letter: str) -> Edit:
    return Edit(KEEP, 0, lambda t: t[2] if t[0] == letter and not t[1] else None)


_REROLE = Edit(REROLE, 2, lambda t: None if t[1] else t[2])
_INSERT = Edit(INSERT, 2, None)

#: What has been read: nothing that stays, a system turn, an open question, or whole pairs.
GRAMMAR = Grammar(
    "Talk",
    {
        "Talk": [("Nothing",), ("Answered",)],
        "Nothing": [(), ("Nothing", "Gone")],
        "Headed": [("Nothing", "System"), ("Headed", "Gone")],
        "Asked": [("Nothing", "User"), ("Headed", "User"), ("Answered", "User"), ("Asked", "Gone")],
        "Answered": [("Asked", "Assistant"), ("Answered", "Gone")],
        "System": [_kept("s")],
        "User": [_kept("u"), _REROLE, _INSERT],
        "Assistant": [_kept("a"), _REROLE, _INSERT],
        "Gone": [Edit(DELETE, 3, lambda t: 0)],
    },
)
#: From any state one can go on as from any other at the cost of an inserted turn (2) and a deleted system turn (3).
SLACK = 5


class _Path:
    """A derivation so far: its audit in pieces, each with the one before, the digest of its lines, and the last role."""

    def __init__(self, audit: tuple | None = None, sha=None, last: str = ""):
        self.audit, self.sha, self.last = audit, sha or hashlib.sha256(), last

    def follow(self, letters: str, turns: Iterator[tuple[str, str] | None]) -> _Path:
        """The path after these edits of the turns."""
        sha, last = self.sha.copy(), self.last
        for letter in letters:
            role, text = (None, "") if letter == INSERT else next(turns) or (None, "")
            if letter == DELETE:
                continue
            if letter != KEEP:
                role = answer_to(last)
            sha.update((("\n" if last else "") + f"{role}:{text}").encode("utf-8", "replace"))
            last = role[:1]
        return _Path((self.audit, letters), sha, last)

    def letters(self) -> str:
        """The whole audit."""
        pieces, at = [], self.audit
        while at is not None:
            at, piece = at
            pieces.append(piece)
        return "".join(reversed(pieces))


def answer_to(last: str) -> str:
    """The role that must follow one of this first letter, or begins a conversation without a system turn."""
    return ROLES["a" if last == "u" else "u"]


class Repair:
    """One conversation's parse: takes its turns in order, and in the end tells the cost, the audit and the digest."""

    def __init__(self):
        self.parser, self.path = Parser(GRAMMAR, SLACK), _Path()
        #: Turns that are not settled, those that must go as None, and the characters of the others.
        self.window: deque[tuple[str, str] | None] = deque()
        self.size = 0
        #: Derivations that the parser has folded.
        self.paths: dict[str, _Path] = {}

    def turn(self, role: str, text: str, must_go: bool, extra: int) -> None:
        """The next turn: whether it must go, and what it costs more if it stays."""
        self.window.append(None if must_go else (role, text))
        self.size += 0 if must_go else len(text)
        self._settle(self.parser.feed((role[:1], must_go, extra)))
        if len(self.window) > MOST_TURNS or self.size > MOST_CHARS and len(self.window) > 1:
            tokens = -(-len(self.window) // 2)
            begun = self.parser.fold(tokens)
            self.paths = {char: self._from(beginning) for char, beginning in begun.items()}
            self._drop(tokens)

    def end(self) -> tuple[int, str, str]:
        """(cost, audit, digest of the repaired lines)."""
        cost, letters = self.parser.finish()
        self._settle(letters)
        return cost, self.path.letters(), self.path.sha.hexdigest()

    def _from(self, letters: str) -> _Path:
        """The path of these letters, the first of which may stand for a folded derivation."""
        path = self.paths.get(letters[:1])
        return (path or self.path).follow(letters[1:] if path else letters, iter(self.window))

    def _settle(self, letters: str) -> None:
        if letters:
            folded = letters[0] in self.paths
            self.path = self._from(letters)
            self.paths = {} if folded else self.paths
            self._drop(sum(letter != INSERT for letter in letters[folded:]))

    def _drop(self, turns: int) -> None:
        for _ in range(turns):
            gone = self.window.popleft()
            self.size -= len(gone[1]) if gone else 0


def _faults(text: str, again: bool) -> tuple[str, bool, int]:
    """(fault, whether the turn must go, what it costs more if it stays)."""
    body = text.rstrip(_BLANKS)
    if not body:
        return "blank", True, 0
    if again:
        return "duplicate", True, 0
    return ("truncated", False, 1) if body[-1] not in _ENDS else ("", False, 0)


def _ordered(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, present: Column | None) -> DataFrame:
    """Rows (conv, turn, role, text, present, again) by conversation, in order of their turns."""
    here = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    role, text = (F.when(here, F.coalesce(F.col(c), F.lit(" "))) for c in (role_col, text_col))
    plain = rows.select(F.col(conv_col).alias("conv"), F.when(here, F.col(turn_col)).cast("long").alias("turn"), role.alias("role"), text.alias("text"), here.alias("present"))
    dealt = plain.repartition(parts(rows), "conv")
    same = Window.partitionBy("conv", "present", "role", "text").orderBy("turn")
    return dealt.withColumn("again", F.row_number().over(same)).sortWithinPartitions("conv", "turn", "role", "text", "again")


_COLUMNS = ("conv", "turn", "role", "text", "present", "again")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, tuple]]:
    """Rows of sorted batches, each with whether it begins another conversation."""
    current, begun = None, False
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in _COLUMNS), strict=True):
            new = not begun or row[0] != current
            current, begun = row[0], True
            yield new, row


class _Summary:
    """The figures of one conversation."""

    def __init__(self, conv):
        self.conv, self.repair = conv, Repair()
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.low = self.high = self.before = None
        self.turns = 0

    def add(self, turn: int | None, role: str, text: str, again: int) -> None:
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.turns += 1
        if self.before is not None and self.before + role[:1] not in LEGAL:
            self.counts["illegal"] += 1
        self.before = role[:1]
        fault, must_go, extra = _faults(text, again > 1)
        if fault:
            self.counts[fault] += 1
        self.repair.turn(role, text, must_go, extra)

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv, gaps, *self.counts.values(), *self.repair.end())


def repair(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", present: Column | None = None
) -> DataFrame:
    """(conversation, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit``, ``repaired_sha256``) of each conversation.

    ``gaps`` are missing turns between the first and the last; the counts are of faulty turns, by the
    first fault of each, and of neighbours whose roles may not follow one another. ``audit`` has the
    first letters of the cheapest edits (K, R, D, I). The digest is of the repaired ``role:text``
    lines. Rows for which ``present`` doesn't hold only say that there is such a conversation.
    """
    conv_type = rows.schema[conv_col].dataType
    kind = {"cost": T.LongType(), "audit": T.StringType(), "repaired_sha256": T.StringType()}
    schema = T.StructType([T.StructField(conv_col, conv_type), *[T.StructField(c, kind.get(c, T.LongType())) for c in OUTPUTS]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, summary, done = None, None, []

        def out() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True))
            arrays = [pa.array(columns[0], kinds), *(pa.array(list(c), pa.string() if n in ("audit", "repaired_sha256") else pa.int64()) for n, c in zip(OUTPUTS, columns[1:], strict=True))]
            done.clear()
            return pa.RecordBatch.from_arrays(arrays, [conv_col, *OUTPUTS])

        def typed() -> Iterator[pa.RecordBatch]:
            nonlocal kinds
            for batch in batches:
                kinds = batch.column("conv").type
                yield batch

        for new, (conv, turn, role, text, here, again) in _conversations(typed()):
            if new:
                if summary is not None:
                    done.append(summary.row())
                summary = _Summary(conv)
                if len(done) >= 4096:
                    yield out()
            if here:
                summary.add(turn, role, text, again)
        if summary is not None:
            done.append(summary.row())
            yield out()

    return _ordered(rows, conv_col, turn_col, role_col, text_col, present).select(*_COLUMNS).mapInArrow(run, schema)


def repaired(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The repaired conversations: (conversation, ``position``, ``edit``, role, text) of each turn that stays or is inserted.

    The audits of ``repair`` go before the turns of their conversations, which are then edited one by one.
    """
    conv_type = rows.schema[conv_col].dataType
    names = [conv_col, "position", "edit", role_col, text_col]
    schema = T.StructType([T.StructField(n, t) for n, t in zip(names, (conv_type, T.LongType(), *[T.StringType()] * 3), strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out(kinds: pa.DataType) -> pa.RecordBatch:
            types = (kinds, pa.int64(), pa.string(), pa.string(), pa.string())
            made = pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names)
            held.clear()
            return made

        audit, at, position, last = "", 0, 0, ""
        for batch in batches:
            kinds = batch.column("conv").type
            for conv, letters, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "audit", "role", "text")), strict=True):
                if letters is not None:
                    audit, at, position, last = letters, 0, 0, ""
                # Up to the edit of this turn and the insertions after it; an audit itself stands for those before the first turn.
                mine = letters is None
                while at < len(audit) and (mine or audit[at] == INSERT):
                    edit, at = audit[at], at + 1
                    if edit != INSERT:
                        mine = False
                    if edit != DELETE:
                        now = role if edit == KEEP else answer_to(last)
                        held.append((conv, position, edit, now, "" if edit == INSERT else text))
                        position, last, size = position + 1, now[:1], size + len(text or "")
                if len(held) >= 4096 or size > 4 << 20:
                    yield out(kinds)
                    size = 0
            if held:
                yield out(kinds)
                size = 0

    ordered = _ordered(rows, conv_col, turn_col, role_col, text_col, None).select(*_COLUMNS, F.lit(None).cast("string").alias("audit"))
    audits = repair(rows, conv_col, turn_col, role_col, text_col).where("audit <> ''")
    heads = audits.select(F.col(conv_col).alias("conv"), *[F.lit(None).cast(ordered.schema[c].dataType).alias(c) for c in _COLUMNS[1:]], "audit")
    both = ordered.unionByName(heads).repartition(parts(rows), "conv")
    # An audit comes before the turns, which have none.
    return both.sortWithinPartitions("conv", F.col("audit").isNull(), "turn", "role", "text", "again").select("conv", "audit", "role", "text").mapInArrow(run, schema)


def damaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Conversations with seeded faults: (conversation, turn, role, text, ``present``).

    The CRC-32 of ``conversation:turn`` modulo 20 says what happens to a row: 0 drops it (``present`` is
    false), 1 empties its text, 2 takes its ``.!?`` out, 3 repeats it, 4 makes it the user's. A null is
    one space.
    """
    told = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv_col, turn_col)]
    kind = F.crc32(F.concat(told[0], F.lit(":"), told[1]).cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in (role_col, text_col))
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, _ENDS, "")).otherwise(text)
    rows = rows.select(F.col(conv_col), F.col(turn_col), F.when(kind == 4, F.lit("user")).otherwise(role).alias(role_col), text.alias(text_col), (kind != 0).alias("present"), kind.alias("__dk_kind"))
    return rows.withColumn("__dk_copy", F.explode(F.array_repeat(F.lit(0), F.when(F.col("__dk_kind") == 3, 2).otherwise(1)))).drop("__dk_kind", "__dk_copy")
