"""Fill-in-middle: a text is cut at two unit boundaries and its parts put in another order around sentinels.

One automaton over bytes does all the reading. Its states follow UTF-8 sequences, tell white space
from words (a unit is a word with the white space before it, or white space that ends the text) and
follow the letters of a sentinel. It is a table; the scan runs all pieces of all texts of a batch
in step, a byte of each at a time, and adds up what the transitions count: units that end, code
points that begin, sentinels that close. A piece starts three bytes early, uncounted, which is all
that a state can depend on. From a text's counts follow its form and its two cuts; the second pass
runs only the pieces in which these lie, and stops at the transition that ends the wanted unit.

Which units and which form is drawn from a digest of a seed and the id, so a rerun gives the same.

Edge cases: a null text is an empty one, and empty texts stay plain; very long texts are scanned in
pieces; a text that holds a sentinel stays plain; a null id hashes as the empty string, repeated rows
and equal ids (ties) draw alike; an empty table gives an empty result; input columns named like an
output column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
OUTPUTS = ("n", "form", "prefix_chars", "middle_chars")
#: Bytes of a piece, and those before it that settle the state in which it starts.
_PIECE, _EARLY = 256, 3

# States: in white space or at the start, in a word, after "<", after "<" and a letter, and waiting
# for one, two or three bytes of a code point.
BLANK, WORD, OPEN, NAMED, WANT1, WANT2, WANT3 = range(7)
_STATES = 7


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Next state, and counts of a transition, by state and byte: units and code points in one word, sentinels in another."""
    after = np.full((_STATES, 256), WORD, np.uint8)
    ends, closes = np.zeros((_STATES, 256), np.int64), np.zeros((_STATES, 256), np.int64)
    blanks = [0x20, *range(0x09, 0x0E)]
    after[:, blanks] = BLANK
    after[:, ord("<")] = OPEN
    after[OPEN, [ord(c) for c in (PREFIX[1], SUFFIX[1], MIDDLE[1])]] = NAMED
    closes[NAMED, ord(">")] = 1
    for lo, hi, state in ((0xC0, 0xE0, WANT1), (0xE0, 0xF0, WANT2), (0xF0, 0xF8, WANT3)):
        after[:, lo:hi] = state
    for state, left in ((WANT1, WORD), (WANT2, WANT1), (WANT3, WANT2)):
        after[state, 0x80:0xC0] = left
    ends[np.ix_(range(WORD, _STATES), blanks)] = 1 << 32  # a word ends, and its unit with it
    points = np.ones(256, np.int64)
    points[0x80:0xC0] = 0
    return after, ends + points, closes


_AFTER, _COUNTS, _CLOSES = _tables()
# Flat tables: a state is held as its row's place, so that a step is one addition and one lookup.
_AFTER = (_AFTER.astype(np.int32) * 256).ravel()
_COUNTS, _CLOSES = _COUNTS.ravel(), _CLOSES.ravel()
_POINTS = (1 << 32) - 1


class Pieces:
    """Texts that lie in one buffer, cut into pieces, and what the automaton counts in each."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        self.data, self.starts, self.ends = data, starts, ends
        pieces = -(-(ends - starts) // _PIECE)
        self.heads = np.concatenate([[0], np.cumsum(pieces)])
        self.text = np.repeat(np.arange(len(starts)), pieces)
        self.at = starts[self.text] + (np.arange(len(self.text)) - self.heads[self.text]) * _PIECE
        self.to = np.minimum(self.at + _PIECE, ends[self.text])
        counts, closed = self._count()
        #: Counts before each piece of the batch, the last one after all.
        self.before = np.concatenate([[0], np.cumsum(counts)])
        self.closed = np.concatenate([[0], np.cumsum(closed)])

    def _entered(self, piece: np.ndarray) -> np.ndarray:
        """The states in which pieces begin, from the bytes before them; a text begins in the first state."""
        state, at, begun = np.zeros(len(piece), np.int32), self.at[piece], self.starts[self.text[piece]]
        for back in range(_EARLY, 0, -1):
            inside = at - back >= begun
            state = np.where(inside, _AFTER[state + self.data[np.where(inside, at - back, 0)]], state)
        return state

    def _count(self) -> tuple[np.ndarray, np.ndarray]:
        """What the transitions of each piece count."""
        order = np.argsort(self.at - self.to, kind="stable")  # the longest first, so that those which end drop off
        at, lengths, state = self.at[order], (self.to - self.at)[order], self._entered(order)
        counts, closed = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
        alive = np.searchsorted(-lengths, -np.arange(_PIECE), side="left")
        for i in range(_PIECE):
            n = alive[i]
            if not n:
                break
            step = state[:n] + self.data[at[:n] + i]
            counts[:n] += _COUNTS[step]
            closed[:n] += _CLOSES[step]
            state[:n] = _AFTER[step]
        back = np.argsort(order, kind="stable")
        return counts[back], closed[back]

    def totals(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(units, code points, sentinels) of each text."""
        whole = self.before[self.heads[1:]] - self.before[self.heads[:-1]]
        units = (whole >> 32) + (self.ends > self.starts)  # what ends with the text is a unit, too
        return units, whole & _POINTS, self.closed[self.heads[1:]] - self.closed[self.heads[:-1]]

    def locate(self, text: np.ndarray, units: np.ndarray, all_units: np.ndarray, all_points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, code points before it) of where the first ``units`` units of each of these texts end."""
        place, points = self.starts[text].copy(), np.zeros(len(text), np.int64)
        whole = units == all_units[text]
        place[whole], points[whole] = self.ends[text[whole]], all_points[text[whole]]
        rest = np.flatnonzero(~whole & (units > 0))
        base = self.before[self.heads[text[rest]]]
        wanted = (base >> 32) + units[rest]  # units that have ended, counted over the batch
        piece = np.searchsorted(self.before >> 32, wanted, side="left") - 1
        left, state, at = wanted - (self.before[piece] >> 32), self._entered(piece), self.at[piece]
        seen, length = (self.before[piece] & _POINTS) - (base & _POINTS), self.to[piece] - self.at[piece]
        open_ = np.arange(len(rest))
        for i in range(_PIECE):
            open_ = open_[length[open_] > i]
            if not len(open_):
                break
            step = state[open_] + self.data[at[open_] + i]
            counted = _COUNTS[step]
            left[open_] -= counted >> 32
            done = left[open_] == 0
            place[rest[open_[done]]], points[rest[open_[done]]] = at[open_[done]] + i, seen[open_[done]]
            seen[open_] += counted & _POINTS
            state[open_] = _AFTER[step]
            open_ = open_[~done]
        return place, points


def _buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of a string column, and where each text starts and ends in them."""
    column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data or b"", np.uint8), ends[:-1], ends[1:]


def fill_in_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: int = 50, spm_rate: int = 80, seed: int = 42
) -> DataFrame:
    """Rows of ``docs`` with the text transformed, and ``n``, ``form``, ``prefix_chars`` and ``middle_chars``.

    ``rate`` of a hundred texts are transformed, ``spm_rate`` of a hundred of those with the suffix
    first. ``n`` is the text's units; the lengths are in code points and null where ``form`` is plain.
    """
    docs = docs.drop(*[c for c in OUTPUTS if c in docs.columns])
    names = docs.columns
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    draws = F.array(*[F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)])

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            draw = np.array(batch.column("__dk_draws").to_pylist(), np.int64).reshape(-1, 4)
            data, starts, ends = _buffer(batch.column(text_col))
            pieces = Pieces(data, starts, ends)
            units, points, sentinels = pieces.totals()
            moved = (ends > starts) & (sentinels == 0) & (draw[:, 2] % 100 < rate)
            text = np.flatnonzero(moved)
            cuts = np.sort(draw[text, :2] % (units[text, None] + 1), axis=1)
            a, a_points = pieces.locate(text, cuts[:, 0], units, points)
            b, b_points = pieces.locate(text, cuts[:, 1], units, points)
            first = draw[:, 3] % 100 < spm_rate
            form = np.where(moved, np.where(first, "spm", "psm"), "plain")
            whole = data.tobytes()
            out = [whole[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
            for i, x, y in zip(text.tolist(), a.tolist(), b.tolist(), strict=True):
                prefix, middle, suffix = (PREFIX.encode(), whole[starts[i] : x]), whole[x:y], (SUFFIX.encode(), whole[y : ends[i]])
                parts = (*suffix, *prefix) if first[i] else (*prefix, *suffix)
                out[i] = b"".join((*parts, MIDDLE.encode(), middle))
            lengths = {}
            for name, values in (("prefix_chars", a_points), ("middle_chars", b_points - a_points)):
                full = np.zeros(len(starts), np.int64)
                full[text] = values
                lengths[name] = pa.array(full, mask=~moved)
            columns = {c: batch.column(c) for c in names} | {text_col: pa.array(out, pa.binary()), "n": pa.array(units.astype(np.int64)), "form": pa.array(form.tolist(), pa.string()), **lengths}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    fields = [T.StructField(f.name, T.BinaryType()) if f.name == text_col else f for f in docs.schema.fields]
    fields += [T.StructField("n", T.LongType()), T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType())]
    made = docs.withColumn("__dk_draws", draws).mapInArrow(transform, T.StructType(fields))
    return made.withColumn(text_col, F.col(text_col).cast("string"))


def restored(output: Column, form: Column) -> Column:
    """The text from which an output was made."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    part = lambda i: F.get(parts, F.lit(i))
    return F.when(form == "psm", F.concat(part(1), part(3), part(2))).when(form == "spm", F.concat(part(2), part(3), part(1))).otherwise(output)
