"""Language identification by multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased, runs of anything but letters become one space, and all character n-grams of
one to four code points are hashed into a fixed number of columns. Training counts the columns for
each language over all learning rows, adds them up in Spark, and smooths them into a matrix of log
probabilities of fixed width, which is broadcast. Scoring is sparse: a batch of texts becomes a matrix
of counts that holds only the columns that each text has, which is multiplied with those rows of the
table.

Edge cases: a null text, or one without a letter, is ``und`` with score 0; rows with a null text or
language teach nothing; without any learning row every text is ``und``; long texts are counted and
scored in bounded pieces; repeated rows count each; of equally likely languages (ties) the first by
code point is taken; input columns named like an output column are replaced; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN = "und"
ORDERS = (1, 2, 3, 4)
_PIECE = 1 << 18
#: Languages that a task counts before it sends what it has, and blocks of columns that are summed apart.
_HELD, _BLOCKS = 32, 64


def _letter_table() -> np.ndarray:
    """For each code point of the basic plane, whether it is a letter."""
    return np.array([chr(c).isalpha() for c in range(1 << 16)])


_LETTER = _letter_table()


def code_points(text: str) -> np.ndarray:
    """Code points of the lower-cased text with a space for each run of other than letters, and at both ends."""
    return joined_points([text])[1:]


def joined_points(texts: list[str]) -> np.ndarray:
    """The ``code_points`` of all texts, a zero before each."""
    whole = "".join([f"\0 {t.replace(chr(0), ' ') if chr(0) in t else t} " for t in texts]).lower()
    points = np.frombuffer(whole.encode("utf-32-le", "replace"), np.uint32)
    letter = _LETTER[np.minimum(points, 0xFFFF)]
    if len(beyond := np.flatnonzero(points > 0xFFFF)):
        letter[beyond] = [chr(c).isalpha() for c in points[beyond].tolist()]
    head = points == 0
    points = np.where(letter | head, points, 32)
    keep = letter | head
    keep[1:] |= (letter | head)[:-1]  # the first of a run of others stays
    return points[keep]


def ngram_columns(points: np.ndarray, columns: int, starts: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(column, first place) of all n-grams of ``points`` that hold no zero and begin before ``starts``."""
    mixed = points.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    shift = np.uint64(64 - (columns - 1).bit_length())
    whole = points != 0
    out, places = [], []
    rolling, inside = np.zeros(len(mixed), np.uint64), np.ones(len(mixed), bool)
    for n in range(1, max(ORDERS) + 1):
        if len(mixed) < n:
            break
        rolling = rolling[: len(mixed) - n + 1] * np.uint64(0xD6E8FEB86659FD93) + mixed[n - 1 :]
        inside = inside[: len(mixed) - n + 1] & whole[n - 1 :]
        if n in ORDERS:
            at = np.flatnonzero(inside[:starts])
            out.append((((rolling[at] ^ (rolling[at] >> np.uint64(32))) * np.uint64(0xFF51AFD7ED558CCD)) >> shift).astype(np.int64))
            places.append(at)
    return (np.concatenate(out), np.concatenate(places)) if out else (np.empty(0, np.int64), np.empty(0, np.int64))


def _batches(texts: list[str | None], points: int) -> Iterator[tuple[int, list[str]]]:
    """(first, texts) of runs of texts of about so many code points; a null text is empty."""
    lo, size, held = 0, 0, []
    for i, text in enumerate(texts):
        held.append(text or "")
        size += len(held[-1]) + 3
        if size >= points or i + 1 == len(texts):
            yield lo, held
            lo, size, held = i + 1, 0, []


class LanguageModel:
    """Languages, log priors and log probabilities (columns x languages)."""

    def __init__(self, languages: list[str], prior: np.ndarray, table: np.ndarray):
        self.languages, self.prior, self.table = languages, prior, table

    def score(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """The likeliest language of each text and its posterior probability."""
        names, posteriors = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not self.languages:
            return names, posteriors
        for first, held in _batches(texts, max(1 << 12, _PIECE // len(self.languages))):
            total, has_letter = self._totals(held)
            best = total.argmax(axis=1)
            share = 1.0 / np.exp(np.minimum(total - total[np.arange(len(held)), best][:, None], 0.0)).sum(axis=1)
            for i in np.flatnonzero(has_letter).tolist():
                names[first + i], posteriors[first + i] = self.languages[best[i]], share[i]
        return names, posteriors

    def _totals(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log scores (texts x languages): the batch's counts, a sparse matrix sorted by text and column, times the table."""
        total = np.tile(self.prior, (len(texts), 1))
        has_letter = np.zeros(len(texts), bool)
        points = joined_points(texts)
        text_of = np.cumsum(points == 0) - 1
        has_letter[text_of[(points != 32) & (points != 0)]] = True
        width = np.int64(len(self.table))
        step = max(1 << 12, _PIECE // len(self.languages))
        for lo in range(0, len(points), step):
            part = slice(lo, lo + step + max(ORDERS) - 1)
            columns, at = ngram_columns(points[part], len(self.table), step)
            cells, times = np.unique(text_of[part][at] * width + columns, return_counts=True)
            rows, heads = np.unique(cells // width, return_index=True)
            if len(rows):
                total[rows] += np.add.reduceat(self.table[cells % width] * times[:, None].astype(np.float64), heads, axis=0)
        return total, has_letter


def fit(rows: DataFrame, columns: int = 1 << 16, smoothing: float = 0.5, most_languages: int = 1000) -> LanguageModel:
    """Fit on (text, lang) rows: all of them are counted, with no sample.

    The driver gets a vector of ``columns`` counts a language, and the broadcast table has four bytes
    for each of them; more than ``most_languages`` distinct languages are an error.
    """
    span = max(1, columns // _BLOCKS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}

        def send() -> Iterator[pa.RecordBatch]:
            for lang, of in counts.items():
                used = np.flatnonzero(of)
                cuts = np.searchsorted(used, np.arange(0, columns + span, span))
                parts = [(b, used[lo:hi]) for b, (lo, hi) in enumerate(zip(cuts, cuts[1:], strict=False)) if hi > lo or not b]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(parts)), pa.array([b for b, _ in parts], pa.int32()), pa.array([0 if b else docs[lang] for b, _ in parts], pa.int64()),
                        pa.array([(at - b * span).astype("<u4").tobytes() for b, at in parts], pa.binary()), pa.array([of[at].astype("<i8").tobytes() for _, at in parts], pa.binary()),
                    ],
                    ["lang", "block", "docs", "at", "n"],
                )
            counts.clear()
            docs.clear()

        for batch in batches:
            by_lang: dict[str, list[str]] = {}
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                if lang not in counts:
                    if len(counts) >= _HELD:
                        yield from send()
                    counts[lang], docs[lang] = np.zeros(columns, np.int64), 0
                docs[lang] += len(texts)
                for _, held in _batches(texts, _PIECE):
                    points = joined_points(held)
                    for lo in range(0, len(points), _PIECE):
                        counts[lang] += np.bincount(ngram_columns(points[lo : lo + _PIECE + max(ORDERS) - 1], columns, _PIECE)[0], minlength=columns)
        yield from send()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, docs, current = np.zeros(span, np.int64), 0, None

        def done() -> Iterator[pa.RecordBatch]:
            if current is not None:
                values = [[current[0]], [current[1]], [docs], [b""], [of.astype("<i8").tobytes()]]
                kinds = (pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], ["lang", "block", "docs", "at", "n"])

        for batch in batches:
            for lang, block, d, at, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "block", "docs", "at", "n")), strict=True):
                if (lang, block) != current:
                    yield from done()
                    of, docs, current = np.zeros(span, np.int64), 0, (lang, block)
                of[np.frombuffer(at, "<u4")] += np.frombuffer(n, "<i8")
                docs += d
        yield from done()

    schema = "lang string, block int, docs long, at binary, n binary"
    usable = rows.select("text", "lang").where("text is not null and lang is not null")
    # Each language is cut into blocks of columns, so that its sums don't meet in one task.
    summed = usable.mapInArrow(count, schema).repartition("lang", "block").sortWithinPartitions("lang", "block").mapInArrow(add, schema)
    tables: dict[str, np.ndarray] = {}
    docs_of: dict[str, int] = {}
    for r in summed.toLocalIterator():
        if r["lang"] not in tables:
            if len(tables) >= most_languages:
                raise ValueError(f"more than {most_languages} languages")
            tables[r["lang"]], docs_of[r["lang"]] = np.zeros(columns, np.int64), 0
        part = np.frombuffer(r["n"], "<i8")[: columns - r["block"] * span]
        tables[r["lang"]][r["block"] * span : r["block"] * span + len(part)] = part
        docs_of[r["lang"]] += r["docs"]
    if not tables:
        return LanguageModel([], np.empty(0), np.empty((columns, 0), np.float32))
    found = [(lang, docs_of[lang]) for lang in sorted(tables)]
    counts = np.stack([tables[lang] for lang, _ in found], axis=1) + smoothing
    prior = np.log(np.array([f[1] for f in found], float) / sum(f[1] for f in found))
    return LanguageModel([f[0] for f in found], prior, np.log(counts / counts.sum(axis=0)).astype(np.float32))


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, with ``lang_pred`` and ``score``; input columns of those names are replaced."""
    others = [c for c in docs.columns if c not in (text_col, "lang_pred", "score")]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            names, posteriors = known.score(batch.column(text_col).to_pylist())
            columns = [*(batch.column(c) for c in others), pa.array(names, pa.string()), pa.array(posteriors, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*others, "lang_pred", "score"])

    schema = T.StructType([*[docs.schema[c] for c in others], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.select(*others, F.col(text_col)).mapInArrow(scan, schema)
