"""Which passages of a table long texts hold, whole or nearly: a seed join.

A text that holds a passage shares a run with it: the whole passage, or the least run that a near
match must have. Both sides are cut into grams and winnowed: of each window of neighbouring grams
the ones of the smallest hash are seeds, so two texts that share a run as long as a window share a seed of
it at the same place. Windows are as long as a passage's run allows, so long passages have few seeds.
Seeds of texts that a Bloom filter of the passages' seeds excludes stay where they are; the others
are joined by their hash. Then each text that was hit meets the passages that hit it, one after the other in
a sorted stream: hits are extended to runs, and only windows around the longest run are scored.

Passages are a table of any size; what is sent to all tasks is the filter, which has a bounded size.

Edge cases: null and empty texts hold nothing, null and empty passages are in nothing; texts repeated
under one id count each; of passages under one key each is looked for; very long texts are read in
blocks, but the texts that are hit are held whole, one at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fuzzy
from ..sources.shared import materialised

#: Bits of the filter: so many a seed of the passages, and at most so many.
BITS_A_SEED, MOST_BITS = 16, 1 << 29
#: log2 of the bits of a part of the filter.
_PART = 18
#: Lengths of grams, and the least run from which each is used; shorter runs are one gram themselves.
GRAMS = ((16, 24), (8, 12), (4, 6))
#: Grams of a text that are hashed at once.
_BLOCK = 1 << 20


def gram_of(run: int) -> int:
    """The length of grams for passages of this least run."""
    return next((gram for gram, least in GRAMS if run >= least), max(run, 1))


def _hashes(codes: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of each gram: two grams of half its length make one, and so on down to letters."""
    if gram == 1:
        out = (codes + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    else:
        half = _hashes(codes, gram // 2)
        n, other = len(codes) - gram + 1, gram - gram // 2
        out = half[:n] * np.uint64(0xD6E8FEB86659FD93) + (half if other == gram // 2 else _hashes(codes, other))[gram // 2 : gram // 2 + n]
    out ^= out >> np.uint64(32)
    return out


def _slide(values: np.ndarray, width: int, of) -> np.ndarray:
    """The least or greatest value (``of``) of each window."""
    size = 1
    while 2 * size <= width:
        values, size = of(values[:-size], values[size:]), 2 * size
    rest = width - size
    return of(values[: len(values) - rest], values[rest:]) if rest else values


def seeds(text: str, gram: int, width: int, block: int = _BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hashes, places) of the smallest grams of each window of ``width`` grams, all that are equal, in blocks."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    n = len(codes) - gram + 1
    if n < width:
        return
    for lo in range(0, n, block):
        first, last = max(0, lo - width + 1), min(n, lo + block + width - 1)
        hashes = _hashes(codes[first : last + gram - 1], gram)
        least = np.concatenate([np.zeros(width - 1, np.uint64), _slide(hashes, width, np.minimum), np.zeros(width - 1, np.uint64)])
        mine = np.flatnonzero(_slide(least, width, np.maximum) == hashes)
        mine = mine[(mine + first >= lo) & (mine + first < lo + block)]
        yield hashes[mine], mine + first


def _passage_seeds(passages: DataFrame) -> DataFrame:
    """(hash, item, mark, at, gram) of the passages (item, mark, text, run)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (text, run) in enumerate(zip(batch.column("text").to_pylist(), batch.column("run").to_pylist(), strict=True)):
                gram = gram_of(run)
                for hashes, at in seeds(text, gram, run - gram + 1):
                    row = pa.array(np.full(len(at), i, np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(hashes.view(np.int64)), batch.column("item").take(row), batch.column("mark").take(row), pa.array(at), pa.array(np.full(len(at), gram, np.int32))],
                        ["hash", "item", "mark", "at", "gram"],
                    )

    return passages.mapInArrow(scan, "hash long, item long, mark long, at long, gram int")


def _filter(found: DataFrame, n: int) -> np.ndarray:
    """Bits by hash, as bytes; parts of it come from tasks."""
    bits = 1 << _PART
    while bits < min(BITS_A_SEED * n, MOST_BITS):
        bits *= 2
    place = F.col("hash").bitwiseAND(F.lit(bits - 1))
    parts = found.select(F.shiftright(place, _PART).alias("part"), place.bitwiseAND(F.lit((1 << _PART) - 1)).cast("int").alias("bit"))
    out = np.zeros(bits >> 3, np.uint8)
    for row in parts.groupBy("part").agg(F.collect_set("bit").alias("set")).toLocalIterator():
        part = np.zeros(1 << _PART, bool)
        part[row["set"]] = True
        out[row["part"] << (_PART - 3) : (row["part"] + 1) << (_PART - 3)] = np.packbits(part, bitorder="little")
    return out


def _marked(texts: list[str | None]) -> pa.Array:
    """A mark of each text, by which texts of one id are told apart."""
    digests = (hashlib.blake2b((t or "").encode("utf-8", "surrogatepass"), digest_size=8).digest() for t in texts)
    return pa.array([int.from_bytes(d, "little", signed=True) for d in digests], pa.int64())


def _groups(texts: list[str], most: int = _BLOCK) -> Iterator[slice]:
    """Runs of texts of some ``most`` characters together, or of one longer text."""
    lo, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield slice(lo, i)
            lo, size = i, 0
        size += len(text) + 1
    if texts:
        yield slice(lo, len(texts))


def _text_seeds(docs: DataFrame, widths: dict[int, int], bits: np.ndarray) -> DataFrame:
    """(hash, id, of, pos) of the texts' seeds, for each gram by its narrowest window, that the filter holds."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        mask = np.uint64(len(held) * 8 - 1)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for some in _groups(texts):
                # Texts in one string: what windows across their borders add is no harm.
                whole, lengths = "\0".join(texts[some]), np.fromiter(map(len, texts[some]), np.int64)
                starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
                for gram, width in widths.items():
                    for found, at in seeds(whole, gram, width):
                        place = found & mask
                        hit = (held[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0
                        if hit.any():
                            row = np.searchsorted(starts, at[hit], side="right") - 1
                            which, of = np.unique(row, return_inverse=True)
                            marks = _marked([texts[some.start + i] for i in which]).take(pa.array(of))
                            made = [pa.array(found[hit].view(np.int64)), batch.column("id").take(pa.array(row + some.start)), marks, pa.array(at[hit] - starts[row])]
                            yield pa.RecordBatch.from_arrays(made, ["hash", "id", "of", "pos"])

    schema = T.StructType([T.StructField("hash", T.LongType()), docs.schema["id"], T.StructField("of", T.LongType()), T.StructField("pos", T.LongType())])
    return docs.mapInArrow(scan, schema)


def _bodies(docs: DataFrame) -> DataFrame:
    """(id, of, text) of texts."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("id"), _marked(batch.column("text").to_pylist()), batch.column("text")], ["id", "of", "text"])

    return docs.mapInArrow(mark, T.StructType([docs.schema["id"], T.StructField("of", T.LongType()), docs.schema["text"]]))


class _Longest:
    """The longest run that a text shares with a passage, from its seeds."""

    def __init__(self, body: str, passage: str):
        self.body, self.passage, self.run, self.seen = body, passage, None, {}

    def add(self, pos: int, at: int, gram: int) -> None:
        """A gram of the passage at ``at`` may be in the text at ``pos``."""
        lo, hi, shift = pos, pos + gram, pos - at
        if self.seen.get(shift, -1) >= hi or self.body[lo:hi] != self.passage[at : at + gram]:  # within a run that is known, or another gram of this hash
            return
        body, passage = self.body, self.passage
        while lo > max(shift, 0) and body[lo - 1] == passage[lo - 1 - shift]:
            lo -= 1
        last = min(len(body), shift + len(passage))
        while hi < last and body[hi] == passage[hi - shift]:
            hi += 1
        self.seen[shift] = hi
        run = (lo, lo - shift, hi - lo)
        if self.run is None or (-run[2], run[0], run[1]) < (-self.run[2], self.run[0], self.run[1]):
            self.run = run

    def score(self, near: float | None) -> float:
        if self.run is None:
            return 0.0
        return float(self.run[2] == len(self.passage)) if near is None else fuzzy.contains_score(self.body, self.passage, near, self.run)


def _scored(rows: DataFrame, doc_key: str, key: str, near: float | None) -> DataFrame:
    """Scores from a sorted stream: a text, then for each of its passages that passage and its hits."""
    names = [doc_key, key, "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, body, copies, open_, item = None, "", 0, None, None
        done: list[tuple] = []

        def close() -> None:
            if open_ is not None and (score := open_.score(near)) > 0:
                done.extend([(now[0], item, score)] * copies)

        for batch in batches:
            kind = batch.column("id").type
            for row in zip(*(batch.column(c).to_pylist() for c in ("id", "of", "kind", "item", "text", "pos", "at", "gram")), strict=True):
                if row[2] == 0:
                    close()
                    copies = copies + 1 if now == row[:2] else 1
                    now, body, open_ = row[:2], row[4], None
                elif row[2] == 1:
                    close()
                    open_, item = _Longest(body, row[4]), row[3]
                else:
                    open_.add(*row[5:])
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], kind), pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.float64())], names)
                done = []
        close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], kind), pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.float64())], names)

    schema = T.StructType([T.StructField(doc_key, rows.schema["id"].dataType), T.StructField(key, T.LongType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(run, schema)


def held_passages(docs: DataFrame, passages: DataFrame, doc_key: str, doc_text: str, key: str, text: str, near: float | None = None) -> DataFrame:
    """(doc_key, key, score) of the passages that each text holds: whole, or by ``contains_score`` of at least ``near``.

    A near match must share a run of 35 % of the passage with the text. Every such run holds a seed of
    both sides, and the seeds that are hit tell the longest run.
    """
    given = passages.select(F.col(key).cast("long").alias("item"), F.col(text).alias("text")).where(F.char_length("text") > 0).distinct()
    n = F.char_length("text")
    run = n if near is None else F.least(n, F.greatest(F.lit(3), F.floor(n * F.lit(0.35)).cast("int")))
    given = materialised(given.withColumns({"mark": F.xxhash64("item", "text"), "run": run}), "passages")
    found = materialised(_passage_seeds(given), "seeds")
    gram = F.expr("case " + " ".join(f"when run >= {least} then {gram}" for gram, least in GRAMS) + " else greatest(run, 1) end")
    widths = {r["gram"]: r["width"] for r in given.groupBy(gram.alias("gram")).agg(F.min(F.col("run") - gram + 1).alias("width")).collect()}
    texts = docs.select(F.col(doc_key).alias("id"), F.col(doc_text).alias("text"))
    hits = _text_seeds(texts, widths, _filter(found, found.count())).join(found, "hash")
    hits = materialised(hits.select("id", "of", "item", "mark", "pos", "at", "gram"), "hits")
    hit = hits.select(F.col("id").alias("__id")).distinct()
    bodies = _bodies(texts.join(hit, F.col("id").eqNullSafe(F.col("__id")), "left_semi"))
    pairs = hits.select("id", "of", "item", "mark").distinct().join(given.select("mark", "text"), "mark")
    none = lambda kind: F.lit(None).cast(kind)
    shape = lambda df, kind, **have: df.select("id", "of", F.lit(kind).alias("kind"), *[have.get(c, none(t)).alias(c) for c, t in (("item", "long"), ("mark", "long"), ("text", "string"), ("pos", "long"), ("at", "long"), ("gram", "int"))])
    cols = lambda *names: {c: F.col(c) for c in names}
    rows = shape(bodies, 0, **cols("text")).unionByName(shape(pairs, 1, **cols("item", "mark", "text"))).unionByName(shape(hits, 2, **cols("item", "mark", "pos", "at", "gram")))
    dealt = rows.repartition("id", "of").sortWithinPartitions("id", "of", "item", "mark", "kind", "pos", "at")
    return _scored(dealt, doc_key, key, near)
