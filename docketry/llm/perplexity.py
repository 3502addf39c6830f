"""Quality rules: text statistics and n-gram perplexity bands.

Spark counts the character n-grams of the highest order over all texts; the counts of the lower
orders are Kneser-Ney continuation counts, each from the distinct n-grams of the order above, but
for n-grams at the start of a text, which nothing can precede and which keep their counts. Every
order has three discounts from its own counts of counts (modified Kneser-Ney). Interpolated
probabilities and the back-off weights of contexts are kept in arrays sorted by a 64-bit hash and
broadcast. A document's perplexity is that of its characters; each language rejects documents
outside its own band, which reaches three interquartile ranges (the usual fence for far outliers)
beyond the quartiles of the log-perplexity of its texts, copies counting once.

The model keeps all n-grams, so it grows with the texts, on the driver and in the broadcast. Texts
with more than ``most_entries`` distinct n-grams of an order are refused with an error; none is dropped.

Edge cases: a null text has no words; documents without characters have a null perplexity and fail
the base rule; a null language is a language of its own; ties at a quartile share a bin; very long texts are counted and scored in
bounded pieces; repeated rows count each; an empty table gives an empty result; input columns named
like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written

ORDER = 4
_BEGIN, _END = 1, 2
_PIECE = 1 << 19
_BUCKETS = 256
_WINDOW = 8
#: The characters that count as symbols.
SYMBOLS = "#*$%&|<>"
_BLANKS = " \t\n\x0b\x0c\r"
_BINS = 1000
#: Distinct n-grams of an order that the driver may hold: 164 bytes each were measured while an order is built, so some 690 MB.
MOST_ENTRIES = 1 << 22
#: Interquartile ranges from a quartile to the end of a band.
REACH = 3.0
METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def symbols_of(text: str) -> np.ndarray:
    """16-bit symbols of a text: its code points with white space runs as one space, folded beyond the basic plane."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    blank = (points == 32) | ((points >= 9) & (points <= 13))
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    if len(keep):
        keep[0] = True
    points = np.where(blank, 32, points)[keep]
    return np.where(points > 0xFFFF, 0xE000 + points % 0x1800, points).astype(np.uint16)


def gram_keys(text: str) -> Iterator[np.ndarray]:
    """Packed n-grams of the text with its ends, in bounded pieces: the last symbol has the low bits."""
    body = symbols_of(text)
    if not len(body):
        return
    padded = np.concatenate([np.full(ORDER - 1, _BEGIN, np.uint16), body, np.array([_END], np.uint16)])
    for lo in range(0, len(padded) - ORDER + 1, _PIECE):
        part = padded[lo : lo + _PIECE + ORDER - 1].astype(np.uint64)
        key = part[: len(part) - ORDER + 1].copy()
        for i in range(1, ORDER):
            key = (key << np.uint64(16)) | part[i : len(part) - ORDER + 1 + i]
        yield key


def _hash(keys: np.ndarray) -> np.ndarray:
    """A mixing of 64-bit words that maps no two to one."""
    x = keys * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class HashArray:
    """Values by 64-bit key: hashes in a sorted array, entered through their leading bits."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        hashes = _hash(keys)
        order = np.argsort(hashes)
        self.hashes, self.values = hashes[order], values[order].astype(np.float32)
        self.shift = np.uint64(64 - max(1, len(keys).bit_length()))
        heads = (1 << (64 - int(self.shift))) + 1
        self.starts = np.searchsorted((self.hashes >> self.shift).astype(np.int64), np.arange(heads)).astype(np.int32)

    def find(self, keys: np.ndarray, missing: float) -> np.ndarray:
        """Values of the keys, ``missing`` where there is none."""
        out = np.full(len(keys), missing, np.float32)
        if not len(self.hashes):
            return out
        hashes = _hash(keys)
        head = (hashes >> self.shift).astype(np.int64)
        at, end = self.starts[head], self.starts[head + 1]
        rest = np.arange(len(keys))
        while len(rest):
            open_ = at < end
            rest, at, end = rest[open_], at[open_], end[open_]
            hit = self.hashes[at] == hashes[rest]
            out[rest[hit]] = self.values[at[hit]]
            rest, at, end = rest[~hit], at[~hit] + 1, end[~hit]
        return out


class KneserNey:
    """Interpolated log probabilities by order, and back-off weights of contexts."""

    def __init__(self, probabilities: list[HashArray], weights: list[HashArray], floor: float):
        self.probabilities, self.weights, self.floor = probabilities, weights, floor

    def log_probability(self, keys: np.ndarray, top: int = ORDER) -> np.ndarray:
        """Natural log of the probability of each n-gram's last symbol, given the symbols before it up to order ``top``."""
        out, factor, rest = np.zeros(len(keys)), np.zeros(len(keys)), np.arange(len(keys))
        for order in range(top, 0, -1):
            part = keys[rest] & np.uint64((1 << (16 * order)) - 1)
            found = self.probabilities[order].find(part, -1.0)
            hit = found > 0
            out[rest[hit]] = np.log(found[hit]) + factor[hit]
            rest, factor = rest[~hit], factor[~hit]
            if not len(rest):
                return out
            factor = factor + np.log(np.maximum(self.weights[order].find(part[~hit] >> np.uint64(16), 1.0), 1e-9))
        out[rest] = factor + self.floor
        return out


def count_grams(texts: DataFrame) -> DataFrame:
    """(key, n) of all n-grams of the highest order in the column ``text``: tasks send sums, not occurrences."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        keys, counts, n = np.empty(0, np.uint64), np.empty(0, np.int64), 0

        def fold() -> None:
            nonlocal held, keys, counts, n
            if held:
                new, times = np.unique(np.concatenate(held), return_counts=True)
                keys, at = np.unique(np.concatenate([keys, new]), return_inverse=True)
                counts = np.bincount(at, np.concatenate([counts, times])).astype(np.int64)
            held, n = [], 0

        def send() -> Iterator[pa.RecordBatch]:
            bucket = (_hash(keys) % np.uint64(_BUCKETS)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            at = np.searchsorted(bucket[order], np.arange(_BUCKETS + 1))
            for lo in range(0, _BUCKETS, 32):
                spans = [order[at[b] : at[b + 1]] for b in range(lo, lo + 32)]
                blobs = [pa.array([x[s].astype("<i8").tobytes() for s in spans], pa.binary()) for x in (keys.view(np.int64), counts)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(lo, lo + 32), pa.int32()), *blobs],
                    ["bucket", "keys", "counts"],
                )

        for batch in batches:
            for text in batch.column("text").to_pylist():
                for part in gram_keys(text or ""):
                    held.append(part)
                    n += len(part)
                    if n > 4_000_000:
                        fold()
                        if len(keys) > 2_000_000:
                            yield from send()
                            keys, counts = keys[:0], counts[:0]
        fold()
        if len(keys):
            yield from send()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, keys, counts = -1, np.empty(0, np.int64), np.empty(0, np.int64)
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def fold() -> None:
            nonlocal held, keys, counts
            keys, at = np.unique(np.concatenate([keys, *(k for k, _ in held)]), return_inverse=True)
            counts = np.bincount(at, np.concatenate([counts, *(c for _, c in held)]), len(keys)).astype(np.int64)
            held = []

        def done() -> Iterator[pa.RecordBatch]:
            fold()
            for lo in range(0, len(keys), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(keys[lo : lo + 50_000]), pa.array(counts[lo : lo + 50_000])], ["key", "n"])

        for batch in batches:
            for bucket, k, c in zip(*(batch.column(x).to_pylist() for x in ("bucket", "keys", "counts")), strict=True):
                if bucket != current:
                    yield from done()
                    current, keys, counts = bucket, keys[:0], counts[:0]
                held.append((np.frombuffer(k, "<i8"), np.frombuffer(c, "<i8")))
                if sum(len(x) for x, _ in held) > max(1_000_000, len(keys)):  # so that each fold doubles what is held at least
                    fold()
        yield from done()

    sent = texts.select("text").mapInArrow(count, "bucket int, keys binary, counts binary")
    return sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(add, "key long, n long")


def discounts(counts_of_counts: dict[int, int]) -> tuple[float, float, float]:
    """Discounts of counts one, two, and three or more."""
    n1, n2, n3, n4 = (counts_of_counts.get(i, 0) for i in (1, 2, 3, 4))
    if not (n1 and n2):
        return 0.5, 0.75, 0.9
    y = n1 / (n1 + 2 * n2)
    d1 = 1 - 2 * y * n2 / n1
    d2 = 2 - 3 * y * n3 / n2
    d3 = 3 - 4 * y * n4 / n3 if n3 else d2
    return tuple(float(np.clip(d, 0.05, i - 0.05)) for i, d in ((1, d1), (2, d2), (3, d3)))


def fit(texts: DataFrame, most_entries: int = MOST_ENTRIES) -> KneserNey:
    """A modified Kneser-Ney model of the column ``text`` of all rows."""
    grams = written(count_grams(texts), "grams")
    empty = np.empty(0, np.uint64)
    kept: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = [(empty, empty, empty, empty)] * (ORDER + 1)
    floor = -np.log(1 << 16)
    for order in range(ORDER, 0, -1):
        if order < ORDER:
            suffix = F.col("key").bitwiseAND(F.lit((1 << (16 * order)) - 1))
            starts = F.shiftrightunsigned("key", 16 * (order - 1)) == _BEGIN
            grams = grams.groupBy(suffix.alias("key")).agg(F.count("*").alias("before"), F.sum("n").alias("times"))
            grams = written(grams.select("key", F.when(starts, F.col("times")).otherwise(F.col("before")).alias("n")), "grams")
        histogram = {r["n"]: r["count"] for r in grams.groupBy(F.least("n", F.lit(5)).alias("n")).count().collect()}
        if sum(histogram.values()) > most_entries:
            raise ValueError(f"more than {most_entries} distinct n-grams of order {order}: a larger bound needs a larger driver and larger executors")
        d1, d2, d3 = discounts(histogram)
        context = F.shiftrightunsigned("key", 16)
        totals = grams.groupBy(context.alias("context")).agg(F.sum("n").alias("total"))
        share = (F.col("n") - F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)) / F.col("total")
        rows = grams.join(totals, context == F.col("context")).select("key", "context", share.alias("share")).toPandas()
        key, ctx = rows["key"].to_numpy(np.int64).view(np.uint64), rows["context"].to_numpy(np.int64).view(np.uint64)
        alpha = rows["share"].to_numpy(np.float64)
        contexts, at = np.unique(ctx, return_inverse=True)
        weight = np.maximum(1.0 - np.bincount(at, alpha, len(contexts)), 1e-9) if len(contexts) else np.empty(0)
        kept[order] = (key, alpha, contexts, weight)
        if order == 1 and len(key):
            floor = -float(np.log(max(len(key), 2)))
    probabilities, weights = [HashArray(empty, empty)], [HashArray(empty, empty)]
    for order in range(1, ORDER + 1):
        key, alpha, contexts, weight = kept[order]
        weights.append(HashArray(contexts, weight))
        below = np.full(len(key), floor)
        if order > 1:
            below = KneserNey(probabilities, weights, floor).log_probability(key, order - 1)
        probabilities.append(HashArray(key, alpha + weights[order].find(key >> np.uint64(16), 1.0) * np.exp(below)))
    return KneserNey(probabilities, weights, floor)


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of eight words that occur twice or more."""
    n = len(words) - _WINDOW + 1
    if n < 2:
        return 0
    codes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    rolled = np.zeros(n, np.uint64)
    for i in range(_WINDOW):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + codes[i : i + n]
    ordered = np.sort(rolled)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    marks = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(np.isin(rolled, twice))
    np.add.at(marks, at, 1)
    np.add.at(marks, at + _WINDOW, -1)
    return int((np.cumsum(marks[:-1]) > 0).sum())


def text_metrics(text: str | None) -> tuple[int, int, int, int, int]:
    """Words, code points in words, symbols, repeated lines, words in repeated windows."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.encode("utf-8", "replace").split()
    blanks = sum(map(text.count, _BLANKS))
    lines = [x for x in text.split("\n") if x.strip(_BLANKS)]
    return len(words), len(text) - blanks, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words)


def rate(docs: DataFrame, model: KneserNey, text_col: str = "text") -> DataFrame:
    """``docs`` with the metrics and ``log_perplexity``."""
    docs = docs.drop(*[c for c in (*METRICS, "log_perplexity") if c in docs.columns])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            metrics, logs = [], []
            for text in batch.column(text_col).to_pylist():
                metrics.append(text_metrics(text))
                total, n = 0.0, 0
                for keys in gram_keys(text or ""):
                    total -= float(known.log_probability(keys).sum())
                    n += len(keys)
                logs.append(total / n if n else None)
            columns = [*batch.columns, *(pa.array(list(m), pa.int64()) for m in zip(*metrics, strict=True)), pa.array(logs, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, *METRICS, "log_perplexity"])

    schema = T.StructType([*docs.schema.fields, *[T.StructField(m, T.LongType()) for m in METRICS], T.StructField("log_perplexity", T.DoubleType())])
    return docs.mapInArrow(scan, schema)


def bands(rated: DataFrame, lang_col: str = "lang", reach: float = REACH, text_hash: str | None = None) -> DataFrame:
    """(__dk_lang, low, high): each language's band of log-perplexity, from a histogram of all its documents.

    With ``text_hash``, a column that copies share, each text counts once, so that a large group of
    copies doesn't move the band.
    """
    marks = [F.col(lang_col).alias("__dk_lang"), F.floor(F.col("log_perplexity") * _BINS).alias("bin")]
    known = rated.where("log_perplexity is not null")
    known = known.select(*marks, F.col(text_hash).alias("hash")).distinct() if text_hash else known.select(*marks)
    bins = known.groupBy("__dk_lang", "bin").count()
    running = Window.partitionBy("__dk_lang").orderBy("bin")
    whole = Window.partitionBy("__dk_lang")
    share = bins.withColumn("share", F.sum("count").over(running) / F.sum("count").over(whole))

    def quartile(q: float):
        return F.min(F.when(F.col("share") >= q, (F.col("bin") + 0.5) / _BINS))

    found = share.groupBy("__dk_lang").agg(quartile(0.25).alias("q1"), quartile(0.75).alias("q3"))
    spread = F.greatest(F.col("q3") - F.col("q1"), F.lit(0.02))
    return found.select("__dk_lang", (F.col("q1") - reach * spread).alias("low"), (F.col("q3") + reach * spread).alias("high"))


def judge(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", reach: float = REACH, most_entries: int = MOST_ENTRIES, carry: list[str] | None = None) -> DataFrame:
    """Rows of ``docs`` (the columns ``carry``; all by default) with metrics, ``log_perplexity``, ``base_failed`` and ``kept``."""
    model = fit(docs.select(F.col(text_col).alias("text")), most_entries)
    out = [c for c in (carry or docs.columns) if c not in (*METRICS, "log_perplexity", "low", "high", "base_failed", "kept")]
    rated = rate(docs.select(*dict.fromkeys([*out, lang_col, text_col])), model, text_col).withColumn("__dk_text", F.xxhash64(text_col))
    rated = written(rated.select(*dict.fromkeys([*out, lang_col]), *METRICS, "log_perplexity", "__dk_text"), "rated")
    band = written(bands(rated, lang_col, reach, "__dk_text"), "bands")
    joined = rated.join(band, F.col(lang_col).eqNullSafe(F.col("__dk_lang")), "left")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    inside = F.coalesce((F.col("log_perplexity") >= F.col("low")) & (F.col("log_perplexity") <= F.col("high")), F.lit(False))
    return joined.select(*out, *METRICS, "log_perplexity", "low", "high", failed.alias("base_failed"), (~failed & inside).alias("kept"))
