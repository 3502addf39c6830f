"""Near-dedup by the Jaccard similarity of word shingles: SimHash, then MinHash bands find pairs, whole sets verify them.

Each text has a set of 64-bit hashes of its five-word shingles, and the SimHash of these shingles.
Fingerprints are linked as in ``simhash``: block buckets, pivot distance tables that discard pairs,
verified survivors. A link there is a candidate pair here, verified by the whole sets. That finds
copies with small changes and no more: sets alike to 0.8 differ by ten bits on average and often by
more, and no block scheme holds such a radius. So the pairs beyond the radius are found another way.

Of 288 minima of the set, six make
a band; two sets that share a band are a candidate pair, and a pair is linked only if the similarity
of the whole sets is at least 0.8. A pair at 0.8 shares none of the 48 bands with probability 5e-7,
a more similar pair with less. Equal sets are one vertex. First every set is compared with the
member of its bucket that has the most candidates over all buckets, which in a group of near copies
is their original. Buckets whose members are not in one component by then are solved whole: the
intersections of all their sets are counted at once in a task, which reports a spanning forest, so
no row is made for a pair that is no link. A bucket beyond one task's bound is split into chunks,
every two of which meet in a task of their own.

Edge cases: a text of at most five words is one shingle; null and blank texts have the empty set and
are one group; very long texts have all their shingles; rows with a null id take part; repeated rows
share a set; of a group the row with the smallest id stays, of those (ties) one, rows equal in all
columns included; an empty table gives an empty result; other columns keep their names and values,
whatever they are called, but for names that begin with ``__dk_``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import utf8_bytes, written
from .components import connected_components
from .simhash import RADIUS, fingerprint_of, keep_of_classes, links, row_keys

WIDTH, ALIKE = 5, 0.8
BANDS, ROWS = 48, 6
_CHUNK = 1 << 12
#: Sets of a bucket, and bytes of them, that one task holds at once.
_BUCKET, _BUCKET_BYTES = 1024, 24 << 20
#: Shingles whose owners are multiplied at once.
_COLUMNS = 8192
_EMPTY = np.empty(0, np.uint64)


def _factors() -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and addends of the minima's hash functions: fixed pseudo-random words."""
    words = np.random.default_rng(101).integers(0, 1 << 64, (2, BANDS * ROWS), np.uint64)
    return words[0] | np.uint64(1), words[1]


def shingle_hashes(text: bytes | None, width: int = WIDTH) -> np.ndarray:
    """Hashes of a UTF-8 text's word shingles, repeats included."""
    words = (text or b"").lower().split()
    if not words:
        return _EMPTY
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), 42)], np.uint64)
    shingles = map(b" ".join, zip(*[words[i:] for i in range(width)], strict=False))
    return np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in shingles), np.uint64, len(words) - width + 1)


def shingle_set(text: bytes | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of a UTF-8 text's word shingles."""
    return np.unique(shingle_hashes(text, width))


def set_digest(hashes: np.ndarray) -> int:
    """A set's vertex, signed."""
    word = xxhash.xxh3_64_intdigest(hashes.astype("<u8").tobytes())
    return word - (1 << 64) if word >> 63 else word


def band_keys(hashes: np.ndarray, factors: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """One key a band from the minima of its hash functions."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(hashes), _CHUNK):
        mixed = hashes[lo : lo + _CHUNK, None] * factors[0] + factors[1]
        np.minimum(least, (mixed ^ (mixed >> np.uint64(29))).min(axis=0), out=least)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        key = (key ^ column) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(32)
    return key.view(np.int64)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets; two empty ones are alike."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) + len(b) else 1.0


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """The sizes of the intersections of every two sets: products of the matrix of who owns what, a block of columns at a time."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, times = np.unique(np.concatenate([*sets, _EMPTY]), return_inverse=True, return_counts=True)
    common = times > 1
    column_of = np.cumsum(common) - 1
    wanted = common[column]
    owner, column = owner[wanted], column_of[column[wanted]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(sets), len(sets)))
    n = int(common.sum())
    for lo in range(0, n, _COLUMNS):
        at, end = np.searchsorted(column, [lo, lo + _COLUMNS])
        block = np.zeros((len(sets), min(_COLUMNS, n - lo)), np.float32)
        block[owner[at:end], column[at:end] - lo] = 1.0
        out += block @ block.T
    return out


def forest(sets: list[np.ndarray], label: list[int], alike: float) -> list[tuple[int, int]]:
    """Pairs of places whose sets are alike and that, together, join what the links join; equal labels are joined already."""
    size = np.array([len(s) for s in sets], float)
    both = shared_counts(sets)
    whole = size[:, None] + size[None, :] - both
    of = np.unique(np.array(label), return_inverse=True)[1]
    near = (both >= alike * whole) & (both / np.maximum(whole, 1.0) >= alike) & (of[:, None] != of[None, :])
    found = []
    for i, j in zip(*np.nonzero(np.triu(near)), strict=True):
        if of[i] != of[j]:
            found.append((int(i), int(j)))
            of[of == of[j]] = of[i]
    return found


def _sketches(keyed: DataFrame, text_col: str, width: int) -> DataFrame:
    """(key, fp, n, sim, bands) of every row: the set's vertex and size, the text's SimHash, and the set's band keys."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = _factors()
        for batch in batches:
            sets, sims = [], np.empty(batch.num_rows, np.uint64)
            for i, t in enumerate(utf8_bytes(batch.column("text"))):
                hashes = shingle_hashes(t, width)
                sims[i] = fingerprint_of(hashes)
                sets.append(np.unique(hashes))
            bands = [band_keys(s, factors) for s in sets]
            flat = pa.array(np.concatenate(bands) if bands else np.empty(0, np.int64))
            offsets = pa.array(np.arange(len(bands) + 1, dtype=np.int32) * BANDS)
            columns = [batch.column("key"), pa.array([set_digest(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(sims.view(np.int64))]
            yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(offsets, flat)], ["key", "fp", "n", "sim", "bands"])

    schema = T.StructType([keyed.schema["key"], T.StructField("fp", T.LongType()), T.StructField("n", T.LongType()), T.StructField("sim", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType()))])
    return keyed.select("key", F.col(text_col).alias("text")).mapInArrow(scan, schema)


def _sets(texts: DataFrame, width: int) -> DataFrame:
    """(fp, hashes) of the column ``text``, the set as bytes."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t, width) for t in utf8_bytes(batch.column("text"))]
            for lo in range(0, len(sets), 256):
                part = sets[lo : lo + 256]
                yield pa.RecordBatch.from_arrays([pa.array([set_digest(s) for s in part], pa.int64()), pa.array([s.astype("<u8").tobytes() for s in part], pa.binary())], ["fp", "hashes"])

    return texts.mapInArrow(scan, "fp long, hashes binary")


def _linked_fingerprints(marked: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Candidate pairs (a, b) of vertices whose SimHashes are within ``radius`` bits, as a spanning forest.

    A SimHash stands for its smallest vertex, with which its other vertices are pairs.
    """
    seen = written(marked.where("n > 0").select("sim", "fp").distinct(), "sims")
    first = written(seen.groupBy("sim").agg(F.min("fp").alias("lead")), "leads")
    same = seen.join(first, "sim").where("fp <> lead").select(F.col("lead").alias("a"), F.col("fp").alias("b"))
    of = lambda side: first.select(F.col("sim").alias(f"sim_{side}"), F.col("lead").alias(side))
    near = links(first.select(F.col("sim").alias("fp")), radius).select(F.col("a").alias("sim_a"), F.col("b").alias("sim_b"))
    near = near.join(of("a"), "sim_a").join(of("b"), "sim_b").where("a <> b").select("a", "b")
    return same.unionByName(near).distinct()


def _verified(pairs: DataFrame, sets: DataFrame, alike: float) -> DataFrame:
    """The pairs (a, b) whose whole sets are alike."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column("x"), batch.column("y")
            good = [similarity(np.frombuffer(x[i].as_py(), "<u8"), np.frombuffer(y[i].as_py(), "<u8")) >= alike for i in range(batch.num_rows)]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    of_a = sets.select(F.col("fp").alias("a"), F.col("hashes").alias("x"))
    of_b = sets.select(F.col("fp").alias("b"), F.col("hashes").alias("y"))
    return pairs.join(of_a, "a").join(of_b, "b").select("a", "b", "x", "y").mapInArrow(check, "a long, b long")


def _solved(buckets: DataFrame, alike: float) -> DataFrame:
    """Edges (a, b) that join what the links in the buckets (key, fp, of, hashes) join beyond the components ``of``."""

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []

        def done() -> Iterator[pa.RecordBatch]:
            if len({h[1] for h in held}) > 1:
                found = forest([h[2] for h in held], [h[1] for h in held], alike)
                if found:
                    ends = [pa.array([held[pair[side]][0] for pair in found], pa.int64()) for side in (0, 1)]
                    yield pa.RecordBatch.from_arrays(ends, ["a", "b"])

        for batch in batches:
            for key, fp, of, hashes in zip(*(batch.column(c).to_pylist() for c in ("key", "fp", "of", "hashes")), strict=True):
                if key != current:
                    yield from done()
                    current, held = key, []
                held.append((fp, of, np.frombuffer(hashes, "<u8")))
        yield from done()

    return buckets.repartition("key").sortWithinPartitions("key").mapInArrow(solve, "a long, b long")


def _unsettled(rows: DataFrame, label: DataFrame) -> DataFrame:
    """(key, fp, n, of) of the buckets of ``rows`` that hold more than one component ``of``."""
    marked = rows.join(label, F.col("fp") == F.col("vertex"), "left").select("key", "fp", "n", F.coalesce("component", "fp").alias("of"))
    mixed = marked.groupBy("key").agg(F.min("of").alias("low"), F.max("of").alias("high")).where("low <> high").select("key")
    return marked.join(mixed, "key", "left_semi")


def _chunked(rows: DataFrame, most: int, most_bytes: int) -> DataFrame:
    """``rows`` with a key for each task: buckets within the bounds as they are, every two chunks of the others together."""
    size = rows.groupBy("key").agg(F.count("*").alias("c"), F.sum("n").alias("w"))
    chunks = F.greatest(F.ceil(F.col("c") * 2 / F.lit(most)), F.ceil(F.col("w") * 16 / F.lit(most_bytes)))
    over = size.where((F.col("c") > most) | (F.col("w") * 8 > most_bytes)).select("key", chunks.cast("int").alias("g"))
    dealt = rows.join(over, "key", "left").withColumn("c", F.pmod(F.xxhash64("fp"), F.coalesce("g", F.lit(1))).cast("int"))
    dealt = dealt.withColumn("d", F.explode(F.sequence(F.lit(0), F.coalesce("g", F.lit(1)) - 1)))
    task = F.when(F.col("g").isNull(), F.col("key")).otherwise(F.xxhash64("key", F.least("c", "d"), F.greatest("c", "d")))
    return dealt.select(task.alias("key"), "fp", "n", "of")


def keep_one_similar(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    alike: float = ALIKE,
    bucket: int = _BUCKET,
    bucket_bytes: int = _BUCKET_BYTES,
) -> DataFrame:
    """One row of ``docs`` for each component of pairs of similarity ``alike`` or more: the row that ``keep_one`` would choose.

    ``bucket`` and ``bucket_bytes`` bound what a task holds, not what is compared.
    """
    keyed = row_keys(docs, id_col, text_col)
    marked = written(_sketches(keyed, text_col, width), "sketches")
    rows = written(marked.where("n > 0").select("fp", "n", F.explode("bands").alias("key")).distinct(), "bands")
    shared = rows.groupBy("key").agg(F.count("*").alias("c")).where("c > 1")
    rows = written(rows.join(shared, "key"), "bands")
    near = F.least("n", F.col("lead.n")) >= F.lit(alike) * F.greatest("n", F.col("lead.n"))
    # The member with the most candidates leads its buckets; its pairs with a member are one pair in all of them.
    weight = written(rows.groupBy("fp").agg(F.sum("c").alias("weight")), "weights")
    weighed = written(rows.join(weight, "fp").select("key", "fp", "n", "weight"), "weighed")
    lead = weighed.groupBy("key").agg(F.max(F.struct("weight", "fp", "n")).alias("lead"))
    pairs = weighed.join(lead, "key").where((F.col("fp") != F.col("lead.fp")) & near)
    pairs = pairs.select(F.col("lead.fp").alias("a"), F.col("fp").alias("b"))
    pairs = written(_linked_fingerprints(marked).unionByName(pairs).distinct(), "pairs")
    order = F.struct(F.col("key.id").isNull(), F.col("key.id"), F.col("key.mark"))
    first = written(marked.groupBy("fp").agg(F.min(order).alias("first")), "first")
    compared = weight.select("fp").unionByName(pairs.select(F.explode(F.array("a", "b")).alias("fp")))
    wanted = first.join(compared, "fp", "left_semi").select(F.col("first.id").alias("__dk_id"), F.col("first.mark").alias("__dk_of"))
    wanted = written(wanted, "wanted")
    texts = keyed.join(wanted, F.col("key.id").eqNullSafe(F.col("__dk_id")) & (F.col("key.mark") == F.col("__dk_of")), "left_semi")
    sets = written(_sets(texts.select(F.col(text_col).alias("text")), width).dropDuplicates(["fp"]), "sets")
    edges = written(_verified(pairs, sets, alike), "edges")

    label = written(connected_components(edges), "labels")
    unsettled = written(_unsettled(rows.select("key", "fp", "n"), label), "unsettled")
    if not unsettled.isEmpty():
        more = _solved(_chunked(unsettled, bucket, bucket_bytes).join(sets, "fp"), alike)
        label = connected_components(written(edges.unionByName(more), "edges"))
    label = label.select(F.col("vertex").alias("of_fp"), F.col("component").alias("label"))
    classes = first.join(label, F.col("fp") == F.col("of_fp"), "left").select("first", F.coalesce("label", "fp").alias("label"))
    return keep_of_classes(docs, marked, classes, id_col, text_col)
