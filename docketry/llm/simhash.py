"""SimHash near-dedup with pivot distance tables.

Each text gets a 64-bit fingerprint. Distinct fingerprints meet in buckets: the 64 bits are cut
into six blocks, at most three differing bits leave three blocks alike, so a fingerprint is put
into the twenty buckets of its block triples and no link is missed. In a bucket, the Hamming
distances of every fingerprint to a fixed set of reference fingerprints (the pivots) are computed
once for each run of buckets that a task holds, for fingerprints that are not alone in all of them; by the triangle inequality a pair whose distances to any pivot differ by more than the
radius is no link and is discarded, and only the pairs that survive all pivots are verified.
Large buckets report a spanning forest instead of all links, which loses no component; a bucket
beyond one task's bound is split into chunks that meet pairwise in separate tasks.

Edge cases: null and blank texts get fingerprint zero and are linked like any others; very long
texts are hashed whole, a bounded run of words at a time; rows with a null id take part, and a
component's id is its smallest id that isn't null; ties between equal ids need no order, as they
give one id, and where one row is kept the smallest id, null last, then the smallest digest of the
text, then the smallest hash of the row decides; repeated rows share a fingerprint; an empty table
gives an empty result; input columns named like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import utf8_bytes, written
from .components import connected_components

OUTPUTS = ("fingerprint", "component_id")
BLOCKS, RADIUS = 6, 3
#: Buckets up to this many fingerprints report each link, larger ones a spanning forest.
_SMALL = 16
#: Fingerprints of a bucket that one task handles at once.
_BUCKET = 16_384
_CHUNK_WORDS = 1 << 18


def pivots(n: int = 24, seed: int = 97) -> np.ndarray:
    """The reference fingerprints: fixed pseudo-random words."""
    return np.random.default_rng(seed).integers(0, 1 << 64, n, np.uint64)


def fingerprint(text: bytes | None, width: int = 3) -> int:
    """The SimHash of a UTF-8 text over word shingles, unsigned."""
    data = (text or b"").lower()
    words = data.split()
    if not words:
        return 0
    if len(words) <= width:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    total, ones = len(words) - width + 1, np.zeros(64, np.int64)
    digest = xxhash.xxh64_digest
    for lo in range(0, total, _CHUNK_WORDS):
        part = words[lo : lo + _CHUNK_WORDS + width - 1]
        shingles = map(b" ".join, zip(*[part[i:] for i in range(width)], strict=False))
        packed = np.frombuffer(b"".join([digest(s, 42) for s in shingles]), np.uint8).reshape(-1, 8)
        for at in range(0, len(packed), 255):
            ones += np.add.reduce(np.unpackbits(packed[at : at + 255], axis=1), axis=0, dtype=np.uint8)
    return int.from_bytes(np.packbits(ones * 2 > total).tobytes(), "big")


def fingerprint_of(hashes: np.ndarray) -> int:
    """The SimHash of a text whose shingles, repeats included, have these hashes, unsigned; zero where there are none."""
    ones = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), _CHUNK_WORDS):
        packed = hashes[lo : lo + _CHUNK_WORDS].astype(">u8").view(np.uint8).reshape(-1, 8)
        for at in range(0, len(packed), 255):
            ones += np.add.reduce(np.unpackbits(packed[at : at + 255], axis=1), axis=0, dtype=np.uint8)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def add_fingerprints(docs: DataFrame, id_col: str, text_col: str, width: int = 3) -> DataFrame:
    """(id, fp) of every row; fp is the fingerprint as a signed long."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, width) for t in utf8_bytes(batch.column("text"))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found.view(np.int64))], ["id", "fp"])

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("fp", T.LongType(), False)])
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(scan, schema)


def bucket_masks(blocks: int = BLOCKS, radius: int = RADIUS) -> list[int]:
    """Bit masks of all choices of ``blocks - radius`` blocks."""
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    spans = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:], strict=False)]
    return [sum(c) for c in combinations(spans, blocks - radius)]


def _signed(word: int) -> int:
    return word - (1 << 64) if word >> 63 else word


def _links_of_pairs(key: np.ndarray, fp: np.ndarray, table: np.ndarray, radius: int, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """All links among neighbours in sorted small buckets, by growing offsets."""
    left, right = [], []
    for step in range(1, longest):
        i = np.flatnonzero(key[:-step] == key[step:])
        if not len(i):
            break
        for p in range(table.shape[1]):
            i = i[np.abs(table[i, p] - table[i + step, p]) <= radius]
        i = i[np.bitwise_count(fp[i] ^ fp[i + step]) <= radius]
        left.append(fp[i])
        right.append(fp[i + step])
    return (np.concatenate(left), np.concatenate(right)) if left else (fp[:0], fp[:0])


def _forest(fp: np.ndarray, table: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that span the components of one bucket: a search over what no step has reached yet."""
    left, right, rest = [], [], np.arange(len(fp))
    stack: list[int] = []
    while len(rest):
        if not stack:
            stack, rest = [int(rest[0])], rest[1:]
            continue
        at = stack.pop()
        near = np.abs(table[rest] - table[at]).max(axis=1) <= radius
        near[near] = np.bitwise_count(fp[rest[near]] ^ fp[at]) <= radius
        found = rest[near]
        if len(found):
            left.append(np.full(len(found), fp[at]))
            right.append(fp[found])
            stack.extend(found.tolist())
            rest = rest[~near]
    return (np.concatenate(left), np.concatenate(right)) if left else (fp[:0], fp[:0])


def _bucket_links(rows: DataFrame, radius: int, bound: int | None) -> DataFrame:
    """Links in rows (key, fp) sorted by key; buckets over ``bound`` come back as rows of kind 1."""
    refs = pivots()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(kind: int, a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
            for lo in range(0, len(a), 50_000):
                x, y = a[lo : lo + 50_000], b[lo : lo + 50_000]
                kinds = np.full(len(x), kind, np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kinds), pa.array(np.ascontiguousarray(x).view(np.int64)), pa.array(np.ascontiguousarray(y).view(np.int64))], ["kind", "a", "b"]
                )

        def solve(key: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            lengths = np.diff(np.concatenate([starts, [len(key)]]))
            many = np.repeat(lengths > 1, lengths)  # what is alone in its bucket needs no distances
            key, fp, lengths = key[many], fp[many], lengths[lengths > 1]
            starts = np.cumsum(lengths) - lengths
            once, at = np.unique(fp, return_inverse=True)
            table = np.bitwise_count(once[:, None] ^ refs[None, :]).astype(np.int16)[at]
            small = np.repeat((lengths > 1) & (lengths <= _SMALL), lengths)
            if small.any():
                yield from out(0, *_links_of_pairs(key[small], fp[small], table[small], radius, _SMALL))
            for s, n in zip(starts[lengths > _SMALL], lengths[lengths > _SMALL], strict=True):
                yield from out(0, *_forest(fp[s : s + n], table[s : s + n], radius))

        key, fp = np.empty(0, np.int64), np.empty(0, np.uint64)
        spilling = None
        for batch in batches:
            key = np.concatenate([key, batch.column("key").to_numpy(zero_copy_only=False)])
            fp = np.concatenate([fp, batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)])
            if spilling is not None:
                n = int(np.searchsorted(key, spilling, "right"))
                yield from out(1, key[:n].view(np.uint64), fp[:n])
                key, fp = key[n:], fp[n:]
                if not len(key):
                    continue
                spilling = None
            cut = int(np.searchsorted(key, key[-1], "left"))  # the last bucket may go on
            if cut:
                yield from solve(key[:cut], fp[:cut])
                key, fp = key[cut:], fp[cut:]
            if bound and len(key) > bound:
                yield from out(1, key.view(np.uint64), fp)
                spilling, key, fp = key[-1], key[:0], fp[:0]
        if len(key):
            yield from solve(key, fp)

    return rows.mapInArrow(search, "kind int, a long, b long")


def links(fps: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fp`` whose components are those of all links."""
    if not 0 < radius < blocks:
        raise ValueError("the radius must be positive and below the number of blocks")
    keys = [F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(_signed(mask)))) for i, mask in enumerate(bucket_masks(blocks, radius))]
    rows = fps.select("fp", F.explode(F.array(*keys)).alias("key")).select("key", "fp")
    found = written(_bucket_links(rows.repartition("key").sortWithinPartitions("key"), radius, _BUCKET), "links")
    edges = found.where("kind = 0").select("a", "b")
    over = found.where("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("fp"))
    if over.isEmpty():
        return edges
    # Every two chunks of an oversized bucket meet in a task of their own.
    n = over.groupBy("key").count().select(F.col("key").alias("k"), F.ceil(F.col("count") / F.lit(_BUCKET // 2)).cast("int").alias("g"))
    chunked = over.join(n, F.col("key") == F.col("k")).withColumn("c", F.pmod(F.xxhash64("fp"), F.col("g")).cast("int"))
    pairs = chunked.select("key", "fp", "c", F.explode(F.sequence(F.lit(0), F.col("g") - 1)).alias("d"))
    pairs = pairs.select(F.xxhash64("key", F.least("c", "d"), F.greatest("c", "d")).alias("key"), "fp")
    more = _bucket_links(pairs.repartition("key").sortWithinPartitions("key"), radius, None)
    return edges.unionByName(more.select("a", "b"))


def _components(marked: DataFrame, radius: int) -> DataFrame:
    """(of_fp, label) for each distinct fingerprint of ``marked``."""
    distinct = written(marked.select("fp").distinct(), "distinct")
    label = connected_components(links(distinct, radius))
    return distinct.join(label, F.col("fp") == F.col("vertex"), "left").select(
        F.col("fp").alias("of_fp"), F.coalesce("component", "fp").alias("label")
    )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, radius: int = RADIUS) -> DataFrame:
    """(id, fingerprint, component_id) of every row: components of fingerprints within ``radius`` bits."""
    marked = written(add_fingerprints(docs, id_col, text_col, width), "fingerprints")
    first = marked.groupBy("fp").agg(F.min("id").alias("first"))
    labelled = first.join(_components(marked, radius), F.col("fp") == F.col("of_fp")).select("fp", "first", "label")
    least = labelled.groupBy("label").agg(F.min("first").alias("component_id")).withColumnRenamed("label", "of")
    classes = labelled.join(least, F.col("label") == F.col("of")).select(F.col("fp").alias("of_fp"), "component_id")
    return marked.join(classes, F.col("fp") == F.col("of_fp")).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _mark(text_col: str):
    """The digest that tells a row's text from those of other rows of its id."""
    return F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit(""))))


def row_keys(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(key, text_col) of every row, the key of its id and its text's digest."""
    return docs.select(F.struct(F.col(id_col).alias("id"), _mark(text_col).alias("mark")).alias("key"), text_col)


def keep_of_classes(docs: DataFrame, marked: DataFrame, classes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` whose key is the smallest ``first`` of a ``label`` in ``classes``.

    ``marked`` has every row's ``key``. Of rows equal in key the one with the smallest hash of all its
    columns stays; texts are sent a second time only for such rows.
    """
    chosen = classes.groupBy("label").agg(F.min("first").alias("first")).select(F.col("first.id").alias("__dk_id"), F.col("first.mark").alias("__dk_of"))
    same = F.col(id_col).eqNullSafe(F.col("__dk_id")) & (F.col("__dk_mark") == F.col("__dk_of"))
    kept = docs.withColumn("__dk_mark", _mark(text_col)).join(chosen, same, "left_semi")
    repeated = marked.groupBy("key").count().where("count > 1").select(F.col("key.id").alias("__dk_id"), F.col("key.mark").alias("__dk_of"))
    repeated = written(repeated, "repeated")
    if repeated.isEmpty():
        return kept.drop("__dk_mark")
    names = [f"`{c}`" for c in docs.columns]
    hashed = [F.col(n) for n, f in zip(names, docs.schema.fields, strict=True) if not _holds_map(f.dataType)]
    groups = kept.join(repeated, same, "left_semi").groupBy(id_col, "__dk_mark")
    one = groups.agg(F.min_by(F.struct(*names), F.xxhash64(*hashed)).alias("__dk_row")).select("__dk_row.*")
    return kept.join(repeated, same, "left_anti").drop("__dk_mark").unionByName(one)


def _holds_map(kind: T.DataType) -> bool:
    return "map<" in kind.simpleString()


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, radius: int = RADIUS) -> DataFrame:
    """One row of ``docs`` for each near-duplicate component: its smallest id, null last, then the smallest digest of the text."""
    marked = written(add_fingerprints(row_keys(docs, id_col, text_col), "key", text_col, width).withColumnRenamed("id", "key"), "fingerprints")
    order = F.struct(F.col("key.id").isNull(), F.col("key.id"), F.col("key.mark"))
    first = marked.groupBy("fp").agg(F.min(order).alias("first"))
    labelled = first.join(_components(marked, radius), F.col("fp") == F.col("of_fp"))
    return keep_of_classes(docs, marked, labelled, id_col, text_col)
