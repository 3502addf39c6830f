"""Approximate nearest neighbours by 2-stable projections and kd-trees.

Vectors are projected on a few Gaussian directions, so the squared projected distance of two
vectors over their squared distance follows a chi-square law with as many degrees of freedom. The
directions are made orthogonal, which only narrows the law: the test below errs to the safe side.
The projected space is cut into cells by a kd-tree of median cuts fitted on a bounded sample; every
row is put into its cell. A query first visits its own cell: a best-first walk of a kd-tree over the
cell's projected rows yields leaves by growing projected distance, and of a leaf only the rows whose
own projected distance passes the test are verified on the original vectors. The test: by the
chi-square law, a row nearer than the present k-th would lie beyond that projected distance with a
probability below ``miss``. The walk ends when the next box fails it. The k-th distance found then
picks the other cells by the same test, and the query visits those.

A vector that many rows share stands for them with its k + 1 smallest ids, which is all that a
result of k can hold; no result is lost by that. Cells are split into blocks, of bounded rows and
of bounded work: data is sent once, queries go to each block, and a task holds one block while the
queries stream past it.

Edge cases: vectors that are null, empty, zero, of another length than most, or that hold a null or
non-finite component take no part, and neither do null ids; ties go to the smaller id; rows equal in
id and vector count once, and rows that repeat an id with different vectors are candidates each; an
empty table gives an empty result; only the id and vector columns are read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

_LEAF = 96
#: Cells at most, so that what is broadcast of them is bounded; a cell beyond a block's rows has several blocks.
_MOST_CELLS = 4096


def chi_square_quantile(p: float, m: int) -> float:
    """The quantile of the chi-square law with ``m`` degrees of freedom, by bisection of its series."""

    def below(x: float) -> float:
        a, half = m / 2, x / 2
        term = math.exp(a * math.log(half) - half - math.lgamma(a + 1)) if half else 0.0
        total, n = term, 0
        while term > total * 1e-16:
            n += 1
            term *= half / (a + n)
            total += term
        return total

    lo, hi = 0.0, 1.0
    while below(hi) < p:
        hi *= 2
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if below(mid) < p else (lo, mid)
    return hi


def directions_of(width: int, most: int, seed: int) -> np.ndarray:
    """At most ``most`` orthogonal Gaussian directions as columns: a vector's square times their number is its projection's, on average."""
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, min(most, width))))
    return q * math.sqrt(width)


class KdTree:
    """A kd-tree over points that is walked best first."""

    def __init__(self, points: np.ndarray, leaf: int = _LEAF):
        low, high = [points.min(axis=0)], [points.max(axis=0)]
        self.rows: list[np.ndarray] = [np.arange(len(points))]
        self.children: list[tuple[int, int] | None] = [None]
        at = 0
        while at < len(self.rows):
            rows = self.rows[at]
            if len(rows) > leaf:
                axis, half = int((high[at] - low[at]).argmax()), len(rows) // 2
                order = np.argpartition(points[rows, axis], half)
                self.children[at] = (len(self.rows), len(self.rows) + 1)
                for part in (rows[order[:half]], rows[order[half:]]):
                    self.rows.append(part)
                    self.children.append(None)
                    low.append(points[part].min(axis=0))
                    high.append(points[part].max(axis=0))
            at += 1
        self.low, self.high = np.array(low), np.array(high)

    def by_distance(self, at: np.ndarray) -> Iterator[tuple[float, np.ndarray]]:
        """(squared distance of the leaf's box, rows) in growing order; boxes are opened only as the walk gets there."""
        ahead: list[tuple[float, int]] = [(0.0, 0)]
        while ahead:
            far, node = heapq.heappop(ahead)
            inner = self.children[node]
            if inner is None:
                yield far, self.rows[node]
                continue
            span = slice(inner[0], inner[1] + 1)
            gap = np.maximum(np.maximum(self.low[span] - at, at - self.high[span]), 0.0)
            for child, square in zip(inner, (gap * gap).sum(axis=1).tolist(), strict=True):
                heapq.heappush(ahead, (square, child))


class Cells:
    """A kd-tree of median cuts of the projected space, fitted on a sample."""

    def __init__(self, sample: np.ndarray, cells: int):
        self.boxes: list[tuple[np.ndarray, np.ndarray]] = []
        self.cuts: list[tuple[int, float, int, int]] = []  # axis, value, left, right; below 0: ~cell
        m = sample.shape[1]

        def grow(rows: np.ndarray, want: int, low: np.ndarray, high: np.ndarray) -> int:
            part = sample[rows]
            spread = np.ptp(part, axis=0) if len(rows) else np.zeros(m)
            if want < 2 or not spread.any():
                self.boxes.append((low, high))
                return ~(len(self.boxes) - 1)
            axis = int(spread.argmax())
            value = float(np.quantile(part[:, axis], (want // 2) / want))
            node = len(self.cuts)
            self.cuts.append((axis, value, 0, 0))
            left_high, right_low = high.copy(), low.copy()
            left_high[axis] = right_low[axis] = value
            left = grow(rows[part[:, axis] < value], want // 2, low, left_high)
            right = grow(rows[part[:, axis] >= value], want - want // 2, right_low, high)
            self.cuts[node] = (axis, value, left, right)
            return node

        self.root = grow(np.arange(len(sample)), cells, np.full(m, -np.inf), np.full(m, np.inf))
        self.low = np.array([b[0] for b in self.boxes])
        self.high = np.array([b[1] for b in self.boxes])

    def of(self, points: np.ndarray) -> np.ndarray:
        """The cell of each point."""
        node = np.full(len(points), self.root)
        while (inner := np.flatnonzero(node >= 0)).size:
            at = np.array([self.cuts[n] for n in node[inner]])
            left = points[inner, at[:, 0].astype(int)] < at[:, 1]
            node[inner] = np.where(left, at[:, 2], at[:, 3]).astype(int)
        return ~node

    def distances(self, at: np.ndarray) -> np.ndarray:
        """Squared distances of one point to all cells."""
        gap = np.maximum(np.maximum(self.low - at, at - self.high), 0.0)
        return (gap * gap).sum(axis=1)


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


class Block:
    """Rows that a task holds while queries stream past them."""

    def __init__(self, vectors: np.ndarray, ids: list[list[int]], directions: np.ndarray, limit: float, k: int):
        self.vectors, self.ids, self.directions, self.limit, self.k = vectors, ids, directions, limit, k
        self.points = vectors @ directions
        self.tree = KdTree(self.points)

    def nearest(self, query: int, vector: np.ndarray, bound: float) -> tuple[list[tuple[float, int]], int]:
        """The k nearest (square, id) that pass the test, none beyond ``bound``, and the number of rows verified."""
        at, best, worst, verified = vector @ self.directions, [], bound, 0
        for far, rows in self.tree.by_distance(at):
            if far > self.limit * worst:
                break
            gap = self.points[rows] - at
            rows = rows[(gap * gap).sum(axis=1) <= self.limit * worst]
            if not len(rows):
                continue
            verified += len(rows)
            gap = self.vectors[rows] - vector
            squares = (gap * gap).sum(axis=1)
            near = np.flatnonzero(squares <= worst)
            if len(near):
                best += [(float(squares[i]), int(x)) for i in near for x in self.ids[rows[i]] if x != query]
                best = sorted(best)[: self.k]
                if len(best) == self.k:
                    worst = min(worst, best[-1][0])
        return best, verified


_FOUND = "query_id long, vec_id long, square double, verified long"


def _visit(data: DataFrame, asked: DataFrame, k: int, limit: float, basis: np.ndarray, block_rows: int, block_work: int) -> DataFrame:
    """Queries (id, v, bound, cell) against the rows (v, ids, cell) of their cells.

    One row for each neighbour found, and one without neighbour for each block that a query saw,
    with the number of rows verified.
    """
    wanted = asked.groupBy("cell").agg(F.count("*").alias("asked"))
    sizes = data.groupBy("cell").agg(F.count("*").alias("rows")).join(wanted, "cell")
    needs = F.greatest(F.col("rows") / F.lit(block_rows), F.col("rows") * F.col("asked") / F.lit(block_work))
    blocks_of = written(sizes.select("cell", F.ceil(needs).cast("int").alias("blocks")), "blocks")
    held = data.join(blocks_of, "cell").select(
        "cell", F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int").alias("block"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("id"), "v", "ids", F.lit(None).cast("double").alias("bound")
    )
    passing = asked.join(blocks_of, "cell").select(
        "cell", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("kind"), "id", "v", F.lit(None).cast("array<long>").alias("ids"), "bound"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, parts, block = None, [], None
        for batch in batches:
            where = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("cell", "block", "kind")], axis=1)
            cuts = np.flatnonzero((where[1:] != where[:-1]).any(axis=1)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(where)], strict=True):
                if hi == lo:
                    continue
                if place != tuple(where[lo, :2]):
                    place, parts, block = tuple(where[lo, :2]), [], None
                piece = batch.slice(lo, hi - lo)
                if not where[lo, 2]:
                    parts.append((_matrix(piece.column("v")), piece.column("ids").to_pylist()))
                    continue
                if not parts:
                    continue
                if block is None:
                    block = Block(np.concatenate([p[0] for p in parts]), [x for p in parts for x in p[1]], basis, limit, k)
                found: list[tuple[int, int | None, float | None, int]] = []
                for query, vector, bound in zip(piece.column("id").to_pylist(), _matrix(piece.column("v")), piece.column("bound").to_pylist(), strict=True):
                    best, verified = block.nearest(query, vector, bound)
                    found += [(query, x, s, 0) for s, x in best]
                    found.append((query, None, None, verified))
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*found, strict=True), kinds, strict=True)], ["query_id", "vec_id", "square", "verified"])

    together = held.unionByName(passing).repartition("cell", "block").sortWithinPartitions("cell", "block", "kind")
    return together.mapInArrow(run, _FOUND)


def nearest(
    table: DataFrame,
    queries: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 10,
    directions: int = 32,
    miss: float = 0.1,
    block_rows: int = 8192,
    block_work: int = 1 << 28,
    sample_rows: int = 20_000,
    seed: int = 5,
) -> DataFrame:
    """(query_id, rank, vec_id, score, verified): for each row where ``queries`` holds, its k nearest others.

    The cells are fitted on at most ``sample_rows`` vectors; every row is indexed. ``miss`` bounds
    the chance that a true neighbour is skipped by the test. ``verified`` is the number of distinct
    vectors that were compared with the query in full. A block has at most about ``block_rows`` rows
    and meets at most about ``block_work`` pairs of a row and a query.
    """
    spark = table.sparkSession
    rows = table.where(F.col(id_col).isNotNull() & _usable(F.col(vector_col))).select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), F.coalesce(queries, F.lit(False)).alias("asked")
    )
    length = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    width = length["n"] if length else 1
    rows = rows.where(F.size("v") == width)
    basis = directions_of(width, directions, seed)
    limit = chi_square_quantile(1.0 - miss, basis.shape[1])

    # Rows that share a vector: its smallest ids say all that a result of k can hold.
    ranked = rows.select("id", "v", F.dense_rank().over(Window.partitionBy("v").orderBy("id")).alias("r")).where(F.col("r") <= k + 1)
    distinct = written(ranked.groupBy("v").agg(F.sort_array(F.collect_set("id")).alias("ids")), "vectors")
    n = distinct.count()
    fraction = min(1.0, sample_rows / max(n, 1))
    picked = distinct.where(F.pmod(F.xxhash64("v"), F.lit(1 << 30)) < F.lit(int(fraction * (1 << 30)))).select("v").limit(2 * sample_rows).toPandas()
    sample = np.stack(picked["v"].to_numpy()) @ basis if len(picked) else np.zeros((1, basis.shape[1]))
    cells = spark.sparkContext.broadcast(Cells(sample, max(1, min(_MOST_CELLS, -(-n // block_rows)))))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = cells.value.of(_matrix(batch.column("v")) @ basis) if len(batch) else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32), pa.int32())], [*batch.schema.names, "cell"])

    data = written(distinct.mapInArrow(place, "v array<double>, ids array<long>, cell int"), "placed")
    home = written(rows.where("asked").select("id", "v").distinct().mapInArrow(place, "id long, v array<double>, cell int"), "home")
    first = written(_visit(data, home.withColumn("bound", F.lit(float("inf"))), k, limit, basis, block_rows, block_work), "first")
    bounds = first.where("vec_id is not null").groupBy("query_id").agg(F.count("*").alias("n"), F.max("square").alias("square"))
    best = Window.partitionBy("query_id").orderBy("square", "vec_id")
    kth = first.where("vec_id is not null").withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k).select("query_id", "square")
    known = home.join(kth.withColumnRenamed("query_id", "of"), F.col("id") == F.col("of"), "left").select(
        "id", "v", "cell", F.coalesce("square", F.lit(float("inf"))).alias("bound")
    )

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _matrix(batch.column("v")) @ basis if len(batch) else np.empty((0, basis.shape[1]))
            bound, own = batch.column("bound").to_numpy(zero_copy_only=False), batch.column("cell").to_numpy(zero_copy_only=False)
            which, reached = [], []

            def send(which: list, reached: list, batch: pa.RecordBatch = batch) -> pa.RecordBatch:
                asking = batch.take(pa.array(np.concatenate(which), pa.int32()))
                return pa.RecordBatch.from_arrays([asking.column("id"), asking.column("v"), pa.array(np.concatenate(reached)), asking.column("bound")], ["id", "v", "cell", "bound"])

            for i in range(len(batch)):
                reach = np.flatnonzero(cells.value.distances(at[i]) <= limit * bound[i])
                reach = reach[reach != own[i]].astype(np.int32)
                which.append(np.full(len(reach), i, np.int32))
                reached.append(reach)
                if sum(map(len, which)) >= 8192:
                    yield send(which, reached)
                    which, reached = [], []
            if which:
                yield send(which, reached)

    asked = written(known.mapInArrow(others, "id long, v array<double>, cell int, bound double"), "asked")
    both = first.unionByName(_visit(data, asked, k, limit, basis, block_rows, block_work))
    seen = F.sum("verified").over(Window.partitionBy("query_id"))
    merged = both.withColumn("verified", seen).where("vec_id is not null").distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return merged.select("query_id", "rank", "vec_id", F.sqrt("square").alias("score"), "verified")
