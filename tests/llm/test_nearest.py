from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from docketry.llm import nearest as nn


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1.0) for i, v in rows], "vec_id long, embedding array<float>, cell string, rank double").repartition(3)


def brute(rows, k=10, asked=lambda i: i % 100 == 0):
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v is not None and len(v) and None not in v]
    ok = [(i, v) for i, v in ok if np.isfinite(v).all() and v.any()]
    out = {}
    for q, a in ok:
        if asked(q):
            near = sorted((float(np.sqrt(((v - a) ** 2).sum())), i) for i, v in ok if i != q)[:k]
            out[q] = near
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    return out


def recall(got, want):
    total = sum(map(len, want.values()))
    return sum(len({i for _, i in got.get(q, [])} & {i for _, i in w}) for q, w in want.items()) / total


@pytest.mark.parametrize("block", [8192, 150])
def test_recall(spark, block):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(12, 16)) * 3
    rows = [(i, (centres[i % 12] + rng.normal(size=16)).tolist()) for i in range(1500)]
    got = found(nn.nearest(table(spark, rows), F.col("vec_id") % 100 == 0, block_rows=block))
    want = brute(rows)
    assert got.keys() == want.keys() and all(len(g) == 10 for g in got.values())
    assert recall(got, want) >= 0.95
    exact = {(q, i): s for q, w in brute(rows, 10_000).items() for s, i in w}
    assert all(s == pytest.approx(exact[q, i], rel=1e-12) for q, g in got.items() for s, i in g)
    assert all(g == sorted(g) for g in got.values())


@pytest.mark.parametrize("scale", ["0.01", "0.1"])
def test_recall_and_share_verified_on_the_embeddings(spark, scale):
    """Most of the true neighbours by verifying a part of the vectors, on the hardest data: no structure at all."""
    from docketry.llm.queries import op10_nearest

    sf_dir = f"/root/testdata/sf{scale}"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    out = op10_nearest(spark, sf_dir).cache()
    got, want = found(out), brute(rows)
    assert got.keys() == want.keys() and all(len(g) == 10 for g in got.values())
    assert recall(got, want) >= 0.9
    verified = sum(r["verified"] for r in out.select("query_id", "verified").distinct().collect())
    assert verified < (0.5 if scale == "0.1" else 0.7) * len(rows) * len(want)


def test_bounds_on_blocks_change_no_exact_result(spark):
    """With a test that never skips, blocks of few rows and of little work give what one block gives."""
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(600)]
    want = brute(rows, asked=lambda i: i % 10 == 0)
    for bounds in ({}, {"block_rows": 40}, {"block_work": 500}, {"sample_rows": 20, "block_rows": 30}):
        assert found(nn.nearest(table(spark, rows), F.col("vec_id") % 10 == 0, miss=1e-12, **bounds)) == {q: [(pytest.approx(s, rel=1e-12), i) for s, i in w] for q, w in want.items()}


def test_ties_copies_and_unusable_vectors(spark):
    one, two = [1.0, 2.0, 3.0], [1.0, 2.0, 4.0]
    rows = [(i, one) for i in range(0, 400)] + [(1000 + i, two) for i in range(30)]
    rows += [(0, one), (1005, two), (1005, one)]
    rows += [(500, None), (600, []), (700, [0.0, 0.0, 0.0]), (800, [1.0, None, 2.0]), (900, [1.0, float("nan"), 2.0]), (1100, [1.0, float("inf"), 2.0]), (1200, [1.0, 2.0]), (None, one)]
    got, want = found(nn.nearest(table(spark, rows), F.col("vec_id") % 100 == 0)), brute(dict.fromkeys((i, None if v is None else tuple(v)) for i, v in rows if i != 1200))
    assert got == want


def test_fewer_rows_than_asked_for(spark):
    rows = [(0, [1.0, 0.0]), (100, [0.0, 1.0]), (3, [1.0, 1.0])]
    assert found(nn.nearest(table(spark, rows), F.col("vec_id") % 100 == 0)) == brute(rows)
    assert nn.nearest(table(spark, rows[:1]), F.col("vec_id") % 100 == 0).count() == 0
    assert nn.nearest(table(spark, []), F.col("vec_id") % 100 == 0).count() == 0


def test_chi_square_quantile():
    assert nn.chi_square_quantile(0.95, 2) == pytest.approx(5.991, abs=1e-3)
    assert nn.chi_square_quantile(0.99, 8) == pytest.approx(20.090, abs=1e-3)
    assert nn.chi_square_quantile(0.9, 3) == pytest.approx(6.251, abs=1e-3)
    assert nn.chi_square_quantile(0.9, 32) == pytest.approx(42.585, abs=1e-3)


def test_tree_yields_leaves_by_distance():
    rng = np.random.default_rng(1)
    points = rng.normal(size=(700, 4))
    tree = nn.KdTree(points)
    seen, last = [], 0.0
    for far, rows in tree.by_distance(np.zeros(4)):
        assert far >= last and ((points[rows] ** 2).sum(axis=1) >= far - 1e-12).all()
        last = far
        seen += rows.tolist()
    assert sorted(seen) == list(range(700))


def test_cells_cover_the_space():
    rng = np.random.default_rng(2)
    cells = nn.Cells(rng.normal(size=(500, 4)), 9)
    points = rng.normal(size=(300, 4)) * 3
    of = cells.of(points)
    assert all(cells.distances(p)[c] == 0 for p, c in zip(points, of, strict=True))
