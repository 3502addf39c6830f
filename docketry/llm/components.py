"""Connected components of an edge table, by alternating large-star and small-star steps.

Every step is a partial aggregate and a join on the vertex; a hub's rows are split by adaptive
execution's skewed joins, and no vertex's neighbours are ever gathered in one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").cast("decimal(20,0)"))).first()
    return tuple(row)


def connected_components(edges: DataFrame) -> DataFrame:
    """(vertex, component) for each vertex of the undirected edges (a, b) of longs.

    The component is its smallest vertex. Self loops and nulls are ignored. Rounds go on until no
    label moves: by the method's law a number that grows with the square of the vertices' logarithm.
    """
    now = checkpoint(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    sign = _signature(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        large = both.join(low, F.col("u") == F.col("w")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), "m")
        hung = large.join(low, F.col("u") == F.col("w")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = checkpoint(hung.unionByName(low.select(F.col("w").alias("u"), F.col("m").alias("v"))).distinct())
        new = _signature(after)
        if new == sign:
            children = after.select(F.col("u").alias("vertex"), F.col("v").alias("component"))
            roots = after.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct()
            return children.unionByName(roots)
        now, sign = after, new
