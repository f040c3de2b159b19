"""Connected components of an edge table, by alternating star contractions.

Each round points every node's larger neighbours, then its smaller ones, at
the smallest neighbour. The edges of a round are written as a table in the
shared folder. Nothing but a row count and a checksum reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written


def _pointed(edges: DataFrame, down: bool) -> DataFrame:
    """``edges`` (a, b): each neighbour of ``a`` pointed at the smallest of
    ``a`` and its neighbours. Minima are pre-aggregated in the tasks that
    read; the join back is one that skew handling can split."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
    near = edges.where(F.col("b") > F.col("a")) if not down else edges
    out = near.join(least, F.col("a") == F.col("k")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    if down:  # all of a's neighbours are smaller; a itself follows them
        out = out.unionByName(least.select(F.col("k").alias("a"), F.col("m").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame, src: str = "src", dst: str = "dst", label: str = "components") -> DataFrame:
    """``node, component``: the smallest node that each node of ``edges`` can
    reach. Edges with a null end and loops are left out."""
    e = edges.where(F.col(src) != F.col(dst)) \
        .select(F.greatest(src, dst).alias("a"), F.least(src, dst).alias("b")).distinct()
    current, before = written(e, label), None
    while True:
        previous = current
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _pointed(both, down=False)
        current = written(_pointed(large, down=True), label)
        discard(previous)
        state = current.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if tuple(state) == before:
            break
        before = tuple(state)
    pairs = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    out = written(pairs.unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()), label)
    discard(current)
    return out
