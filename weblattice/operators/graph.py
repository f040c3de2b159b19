"""Graph building blocks: edges, degrees, node sets, diagnostics.

Edges are always kept exploded as ``(src, dst, n)`` rows, ``n`` being the
number of times the link occurs (1 after de-duplication). No operator builds
a list per node: out-degrees and node sets are partial-then-final
aggregations, so a node with a huge number of links is pre-summed inside every
task before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.lineage import drop_checkpoint, materialize


def with_multiplicity(edges: DataFrame) -> DataFrame:
    """``(src, dst[, n])`` -> ``(src, dst, n)`` with ``n`` defaulting to 1."""
    if "n" in edges.columns:
        return edges.select("src", "dst", F.col("n").cast("bigint").alias("n"))
    return edges.select("src", "dst", F.lit(1).cast("bigint").alias("n"))


def distinct_edges(edges: DataFrame) -> DataFrame:
    """Distinct ``(src, dst)`` pairs."""
    return edges.select("src", "dst").distinct()


def out_degree(edges: DataFrame) -> DataFrame:
    """``(src, deg)``: links leaving each node, duplicates counted."""
    return with_multiplicity(edges).groupBy("src").agg(F.sum("n").alias("deg"))


def join_by(rows: DataFrame, per_key: DataFrame, key: str, partitions: int | None = None,
            temporary: list | None = None) -> DataFrame:
    """``rows(key, ...)`` joined with ``per_key(key, ...)``, which has one row
    per key.

    Keys with more than ``rows / partitions`` rows are hot: fewer than
    ``partitions`` of them, a proven bound, so their entries of ``per_key`` are
    broadcast. The same rows then meet the other entries by shuffle, where
    those that found theirs are spread by their own hash and match nothing, so
    no task has more than a partition's share of one key. ``rows`` is read
    twice, for the counts and for the join, with three exchanges in all. The
    small table of hot keys that the result reads is added to ``temporary``,
    for callers that materialise the result and then drop it.
    """
    p = partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = materialize(rows.groupBy(key).agg(F.count(F.lit(1)).alias("__rows")))
    total, most = counts.agg(F.sum("__rows"), F.max("__rows")).first()
    limit = -(-(total or 0) // p)
    found = [c for c in per_key.columns if c != key]
    others = [c for c in rows.columns if c != key]
    if (most or 0) <= limit:
        drop_checkpoint(counts)
        return rows.join(per_key, key).select(key, *others, *found)
    hot = materialize(counts.where(F.col("__rows") > limit).select(key))
    drop_checkpoint(counts)
    if temporary is not None:
        temporary.append(hot)
    entry = per_key.select(key, F.struct(F.lit(True).alias("__here"), *found).alias("__entry"))
    hot_entry = F.broadcast(entry.join(F.broadcast(hot), key, "left_semi").withColumnRenamed("__entry", "__hot"))
    # The key's hash, not a literal: the optimiser would drop that from the join keys.
    plain = F.xxhash64(F.lit(p), key)
    own = plain.bitwiseXOR(F.pmod(F.xxhash64(*rows.columns), F.lit(p)) + 1)
    spread = rows.join(hot_entry, key, "left").withColumn("__salt", F.when(F.col("__hot").isNull(), plain).otherwise(own))
    joined = spread.join(entry.withColumn("__salt", plain), [key, "__salt"], "left")
    both = F.coalesce("__hot", "__entry")
    return joined.where(both.isNotNull()).withColumn("__both", both).select(key, *others, *(F.col("__both")[c].alias(c) for c in found))


def join_sources(edges: DataFrame, per_source: DataFrame, partitions: int | None = None) -> DataFrame:
    """``edges(src, ...)`` joined with ``per_source(src, ...)`` by ``join_by``."""
    return join_by(edges, per_source, "src", partitions)


def adjacency_rows(edges: DataFrame, partitions: int | None = None) -> DataFrame:
    """Grouped-adjacency view kept exploded: ``(src, dst, deg)`` over distinct
    edges (the edge-list job's ``distinct().groupByKey()``)."""
    d = materialize(distinct_edges(edges))
    return join_sources(d, out_degree(d), partitions)


def node_set(pages: DataFrame | None, edges: DataFrame) -> DataFrame:
    """Every node: ranked pages, link sources and link targets."""
    parts = [edges.select(F.col("src").alias("node")), edges.select(F.col("dst").alias("node"))]
    if pages is not None:
        parts.append(pages.select("node"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def dangling_nodes(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes that have no outgoing link."""
    return nodes.select("node").join(
        edges.select(F.col("src").alias("node")).distinct(), "node", "left_anti")


def initial_ranks(nodes: DataFrame, value: float = 1.0) -> DataFrame:
    """``(node, rank)`` with the starting rank for every node."""
    return nodes.select("node", F.lit(float(value)).alias("rank"))


def _mapped_stream(ranks: DataFrame, edges: DataFrame, partitions: int | None) -> DataFrame:
    """``(node, c)``: one round's mapped stream, a node's own row and one row
    per link from a ranked source with its occurrences."""
    own = ranks.select("node", F.lit(1).cast("bigint").alias("c"))
    incoming = join_sources(with_multiplicity(edges), ranks.select(F.col("node").alias("src")).distinct(), partitions) \
        .select(F.col("dst").alias("node"), F.col("n").alias("c"))
    return own.unionByName(incoming)


def key_counts(ranks: DataFrame, edges: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows per key of one round's mapped stream."""
    return _mapped_stream(ranks, edges, partitions).groupBy("node").agg(F.sum("c").alias("n"))


def node_count(ranks: DataFrame, edges: DataFrame, partitions: int | None = None) -> DataFrame:
    """One row: distinct keys of one round's mapped stream (``nodes``). Keys
    are made distinct in the tasks that map, then by key; nothing is summed."""
    keys = _mapped_stream(ranks, edges, partitions).select("node").distinct()
    return keys.agg(F.count(F.lit(1)).alias("nodes"))
