"""Approximate nearest neighbours by inner product: a forest of random
projection trees, searched through one priority queue for all trees.

The trees are fit on a bounded sample; every row is indexed. A vector gets one
more component that lifts all to the same length, so that the largest inner
product is the nearest point. A node splits at the median along the difference
of two random points. A query's queue holds the branches not taken, in all
trees, by how far the query lies from them; it visits the nearest leaves until
it has seen ``leaves`` of them. All rows of a visited leaf are candidates and
are reranked exactly on the original vectors, in double precision.

Rows and queries meet by leaf. Small leaves of a tree are packed into blocks,
large ones (many equal vectors) are dealt over several blocks that the query
visits all, so a block is bounded and no row is left out. Each block returns a
query's best ``k``; the best of those over all blocks are the result.

Vectors that are null, zero, of another length than most, or that hold null or
non-finite components take no part, nor do rows with a null id. Rows that
repeat an id are one candidate with the better score. Ties go to the smaller
id. An empty table gives no rows. Very long vectors cost
their length. Only the id and the vector are read, so other columns may have
any name.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import drawn, ship, written


@dataclass(frozen=True)
class Params:
    """The trees are fit on about ``sample_rows`` rows, never on twice as many."""

    trees: int = 12
    sample_rows: int = 20_000
    leaf_rows: int = 64       # of the sample, at most, in a leaf
    leaves: int = 360         # that a query visits, in all trees together
    block_rows: int = 4096
    seed: int = 23


@dataclass
class Tree:
    normal: np.ndarray        # nodes x (dimensions + 1)
    offset: np.ndarray
    child: np.ndarray         # nodes x 2: a node, or -1 - leaf
    leaves: int


def lifted(x: np.ndarray, longest: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(longest * longest - (x * x).sum(1), 0))
    return np.concatenate([x, rest[:, None]], axis=1)


def grow(x: np.ndarray, leaf_rows: int, rng: np.random.Generator) -> Tree:
    normal, offset, child, leaves = [], [], [], 0
    stack = [(np.arange(len(x)), -1, 0)]
    root_is_leaf = True
    while stack:
        rows, parent, side = stack.pop()
        split = None
        for _ in range(5 if len(rows) > leaf_rows else 0):
            a, b = x[rng.choice(rows, 2, replace=False)]
            v = a - b
            size = np.sqrt(v @ v)
            if size > 1e-12:
                along = x[rows] @ (v / size)
                middle = float(np.median(along))
                right = along > middle
                if right.any():
                    split = v / size, middle, right
                    break
        if split is None:
            leaves += 1
            if parent >= 0:
                child[parent][side] = -leaves
            continue
        root_is_leaf = False
        node = len(normal)
        normal.append(split[0])
        offset.append(split[1])
        child.append([0, 0])
        if parent >= 0:
            child[parent][side] = node
        stack += [(rows[split[2]], node, 1), (rows[~split[2]], node, 0)]
    if root_is_leaf:
        return Tree(np.empty((0, x.shape[1])), np.empty(0), np.empty((0, 2), np.int64), 1)
    return Tree(np.array(normal), np.array(offset), np.array(child, np.int64), leaves)


def leaf_of(tree: Tree, x: np.ndarray) -> np.ndarray:
    """The leaf of each row."""
    if not len(tree.normal):
        return np.zeros(len(x), np.int64)
    at = np.zeros(len(x), np.int64)
    going = np.arange(len(x))
    while len(going):
        here = at[going]
        right = (x[going] * tree.normal[here]).sum(1) > tree.offset[here]
        at[going] = tree.child[here, right.astype(np.int64)]
        going = going[at[going] >= 0]
    return -1 - at


def nearest_leaves(forest: list[Tree], q: np.ndarray, leaves: int) -> list[tuple[int, int]]:
    """``(tree, leaf)`` in the order of one queue over all trees."""
    margins = [t.normal @ q - t.offset for t in forest]
    queue = [(0.0, k, 0 if len(t.normal) else -1) for k, t in enumerate(forest)]
    out = []
    while queue and len(out) < leaves:
        far, k, node = heapq.heappop(queue)
        margin, child = margins[k], forest[k].child
        while node >= 0:
            m = margin[node]
            side = 1 if m > 0 else 0
            heapq.heappush(queue, (max(far, abs(m)), k, int(child[node, 1 - side])))
            node = int(child[node, side])
        out.append((k, -1 - node))
    return out


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, v`` of the rows that take part; single floats stay single
    until they are multiplied."""
    single = vectors.schema[vector_col].dataType.simpleString() == "array<float>"
    v = F.col(vector_col) if single else F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)
        & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
        & F.exists("v", lambda c: c != 0))
    usual = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").select("n").head()
    return rows.where(F.size("v") == (usual["n"] if usual else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def neighbours(vectors: DataFrame, queries: DataFrame, k: int = 20, params: Params | None = None,
               id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: of each row of ``queries`` (same
    columns as ``vectors``) its ``k`` nearest rows with another id."""
    params = params or Params()
    spark = vectors.sparkSession
    ship(spark)
    rows, asked = usable(vectors, id_col, vector_col), usable(queries, id_col, vector_col)
    longest = rows.agg(F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double")))).alias("m")).first()["m"] or 0.0
    found = sorted(drawn(rows, params.sample_rows, "vec_id", "v").collect(), key=lambda r: (r["vec_id"], r["v"]))
    rng = np.random.default_rng(params.seed)
    sample = lifted(np.array([r["v"] for r in found]).reshape(len(found), -1), longest) if found else np.zeros((1, 1))
    forest = [grow(sample, params.leaf_rows, rng) for _ in range(params.trees)]
    shared = spark.sparkContext.broadcast((forest, longest))  # bounded by the sample
    kind, query_kind = (f.schema["v"].dataType.simpleString() for f in (rows, asked))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, top = shared.value
        for batch in batches:
            if batch.num_rows:
                x = lifted(_matrix(batch.column(1)), top)
                of = np.stack([leaf_of(t, x) for t in trees], axis=1).astype(np.int32)
                ends = pa.array(np.arange(0, of.size + 1, len(trees)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.ListArray.from_arrays(ends, pa.array(of.ravel(), pa.int32()))],
                    ["vec_id", "v", "leaf"])

    indexed = written(rows.mapInArrow(index, f"vec_id bigint, v {kind}, leaf array<int>"), "ann-index")
    spread = indexed.select("vec_id", "v", F.posexplode("leaf").alias("tree", "leaf"))
    counts = {(r["tree"], r["leaf"]): r["count"] for r in spread.groupBy("tree", "leaf").count().collect()}
    blocks = spark.sparkContext.broadcast(packed(forest, counts, params.block_rows))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where = blocks.value
        for batch in batches:
            trees, leaves, ids = (batch.column(k).to_numpy() for k in (2, 3, 0))
            base, parts = where[0][trees, leaves], where[1][trees, leaves]
            deal = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % parts.astype(np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(base + deal.astype(np.int64)), batch.column(3), batch.column(0), batch.column(1)],
                ["block", "leaf", "vec_id", "v"])

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (trees, _), where = shared.value, blocks.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                x = _matrix(part.column(1))
                x = np.concatenate([x, np.zeros((len(x), 1))], axis=1)
                to: dict[tuple[int, int], list[int]] = {}
                for i in range(len(x)):
                    for t, f in nearest_leaves(trees, x[i], params.leaves):
                        for j in range(int(where[1][t, f])):
                            to.setdefault((i, int(where[0][t, f]) + j), []).append(f)
                take = pa.array([i for i, _ in to], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b for _, b in to], pa.int64()), part.column(0).take(take), part.column(1).take(take),
                     pa.array(list(to.values()), pa.list_(pa.int32()))], ["block", "query_id", "q", "leaves"])

    held = spread.mapInArrow(place, f"block bigint, leaf int, vec_id bigint, v {kind}")
    sought = asked.mapInArrow(visit, f"block bigint, query_id bigint, q {query_kind}, leaves array<int>")

    def rerank(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        return best_in_block(queries, rows, k)

    found = sought.groupBy("block").cogroup(held.groupBy("block")) \
        .applyInPandas(rerank, "query_id bigint, vec_id bigint, score double")
    one = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return one.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")


def packed(forest: list[Tree], counts: dict, block_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """First block and number of blocks of each leaf, as trees x leaves."""
    most = max(t.leaves for t in forest)
    first, parts = np.zeros((len(forest), most), np.int64), np.ones((len(forest), most), np.int64)
    block = 0
    for k, tree in enumerate(forest):
        filled = 0
        for leaf in range(tree.leaves):
            n = counts.get((k, leaf), 0)
            if filled and filled + n > block_rows:
                block, filled = block + 1, 0
            first[k, leaf] = block
            if n > block_rows:
                parts[k, leaf] = -(-n // block_rows)
                block, filled = block + int(parts[k, leaf]), 0
            else:
                filled += n
        block += 1
    return first, parts


def best_in_block(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """The ``k`` best rows of each query among the leaves of a block that it visits."""
    none = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
    if not len(queries) or not len(rows):
        return none
    rows = rows.sort_values(["leaf", "vec_id"], kind="stable")
    x, ids, leaf = np.stack(rows["v"].to_numpy()).astype(np.float64), rows["vec_id"].to_numpy(), rows["leaf"].to_numpy()
    every_q, every_id = np.stack(queries["q"].to_numpy()).astype(np.float64), queries["query_id"].to_numpy()
    if every_q.shape[1] != x.shape[1]:
        return none
    visits = [np.asarray(v) for v in queries["leaves"]]
    who, which = np.repeat(np.arange(len(visits)), [len(v) for v in visits]), np.concatenate(visits)
    out = []
    for at in np.unique(which):
        low, high = np.searchsorted(leaf, at, "left"), np.searchsorted(leaf, at, "right")
        if low == high:
            continue
        some, some_ids, own = x[low:high], ids[low:high], who[which == at]
        for start in range(0, len(own), 512):
            q, q_ids = every_q[own[start:start + 512]], every_id[own[start:start + 512]]
            s = q @ some.T
            s[q_ids[:, None] == some_ids[None, :]] = -np.inf
            if s.shape[1] > k:  # keep what rounding could bring among the best
                least = np.partition(s, -k, axis=1)[:, -k] - 1e-9 * (1 + np.abs(s).max(axis=1, where=np.isfinite(s), initial=0))
                i, j = np.nonzero(s >= least[:, None])
            else:
                i, j = np.nonzero(np.isfinite(s))
            good = np.isfinite(s[i, j])
            i, j = i[good], j[good]
            # Summed alike for every pair, so that equal vectors tie exactly.
            out.append(pd.DataFrame({"query_id": q_ids[i], "vec_id": some_ids[j], "score": (q[i] * some[j]).sum(1)}))
    if not out:
        return none
    both = pd.concat(out).sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True], kind="stable")
    both = both.drop_duplicates(["query_id", "vec_id"])
    return both.groupby("query_id", sort=False).head(k)
