"""The three rank jobs as DataFrame loops.

Shared shape of a round::

    contributions = links(src, dst, w) JOIN ranks(node=src)  -> (dst, rank * w)
    new ranks     = contributions [UNION ALL own rows]  GROUP BY node  -> damping

``w`` is ``occurrences / out-degree`` so duplicate links are paid once per
occurrence without keeping duplicate rows.

Physical layout (see ``prepare_links``):

* the input's link rows are evaluated once, into memory and local disk, with
  the caller's settings and adaptive execution; rows are counted by a hash of
  the source, and by source only where a bucket of it has enough rows for a hot
  source or one of several packed rows.
* cold links - every source with at most ``T`` link rows - are hash
  partitioned by ``src`` into exactly the loop's partition count, the one time
  that links are shuffled; there repeats of a pair are summed and the targets of
  a source packed into rows ``(src, n, w, targets)``, sorted by ``src``. Each
  round's rank table comes out of the grouped sum hash-partitioned by ``node``
  into the same count, so the join of links and ranks needs **no exchange** and
  meets a source once, not once per link; the grouped sum is the round's only
  shuffle, with map-side partial sums (a very popular target is pre-summed per
  task). A packed row holds at most about ``max(PACKED, T / 64)`` targets.
* hot links - sources with more than ``T = ceil(rows / partitions)`` link
  rows, fewer than ``partitions`` of them by construction - are summed per
  ``(src, dst)`` with map-side partial sums and stay spread by it; their ranks
  (one row per hot source, so a proven bound) are broadcast to them. A source
  holding a third of all links thus costs no straggler task.
* unless the caller gives a partition count, a loop has one partition per
  ``LINKS_PER_PARTITION`` link rows, at least one per core and at most the
  session's shuffle partitions: the fewer partitions, the more of a target's
  contributions are summed before the shuffle.
* the link tables are checkpointed once (reliable, to the session's folder)
  and cached; every round's ranks are checkpointed, which bounds the plan and
  lets a lost executor be recovered from files, not from a rerun. When a loop
  ends, only the returned ranks' files remain.

Global values of the dangling variant (dangling mass ``D``, node count ``N``)
are observed while a round's table is written, in the round's own job, and
reach the driver as scalars, as the original job captured them in closures.

With ``node_ids`` a loop runs on the numbers of a node dictionary instead of
names: links are laid out by name first, so that sources are translated a packed
row at a time without an exchange of links, then targets once; rounds shuffle, join and checkpoint 8-byte
keys, and the last ranks are translated back. With ``rounds_at`` every round
is also kept as a named folder, from which ``resume`` continues.
"""

from __future__ import annotations

import math
import time
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import half_up
from ..operators.graph import with_multiplicity
from ..operators.nodes import NodeDictionary, link_names, node_dictionary
from .lineage import RoundFolders, drop_checkpoint, fingerprint, materialize, pinned_partitions, shuffle_partitions

DAMPING = 0.85
# Fixed values that decide results: the teleport term of the edge-list job is
# the literal 0.15; the table-based jobs compute it as 1 - 0.85, which is
# 0.15000000000000002 in doubles.
TELEPORT_LITERAL = 0.15
TELEPORT_COMPUTED = 1 - 0.85
DANGLING_NODE = "dangling"
LINKS_PER_PARTITION = 8_000_000  # of a loop: about 200 MB of packed links with short names
PACKED = 4096                    # targets of a source in one packed row
BUCKETS = 1 << 15                # by which rows are counted before any source is


@dataclass
class PreparedLinks:
    """Loop-invariant link tables (see module doc)."""

    cold: DataFrame                 # (src, n, w, targets) or (src, dst, w)   hash(src, P), sorted by src
    hot: DataFrame | None           # (src, dst[, n], w)   spread by (src, dst)
    hot_sources: DataFrame | None   # (src)           <= P rows
    sources: DataFrame              # (src, ...)      one row per source
    partitions: int
    threshold: int
    _tables: list = field(default_factory=list, repr=False)

    def release(self) -> None:
        """Free the tables' memory and delete their checkpoint files."""
        for df in self._tables:
            drop_checkpoint(df)
        self._tables.clear()


def link_pairs(edges: DataFrame, distinct: bool = False) -> DataFrame:
    """``(src, dst[, n])`` edges, kept in memory and on local disk so that the
    input is evaluated once, planned with the caller's settings: rows ``(src,
    dst, n)``, which ``prepare_links`` sums per pair. ``distinct=True`` leaves
    ``n`` out: every pair counts once. Call it outside ``pinned_partitions``."""
    rows = edges.select("src", "dst") if distinct else with_multiplicity(edges)
    return rows.persist(StorageLevel.MEMORY_AND_DISK)


def summed_pairs(rows: DataFrame) -> DataFrame:
    """``(src, dst, n)``: one row per pair of ``link_pairs``' rows."""
    n = F.sum("n") if "n" in rows.columns else F.lit(1)
    return rows.groupBy("src", "dst").agg(n.cast("bigint").alias("n"))


def loop_partitions(spark: SparkSession, rows: int) -> int:
    """Partitions of a loop over so many link rows (see module doc)."""
    cores = spark.sparkContext.defaultParallelism
    return min(shuffle_partitions(spark), max(cores, math.ceil(rows / LINKS_PER_PARTITION)))


def _packed_size(threshold: int) -> int:
    return max(PACKED, math.ceil(threshold / 64))


def _packed(rows: DataFrame, counts: DataFrame | None, widest: int, threshold: int, p: int) -> DataFrame:
    """Rows of cold sources -> ``(src, n, w, targets)``, by one exchange on ``src``.
    A null target is one of the list; a null source meets no rank."""
    rows = rows.where(F.col("src").isNotNull()).repartition(p, "src")
    pairs, found = (summed_pairs(rows), F.collect_list("dst")) if "n" in rows.columns else (rows, F.collect_set("dst"))
    keys = ["src"]
    if "n" in pairs.columns:
        # Grouped by -n: a cached table that is sorted by one of its further columns
        # cannot be read under new column ids (Spark 4.1 fails to find the column).
        pairs = pairs.select("src", "dst", (-F.col("n")).alias("minus"))
        keys.append("minus")
    size = _packed_size(threshold)
    if widest > size:  # fewer than 64 p such sources
        wide = counts.where(F.col("rows") > size).select("src", F.ceil(F.col("rows") / size).alias("chunks"))
        chunk = F.coalesce(F.pmod(F.xxhash64("dst"), "chunks"), F.lit(0).cast("bigint"))
        pairs = pairs.join(F.broadcast(wide), "src", "left").select(*pairs.columns, chunk.alias("chunk"))
        keys.append("chunk")
    # Sorted before they are grouped, the rows are gathered once, as they come.
    lists = pairs.sortWithinPartitions(*keys).groupBy(*keys).agg(found.alias("named"), F.max(F.col("dst").isNull()).alias("bare"))
    none = F.array(F.lit(None).cast(rows.schema["dst"].dataType))
    n = -F.col("minus") if "minus" in keys else F.lit(1).cast("bigint")
    packed = lists.select("src", n.alias("n"), F.when(F.col("bare"), F.concat("named", none)).otherwise(F.col("named")).alias("targets"))
    deg = F.col("n") * F.size("targets")
    if len(keys) > 1:  # a source may have several rows
        deg = F.sum(deg).over(Window.partitionBy("src"))
    return packed.select("src", "n", (F.col("n") / deg).alias("w"), "targets").sortWithinPartitions("src")


def prepare_links(pairs: DataFrame, partitions: int | None = None, buckets: DataFrame | None = None) -> PreparedLinks:
    """Lay out ``link_pairs`` for repeated joins with ranks: the hot/cold split
    and both layouts. ``buckets`` are its ``bucket_counts``, if they were taken
    before. Call it inside ``pinned_partitions``; ``release`` also frees
    ``pairs``."""
    spark = pairs.sparkSession
    p = partitions or shuffle_partitions(spark)
    buckets = buckets or bucket_counts(pairs)
    total, fullest, nameless = _extent(buckets)
    threshold = math.ceil(total / p)
    tables = [buckets, pairs]
    counts, widest = None, 0
    full = min(threshold, _packed_size(threshold))
    if fullest > full:  # all other sources have at most so many rows
        counts = row_counts(pairs.join(F.broadcast(buckets.where(F.col("rows") > full).select("bucket")), _bucket() == F.col("bucket"), "left_semi"))
        widest = counts.agg(F.max("rows")).first()[0]
        tables.append(counts)
    cold_rows, hot, hot_sources, top = pairs, None, None, widest
    if widest > threshold:
        # fewer than total / threshold <= p sources: a proven bound for the broadcast
        hot_sources = materialize(counts.where(F.col("rows") > threshold).select("src"))
        cold_rows = pairs.join(F.broadcast(hot_sources), "src", "left_anti")
        hot_pairs = materialize(summed_pairs(pairs.join(F.broadcast(hot_sources), "src", "left_semi")))
        hot_deg = hot_pairs.groupBy("src").agg(F.sum("n").alias("deg"))
        hot = materialize(hot_pairs.join(F.broadcast(hot_deg), "src")
                          .select("src", "dst", "n", (F.col("n") / F.col("deg")).alias("w")), persist=True)
        drop_checkpoint(hot_pairs)
        tables += [hot, hot_sources]
        top = threshold
    cold = materialize(_packed(cold_rows, counts, top, threshold, p), persist=True)
    tables.append(cold)
    return PreparedLinks(cold, hot, hot_sources, _sources(cold, hot_sources, nameless, p), p, threshold, tables)


def _sources(cold: DataFrame, hot_sources: DataFrame | None, nameless: bool, p: int) -> DataFrame:
    """``(src)``: each source once, as the cold links are partitioned; a null
    one has no packed row."""
    own = cold.select("src").distinct()
    more = [hot_sources.where(F.col("src").isNotNull())] if hot_sources is not None else []
    if nameless:
        more.append(cold.sparkSession.range(1).select(F.lit(None).cast(cold.schema["src"].dataType).alias("src")))
    for rows in more:
        own = own.unionByName(rows)
    return own.repartition(p, "src") if more else own


def _bucket():
    return F.pmod(F.xxhash64("src"), F.lit(BUCKETS))


def bucket_counts(pairs: DataFrame) -> DataFrame:
    """``(bucket, rows, nameless)``: link rows by a hash of the source, and
    whether some have a null source, kept in memory. At most ``BUCKETS`` rows a
    task are shuffled, however many sources it meets, and a core has one task,
    however many partitions the input has."""
    return pairs.coalesce(pairs.sparkSession.sparkContext.defaultParallelism).groupBy(_bucket().alias("bucket")) \
        .agg(F.count(F.lit(1)).alias("rows"), F.max(F.col("src").isNull()).alias("nameless")).persist(StorageLevel.MEMORY_AND_DISK)


def row_counts(pairs: DataFrame) -> DataFrame:
    """``(src, rows)``: link rows of each source, kept in memory."""
    return pairs.groupBy("src").agg(F.count(F.lit(1)).alias("rows")).persist(StorageLevel.MEMORY_AND_DISK)


def _extent(buckets: DataFrame) -> tuple[int, int, bool]:
    """All link rows, those of the fullest bucket, and whether a source is null."""
    total, fullest, nameless = buckets.agg(F.sum("rows"), F.max("rows"), F.max("nameless")).first()
    return total or 0, fullest or 0, bool(nameless)


def contributions(links: PreparedLinks, ranks: DataFrame) -> DataFrame:
    """``(src, node, c)``: one row per (source, target) with ``rank * w``."""
    r = ranks.select(F.col("node").alias("src"), "rank")
    node = F.explode_outer("targets") if "targets" in links.cold.columns else F.col("dst")
    out = links.cold.join(r, "src").select("src", node.alias("node"), (F.col("rank") * F.col("w")).alias("c"))
    if links.hot is not None:
        hot_ranks = r.join(F.broadcast(links.hot_sources), "src")
        out = out.unionByName(links.hot.join(F.broadcast(hot_ranks), "src").select(
            "src", F.col("dst").alias("node"), (F.col("rank") * F.col("w")).alias("c")))
    return out


def grouped_sums(parts: list[DataFrame]) -> DataFrame:
    """Union of ``(node, c, has_links)`` rows -> ``(node, s, has_links)``."""
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy("node").agg(F.sum("c").alias("s"), F.max("has_links").alias("has_links"))


def _flagged(c: DataFrame) -> DataFrame:
    return c.select("node", "c", F.lit(False).alias("has_links"))


def _own_rows(ranks: DataFrame) -> DataFrame:
    return ranks.select("node", F.lit(0.0).alias("c"), "has_links")


def step_active(links: PreparedLinks, ranks: DataFrame,
                damping: float = DAMPING, teleport: float = TELEPORT_LITERAL) -> DataFrame:
    """Edge-list round: only pages that receive something stay ranked."""
    s = contributions(links, ranks).select("node", "c").groupBy("node").agg(F.sum("c").alias("s"))
    return s.select("node", (F.lit(teleport) + F.col("s") * F.lit(damping)).alias("rank"))


def step_all_nodes(links: PreparedLinks, ranks: DataFrame, compat_round: int | None = None,
                   damping: float = DAMPING, teleport: float = TELEPORT_COMPUTED,
                   dangling: str | int = DANGLING_NODE) -> DataFrame:
    """Table round: every ranked node and every target keeps a row.

    ``ranks`` is ``(node, rank, has_links[, self_vote])``. ``compat_round``
    (None = off) reproduces the text-protocol quirks: in round 0 rows flagged
    ``self_vote`` give their rank to themselves, in later rounds every node
    without links gives its rank to the node ``dangling``.
    """
    parts = [_flagged(contributions(links, ranks)), _own_rows(ranks)]
    if compat_round is not None:
        if compat_round == 0:
            if "self_vote" in ranks.columns:
                parts.append(ranks.where("self_vote").select(
                    "node", F.col("rank").alias("c"), F.lit(False).alias("has_links")))
        else:
            parts.append(_to_dangling(ranks, dangling))
    s = grouped_sums(parts)
    return s.select("node", (F.lit(teleport) + F.lit(damping) * F.col("s")).alias("rank"), "has_links")


def dangling_mass_value(ranks: DataFrame, round_mass: bool = True) -> tuple[float, float]:
    """(raw, applied) rank mass of nodes without links; applied is rounded
    half-up to an integer when ``round_mass``."""
    raw = ranks.where(~F.col("has_links")).agg(F.sum("rank")).first()[0] or 0.0
    return raw, (float(math.floor(raw + 0.5)) if round_mass else raw)


def dangling_mass_frame(ranks: DataFrame, round_mass: bool = True) -> DataFrame:
    """One row ``dangling_mass``: the same value as a DataFrame."""
    raw = F.coalesce(F.sum(F.when(~F.col("has_links"), F.col("rank"))), F.lit(0.0))
    return ranks.agg((half_up(raw) if round_mass else raw).alias("dangling_mass"))


def _to_dangling(ranks: DataFrame, dangling: str | int) -> DataFrame:
    """Every node without links gives its rank to the node ``dangling``."""
    return ranks.where(~F.col("has_links")).select(
        F.lit(dangling).cast(ranks.schema["node"].dataType).alias("node"), F.col("rank").alias("c"), F.lit(False).alias("has_links"))


def step_dangling_sums(links: PreparedLinks, ranks: DataFrame, compat_round: int | None = None,
                       dangling: str | int = DANGLING_NODE) -> DataFrame:
    """Grouped sums of a dangling-redistribution round, before damping.
    ``compat_round`` (None = off) is the text-protocol quirk of later rounds:
    nodes without links also give their rank to the node ``dangling``."""
    parts = [_flagged(contributions(links, ranks)), _own_rows(ranks)]
    if compat_round:
        parts.append(_to_dangling(ranks, dangling))
    return grouped_sums(parts)


def apply_dangling(sums: DataFrame, mass: float, nodes: int,
                   damping: float = DAMPING, teleport: float = TELEPORT_COMPUTED) -> DataFrame:
    share = mass / nodes if nodes else 0.0
    return sums.select(
        "node",
        (F.lit(teleport) + F.lit(damping) * (F.col("s") + F.lit(share))).alias("rank"),
        "has_links")


@dataclass
class RankResult:
    ranks: DataFrame                       # (node, rank[, has_links])
    metrics: list[tuple] = field(default_factory=list)   # per round
    links: PreparedLinks | None = None
    prep_sec: float = 0.0                  # wall clock of the link layout
    round_secs: list[float] = field(default_factory=list)

    def metrics_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            self.metrics,
            "round int, nodes bigint, dangling_mass double, dangling_mass_raw double")


def _node_flags(pages: DataFrame, links: PreparedLinks) -> DataFrame:
    """pages(node, rank[, self_vote]) -> + has_links (node has an out-edge)."""
    flags = links.sources.select(F.col("src").alias("node"), F.lit(True).alias("hl"))
    return pages.join(flags, "node", "left").withColumn(
        "has_links", F.coalesce(F.col("hl"), F.lit(False))).drop("hl")


@dataclass
class _Job:
    """What the loops share: links, numbering and kept rounds of one run."""

    pairs: DataFrame                  # (src, dst[, n]), names or numbers
    pages: DataFrame | None           # (node, rank[, self_vote]), likewise
    buckets: DataFrame                # (bucket, rows, nameless) of pairs
    partitions: int
    dangling: str | int = DANGLING_NODE
    names: NodeDictionary | None = None
    folders: RoundFolders | None = None

    def resumed(self) -> tuple[int, dict, DataFrame | None]:
        """First round to run, the loop's state, and ranks (None: from the start)."""
        found = self.folders.last() if self.folders else None
        if not found:
            return 0, {}, None
        done, state, ranks = found
        return done + 1, state, materialize(ranks.repartition(self.partitions, "node"), persist=True)

    def keep(self, i: int, ranks: DataFrame, state: dict | None = None) -> None:
        if self.folders:
            self.folders.keep(i, ranks, state)

    def finish(self, ranks: DataFrame, table: DataFrame, links: PreparedLinks, keep_links: bool) -> DataFrame:
        """``ranks``, which read ``table``, under their names; its files stay,
        all others of the run go."""
        if self.names:
            ranks = materialize(self.names.decode(ranks))
            drop_checkpoint(table)
            self.names.release()
        table.unpersist()
        if not keep_links:
            links.release()
        return ranks


def _flat(links: PreparedLinks, *columns: str) -> DataFrame:
    """``(src, dst, ...)``: one row per pair of the link tables."""
    out = links.cold.select("src", F.explode_outer("targets").alias("dst"), *columns)
    return out if links.hot is None else out.unionByName(links.hot.select("src", "dst", *columns))


def _numbered_sources(links: PreparedLinks, names: NodeDictionary) -> DataFrame:
    """``(src, dst, n)`` of the link tables with the sources' numbers. Packed
    rows meet the dictionary where they are, once per source; hot sources, of
    which there are few, are broadcast."""
    ids = names.table.select(F.col("node").alias("src"), F.col("id").alias("__id"))
    pair = F.col("__id").alias("src"), "dst", "n"
    out = links.cold.join(ids, "src").select("__id", "n", F.explode_outer("targets").alias("dst")).select(*pair)
    if links.hot is not None:
        hot_ids = ids.join(F.broadcast(links.hot_sources), "src", "left_semi")
        out = out.unionByName(links.hot.join(F.broadcast(hot_ids), "src").select(*pair))
    return out


def _job(pages: DataFrame | None, edges: DataFrame, partitions: int | None, node_ids: bool, rounds_at: str | None,
         resume: bool, distinct: bool = False, **settings) -> _Job:
    spark = edges.sparkSession
    pairs = link_pairs(edges, distinct)
    own = materialize(pages) if pages is not None else None
    folders = names = None
    dangling: str | int = DANGLING_NODE
    if rounds_at:
        prints = [fingerprint(summed_pairs(pairs)), fingerprint(own) if own is not None else None]
        folders = RoundFolders(spark, rounds_at, {**settings, "node_ids": node_ids, "input": prints}, resume)
    if node_ids:
        more = [own] if own is not None else []
        if settings.get("compat"):  # the name has a number, but a rank only if something reaches it
            more.append(spark.range(1).select(F.lit(DANGLING_NODE).alias("node")))
        buckets = bucket_counts(pairs)
        p = partitions or loop_partitions(spark, _extent(buckets)[0])
        with pinned_partitions(spark, p):
            named = prepare_links(pairs, p, buckets)
        links = _flat(named, "n")
        names = node_dictionary(link_names(links, *more), p)
        if settings.get("compat"):
            dangling = names.table.where(F.col("node") == DANGLING_NODE).first()["id"]
        with pinned_partitions(spark, p):
            by_source = _numbered_sources(named, names).persist(StorageLevel.MEMORY_AND_DISK)
        pairs = names.encode(by_source, "dst").persist(StorageLevel.MEMORY_AND_DISK)
        by_source.unpersist()
        named.release()
        if own is not None:
            numbered = names.encode(own, "node")
            drop_checkpoint(own)
            own = numbered
    buckets = bucket_counts(pairs)
    p = partitions or loop_partitions(spark, _extent(buckets)[0])
    return _Job(pairs, own, buckets, p, dangling, names, folders)


def active_job(edges: DataFrame, partitions: int | None = None, node_ids: bool = False, rounds_at: str | None = None,
               resume: bool = False, damping: float = DAMPING) -> _Job:
    """What the edge-list job starts from: every pair of ``edges`` once."""
    return _job(None, edges.select("src", "dst"), partitions, node_ids, rounds_at, resume, distinct=True,
                job="active", damping=damping)


def pagerank_active(edges: DataFrame, iterations: int, damping: float = DAMPING,
                    partitions: int | None = None, keep_links: bool = False, node_ids: bool = False,
                    rounds_at: str | None = None, resume: bool = False) -> RankResult:
    """Edge-list rank: distinct edges, start 1.0 on every source, ``N`` rounds
    of join + grouped sum; pages without in-links drop out after a round."""
    spark = edges.sparkSession
    secs = []
    t0 = time.perf_counter()
    job = active_job(edges, partitions, node_ids, rounds_at, resume, damping)
    with pinned_partitions(spark, job.partitions):
        links = prepare_links(job.pairs, job.partitions, job.buckets)
        first, _, ranks = job.resumed()
        if ranks is None:
            ranks = materialize(links.sources.select(F.col("src").alias("node"), F.lit(1.0).alias("rank")), persist=True)
        prep = time.perf_counter() - t0
        for i in range(first, iterations):
            t0 = time.perf_counter()
            previous = ranks
            ranks = materialize(step_active(links, ranks, damping), persist=True)
            drop_checkpoint(previous)
            job.keep(i, ranks)
            secs.append(time.perf_counter() - t0)
    return RankResult(job.finish(ranks, ranks, links, keep_links), [], links, prep, secs)


def _start(pages: DataFrame | None, links: PreparedLinks) -> DataFrame:
    """``(node, rank, has_links[, self_vote])`` of the first round; without
    ``pages``, every source with rank 1.0."""
    if pages is None:
        return links.sources.select(F.col("src").alias("node"), F.lit(1.0).alias("rank"), F.lit(True).alias("has_links"))
    return _node_flags(pages, links)


def pagerank_all_nodes(pages: DataFrame | None, edges: DataFrame, iterations: int = 10,
                       compat: bool = False, damping: float = DAMPING,
                       partitions: int | None = None, keep_links: bool = False, node_ids: bool = False,
                       rounds_at: str | None = None, resume: bool = False) -> RankResult:
    """Table rank: ``pages(node, rank[, self_vote])`` and ``edges(src, dst[, n])``;
    without ``pages``, every source starts with 1.0.

    Every node keeps a row; targets join the table after one round with
    nothing but the teleport term unless they receive mass.
    """
    spark = edges.sparkSession
    secs = []
    t0 = time.perf_counter()
    job = _job(pages, edges, partitions, node_ids, rounds_at, resume, job="all nodes", compat=compat, damping=damping)
    with pinned_partitions(spark, job.partitions):
        links = prepare_links(job.pairs, job.partitions, job.buckets)
        first, _, ranks = job.resumed()
        if ranks is None:
            ranks = materialize(_start(job.pages, links), persist=True)
        drop_checkpoint(job.pages)
        prep = time.perf_counter() - t0
        for i in range(first, iterations):
            t0 = time.perf_counter()
            previous = ranks
            ranks = materialize(step_all_nodes(links, ranks, i if compat else None, damping, dangling=job.dangling), persist=True)
            drop_checkpoint(previous)
            job.keep(i, ranks)
            secs.append(time.perf_counter() - t0)
    return RankResult(job.finish(ranks, ranks, links, keep_links), [], links, prep, secs)


def pagerank_dangling(pages: DataFrame, edges: DataFrame, iterations: int = 2,
                      round_mass: bool = True, damping: float = DAMPING, compat: bool = False,
                      partitions: int | None = None, keep_links: bool = False, node_ids: bool = False,
                      rounds_at: str | None = None, resume: bool = False) -> RankResult:
    """Rank with dangling redistribution: ``0.15 + 0.85 * (sum + D / N)``.

    ``D`` is the rank mass of ranked nodes without links (rounded half-up when
    ``round_mass``), ``N`` the number of nodes after the round (ranked nodes
    and link targets). With ``compat``, nodes without links also give their
    rank to a node ``dangling`` from the second round on.
    """
    spark = edges.sparkSession
    secs = []
    t0 = time.perf_counter()
    job = _job(pages, edges, partitions, node_ids, rounds_at, resume, job="dangling", compat=compat, damping=damping,
               round_mass=round_mass)
    bare = ~F.col("has_links")
    with pinned_partitions(spark, job.partitions):
        links = prepare_links(job.pairs, job.partitions, job.buckets)
        first, state, ranks = job.resumed()
        if ranks is None:
            raw_mass = Observation()
            start = _start(job.pages, links).observe(raw_mass, F.coalesce(F.sum(F.when(bare, F.col("rank"))), F.lit(0.0)).alias("mass"))
            ranks = materialize(start, persist=True)
            state = {"raw": raw_mass.get["mass"], "metrics": []}
        drop_checkpoint(job.pages)
        raw, metrics = state["raw"], [tuple(m) for m in state["metrics"]]
        prep = time.perf_counter() - t0
        table = ranks
        for i in range(first, iterations):
            t0 = time.perf_counter()
            mass = float(math.floor(raw + 0.5)) if round_mass else raw
            # N, and what the next round's dangling mass is made of (rank is
            # affine in s), come with the job that writes the round's table.
            seen = Observation()
            sums = step_dangling_sums(links, ranks, i if compat else None, job.dangling).observe(
                seen, F.count(F.lit(1)).alias("n"), F.count(F.when(bare, 1)).alias("k"),
                F.coalesce(F.sum(F.when(bare, F.col("s"))), F.lit(0.0)).alias("s"))
            sums = materialize(sums, persist=True)
            drop_checkpoint(table)  # the table this round's ranks were read from
            table = sums
            n, k, s_dangling = (seen.get[name] for name in ("n", "k", "s"))
            metrics.append((i, n, mass, raw))
            share = mass / n if n else 0.0
            raw = k * TELEPORT_COMPUTED + damping * (s_dangling + k * share)
            ranks = apply_dangling(sums, mass, n, damping)
            job.keep(i, ranks, {"raw": raw, "metrics": metrics})
            secs.append(time.perf_counter() - t0)
    return RankResult(job.finish(ranks, table, links, keep_links), metrics, links, prep, secs)
