"""End-to-end jobs composed from the operators.

* ``word_count_job``     text files -> tokens -> counts -> pair text
* ``clean_crawl``        crawl records -> merged links, duplicates kept
* ``clean_crawl_dedup``  crawl records -> merged links, set union, sentinel
* ``graph_from_rank_table`` rank-table rows -> (pages, edges) for the rank jobs
* ``rank_table_job``     rank-table text -> table rank -> rank-table text
* ``crawl_clean_job``    crawl SequenceFile parts -> rank-table text
* ``edge_rank_job``      edge-list text -> edge-list rank -> rank report
* ``crawl_rank_job``     crawl parts -> dedup clean-up -> dangling rank
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.crawl import adjacency, extract_links, merge_links
from ..operators.text import word_count
from ..session import checkpoint_dir
from ..sources.crawl import land_crawl, read_landed
from ..sources.sinks import format_ranks, rank_rows, write_pairs_text, write_rank_rows
from ..sources.text import DANGLING_MARK, parse_edges, parse_link_rows, read_lines
from . import pagerank as pr
from .lineage import materialize


@dataclass
class Graph:
    pages: DataFrame   # (node, rank[, self_vote]) - rows of the rank table
    edges: DataFrame   # (src, dst, n)


@dataclass
class CrawlGraph(Graph):
    merged: DataFrame  # (url, link, n): one table, from which pages and edges come

    def rank_rows(self) -> DataFrame:
        """Rank-table rows ``(url, rank, link, n)`` with the starting rank."""
        return adjacency(self.merged).select("url", F.lit(1.0).alias("rank"),
                                             F.coalesce("link", F.lit(DANGLING_MARK)).alias("link"), "n")


def word_count_job(spark: SparkSession, src: str, dst: str | None = None) -> DataFrame:
    counts = word_count(read_lines(spark, src))
    if dst:
        write_pairs_text(counts, dst)
    return counts


def _crawl_graph(links: DataFrame, dedupe: bool) -> CrawlGraph:
    """The records are scanned, parsed and merged once, into a materialised
    table that pages and edges both read."""
    merged = materialize(merge_links(links, dedupe))
    return CrawlGraph(
        merged.where(F.col("link").isNull()).select(F.col("url").alias("node"), F.lit(1.0).alias("rank")),
        merged.where(F.col("link").isNotNull()).select(F.col("url").alias("src"), F.col("link").alias("dst"), "n"),
        merged)


def clean_crawl(records: DataFrame, invalid: str = "drop") -> CrawlGraph:
    """Crawl clean-up of the MapReduce job: anchors with a non-empty href,
    invalid records dropped, all records of a url concatenated."""
    return _crawl_graph(extract_links(records, comma="keep", invalid=invalid), dedupe=False)


def clean_crawl_dedup(records: DataFrame, invalid: str = "sentinel") -> CrawlGraph:
    """Crawl clean-up of the Spark job: hrefs with commas dropped, invalid
    records become the ``random`` page, records of a url merged as a set."""
    return _crawl_graph(extract_links(records, comma="drop", invalid=invalid), dedupe=True)


def graph_from_rank_table(rows: DataFrame, compat: bool = False) -> Graph:
    """``parse_link_rows`` rows -> pages and edges.

    The rows are materialised once; the text is scanned for them alone. Lines
    of one url are merged (links concatenated). A legacy links field that is
    just the ``dangling`` marker means no links, unless ``compat`` (then it is
    a link to the node of that name, as in the text protocol). ``self_vote``
    marks urls that only have lines without a links field (used by ``compat``
    round 0).
    """
    rows = materialize(rows)
    pages = rows.groupBy(F.col("url").alias("node")).agg(
        F.max("rank").alias("rank"), F.min(~F.col("has_field")).alias("self_vote"))
    links = rows.where(F.col("link").isNotNull())
    if not compat:
        links = links.where(~F.col("is_mark"))
    return Graph(pages, links.select(F.col("url").alias("src"), F.col("link").alias("dst"), "n"))


def rank_table_job(spark: SparkSession, src: str, dst: str | None = None, iterations: int = 10,
                   compat: bool = False, partitions: int | None = None, bad_rank: str = "fail", **loop) -> DataFrame:
    """Rank-table text in, ``iterations`` all-node rounds, rank-table text out.
    With ``bad_rank="default"`` a rank that cannot be read is 1.0. ``loop``:
    ``node_ids``, ``rounds_at``, ``resume`` of the rank loops, as in the other jobs."""
    g = graph_from_rank_table(parse_link_rows(spark.read.text(src), bad_rank=bad_rank), compat)
    res = pr.pagerank_all_nodes(g.pages, g.edges, iterations, compat=compat, **loop)
    if dst:
        write_rank_rows(rank_rows(res.ranks, g.edges), dst, partitions=partitions)
    return res.ranks


def _landed(spark: SparkSession, folder: str, landing: str | None, lo: int | None, hi: int | None,
            reuse: bool = False) -> DataFrame:
    """The parts' records; with ``reuse`` from a table landed before."""
    if reuse and landing:
        return read_landed(spark, landing, lo, hi)
    return land_crawl(spark, folder, landing or f"{checkpoint_dir(spark)}/crawl-{uuid.uuid4().hex}", lo, hi)


def crawl_clean_job(spark: SparkSession, folder: str, dst: str | None = None, lo: int | None = None,
                    hi: int | None = None, dedupe: bool = False, invalid: str | None = None,
                    partitions: int | None = None, landing: str | None = None, reuse_landing: bool = False) -> CrawlGraph:
    """Crawl parts (all, or those in the range), landed once as Parquet ->
    merged links (-> rank-table text, rank 1.0)."""
    records = _landed(spark, folder, landing, lo, hi, reuse_landing)
    g = clean_crawl_dedup(records, invalid or "sentinel") if dedupe else clean_crawl(records, invalid or "drop")
    if dst:
        write_rank_rows(g.rank_rows(), dst, partitions=partitions)
    return g


def edge_rank_job(spark: SparkSession, src: str, iterations: int,
                  dst: str | None = None, **loop) -> DataFrame:
    """Edge-list text -> ``iterations`` active-page rounds -> report lines."""
    edges = parse_edges(read_lines(spark, src))
    ranks = pr.pagerank_active(edges, iterations, **loop).ranks
    report = format_ranks(ranks)
    if dst:
        report.write.mode("overwrite").text(dst)
    return ranks


def crawl_rank_job(spark: SparkSession, folder: str, iterations: int = 2, lo: int | None = None,
                   hi: int | None = None, round_mass: bool = True, invalid: str = "sentinel",
                   compat: bool = False, dst: str | None = None, landing: str | None = None,
                   reuse_landing: bool = False, **loop) -> pr.RankResult:
    """Crawl parts, landed once as Parquet -> de-duplicated clean-up -> dangling rank."""
    g = clean_crawl_dedup(_landed(spark, folder, landing, lo, hi, reuse_landing), invalid)
    res = pr.pagerank_dangling(g.pages, g.edges, iterations, round_mass=round_mass, compat=compat, **loop)
    if dst:
        write_rank_rows(rank_rows(res.ranks.select("node", "rank"), g.edges), dst)
    return res
