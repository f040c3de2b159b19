"""Registered queries: one per operator / job of the inventory.

Each takes ``(spark, sf_dir)`` and returns a DataFrame whose column names
match the DuckDB oracle in ``weblattice.oracle``. Ranks are rounded to 6
decimals because two engines sum in different orders.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bindings as b
from .operators import crawl as cr
from .operators import graph as g
from .operators.nodes import link_names, node_dictionary
from .operators.text import format_pairs, tokens, word_count
from .plans import pagerank as pr
from .plans.lineage import materialize, pinned_partitions
from .plans.lookup import lookup, lookup_at, lookup_mapped, write_lookup_table
from .plans.pipelines import clean_crawl, clean_crawl_dedup, graph_from_rank_table
from .session import checkpoint_dir
from .sources.crawl import select_parts
from .sources.sinks import format_ranks, rank_lines
from .sources.text import parse_edges, parse_link_rows

ROUNDS_TABLE = 10      # all-node rank job
ROUNDS_COMPAT = 3      # text protocol from rank-table lines
ROUNDS_DANGLING = 2    # dangling-redistribution job
ROUNDS_ACTIVE = 10     # edge-list job (a command-line argument there)
LOOKUP_KEY = cr.SENTINEL
PART_RANGE = (40, 180)  # leaves part numbers out on either side


def _r6(c: str = "rank"):
    return F.round(F.col(c), 6).alias(c)


def _ranked(df: DataFrame) -> DataFrame:
    return df.select("node", _r6("rank"))


# ---- text -------------------------------------------------------------------

def q_tokenize_lines(spark, d):
    return tokens(b.document_lines(spark, d))


def q_tokenize_lines_blank_tail(spark, d):
    return tokens(b.blank_tail_lines(spark, d))


def q_word_count(spark, d):
    return word_count(b.document_lines(spark, d))


def q_word_count_pairs_text(spark, d):
    return format_pairs(word_count(b.document_lines(spark, d)))


# ---- edge lists -------------------------------------------------------------

def q_edge_parse(spark, d):
    return parse_edges(b.lineitem_edge_lines(spark, d))


def q_edge_distinct(spark, d):
    return parse_edges(b.lineitem_edge_lines(spark, d), distinct=True)


def q_adjacency(spark, d):
    return g.adjacency_rows(parse_edges(b.lineitem_edge_lines(spark, d)))


def q_part_file_select(spark, d):
    return select_parts(b.part_file_names(spark, d), *PART_RANGE)


# ---- rank tables ------------------------------------------------------------

def _table_view(t: DataFrame) -> DataFrame:
    return t.select("url", "rank",
                    F.array_join("links", "|").alias("links"),
                    F.when(F.col("links").isNotNull(), F.size("links")).alias("n_links"))


def q_rank_tsv_parse(spark, d):
    return _table_view(b.page_rank_table(spark, d))


def q_rank_parse_tolerant(spark, d):
    return _table_view(b.page_rank_table(spark, d, rank_from_url=True, bad_rank="default"))


# ---- crawl ------------------------------------------------------------------

def q_crawl_parse(spark, d):
    p = cr.parse_crawl(b.crawl_records(spark, d))
    return p.select("url", F.when(F.col("links").isNotNull(), F.size("links")).alias("n_links"),
                    cr.bad_record("links").alias("bad"))


def _links_view(df: DataFrame) -> DataFrame:
    return df.select("url", F.array_join("links", "|").alias("links"),
                     F.size("links").alias("n_links"))


def q_crawl_links(spark, d):
    return _links_view(cr.extract_links(b.crawl_records(spark, d), comma="keep", invalid="drop"))


def q_crawl_links_no_comma(spark, d):
    return _links_view(cr.extract_links(b.crawl_records(spark, d), comma="drop", invalid="drop"))


def q_crawl_links_sentinel(spark, d):
    return _links_view(cr.extract_links(b.crawl_records(spark, d), comma="drop", invalid="sentinel"))


def q_adjacency_merge_concat(spark, d):
    return cr.adjacency(clean_crawl(b.crawl_records(spark, d)).merged)


def q_adjacency_merge_union(spark, d):
    return cr.adjacency(clean_crawl_dedup(b.crawl_records(spark, d)).merged)


def q_clean_crawl(spark, d):
    return clean_crawl(b.crawl_records(spark, d)).rank_rows()


def q_clean_crawl_dedup(spark, d):
    return clean_crawl_dedup(b.crawl_records(spark, d)).rank_rows()


def q_adjacency_text(spark, d):
    return rank_lines(clean_crawl(b.crawl_records(spark, d)).rank_rows())


# ---- graph diagnostics on the trade graph -----------------------------------

def q_initial_ranks(spark, d):
    e = parse_edges(b.trade_lines(spark, d), distinct=True)
    return g.initial_ranks(e.select(F.col("src").alias("node")).distinct())


def q_out_degree(spark, d):
    return g.out_degree(b.trade_edges(spark, d))


def q_dangling_nodes(spark, d):
    e = b.trade_edges(spark, d)
    return g.dangling_nodes(g.node_set(None, e), e)


def q_node_dictionary(spark, d):
    return node_dictionary(link_names(b.trade_edges(spark, d))).table


# ---- one round --------------------------------------------------------------

def _active_links(spark, d):
    """Links of the edge-list job, which counts a pair once as it lays them out."""
    return parse_edges(b.trade_lines(spark, d))


def _first_round(spark, d, of):
    """``of(contributions)`` of the first active round, planned and run like
    the loop's; the link tables go afterwards."""
    job = pr.active_job(_active_links(spark, d))
    with pinned_partitions(spark, job.partitions):
        links = pr.prepare_links(job.pairs, job.partitions, job.buckets)
        ranks = links.sources.select(F.col("src").alias("node"), F.lit(1.0).alias("rank"))
        out = materialize(of(pr.contributions(links, ranks)))
        links.release()
    return out


def q_contributions(spark, d):
    return _first_round(spark, d, lambda c: c.select("src", "node", _r6("c")))


def q_contribution_sums(spark, d):
    return _first_round(spark, d, lambda c: c.groupBy("node").agg(F.sum("c").alias("s")).select("node", _r6("s")))


def q_rank_step(spark, d):
    return _ranked(pr.pagerank_active(_active_links(spark, d), 1).ranks)


def q_rank_step_all_nodes(spark, d):
    res = pr.pagerank_all_nodes(None, b.trade_edges(spark, d), 1)
    return _ranked(res.ranks)


def _crawl_graph(spark, d):
    return clean_crawl_dedup(b.crawl_records(spark, d))


def q_rank_step_dangling(spark, d):
    gr = _crawl_graph(spark, d)
    return _ranked(pr.pagerank_dangling(gr.pages, gr.edges, 1).ranks)


def q_key_counts(spark, d):
    gr = _crawl_graph(spark, d)
    return g.key_counts(gr.pages, gr.edges)


def q_node_count(spark, d):
    gr = _crawl_graph(spark, d)
    return g.node_count(gr.pages, gr.edges)


def q_dangling_mass(spark, d):
    gr = _crawl_graph(spark, d)
    after_one = pr.pagerank_dangling(gr.pages, gr.edges, 1).ranks
    return pr.dangling_mass_frame(after_one, round_mass=True)


def q_rank_lookup(spark, d):
    gr = _crawl_graph(spark, d)
    ranks = pr.pagerank_dangling(gr.pages, gr.edges, ROUNDS_DANGLING).ranks
    return _ranked(lookup(ranks, LOOKUP_KEY))


def q_rank_lookup_pruned(spark, d):
    """The same lookup from a table that is written for it."""
    gr = _crawl_graph(spark, d)
    path = f"{checkpoint_dir(spark)}/lookup-{uuid.uuid4().hex}"
    write_lookup_table(pr.pagerank_dangling(gr.pages, gr.edges, ROUNDS_DANGLING).ranks, path)
    return _ranked(lookup_at(spark, path, LOOKUP_KEY))


def q_rank_lookup_mapped(spark, d):
    gr = _crawl_graph(spark, d)
    ranks = pr.pagerank_dangling(gr.pages, gr.edges, 1).ranks
    return lookup_mapped(ranks, gr.edges, LOOKUP_KEY).select("node", "src", _r6("value"), "n")


def q_rank_round_metrics(spark, d):
    gr = _crawl_graph(spark, d)
    res = pr.pagerank_dangling(gr.pages, gr.edges, ROUNDS_DANGLING)
    return res.metrics_df(spark).select("round", "nodes", _r6("dangling_mass"), _r6("dangling_mass_raw"))


# ---- whole jobs -------------------------------------------------------------

def q_pagerank_active(spark, d):
    return _ranked(pr.pagerank_active(_active_links(spark, d), ROUNDS_ACTIVE).ranks)


def q_pagerank_hubs(spark, d):
    return _ranked(pr.pagerank_active(b.shelf_edges(spark, d), ROUNDS_ACTIVE).ranks)


def q_pagerank_dangling_compat(spark, d):
    gr = _crawl_graph(spark, d)
    return _ranked(pr.pagerank_dangling(gr.pages, gr.edges, ROUNDS_DANGLING + 1, compat=True).ranks)


def q_rank_report(spark, d):
    ranks = pr.pagerank_active(_active_links(spark, d), ROUNDS_ACTIVE).ranks
    return format_ranks(_ranked(ranks))


def q_pagerank_all_nodes(spark, d):
    res = pr.pagerank_all_nodes(None, b.trade_edges(spark, d), ROUNDS_TABLE)
    return _ranked(res.ranks)


def q_pagerank_all_nodes_compat(spark, d):
    res = pr.pagerank_all_nodes(None, b.trade_edges(spark, d), ROUNDS_TABLE,
                                compat=True)
    return _ranked(res.ranks)


def q_pagerank_dangling(spark, d):
    gr = _crawl_graph(spark, d)
    return _ranked(pr.pagerank_dangling(gr.pages, gr.edges, ROUNDS_DANGLING).ranks)


def q_pagerank_active_ids(spark, d):
    """The edge-list job on node numbers."""
    return _ranked(pr.pagerank_active(_active_links(spark, d), ROUNDS_ACTIVE, node_ids=True).ranks)


def q_pagerank_dangling_ids(spark, d):
    """The dangling job on node numbers, with the text protocol's extra node."""
    gr = _crawl_graph(spark, d)
    return _ranked(pr.pagerank_dangling(gr.pages, gr.edges, ROUNDS_DANGLING + 1, compat=True, node_ids=True).ranks)


def q_pagerank_table_compat(spark, d):
    """The text protocol from rank-table lines, some of which have no links
    field: such pages vote for themselves in the first round."""
    gr = graph_from_rank_table(parse_link_rows(b.bare_rank_lines(spark, d)), compat=True)
    return _ranked(pr.pagerank_all_nodes(gr.pages, gr.edges, ROUNDS_COMPAT, compat=True).ranks)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
