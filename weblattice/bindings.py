"""Inputs derived from the driver's parquet tables (``/root/testdata/sf*``).

Every input grows with the tables; nothing is sampled or capped.

* lines   - every line of every ``documents.text``
* crawl   - one ``(url, json)`` record per ``pages`` row, filed under the
            page's site (host), so a site has several records to merge. Links
            are the first attribute of the page's a, div, html and meta tags,
            typed by the tag, and an anchor to the url's ``ref`` parameter
            (empty where the url has none). A page whose HTML was cut short
            (does not end in ``</html>``) gives a cut-short, hence malformed,
            JSON record.
* trade   - a cyclic graph linear in ``lineitem``: customer -> part bought,
            part -> supplier, supplier -> customer for returned lines,
            customer -> nation (nations only receive links). One edge row per
            transaction, so links repeat.
* shelf   - a graph with hubs: language -> document -> source -> language of
            ``documents``; a language holds up to a third of all edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.text import lines_from_text
from .sources.text import parse_rank_lines

# Fixed values of the test-data binding.
ANCHOR_PATTERN = r'<a href="([^"]*)"'
TAG_PATTERN = r'<(a|div|html|meta) [a-z]+="([^"]*)"'
REF_IN_URL = r"ref=([A-Za-z0-9]*)"
HOST_PATTERN = r"://([^/]+)"
HTML_END = "</html>"
RANK_IN_URL = r"page=(\d+)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_from_text(table(spark, sf_dir, "documents").select("text"))


def blank_tail_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with two line ends appended: one more, empty line each."""
    docs = table(spark, sf_dir, "documents").select(F.concat("text", F.lit("\n\n")).alias("text"))
    return lines_from_text(docs)


def page_hrefs(pages: DataFrame):
    return F.regexp_extract_all(F.col("html"), F.lit(ANCHOR_PATTERN), 1)


def crawl_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("url", "html")
    found = F.arrays_zip(F.regexp_extract_all("html", F.lit(TAG_PATTERN), 1).alias("type"),
                         F.regexp_extract_all("html", F.lit(TAG_PATTERN), 2).alias("href"))
    ref = F.array(F.struct(F.lit("a").alias("type"), F.regexp_extract("url", REF_IN_URL, 1).alias("href")))
    links = F.concat(F.transform(found, lambda x: F.struct(x["type"].alias("type"), x["href"].alias("href"))), ref)
    j = F.to_json(F.struct(F.struct(links.alias("links")).alias("content")))
    cut = F.expr("substring(j, 1, length(j) - 1)")
    return pages.select(
        F.regexp_extract("url", HOST_PATTERN, 1).alias("url"),
        j.alias("j"), F.col("html").endswith(HTML_END).alias("complete")) \
        .select("url", F.when(F.col("complete"), F.col("j")).otherwise(cut).alias("json"))


def page_rank_lines(spark: SparkSession, sf_dir: str, rank_from_url: bool = False) -> DataFrame:
    """One rank-table line per page: ``url \\t rank \\t hrefs``; the rank field
    is ``1.0``, or the ``page=N`` number of the url (empty when absent)."""
    pages = table(spark, sf_dir, "pages").select("url", "html")
    rank = F.regexp_extract("url", RANK_IN_URL, 1) if rank_from_url else F.lit("1.0")
    return pages.select(F.concat_ws("\t", F.col("url"), rank,
                                    F.array_join(page_hrefs(pages), ",")).alias("value"))


def bare_rank_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rank-table line per page: ``url \\t 1.0 \\t hrefs``, without a links
    field where the page has no anchor."""
    pages = table(spark, sf_dir, "pages").select("url", "html")
    hrefs = page_hrefs(pages)
    links = F.when(F.size(hrefs) > 0, F.array_join(hrefs, ","))
    return pages.select(F.concat_ws("\t", F.col("url"), F.lit("1.0"), links).alias("value"))


def page_rank_table(spark: SparkSession, sf_dir: str, rank_from_url: bool = False,
                    bad_rank: str = "fail") -> DataFrame:
    return parse_rank_lines(page_rank_lines(spark, sf_dir, rank_from_url), bad_rank=bad_rank)


def _key(prefix: str, c: str):
    return F.concat(F.lit(prefix), F.col(c).cast("string"))


def trade_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(src, dst)``, one row per transaction (repeats kept). Each table is
    scanned once: a line gives up to three edges."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", (F.col("l_returnflag") == "R").alias("returned"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")

    def edge(a, b):
        return F.struct(a.alias("src"), b.alias("dst"))

    c, p, s = _key("c:", "o_custkey"), _key("p:", "l_partkey"), _key("s:", "l_suppkey")
    back = F.when(F.col("returned"), edge(s, c))
    lines = li.join(orders, li.l_orderkey == orders.o_orderkey, "left") \
        .select(F.inline(F.array(edge(c, p), edge(p, s), back))).where("src is not null and dst is not null")
    return lines.unionByName(cust.select(_key("c:", "c_custkey").alias("src"), _key("n:", "c_nationkey").alias("dst")))


def trade_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trade graph as edge-list text (``src dst`` per line)."""
    return trade_edges(spark, sf_dir).select(F.concat_ws(" ", "src", "dst").alias("value"))


def shelf_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(src, dst)`` with hubs: every document is linked from its language
    and links to its source, which links to the language."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    lang, doc, source = _key("l:", "lang"), _key("d:", "doc_id"), _key("s:", "source")
    pairs = [F.struct(a.alias("src"), b.alias("dst")) for a, b in ((lang, doc), (doc, source), (source, lang))]
    return docs.select(F.inline(F.array(*pairs))).where("src is not null and dst is not null")


def lineitem_edge_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.concat_ws(" ", F.col("l_partkey").cast("string"),
                                 F.col("l_suppkey").cast("string")).alias("value"))


def part_file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return pages.select(F.format_string("metadata-%05d", "page_id").alias("name"))
