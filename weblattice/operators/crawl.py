"""Crawl records -> links -> merged adjacency (the crawl clean-up jobs).

A crawl record is ``(url, json)`` where the JSON carries
``content.links[]`` of ``{type, href}``. Only those fields are declared, so the
JSON reader materialises nothing else; the two values are read as variants,
which keep a string apart from a number or an object.

Link extraction keeps anchors (``type == "a"``) with a non-empty href,
optionally dropping hrefs that contain a comma. Invalid records (JSON that
does not parse, no object / ``content`` / ``links``, or a link the original
job would have dereferenced as null) are handled by policy:

* ``invalid="drop"``     - the record is skipped
* ``invalid="sentinel"`` - it becomes the page ``random`` linking to itself
* ``invalid="fail"``     - the job fails on malformed JSON

Merging several records of one url never builds a list per url. One aggregate
keyed by ``(url, link)`` merges all records: a page's own row has a null link,
every link a row with its number of occurrences. A url with a huge number of
links is spread over many tasks by the hash of the pair.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values that decide results: the JSON fields read, the anchor type
# kept, and the page name given to unusable records.
CRAWL_SCHEMA = "content struct<links:array<struct<type:variant,href:variant>>>"
ANCHOR_TYPE = "a"
SENTINEL = "random"


def parse_crawl(records: DataFrame, url_col: str = "url", json_col: str = "json",
                fail_on_malformed: bool = False) -> DataFrame:
    """``(url, json)`` -> ``(url, links array<struct<type,href>>)``.

    ``links`` is null for a record whose JSON is malformed or lacks an object,
    ``content`` or ``links``; an empty list stays an empty array. A ``type`` or
    ``href`` that is missing or no string is null.
    """
    options = {"mode": "FAILFAST"} if fail_on_malformed else {}
    parsed = F.from_json(F.col(json_col), CRAWL_SCHEMA, options).getField("content").getField("links")

    def text(v):
        return F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string"))

    links = F.transform(parsed, lambda l: F.when(l.isNotNull(), F.struct(
        text(l["type"]).alias("type"), text(l["href"]).alias("href"))))
    return records.select(F.col(url_col).alias("url"), links.alias("links"))


def bad_record(links: str = "links"):
    """Records the clean-up job cannot turn into a row (see module doc)."""
    return F.col(links).isNull() | F.exists(
        F.col(links),
        lambda l: l.isNull() | l["type"].isNull() | ((l["type"] == ANCHOR_TYPE) & l["href"].isNull()))


def extract_links(records: DataFrame, comma: str = "keep", invalid: str = "drop",
                  url_col: str = "url", json_col: str = "json") -> DataFrame:
    """Per record: ``(url, links array<string>)`` of the kept hrefs, in order.

    The array belongs to one input record (its size is bounded by that record),
    it is not a collection over a group.
    """
    if comma not in ("keep", "drop"):
        raise ValueError("comma must be 'keep' or 'drop'")
    if invalid not in ("drop", "sentinel", "fail"):
        raise ValueError("invalid must be 'drop', 'sentinel' or 'fail'")
    parsed = parse_crawl(records, url_col, json_col, fail_on_malformed=(invalid == "fail"))

    def keep(l):
        ok = (l["type"] == ANCHOR_TYPE) & (l["href"] != "")
        if comma == "drop":
            ok = ok & ~l["href"].contains(",")
        return ok

    hrefs = F.transform(F.filter(F.col("links"), keep), lambda l: l["href"])
    bad = bad_record("links")
    if invalid == "sentinel":
        return parsed.select(
            F.when(bad, F.lit(SENTINEL)).otherwise(F.col("url")).alias("url"),
            F.when(bad, F.array(F.lit(SENTINEL))).otherwise(hrefs).alias("links"))
    if invalid == "fail":
        # malformed JSON already fails in the reader; a record without
        # content/links is skipped; a link that cannot be read fails.
        parsed = parsed.where(F.col("links").isNotNull()).select(
            "url",
            F.when(bad, F.raise_error(F.concat(F.lit("unusable crawl link in: "), F.col("url"))))
            .otherwise(F.col("links")).alias("links"))
        return parsed.select("url", hrefs.alias("links"))
    return parsed.where(~bad).select("url", hrefs.alias("links"))


def merge_links(links: DataFrame, dedupe: bool) -> DataFrame:
    """Merge all records of each url into rows ``(url, link, n)``.

    Every url with a usable record has one row with a null link and ``n`` 0
    (the page itself), and one row per distinct link, ``n`` being its number
    of occurrences (concatenation) or 1 (``dedupe=True``, set union). One scan
    and one partially aggregated shuffle on the pair.
    """
    own = F.array(F.lit(None).cast("string"))
    rows = links.select("url", F.explode(F.concat(own, F.col("links"))).alias("link"))
    n = F.lit(1) if dedupe else F.count(F.lit(1))
    merged = rows.groupBy("url", "link").agg(n.cast("bigint").alias("n"))
    return merged.withColumn("n", F.when(F.col("link").isNull(), 0).otherwise(F.col("n")).cast("bigint"))


def adjacency(merged: DataFrame) -> DataFrame:
    """``merge_links`` rows without the page rows of urls that have links: a
    url without links keeps one row with ``link`` null and ``n`` 0. Reads
    ``merged`` twice; pass a materialised table."""
    edges = merged.where(F.col("link").isNotNull())
    own = merged.where(F.col("link").isNull())
    return edges.unionByName(own.join(edges.select("url").distinct(), "url", "left_anti"))
