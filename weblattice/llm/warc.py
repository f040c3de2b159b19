"""WARC derivatives: linked metadata and plain-text conversion records.

For each response record (id, date, target URI, HTTP message) there are two
derived records, which refer to the response by its id and keep its HTTP
headers and its payload digest: a ``metadata`` record with fields taken from
the response, and a ``conversion`` record with the page's text. Ids are named
by digest, so a rerun makes the same ones. All in DataFrame expressions.

A null HTTP message or page counts as empty: its records have an empty title
and an empty text. Null URIs become empty fields. Repeated rows give repeated
records with the same ids. Pages are
converted whole, however long. An empty table gives no records. Other columns
are never read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Line ends, versions and patterns. The patterns mean the same
# in Java's and in RE2's syntax.
CRLF = "\r\n"
VERSION = "WARC/1.1"
EPOCH = "1970-01-01T00:00:00Z"
DROPPED = [r"(?s)<!--.*?(-->|\z)", r"(?is)<script\b.*?(</script\s*>|\z)", r"(?is)<style\b.*?(</style\s*>|\z)"]
BREAKS = (r"(?i)</?(p|div|br|hr|li|ul|ol|dl|dt|dd|h[1-6]|tr|table|section|article|header|footer|nav|aside|main"
          r"|title|blockquote|pre|head|body|html|form)\b[^>]*>")
TAG = r"<[^>]*>"
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&")]
BLANKS = [(r"[ \t\r\f]+", " "), (r" ?\n[ \n]*", "\n")]
TITLE = r"(?is)<title[^>]*>(.*?)</title\s*>"
LANG = r"(?i)<html[^>]*\blang=\"([^\"]*)\""
LINK = r"(?i)<a\s[^>]*href=\"([^\"]*)\""
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CONV32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def sha1_base32(text: Column) -> Column:
    """``sha1:`` and 32 letters, as WARC files label digests."""
    hexed = F.sha1(text.cast("binary"))
    groups = [F.lpad(F.conv(F.substring(hexed, 10 * k + 1, 10), 16, 32), 8, "0") for k in range(4)]
    return F.concat(F.lit("sha1:"), F.translate(F.concat(*groups), CONV32, BASE32))


def record_id(kind: str, key: Column) -> Column:
    """``<urn:uuid:...>`` named by the digest of kind and key."""
    h = F.md5(F.concat(F.lit(kind + "|"), key).cast("binary"))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def plain_text(html: Column) -> Column:
    """The page's text: without comments, scripts, styles and tags; block tags end lines."""
    out = html
    for pattern in DROPPED:
        out = F.regexp_replace(out, pattern, "")
    out = F.regexp_replace(F.regexp_replace(out, BREAKS, "\n"), TAG, "")
    out = decoded(out)
    for pattern, blank in BLANKS:
        out = F.regexp_replace(out, pattern, blank)
    return F.btrim(out, F.lit(" \n"))


def decoded(text: Column) -> Column:
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def responses(pages: DataFrame, date: str = EPOCH) -> DataFrame:
    """Response records of a table of raw pages (page_id, url, html)."""
    html, url = F.coalesce("html", F.lit("")), F.coalesce("url", F.lit(""))
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.octet_length(html).cast("string"), F.lit(CRLF * 2))
    key = F.concat_ws("|", F.col("page_id").cast("string"), url)
    return pages.select("page_id", record_id("response", key).alias("response_id"), F.lit(date).alias("date"),
                        url.alias("target_uri"), F.concat(head, html).alias("http"))


def derivatives(records: DataFrame, key: str = "page_id") -> DataFrame:
    """Two rows for each response: ``key, record_type, record_id, refers_to,
    target_uri, date, content_type, source_headers, payload_digest,
    block_digest, content_length, block``."""
    http = F.coalesce("http", F.lit(""))
    at = F.instr(http, CRLF * 2)
    cut = records.select(
        F.col(key), "response_id", F.coalesce("target_uri", F.lit("")).alias("target_uri"), F.coalesce("date", F.lit(EPOCH)).alias("date"),
        F.when(at > 0, F.substring(http, F.lit(1), at - 1)).otherwise("").alias("source_headers"),
        F.when(at > 0, F.substring(http, at + 4, F.length(http))).otherwise(http).alias("html"))
    html = F.col("html")
    title = F.btrim(F.regexp_replace(decoded(F.regexp_extract(html, TITLE, 1)), r"\s+", " "))
    read = cut.select(
        "*", sha1_base32(html).alias("payload_digest"), plain_text(html).alias("text"), title.alias("title"),
        F.regexp_extract(html, LANG, 1).alias("lang"), F.size(F.regexp_extract_all(html, F.lit(LINK), 1)).cast("string").alias("links"))
    fields = F.concat(
        F.lit("title: "), "title", F.lit(CRLF + "language: "), "lang", F.lit(CRLF + "outlinks: "), "links",
        F.lit(CRLF + "source-payload-digest: "), "payload_digest",
        F.lit(CRLF + "source-header: "), F.replace("source_headers", F.lit(CRLF), F.lit(CRLF + "source-header: ")), F.lit(CRLF))
    kinds = [("metadata", "application/warc-fields", fields), ("conversion", "text/plain; charset=utf-8", F.col("text"))]
    both = read.select("*", F.explode(F.array(*(
        F.struct(F.lit(k).alias("record_type"), F.lit(c).alias("content_type"), record_id(k, F.col("response_id")).alias("record_id"),
                 block.alias("block")) for k, c, block in kinds))).alias("r"))
    block = F.col("r.block")
    return both.select(
        key, "r.record_type", "r.record_id", F.col("response_id").alias("refers_to"), "target_uri", "date", "r.content_type",
        "source_headers", "payload_digest", sha1_base32(block).alias("block_digest"),
        F.octet_length(block).cast("bigint").alias("content_length"), block.alias("block"))


def record_text(records: DataFrame) -> DataFrame:
    """One row ``value`` per record: its header lines, a blank line, its block."""
    lines = [("WARC-Type", "record_type"), ("WARC-Record-ID", "record_id"), ("WARC-Refers-To", "refers_to"),
             ("WARC-Target-URI", "target_uri"), ("WARC-Date", "date"), ("WARC-Block-Digest", "block_digest"),
             ("WARC-Source-Payload-Digest", "payload_digest"), ("Content-Type", "content_type"), ("Content-Length", "content_length")]
    head = [F.concat(F.lit(f"{CRLF}{name}: "), F.col(c).cast("string")) for name, c in lines]
    return records.select(F.concat(F.lit(VERSION), *head, F.lit(CRLF * 2), "block").alias("value"))


def write(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """WARC files, one for each partition: the two line ends that close a
    record are the text sink's line separator."""
    record_text(records).write.option("lineSep", CRLF * 2).option("compression", compression).text(path)
