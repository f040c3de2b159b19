"""Sinks: rank tables as tab-separated text or SequenceFile, pair text, rank
reports.

A rank table has one row ``url, rank, link, n`` per distinct link (``n``
occurrences); a url without links has one row with the link ``dangling`` and
``n`` 0. The form is the same at every size, no row depends on how many links
its url has, and a link may have any name and hold any character: ``n`` tells a
page without links, and a mark in front tells this form from legacy ``a,b,c``
lines. ``graph_from_rank_table`` reads both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import join_sources, with_multiplicity
from ..operators.text import format_pairs
from .hadoop import write_text_pairs, write_text_splits
from .text import DANGLING_MARK, FORM_MARK, escaped


def rank_rows(ranks: DataFrame, edges: DataFrame) -> DataFrame:
    """``ranks(node, rank)`` + ``edges(src, dst[, n])`` -> ``(url, rank, link, n)``."""
    e = with_multiplicity(edges).groupBy("src", "dst").agg(F.sum("n").alias("n"))
    linked = join_sources(e, ranks.select(F.col("node").alias("src"), "rank")) \
        .select(F.col("src").alias("url"), "rank", F.col("dst").alias("link"), "n")
    bare = ranks.join(e.select(F.col("src").alias("node")).distinct(), "node", "left_anti") \
        .select(F.col("node").alias("url"), "rank", F.lit(DANGLING_MARK).alias("link"), F.lit(0).cast("bigint").alias("n"))
    return linked.unionByName(bare)


def rank_lines(rows: DataFrame) -> DataFrame:
    """``(url, rank, link, n)`` rows -> text lines ``value``, each with an
    empty field and the form mark in front."""
    return rows.select(F.concat_ws("\t", F.lit(""), F.lit(FORM_MARK), escaped(F.col("url")), F.col("rank").cast("string"),
                                   escaped(F.col("link")), F.col("n").cast("string")).alias("value"))


def write_rank_rows(rows: DataFrame, path: str, partitions: int | None = None,
                    compression: str = "deflate", mode: str = "overwrite") -> None:
    """Compressed text in the layout that ``rows`` comes in; or spread by the
    hash of url and link over ``partitions`` tasks, which then write exactly so
    many part files, whatever was at ``path``."""
    if not partitions:
        rank_lines(rows).write.mode(mode).option("compression", compression).text(path)
        return
    # Adaptive execution would pack a small shuffle into fewer partitions; a
    # count that is asked for is kept.
    write_text_splits(rank_lines(rows.repartition(partitions, "url", "link")), path, compression)


def write_pairs_text(counts: DataFrame, path: str, key: str = "word", value: str = "n",
                     mode: str = "overwrite") -> None:
    """``(key,value)`` lines, one part file per partition."""
    format_pairs(counts, key, value).write.mode(mode).text(path)


def format_ranks(ranks: DataFrame) -> DataFrame:
    """``X has rank: Y.`` report lines as ``value``."""
    return ranks.select(F.concat(F.col("node"), F.lit(" has rank: "),
                                 F.col("rank").cast("string"), F.lit(".")).alias("value"))


def write_rank_seq(rows: DataFrame, path: str) -> None:
    """Rank rows as a SequenceFile of ``(Text url, Text rank \\t link \\t n)``,
    written inside the JVM by Hadoop's own format and committer."""
    value = F.concat_ws("\t", F.col("rank").cast("string"), escaped(F.col("link")), F.col("n").cast("string"))
    write_text_pairs(rows.select("url", value.alias("value")), path)
