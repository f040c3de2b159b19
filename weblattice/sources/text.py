"""Line-oriented text sources: plain lines, edge lists, rank tables.

All parsing is column expressions over ``spark.read.text``; nothing is
collected. Rank tables come in two forms: legacy lines ``url \\t rank \\t
a,b,c`` (the third field is optional), and the lines this library writes,
``\\t + \\t url \\t rank \\t link \\t n`` with one line per distinct link.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import java_split
from .hadoop import text_splits


def read_lines(spark: SparkSession, path: str | list[str],
               min_partitions: int | None = None) -> DataFrame:
    """Text file(s) -> one row per line in ``value``.

    ``path`` may be any Hadoop file-system URI, glob or list of them.
    ``min_partitions``, the split hint of a text-file read, is a least number
    of splits, as there: files are cut finer, never joined, and nothing is
    shuffled. Without it Spark's own scan packs the files.
    """
    return text_splits(spark, path, min_partitions) if min_partitions else spark.read.text(path)


def parse_edges(lines: DataFrame, col: str = "value", bad_line: str = "fail",
                distinct: bool = False) -> DataFrame:
    """Edge-list lines ``src dst`` (any whitespace) -> ``(src, dst)``.

    Tokens after the second are ignored; a leading blank yields an empty
    source, as a whitespace split does. A line with fewer than two tokens
    fails the job (``bad_line="fail"``) or is skipped (``"drop"``).
    """
    if bad_line not in ("fail", "drop"):
        raise ValueError("bad_line must be 'fail' or 'drop'")
    # A whitespace run is one separator, so the only empty token a Java split
    # can keep is a leading one; an empty second piece is a trailing one
    # (dropped there). One bounded split therefore decides everything.
    parts = lines.select(F.split(F.col(col), r"\s+", 3).alias("t"))
    ok = (F.size("t") >= 2) & (F.col("t")[1] != "")
    if bad_line == "drop":
        parts = parts.where(ok)
        src = F.col("t")[0]
    else:
        src = F.when(ok, F.col("t")[0]).otherwise(
            F.raise_error(F.lit("edge line without two tokens")))
    edges = parts.select(src.alias("src"), F.col("t")[1].alias("dst"))
    return edges.distinct() if distinct else edges


# The link field of a page without links; the rank field of a line
# in this library's own form, which no rank can be; and how that form writes the
# characters that would end a field.
DANGLING_MARK = "dangling"
FORM_MARK = "+"
ESCAPES = [("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")]


def escaped(c):
    """A field of the text form: no tab or line end in it."""
    for plain, written in ESCAPES:
        c = F.replace(c, F.lit(plain), F.lit(written))
    return c


def unescaped(c):
    """The field again. Cut at written backslashes first: what is left of a
    piece holds no backslash but those of the other escapes."""
    def piece(x):
        for plain, written in ESCAPES[1:]:
            x = F.replace(x, F.lit(written), F.lit(plain))
        return x

    return F.array_join(F.transform(F.split(c, r"\\\\", -1), piece), "\\")


def parse_link_rows(lines: DataFrame, col: str = "value", bad_rank: str = "fail") -> DataFrame:
    """Lines of either form -> ``(url, rank, link, n, has_field, is_mark)``, one
    row per link; a page without links is one row with a null link and ``n`` 0.

    A line of this library starts with an empty field and the form mark; there
    ``n`` alone tells a page without links, so a link may have any name. Every
    other line is a legacy one, whose trailing empty fields and fields after
    the third do not count. ``has_field`` is false for a legacy line without a
    links field, ``is_mark`` true for the link row of a legacy links field that
    is just ``dangling``. A legacy rank that cannot be read fails, or becomes
    1.0 with ``bad_rank="default"``.
    """
    t = lines.where(F.col(col) != "").withColumn("f", F.split(F.col(col), "\t", -1))
    own = (F.size("f") == 6) & (F.col("f")[0] == "") & (F.col("f")[1] == FORM_MARK)
    ours = t.where(own).select(
        unescaped(F.col("f")[2]).alias("url"), F.col("f")[3].cast("double").alias("rank"),
        F.when(F.col("f")[5] != "0", unescaped(F.col("f")[4])).alias("link"),
        F.col("f")[5].cast("bigint").alias("n"), F.lit(True).alias("has_field"), F.lit(False).alias("is_mark"))
    legacy = parse_rank_lines(t.where(~own), col, bad_rank).select(
        "url", "rank", F.explode_outer("links").alias("link"), F.col("links").isNotNull().alias("has_field"),
        F.coalesce(F.col("links") == F.array(F.lit(DANGLING_MARK)), F.lit(False)).alias("is_mark"))
    return ours.unionByName(legacy.select(
        "url", "rank", "link", F.when(F.col("link").isNull(), 0).otherwise(1).cast("bigint").alias("n"), "has_field", "is_mark"))


def parse_rank_lines(lines: DataFrame, col: str = "value",
                     bad_rank: str = "fail") -> DataFrame:
    """Rank-table lines -> ``(url string, rank double, links array<string>)``.

    Blank lines are skipped. ``links`` is null when the third field is absent
    and the Java comma split of it otherwise (so the literal ``dangling``
    marker comes back as ``["dangling"]``; rank jobs decide what it means).
    ``bad_rank="default"`` turns an unparsable rank into 1.0; ``"fail"``
    raises, as does a line without a rank field.
    """
    if bad_rank not in ("fail", "default"):
        raise ValueError("bad_rank must be 'fail' or 'default'")
    t = lines.where(F.col(col) != "").select(java_split(F.col(col), "\t").alias("t"))
    raw = F.get("t", F.lit(1))
    parsed = F.expr("try_cast(trim(get(t, 1)) as double)")
    if bad_rank == "default":
        rank = F.coalesce(parsed, F.lit(1.0))
    else:
        rank = F.when(parsed.isNotNull(), parsed).otherwise(
            F.raise_error(F.concat(F.lit("bad rank field: "), F.coalesce(raw, F.lit("<missing>")))))
    links = F.when(F.size("t") >= 3, java_split(F.col("t")[2], ","))
    return t.select(F.col("t")[0].alias("url"), rank.alias("rank"), links.alias("links"))


def read_rank_tsv(spark: SparkSession, path: str | list[str],
                  bad_rank: str = "fail") -> DataFrame:
    """Read (optionally compressed) rank-table text files."""
    return parse_rank_lines(spark.read.text(path), bad_rank=bad_rank)
