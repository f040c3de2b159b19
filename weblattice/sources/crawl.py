"""Crawl input: SequenceFiles of ``(Text url, Text json)`` and part selection.

The read stays inside the JVM (``sources.hadoop``). Part selection keeps files
named ``...metadata-NNNNN...`` with ``lo <= NNNNN <= hi``, whatever the number
of digits; the listing is the same driver-side file listing any Spark file
source does.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .hadoop import read_text_pairs

# Fixed values of the part-file naming rule: marker text, and five digits or more.
PART_PREFIX = "metadata-"
LANDED = "url string, json string, part bigint"
PARTS_AT_ONCE = 200  # parts that one job copies
PART_NUMBER = re.compile(PART_PREFIX + "([0-9]{5,})")


def part_number(name) -> Column:
    """The number after ``metadata-`` in a file name; null if there is none or
    it exceeds a long."""
    c = F.col(name) if isinstance(name, str) else name
    return F.regexp_extract(c, PART_NUMBER.pattern, 1).try_cast("bigint")


def select_parts(names: DataFrame, lo: int | None = None, hi: int | None = None,
                 name_col: str = "name") -> DataFrame:
    """Rows whose file name carries a part number in ``[lo, hi]``; without a
    range, every crawl part.

    Works on any DataFrame with a file-name column, e.g. a scan's
    ``_metadata.file_name``.
    """
    if lo is None and hi is None:
        return names.where(F.col(name_col).contains(PART_PREFIX))
    n = part_number(name_col)
    ok = n.isNotNull()
    if lo is not None:
        ok = ok & (n >= lo)
    if hi is not None:
        ok = ok & (n <= hi)
    return names.where(ok)


def _part_number_py(name: str) -> int | None:
    found = PART_NUMBER.search(name)
    return int(found[1]) if found else None


def list_parts(spark: SparkSession, folder: str, lo: int | None = None, hi: int | None = None) -> list[str]:
    """Paths under ``folder`` whose part number is in ``[lo, hi]``; without a
    range, every crawl part."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(conf)
    out = []
    for st in fs.listStatus(path):
        p = st.getPath()
        num = _part_number_py(p.getName())
        if lo is None and hi is None:
            ok = PART_PREFIX in p.getName()
        else:
            ok = num is not None and (lo is None or lo <= num) and (hi is None or num <= hi)
        if ok:
            out.append(p.toString())
    return sorted(out)


def read_crawl_seq(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """SequenceFile(s) of ``(Text, Text)`` -> ``(url string, json string)``.

    ``paths`` may be a list, a comma-separated string or globs.
    """
    return read_text_pairs(spark, paths, "url", "json")


def land_crawl(spark: SparkSession, folder: str, landing: str,
               lo: int | None = None, hi: int | None = None) -> DataFrame:
    """Copy the selected parts once into a Parquet table at ``landing`` and
    read that: SequenceFiles, which know no columns, are read here only. The
    table has a folder per part number, so that later jobs choose parts without
    listing or opening the others (``read_landed``). Parts are copied
    ``PARTS_AT_ONCE`` to a job; a task reads one part, so nothing is shuffled."""
    parts = list_parts(spark, folder, lo, hi)
    empty = spark.createDataFrame([], LANDED)
    for at in range(0, max(len(parts), 1), PARTS_AT_ONCE):
        rows = empty
        for path in parts[at:at + PARTS_AT_ONCE]:
            number = _part_number_py(path.rsplit("/", 1)[1])
            rows = rows.unionByName(read_crawl_seq(spark, path).withColumn("part", F.lit(number).cast("bigint")))
        rows.write.mode("append" if at else "overwrite").partitionBy("part").parquet(landing)
    return read_landed(spark, landing, lo, hi)


def read_landed(spark: SparkSession, landing: str, lo: int | None = None, hi: int | None = None) -> DataFrame:
    """Crawl records of the parts in ``[lo, hi]`` of a landed table. The range
    is a filter on its partition column: other parts' folders are never opened."""
    rows = spark.read.schema(LANDED).parquet(landing)
    if lo is not None:
        rows = rows.where(F.col("part") >= lo)
    if hi is not None:
        rows = rows.where(F.col("part") <= hi)
    return rows.select("url", "json")


def read_crawl_parts(spark: SparkSession, folder: str, lo: int | None = None, hi: int | None = None) -> DataFrame:
    """Crawl records of the selected part files of one folder."""
    parts = list_parts(spark, folder, lo, hi)
    if not parts:
        return spark.createDataFrame([], "url string, json string")
    return read_crawl_seq(spark, parts)
