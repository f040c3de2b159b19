"""Rank tables as bucketed tables, for jobs that read another job's result.

Text is the exchange form; between jobs of one warehouse a rank table can be a
pair of catalog tables. ``name`` is bucketed and sorted by url, one file per
bucket, so its rows are where a rank loop of as many partitions wants them:
degrees, link weights and the join with ranks need no exchange. Urls with more
than a bucket's share of the rows (fewer of them than buckets) are kept apart in
``name_hot``, spread by url and link, as in the loops' own layout; no bucket
holds a third of the web because one page does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .lineage import drop_checkpoint, materialize, pinned_partitions
from .pagerank import DAMPING, PreparedLinks, _node_flags, step_all_nodes


def write_rank_table(rows: DataFrame, name: str, buckets: int, path: str | None = None) -> None:
    """``(url, rank, link, n)`` rows, one per distinct link (``rank_rows``), as
    the tables ``name`` and ``name_hot``, replacing them; with ``path`` their
    files lie in its folders ``cold`` and ``hot``."""
    counts = materialize(rows.groupBy("url").agg(F.count(F.lit(1)).alias("rows")))
    total = counts.agg(F.sum("rows")).first()[0] or 0
    hot = F.broadcast(counts.where(F.col("rows") > -(-total // buckets)).select("url"))

    def saved(df: DataFrame, part: str, table: str, bucketed: bool) -> None:
        writer = df.write.mode("overwrite").format("parquet")
        if path:
            writer = writer.option("path", f"{path}/{part}")
        if bucketed:
            writer = writer.bucketBy(buckets, "url").sortBy("url")
        writer.saveAsTable(table)

    saved(rows.join(hot, "url", "left_anti").repartition(buckets, "url"), "cold", name, True)
    saved(rows.join(hot, "url", "left_semi"), "hot", f"{name}_hot", False)
    drop_checkpoint(counts)


def bucket_count(spark: SparkSession, name: str) -> int:
    found = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    return int(found["Num Buckets"])


def _links(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("n") > 0).select(F.col("url").alias("src"), F.col("link").alias("dst"), "n")


def _pages(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.col("url").alias("node")).agg(F.max("rank").alias("rank"))


def _degrees(links: DataFrame) -> DataFrame:
    return links.groupBy("src").agg(F.sum("n").alias("deg"))


def weighted(links: DataFrame, degrees: DataFrame) -> DataFrame:
    return links.join(degrees, "src").select("src", "dst", (F.col("n") / F.col("deg")).alias("w"))


def prepared(spark: SparkSession, name: str) -> tuple[PreparedLinks, DataFrame]:
    """The loop's link tables, and ``pages(node, rank)``. Call it inside
    ``pinned_partitions`` of the table's bucket count."""
    p = bucket_count(spark, name)
    rows, hot_rows = spark.table(name), spark.table(f"{name}_hot")
    links, hot_links = _links(rows), _links(hot_rows)
    degrees, hot_degrees = _degrees(links), materialize(_degrees(hot_links))
    cold = materialize(weighted(links, degrees).sortWithinPartitions("src"), persist=True)
    tables = [cold, hot_degrees]
    hot = hot_sources = None
    if hot_degrees.head() is not None:
        hot_sources = hot_degrees.select("src")
        hot = materialize(weighted(hot_links, F.broadcast(hot_degrees)), persist=True)
        tables.append(hot)
    out = PreparedLinks(cold, hot, hot_sources, degrees.unionByName(hot_degrees), p, 0, tables)
    return out, _pages(rows).unionByName(_pages(hot_rows))


def rank_bucketed_job(spark: SparkSession, name: str, iterations: int = 10, damping: float = DAMPING) -> DataFrame:
    """``iterations`` all-node rounds over a bucketed rank table, in as many
    partitions as it has buckets: ``(node, rank, has_links)``."""
    with pinned_partitions(spark, bucket_count(spark, name)):
        links, pages = prepared(spark, name)
        ranks = materialize(_node_flags(pages, links).repartition(links.partitions, "node"), persist=True)
        for _ in range(iterations):
            previous = ranks
            ranks = materialize(step_all_nodes(links, ranks, damping=damping), persist=True)
            drop_checkpoint(previous)
        ranks.unpersist()
        links.release()
    return ranks
