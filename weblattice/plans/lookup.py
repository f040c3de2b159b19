"""Point lookups: all rows of one key, after a rank update (a filter, pushed
to the scan when the input is a file source) or in the mapped stream before it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.graph import with_multiplicity
from .lineage import shuffle_partitions

ROW_GROUP_BYTES = 16 << 20  # of a lookup table: what one lookup reads at most, by and large


def lookup(df: DataFrame, key: str, col: str = "node") -> DataFrame:
    return df.where(F.col(col) == F.lit(key))


def lookup_mapped(ranks: DataFrame, edges: DataFrame, key: str) -> DataFrame:
    """``(node, src, value, n)``: what the mapped stream of a round holds for
    ``key``. Its own row (``src`` null) carries the share that it gives each
    link occurrence, or its rank if it has no link; each inlink from a ranked
    source carries the source's share, ``n`` times.

    Only the key's inlinks and the out-degrees of their sources are computed.
    """
    e = with_multiplicity(edges)
    sources = e.where(F.col("dst") == F.lit(key)).groupBy("src").agg(F.sum("n").alias("n"))
    asked = sources.unionByName(e.sparkSession.createDataFrame([(key, 0)], "src string, n bigint")) \
        .groupBy("src").agg(F.max("n").alias("n"))
    degree = e.join(asked.select("src"), "src", "left_semi").groupBy("src").agg(F.sum("n").alias("deg"))
    share = asked.join(degree, "src", "left").join(ranks.select(F.col("node").alias("src"), "rank"), "src") \
        .select("src", "n", (F.col("rank") / F.coalesce(F.col("deg"), F.lit(1))).alias("value"))
    own = share.where(F.col("src") == F.lit(key)).select(
        F.lit(key).alias("node"), F.lit(None).cast("string").alias("src"), "value", F.lit(1).cast("bigint").alias("n"))
    return own.unionByName(share.where(F.col("n") > 0).select(F.lit(key).alias("node"), "src", "value", "n"))


def write_lookup_table(ranks: DataFrame, path: str, key: str = "node", partitions: int | None = None) -> None:
    """``ranks`` as Parquet for point lookups: range partitioned and sorted by
    the key, so that each row group covers a narrow range of keys, with a Bloom
    filter for keys that lie in the range but are not there."""
    p = partitions or shuffle_partitions(ranks.sparkSession)
    ranks.repartitionByRange(p, key).sortWithinPartitions(key).write.mode("overwrite") \
        .option(f"parquet.bloom.filter.enabled#{key}", "true").option("parquet.block.size", str(ROW_GROUP_BYTES)).parquet(path)


def lookup_at(spark: SparkSession, path: str, value, key: str = "node") -> DataFrame:
    """Rows of one key of a table that ``write_lookup_table`` wrote. The filter
    reaches the scan, which opens only the row groups that may hold the key."""
    return lookup(spark.read.parquet(path), value, key)
