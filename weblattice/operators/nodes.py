"""Node dictionary: dense numbers for node names.

Names (URLs of a hundred bytes and more) are what a graph job would otherwise
shuffle, join and checkpoint in every round. A dictionary gives each distinct
name a number from 0 to N - 1, in name order, by a distributed prefix sum:

1. distinct names are range partitioned and sorted within partitions;
2. a partition's size is one row, and the running sum of the sizes before it is
   its offset (one row per partition, the only thing that is broadcast);
3. a name's number is its partition's offset plus its place in the partition.

Nothing is collected, no partition holds more than its range of distinct
names, and the numbers do not depend on how many partitions there are.
Links are translated end by end, hot names being broadcast to the rows
(``join_by``), and ranks are translated back once, when a loop ends.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.lineage import drop_checkpoint, materialize, shuffle_partitions
from .graph import join_by

PLACE_BITS = 33  # of the row number that Spark gives: the place within a partition


@dataclass
class NodeDictionary:
    table: DataFrame  # (node string, id bigint), materialised

    def encode(self, rows: DataFrame, column: str) -> DataFrame:
        """``rows``, materialised, with the names of ``column`` replaced by
        their numbers; rows whose name is not listed, or null, are left out."""
        ids = self.table.select(F.col("node").alias(column), F.col("id").alias("__id"))
        temporary: list[DataFrame] = []
        coded = join_by(rows, ids, column, temporary=temporary).withColumn(column, F.col("__id")).drop("__id")
        out = materialize(coded)
        for t in temporary:
            drop_checkpoint(t)
        return out

    def decode(self, rows: DataFrame, column: str = "node") -> DataFrame:
        """``rows``, one per number in ``column``, with the names."""
        names = self.table.select(F.col("node").alias("__name"), F.col("id").alias(column))
        return rows.join(names, column).withColumn(column, F.col("__name")).drop("__name")

    def release(self) -> None:
        drop_checkpoint(self.table)


def node_dictionary(names: DataFrame, partitions: int | None = None) -> NodeDictionary:
    """The dictionary of the first column of ``names``; nulls have no number."""
    spark = names.sparkSession
    p = partitions or shuffle_partitions(spark)
    column = F.col(names.columns[0])
    listed = materialize(names.select(column.alias("node")).where(column.isNotNull()).distinct())
    # The place of a row is only stable in a materialised table.
    ordered = materialize(listed.repartitionByRange(p, "node").sortWithinPartitions("node"))
    drop_checkpoint(listed)
    row = F.monotonically_increasing_id()
    placed = ordered.withColumn("part", F.shiftright(row, PLACE_BITS)) \
        .withColumn("place", row.bitwiseAND(F.lit((1 << PLACE_BITS) - 1).cast("bigint")))
    sizes = placed.groupBy("part").agg(F.count("*").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # over one row a partition
    offsets = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    table = materialize(placed.join(F.broadcast(offsets), "part").select("node", (F.col("offset") + F.col("place")).alias("id")))
    drop_checkpoint(ordered)
    return NodeDictionary(table)


def link_names(edges: DataFrame, *more: DataFrame) -> DataFrame:
    """``node``: both ends of all links and the nodes of ``more``."""
    out = edges.select(F.inline(F.array(F.struct(F.col("src").alias("node")), F.struct(F.col("dst").alias("node")))))
    for other in more:
        out = out.unionByName(other.select("node"))
    return out
