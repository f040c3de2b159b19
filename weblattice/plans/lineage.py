"""Lineage and layout control for iterative jobs.

* Reliable checkpoints only (``Dataset.checkpoint``) into the folder the
  session names; the result keeps its hash partitioning and ordering, so the
  next round's join does not re-shuffle it.
* The shuffle-partition count is pinned while a loop is planned, so the
  rank table produced by one round's aggregation is partitioned exactly like
  the loop-invariant link table, and their join needs no exchange.
"""

from __future__ import annotations

import json
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@contextmanager
def pinned_partitions(spark: SparkSession, partitions: int):
    """Plan with exactly ``partitions`` shuffle partitions.

    Adaptive execution is paused meanwhile: an adaptive plan reports no
    output partitioning, so a checkpointed rank table would lose its hash
    layout (and a coalesced one would no longer line up with the links).
    The loop's plan is fixed by construction - co-partitioned join, one
    partially aggregated exchange - so there is nothing to re-plan. Only
    materialised tables may enter: a caller's input is planned outside, with
    adaptive execution. Rows that lie sorted by what they are grouped by are
    aggregated as they come, in one aggregate and not two.
    """
    keys = {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.execution.replaceHashWithSortAgg": "true",
    }
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def materialize(df: DataFrame, persist: bool = False) -> DataFrame:
    """Reliable checkpoint (eager); optionally keep the result in memory too.

    Lost cached blocks are re-read from the checkpoint files, not recomputed
    from the source, so executor loss costs a re-read, never a re-run.
    """
    checkpoint_dir(df.sparkSession)
    out = df.checkpoint(eager=True)
    if persist:
        out = out.persist(StorageLevel.MEMORY_AND_DISK)
    return out


def checkpoint_path(df: DataFrame) -> str | None:
    """Folder holding a checkpointed DataFrame's files (None if not one)."""
    plan = df._jdf.queryExecution().analyzed()
    if not plan.getClass().getName().endswith("LogicalRDD"):
        return None
    opt = plan.rdd().getCheckpointFile()
    return opt.get() if opt.isDefined() else None


def _hadoop_path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def drop_checkpoint(df: DataFrame | None) -> None:
    """Delete the files of a superseded round (the predecessor-folder
    clean-up of the iterative jobs) and free its memory. Only call once
    nothing reads ``df``."""
    if df is None:
        return
    df.unpersist()
    path = checkpoint_path(df)
    if not path:
        return
    p, fs = _hadoop_path(df.sparkSession, path)
    fs.delete(p, True)


def fingerprint(df: DataFrame) -> list[str]:
    """Row count and an order-free checksum of the rows of ``df``."""
    h = F.xxhash64(*sorted(df.columns))
    n, low, high = df.agg(F.count("*"), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF).cast("bigint"))), F.sum(F.shiftright(h, 32))).first()
    return [str(n), str(low or 0), str(high or 0)]


class RoundFolders:
    """A loop's rounds as named Parquet folders, ``round-00007`` for the ranks
    after the eighth round, from which a later run of the same job continues.

    A round counts once its manifest is there: round, the job's settings, a
    fingerprint of its input and the loop's scalars, written as one line of
    text after the ranks. Only then is its predecessor deleted, so whenever a
    job is lost, one whole round remains. A folder of other settings or another
    input is never continued; it is cleared when the loop's first round is kept.
    """

    def __init__(self, spark: SparkSession, folder: str, settings: dict, resume: bool):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.settings, self.resume = json.loads(json.dumps(settings)), resume
        self.previous: list[str] = []

    def _folders(self) -> list[str]:
        root, fs = _hadoop_path(self.spark, self.folder)
        if not fs.exists(root):
            return []
        names = [st.getPath().getName() for st in fs.listStatus(root)]
        return sorted((f"{self.folder}/{n}" for n in names if n.startswith("round-")), reverse=True)

    def last(self) -> tuple[int, dict, DataFrame] | None:
        """``round, state, ranks`` to continue from; None to start afresh."""
        self.previous = self._folders()
        for path in self.previous if self.resume else []:
            manifest, fs = _hadoop_path(self.spark, f"{path}/manifest/_SUCCESS")
            if not fs.exists(manifest):
                continue  # lost while it was written
            found = json.loads(self.spark.read.text(f"{path}/manifest").first()[0])
            if found["settings"] == self.settings:
                return found["round"], found["state"], self.spark.read.parquet(f"{path}/ranks")
        return None

    def keep(self, done: int, ranks: DataFrame, state: dict | None = None) -> None:
        path = f"{self.folder}/round-{done:05d}"
        manifest = json.dumps({"round": done, "settings": self.settings, "state": state or {}})
        ranks.write.mode("overwrite").parquet(f"{path}/ranks")
        self.spark.createDataFrame([(manifest,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest")
        for old in self.previous:
            if old != path:
                p, fs = _hadoop_path(self.spark, old)
                fs.delete(p, True)
        self.previous = [path]
