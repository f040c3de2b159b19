"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir


BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20    # of rows handed to a Python worker at once; by Spark's default a batch ends after 10,000 rows


def ship(spark: SparkSession) -> None:
    """Hand this package to the Python workers, once per session: a driver
    that loaded it by path has workers that cannot import it otherwise. Bounds
    the bytes of a batch, unless the session names a bound: an executor holds
    a batch several times, in the JVM and in the worker of each core."""
    if spark.conf.get(BATCH_LIMIT, None) is None:
        spark.conf.set(BATCH_LIMIT, str(BATCH_BYTES))
    sc = spark.sparkContext
    if getattr(sc, "_weblattice_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="weblattice-ship-"), "weblattice_pkg.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("weblattice", os.path.relpath(path, root)))
    sc.addPyFile(target)
    sc._weblattice_shipped = True


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder name under the session's checkpoint folder, which the
    driver and all executors share."""
    return f"{checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: cuts the
    lineage, and a lost executor costs only a re-read."""
    spark = df.sparkSession
    path = shared_folder(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``written`` made, once nothing reads them any more."""
    for df in tables:
        path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(df._written_to)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drawn(rows: DataFrame, want: int, *key: str, n: int | None = None) -> DataFrame:
    """About ``want`` rows, never twice as many: those whose hashed ``key``
    lies below their share of ``n`` rows (counted if not given). Tasks send
    only what is drawn, however many there are."""
    n = rows.count() if n is None else n
    share = min(1.0, want / max(n, 1))
    return rows.where(F.pmod(F.xxhash64(*key, F.lit(want)), F.lit(1 << 30)) < int(share * (1 << 30))).limit(2 * want)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BROADCAST_IDS = 500_000  # ids (8 MB) that may be broadcast; beyond, tables are joined by shuffle


def by_id(docs: DataFrame, ids: DataFrame, how: str, id_col: str = "doc_id") -> DataFrame:
    """``docs`` whose id is (``left_semi``) or is not (``left_anti``) in the
    one column of ``ids``; null ids match. The ids are broadcast only if a
    count shows that they are few."""
    listed = ids.select(F.col(ids.columns[0]).alias("__listed_id")).distinct()
    if listed.count() <= BROADCAST_IDS:
        listed = F.broadcast(listed)
    return docs.join(listed, docs[id_col].eqNullSafe(listed["__listed_id"]), how)
