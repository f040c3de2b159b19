"""Session helpers: a local session for tests/bench and the checkpoint folder.

Library code never creates a session; callers pass one in. The checkpoint
folder comes from the session (``spark.checkpoint.dir`` or an earlier
``setCheckpointDir``). Only a local-mode session without one gets a private
temporary folder, so tests and the bench run out of the box; on a cluster a
missing setting is an error, because a machine-local folder would not survive
the loss of an executor.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "weblattice") -> SparkSession:
    """A local session configured the way the tests and bench expect."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("WEBLATTICE_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, configuring it if needed."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if re.fullmatch(r"local(\[.*\])?", sc.master):  # not local-cluster
        folder = tempfile.mkdtemp(prefix="weblattice-ckpt-")
        sc.setCheckpointDir(folder)
        return sc.getCheckpointDir() or folder
    raise RuntimeError(
        "spark.checkpoint.dir is not set: iterative jobs need a shared folder "
        "(HDFS/S3/...) to cut lineage and survive executor loss")
