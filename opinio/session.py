"""Session construction and the shared scratch / checkpoint location."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "opinio", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": os.environ.get("OPINIO_DRIVER_MEMORY", "8g"),
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the deployment (a distributed file system path); without it a
    session that is not local is refused.  A local session gets a private temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # pragma: no cover - Spark Connect has no SparkContext
            root = None
    if not root:
        master = spark.conf.get("spark.master", "local")
        if not re.match(r"local(\[[^]]*\])?$", master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="opinio-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    try:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(root)
    except Exception:  # pragma: no cover
        pass
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the checkpoint root for a written intermediate table."""
    return f"{checkpoint_root(spark)}/opinio-{name}-{uuid.uuid4().hex[:12]}"


#: Texts of one task where its memory grows with their distinct words.
TASK_TEXTS = 10_000


def spread(scan, rows_per_task: int | None = None):
    """Deal out a plain table scan that has too few files for the session's cores, so per-row text work uses all of
    them.  A scan's partitions say nothing of that: a large file is cut into as many splits as there are cores, and one
    split reads a whole row group, the others none.  Only for scans: their files are known from the listing, no job
    runs.  A table of two files a core passes through without a shuffle, unless ``rows_per_task`` asks for more
    partitions than it has (the rows are counted from the files' footers)."""
    cores = target = scan.sparkSession.sparkContext.defaultParallelism
    if rows_per_task:
        target = max(target, -(-scan.count() // rows_per_task))
    whole = len(scan.inputFiles()) >= 2 * cores and scan.rdd.getNumPartitions() >= target
    return scan if whole else scan.repartition(target)
