"""Session helpers: shared scratch storage, lineage cuts and size-checked broadcasts."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows a side may have before it is joined by shuffle instead of broadcast.
BROADCAST_ROWS = 500_000


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a local one only where none is configured and all work is local."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if not configured:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        configured = tempfile.mkdtemp(prefix="gristmill-")
        spark.sparkContext.setCheckpointDir(configured)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder for one job's own tables."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` reliably to the shared folder and return it with a short plan."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(scan: DataFrame) -> DataFrame:
    """Give a scan at least as many partitions as there are cores.

    Files with few row groups would leave most cores idle in CPU-bound work. A scan that is
    large enough to fill the cores is left as it is, so big inputs are never shuffled here.
    Meant for plain scans: the partition count of a plan with shuffles is not known upfront.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def tasks_for(spark: SparkSession, rows: int, task_rows: int) -> int:
    """As many tasks as a shuffle has, or more if each would get over `task_rows` rows."""
    usual = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return max(usual, -(-rows // task_rows))


def by_size(df: DataFrame, task_rows: int, *keys: str) -> DataFrame:
    """`df` dealt by `keys` to a number of tasks that grows with its rows, so that what a task holds does not."""
    return df.repartition(tasks_for(df.sparkSession, df.count(), task_rows), *keys)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after counting that the side has at most `max_rows` rows."""
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df


def joinable(derived: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """A derived table (one row per key of something larger), computed once, then size-checked."""
    return broadcast_if_small(cut_lineage(derived), max_rows)


def qualified(spark: SparkSession, path: str) -> str:
    """`path` as Spark resolves it: on the default file system if it names none."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()
