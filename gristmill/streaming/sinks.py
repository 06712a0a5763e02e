"""Batch folders: the unit of idempotent output and of carried state."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.session import scratch


def put_batch(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def batches_before(spark: SparkSession, path: str, schema: str, batch_id: int) -> DataFrame:
    """Rows that earlier batches wrote; empty before the first one."""
    try:
        rows = spark.read.schema(f"{schema}, batch_id bigint").parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], f"{schema}, batch_id bigint")
    return rows.filter(F.col("batch_id") < batch_id)


def previous_state(spark: SparkSession, path: str, schema: str, batch_id: int) -> DataFrame:
    """The state table written by the batch before this one; empty for the first batch."""
    if batch_id == 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/batch_id={batch_id - 1}")


def put_state(df: DataFrame, path: str, batch_id: int) -> None:
    """Write the state after this batch and drop all but the one before it, which a repeated batch starts from."""
    put_batch(df, path, batch_id)
    spark = df.sparkSession
    old = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batch_id={batch_id - 2}")
    old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)


def latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Last written row of each key among update-mode batches."""
    rows = spark.read.parquet(path)
    fields = [c for c in rows.columns if c not in (*keys, "batch_id")]
    last = F.max_by(F.struct(*fields), "batch_id").alias("_r")
    return rows.groupBy(*keys).agg(last).select(*keys, "_r.*")


def files_per_batch(spark: SparkSession, path: str, batches: int) -> int:
    """Files that a batch takes so that those in a folder make at most `batches` batches, however many they are.

    A stateful batch has a price of its own, for opening and committing its state, whatever it holds.
    """
    return max(1, math.ceil(len(spark.read.parquet(path).inputFiles()) / batches))


def drain(stream: DataFrame, put: Callable[[DataFrame, int], None], mode: str = "append", checkpoint: str | None = None) -> None:
    """Run a stream over everything available and wait for it."""
    place = checkpoint or scratch(stream.sparkSession, "stream")
    query = (
        stream.writeStream.outputMode(mode).foreachBatch(put).option("checkpointLocation", place)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
