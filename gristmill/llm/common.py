"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gristmill.operators.blocks import number_in_order
from gristmill.session import scratch


def whole_text(column: str = "text") -> Column:
    """The text as it is; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def bounded_batches(spark: SparkSession, megabytes: int = 8) -> None:
    """Limit what a Python worker gets at once by bytes, as one text may be very long."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{megabytes}m")


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A session setting for the jobs run inside; afterwards it is what it was."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: computed once, safe against lost executors."""
    return Steps(df.sparkSession, label).keep("table", df)


class Steps:
    """Intermediate tables of one job in the shared folder, dropped as soon as they are no longer needed."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.base = spark, scratch(spark, label)

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        """Write `df` and read it back; the shuffle files that writing it took go as soon as it is written."""
        path = f"{self.base}/{name}"
        with setting(self.spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
            df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables that later steps don't read, and let Spark delete the shuffle files of finished steps."""
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        gc.collect()  # frees finished queries on the Python side, so that the JVM can forget them too
        self.spark._jvm.System.gc()


def fresh(names: list[str], wanted: str) -> str:
    """`wanted`, lengthened until no column of `names` is called so in any case of letters."""
    taken = {n.lower() for n in names}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def shuffle_partitions(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, bool]:
    """(_doc, _id, _text): `_doc` is unique and follows (id, text), null ids first; it is the id where ids are unique (then True)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("bigint").alias("_id"), text.alias("_text"))
    n, known, different = rows.agg(F.count(F.lit(1)), F.count("_id"), F.count_distinct("_id")).first()
    if n == known == different:
        return rows.select(F.col("_id").alias("_doc"), "_id", "_text"), True
    ordered = number_in_order(rows, [F.col("_id").asc_nulls_first(), F.col("_text")], "_doc")
    return written(ordered.select(F.col("_doc").cast("bigint").alias("_doc"), "_id", "_text"), "numbered"), False


def with_row_key(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    """`docs` and a BIGINT column that names its rows: the id where it can, else a new one in the order of (id, text)."""
    n, known, different = docs.select(id_col).agg(F.count(F.lit(1)), F.count(id_col), F.count_distinct(id_col)).first()
    if n == known == different:
        return docs, id_col
    order = [F.col(id_col).asc_nulls_first(), F.col(text_col).asc_nulls_first()]
    row = fresh(docs.columns, "__row__")
    return written(number_in_order(docs, order, row).withColumn(row, F.col(row).cast("bigint")), "numbered"), row


def hash_sample(rows: DataFrame, id_col: str, size: int, total: int, seed: int) -> DataFrame:
    """At most `size` of `total` rows, those with the least hash of the id.

    Only about twice as many rows as wanted come to the ranking, however large the table is.
    """
    span = 1 << 30
    share = min(span, -(-2 * size * span // max(total, 1)) + 64 * span // max(total, 1))
    rank = F.pmod(F.xxhash64(id_col, F.lit(seed)), F.lit(span))
    return rows.withColumn("_rank", rank).filter(F.col("_rank") < share).orderBy("_rank", id_col).limit(size).drop("_rank")


_worker: dict = {"step": None, "kept": []}


def make_room(step: str, *kept) -> None:
    """In a Python worker, as a task starts: what tasks of other steps left goes, and free memory returns to the system.

    Workers are reused from step to step. `kept` are functions that free what this step keeps between its tasks.
    """
    if _worker["step"] == step:
        return
    for free in _worker["kept"]:
        free()
    _worker.update(step=step, kept=kept)
    give_back()


def give_back() -> None:
    """Return this process's free memory to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def whole_groups(batches, key: int = 0):
    """Tables of whole groups from batches sorted by a BIGINT column; a group may go over several batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cut = int(np.flatnonzero(keys == keys[-1])[0])  # sorted, so the last group starts here
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        elif held and held[-1].column(key)[-1].as_py() != int(keys[0]):
            yield pa.Table.from_batches(held)
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def ranked(pieces: DataFrame, size: str, order: list[str], rank: str = "_rank") -> DataFrame:
    """Number the rows of each size 0, 1, ...; a size may hold any share of the rows.

    Rows of a size are spread over buckets by a hash of their order columns, numbered there, and
    shifted by the rows in the buckets before.
    """
    buckets = shuffle_partitions(pieces.sparkSession)
    spread = pieces.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    sizes = spread.groupBy(size, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(size).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(size, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    here = W.partitionBy(size, "_bucket").orderBy(*order)
    return (
        spread.withColumn("_rn", F.row_number().over(here))
        .join(offsets, [size, "_bucket"])
        .withColumn(rank, (F.col("_before") + F.col("_rn") - 1).cast("bigint"))
        .drop("_bucket", "_rn", "_before")
    )
