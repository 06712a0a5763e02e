"""Seeded order, exact ratio split, batches and epochs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.operators.blocks import nth_keys, number_in_order, positions

SEED = 42
SPLIT_VERSION = 2


def order_hash(key: Column, seed) -> Column:
    """Reproducible shuffle key: SHA-256 of `seed:key` in hex."""
    return F.sha2(F.concat_ws(":", F.lit(str(seed)) if not isinstance(seed, Column) else seed, key.cast("string")), 256)


def _leading_bits(h: Column) -> Column:
    """First 15 hex digits (60 bits) of a hash as BIGINT, in the hash's own order."""
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("bigint")


def _block(h: Column) -> Column:
    return F.conv(F.substring(h, 1, 4), 16, 10).cast("int")


def permute(df: DataFrame, key: str, seed: int = SEED) -> DataFrame:
    """Add `pos`, the row's place (1-based) in the seeded order of the unique `key`."""
    hashed = df.withColumn("_h", order_hash(F.col(key), seed))
    return positions(hashed, [], ["_h", key], _block(F.col("_h"))).drop("_h")


def ratio_split(
    df: DataFrame, key: str, train: float = 0.9, validation: float = 0.05, seed: int = SEED
) -> DataFrame:
    """Add `split`: floor(n*train) rows, then floor(n*validation), then the rest as test.

    Only the two hashes at the cuts are looked up; the split itself is a projection. Rows
    equal to a cut hash in the leading 60 bits are ordered by the rest of the hash.
    """
    order = order_hash(F.col(key), seed)
    bits = df.select(_leading_bits(order).alias("k"))

    def ends(n: int) -> tuple[int, int]:
        t = int(n * train)
        return t, t + int(n * validation)

    cuts = nth_keys(bits, "k", lambda n: sorted(set(ends(n))))
    t, v = ends(cuts.rows)

    def first(rank: int) -> Column:
        """Is a row among the first `rank` of the order?"""
        value = cuts.keys[rank]
        if rank not in cuts.inside_ties:
            return F.substring(order, 1, 15) <= f"{value:015x}"
        below = bits.filter(F.col("k") < value).count()
        tied = df.select(order.alias("h")).filter(_leading_bits(F.col("h")) == value)
        return order <= tied.orderBy("h").offset(rank - below - 1).limit(1).first()[0]

    name = F.lit("test")
    if v > t:
        name = F.when(first(v), F.lit("val")).otherwise(name)
    if t > 0:
        name = F.when(first(t), F.lit("train")).otherwise(name)
    return df.withColumn("split", name)


def split_sizes(df: DataFrame, ids: str | None = None) -> DataFrame:
    """Rows per split and, when the id arrays are given, their size as int32 cells."""
    cells = F.sum(4 * F.size(ids)).cast("bigint") if ids else F.lit(None).cast("bigint")
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n"), cells.alias("bytes"))


def batches(df: DataFrame, key: str, batch_size: int, shuffle: bool = True, seed: int = SEED) -> DataFrame:
    """Add `batch_id`; rows of the incomplete last batch are dropped.

    Without shuffling the rows keep the order of the key.
    """
    if shuffle:
        hashed = df.withColumn("_h", order_hash(F.col(key), seed))
        placed = positions(hashed, [], ["_h", key], _block(F.col("_h")), "_pos", total="_n")
        placed = placed.withColumn("_pos", F.col("_pos") - 1).drop("_h")
    else:
        placed = number_in_order(df, [key], "_pos").withColumn("_n", F.lit(df.count()))
    return (
        placed.withColumn("batch_id", F.expr(f"_pos div {batch_size}"))
        .filter(F.col("batch_id") < F.expr(f"_n div {batch_size}"))
        .drop("_pos", "_n")
    )


def cycle(df: DataFrame, key: str, batch_size: int, max_steps: int, seed: int = SEED) -> DataFrame:
    """Rows of every training step when the batches are gone through again and again.

    Each epoch has its own order. Output: `(step, epoch, key)`, one row per row used.
    """
    per_epoch = df.count() // batch_size
    if per_epoch == 0:
        return df.select(F.lit(0).cast("bigint").alias("step"), F.lit(0).cast("bigint").alias("epoch"), key).limit(0)
    epochs = -(-max_steps // per_epoch)
    work = df.select(key, F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(epochs - 1).cast("bigint"))).alias("epoch"))
    work = work.withColumn("_h", order_hash(F.col(key), F.concat_ws(":", F.lit(str(seed)), F.col("epoch"))))
    # Of the last epoch only the rows up to the last step are ordered.
    needed = (max_steps - (epochs - 1) * per_epoch) * batch_size
    bits = df.select(_leading_bits(order_hash(F.col(key), f"{seed}:{epochs - 1}")).alias("k"))
    cut = nth_keys(bits, "k", [needed]).keys[needed]
    work = work.filter((F.col("epoch") < epochs - 1) | (_leading_bits(F.col("_h")) <= cut))
    placed = positions(work, ["epoch"], ["_h", key], _block(F.col("_h")), "_pos")
    batch = F.expr(f"(_pos - 1) div {batch_size}")
    return (
        placed.withColumn("_batch", batch).filter(F.col("_batch") < per_epoch)
        .withColumn("step", F.col("epoch") * per_epoch + F.col("_batch") + 1)
        .filter(F.col("step") <= max_steps)
        .select("step", "epoch", key)
    )
