"""Ordered computations that stay parallel inside one key.

A window over `(key)` puts all rows of a key into one task, which fails when a key holds
a large share of the table. Here every key is cut into ordered blocks: the window runs per
(key, block), the blocks are summed up to one row each, and the small block table carries
the state from block to block.

`block` must grow with the order: every row of a lower block sorts before every row of a
higher one. NULL keys are a key of their own, and a NULL block is the first of its key.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill.session import cut_lineage, tasks_for


def _before(keys: list[str]):
    return W.partitionBy(*keys).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)


def _beside(rows: DataFrame, table: DataFrame, on: list[str]) -> DataFrame:
    """`rows` with the other columns of `table`, which has one row for each value of `on`; NULLs match."""
    other = table.select(*[F.col(c).alias(f"_on_{c}") for c in on], *[c for c in table.columns if c not in on])
    same = functools.reduce(operator.and_, [F.col(c).eqNullSafe(F.col(f"_on_{c}")) for c in on])
    return rows.join(other, same).drop(*[f"_on_{c}" for c in on])


def positions(
    df: DataFrame, keys: list[str], order: list, block: Column, pos: str = "pos", total: str | None = None
) -> DataFrame:
    """Number the rows of each key 1, 2, ... in order; optionally add the key's row count."""
    cut = df.withColumn("_b", block)
    sizes = cut.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select(
        *keys, "_b",
        F.coalesce(F.sum("_n").over(_before(keys)), F.lit(0)).alias("_off"),
        F.sum("_n").over(W.partitionBy(*keys)).alias("_total"),
    )
    local = cut.withColumn("_rn", F.row_number().over(W.partitionBy(*keys, "_b").orderBy(*order)))
    out = _beside(local, offsets, [*keys, "_b"]).withColumn(pos, (F.col("_off") + F.col("_rn")).cast("bigint"))
    if total:
        out = out.withColumn(total, F.col("_total").cast("bigint"))
    return out.drop("_b", "_rn", "_off", "_total")


def number_in_order(df: DataFrame, order: list, pos: str = "pos", rows: int = 0, task_rows: int = 1_000_000) -> DataFrame:
    """Number all rows 0, 1, ... in a global order without a single-task window.

    The rows are range-sorted and written once; each sorted partition then only needs its
    offset, and the table of offsets has one row per partition. Given the number of `rows`,
    about, there are more partitions for more than `task_rows` in one.
    """
    parts = tasks_for(df.sparkSession, rows, task_rows)
    placed = (
        cut_lineage(df.repartitionByRange(parts, *order).sortWithinPartitions(*order))
        .withColumn("_b", F.spark_partition_id())
        .withColumn("_i", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    sizes = placed.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_b", F.coalesce(F.sum("_n").over(_before([])), F.lit(0)).alias("_off"))
    return placed.join(F.broadcast(offsets), "_b").withColumn(pos, F.col("_off") + F.col("_i")).drop("_b", "_i", "_off")


def running(
    df: DataFrame, keys: list[str], order: list, block: Column, columns: dict[str, tuple[str, Column]]
) -> DataFrame:
    """Running aggregates per key.

    `columns` maps a new column to (kind, expression); kinds are sum, min, max up to each
    row, and sum_before, min_before, max_before up to the row before it. A sum over no rows
    is 0, a min or max over none is NULL. All columns share one pass.
    """
    fold = {"sum": F.sum, "min": F.min, "max": F.max}
    last = {name: -1 if kind.endswith("_before") else 0 for name, (kind, _) in columns.items()}
    columns = {name: (kind.removesuffix("_before"), value) for name, (kind, value) in columns.items()}
    cut = df.withColumn("_b", block)
    for name, (_, value) in columns.items():
        cut = cut.withColumn("_v_" + name, value)
    parts = cut.groupBy(*keys, "_b").agg(
        *[fold[kind]("_v_" + name).alias("_p_" + name) for name, (kind, _) in columns.items()]
    )
    carry = parts.select(
        *keys, "_b",
        *[fold[kind]("_p_" + name).over(_before(keys)).alias("_c_" + name) for name, (kind, _) in columns.items()],
    )
    here = W.partitionBy(*keys, "_b").orderBy(*order)
    for name, (kind, _) in columns.items():
        frame = here.rowsBetween(W.unboundedPreceding, last[name])
        cut = cut.withColumn("_l_" + name, fold[kind]("_v_" + name).over(frame))
    out = _beside(cut, carry, [*keys, "_b"])
    for name, (kind, _) in columns.items():
        local, carried = F.col("_l_" + name), F.col("_c_" + name)
        if kind == "sum":
            zero = F.lit(0).cast(cut.schema["_l_" + name].dataType)
            both = F.coalesce(local, zero) + F.coalesce(carried, zero)
        elif kind == "min":
            both = F.least(local, carried)
        else:
            both = F.greatest(local, carried)
        out = out.withColumn(name, both)
    helpers = [p + name for name in columns for p in ("_v_", "_l_", "_c_")]
    return out.drop("_b", *helpers)


def trailing(
    df: DataFrame, keys: list[str], pos: str, width: int, columns: dict[str, Column], block_rows: int = 100_000
) -> DataFrame:
    """Aggregates over the last `width` rows of each key, where `pos` counts 1, 2, ...

    The last `width - 1` rows of a block are handed to the next block as well, so each
    window finds all its rows in one block.
    """
    size = max(block_rows, width)
    at = F.col(pos) - 1
    home = F.floor(at / size)
    cut = df.withColumn("_home", home).withColumn(
        "_b",
        F.explode(
            F.when(F.pmod(at, F.lit(size)) >= size - (width - 1), F.array(F.col("_home"), F.col("_home") + 1))
            .otherwise(F.array(F.col("_home")))
        ),
    )
    w = W.partitionBy(*keys, "_b").orderBy(pos).rowsBetween(-(width - 1), 0)
    for name, agg in columns.items():
        cut = cut.withColumn(name, agg.over(w))
    return cut.filter(F.col("_b") == F.col("_home")).drop("_b", "_home")


def sliding_mean(
    df: DataFrame, keys: list[str], pos: str, width: int, value: str, name: str, block_rows: int = 100_000
) -> DataFrame:
    """Add the mean of the known values among the last `width` rows of each key, where `pos` counts 1, 2, ...

    On which side of a bound a mean falls that is exactly the bound hangs on the order of the additions. Here it
    follows from the positions: the rows before the first whole sixteen (1 to 16, 17 to 32, ...) are added one by
    one, then the sum of each sixteen, then the rows after the last one, as an engine adds that keeps sums of sixteen.
    """
    known = F.collect_list(F.coalesce(F.col(value).cast("double"), F.lit(0.0)))
    rows = trailing(df, keys, pos, width, {"_w": known, "_known": F.count(value)}, block_rows)
    size = F.size("_w")
    lead = F.least(F.pmod(size - F.col(pos), F.lit(16)), size).cast("int")
    wholes = F.floor((size - lead) / 16).cast("int")

    def plus(total: Column, start: Column, n: Column) -> Column:
        return F.aggregate(F.slice("_w", start, n), total, operator.add)

    total = plus(F.lit(0.0), F.lit(1), lead)
    firsts = F.slice(F.array(*[F.lit(16 * i) for i in range(width // 16 + 1)]), F.lit(1), wholes)
    total = F.aggregate(firsts, total, lambda s, at: s + plus(F.lit(0.0), lead + at + 1, F.lit(16)))
    total = plus(total, lead + 16 * wholes + 1, F.lit(15))
    return rows.withColumn(name, F.when(F.col("_known") > 0, total / F.col("_known"))).drop("_w", "_known")


def _nth_by_number(df: DataFrame, key: str, ranks: Callable[[int], list[int]] | list[int]) -> Cuts:
    known = df.select(key).filter(F.col(key).isNotNull())
    n = known.count()
    wanted = [r for r in (ranks(n) if callable(ranks) else ranks) if 1 <= r <= n]
    at = sorted({r + i for r in wanted for i in (0, 1)})
    rows = number_in_order(known, [key], "_rank").filter((F.col("_rank") + 1).isin(at)).collect() if at else []
    found = {r["_rank"] + 1: r[key] for r in rows}
    return Cuts(n, {r: found[r] for r in wanted}, {r for r in wanted if r + 1 in found and found[r + 1] == found[r]})


@dataclass
class Cuts:
    """Row count, the key at each rank, and the ranks that fall inside a run of equal keys."""

    rows: int
    keys: dict
    inside_ties: set[int]


def nth_keys(df: DataFrame, key: str, ranks: Callable[[int], list[int]] | list[int]) -> Cuts:
    """The value of `key` at each rank (1-based); ranks may depend on the row count; NULL keys have no rank.

    Whole numbers go through radix selection: a histogram of at most 65 536 equal-width cells
    narrows the range until the cell holding a rank is small; only then are its keys sorted.
    Keys of any other orderable type are range-sorted alone and numbered.
    """
    if not isinstance(df.schema[key].dataType, T.IntegralType):
        return _nth_by_number(df, key, ranks)
    cells, small = 65_536, 100_000
    lo, hi, n = df.agg(F.min(key), F.max(key), F.count(key)).first()
    wanted = ranks(n) if callable(ranks) else ranks
    todo = {r: (lo, hi, r, n) for r in wanted if 1 <= r <= n}
    out = Cuts(n, {}, set())
    while todo:
        for r, (a, b, k, rows) in list(todo.items()):
            inside = df.filter(F.col(key).between(a, b)).select(key)
            if a == b or rows <= small:
                pair = [a, a][: rows - k + 1] if a == b else [x[0] for x in inside.orderBy(key).offset(k - 1).limit(2).collect()]
                out.keys[r] = pair[0]
                if pair[1:] == pair[:1]:
                    out.inside_ties.add(r)
                del todo[r]
                continue
            width = (b - a) // cells + 1
            exact = "decimal(21, 0)"  # a range of 64-bit keys exceeds BIGINT
            cell = F.expr(f"(CAST(`{key}` AS {exact}) - CAST('{a}' AS {exact})) div CAST('{width}' AS {exact})")
            counts = sorted(map(tuple, inside.groupBy(cell.alias("c")).count().collect()))
            for c, m in counts:
                if k <= m:
                    todo[r] = (a + c * width, min(b, a + (c + 1) * width - 1), k, m)
                    break
                k -= m
    return out
