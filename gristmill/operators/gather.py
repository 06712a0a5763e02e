"""Ordered concatenation of many pieces into one text per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _joined(order: str, text: str, sep: str) -> Column:
    rows = F.array_sort(F.collect_list(F.struct(order, text)))
    return F.array_join(F.transform(rows, lambda r: r[text]), sep)


def concat_in_order(
    df: DataFrame, keys: list[str], order: str, text: str, sep: str = "", out: str = "text",
    block: int = 10_000, extra: dict[str, Column] | None = None,
) -> DataFrame:
    """Per key: the pieces joined in the order of a unique BIGINT, plus extra aggregates.

    Pieces are first joined within blocks of the order, so no task sorts a whole key; the
    last step only strings the blocks together. `extra` aggregates are summed.
    """
    extra = extra or {}
    parts = df.groupBy(*keys, F.floor(F.col(order) / block).alias("_b")).agg(
        _joined(order, text, sep).alias("_t"), *[a.alias(n) for n, a in extra.items()]
    )
    return parts.groupBy(*keys).agg(
        _joined("_b", "_t", sep).alias(out), *[F.sum(n).alias(n) for n in extra]
    )
