"""Candidate filters over `(seq_id, token_id, logit)`.

A sequence has at most one row per vocabulary entry, so a window per sequence is bounded by
the vocabulary size and needs no blocks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def softmax(scored: DataFrame, temperature: float = 1.0) -> DataFrame:
    """Add `prob`, the share of each candidate at the given temperature."""
    seq = W.partitionBy("seq_id")
    x = F.col("logit") / temperature
    weighed = scored.withColumn("_w", F.exp(x - F.max(x).over(seq)))
    return weighed.withColumn("prob", F.col("_w") / F.sum("_w").over(seq)).drop("_w")


def top_k(scored: DataFrame, k: int) -> DataFrame:
    """The `k` highest logits per sequence; ties with the k-th stay."""
    rank = F.rank().over(W.partitionBy("seq_id").orderBy(F.desc("logit")))
    return scored.withColumn("_r", rank).filter(F.col("_r") <= k).drop("_r")


def top_p(scored: DataFrame, p: float) -> DataFrame:
    """Keep candidates while the probability before them is at most `p`; needs `prob`."""
    ahead = W.partitionBy("seq_id").orderBy(F.desc("prob"), "token_id").rowsBetween(W.unboundedPreceding, -1)
    return (
        scored.withColumn("_before", F.coalesce(F.sum("prob").over(ahead), F.lit(0.0)))
        .filter(F.col("_before") <= p).drop("_before")
    )


def draw(scored: DataFrame, seed: int = 42) -> DataFrame:
    """One candidate per sequence, drawn by `prob` with reproducible Gumbel noise."""
    digits = F.substring(F.sha2(F.concat_ws(":", F.lit(str(seed)), "seq_id", "token_id"), 256), 1, 13)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(2**52)
    keyed = scored.filter(F.col("prob") > 0).withColumn("_g", F.ln("prob") - F.ln(-F.ln(u)))
    return keyed.groupBy("seq_id").agg(F.max(F.struct(F.col("_g"), -F.col("token_id"))).alias("_best")).select(
        "seq_id", (-F.col("_best.col2")).alias("token_id")
    )


def greedy(scored: DataFrame) -> DataFrame:
    """The highest logit of each sequence; the lowest token id on ties."""
    best = F.max(F.struct(F.col("logit").alias("logit"), (-F.col("token_id")).alias("neg")))
    return scored.groupBy("seq_id").agg(best.alias("_b")).select("seq_id", (-F.col("_b.neg")).alias("token_id"))
