"""Exact dedup: 128-bit content hash, smallest (or largest) stable id, bytes compared inside groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import fresh, whole_text


def exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min") -> DataFrame:
    """One row per row of `docs`: id, keep_id, group_size, kept, text_sha256.

    Groups are formed by the 128-bit hash and, inside it, by the bytes of the text: the hash spreads
    the rows, the aggregation key holds the text itself, so two texts that share a hash stay apart.
    Copies collapse before the shuffle to one row per task, whatever share of the table they hold.
    Each row then finds its group by two digests; no text is shuffled for that, and adaptive
    execution splits the rows of a hot group.

    Null text counts as empty, and all empty texts are one group. A null id is never kept while its
    group has another id. Rows that repeat an id with the same text come back as often as they came,
    and group_size counts them. Further columns of `docs`, whatever their names, are not read.
    """
    text = whole_text(text_col)
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("_text"))
    digest = [F.unhex(F.md5("_text")).alias("_hash"), F.sha2(F.col("_text").cast("binary"), 256).alias("_sha")]
    best = F.min("_id") if keep == "min" else F.max("_id")
    groups = (
        rows.groupBy(F.unhex(F.md5("_text")).alias("_hash"), "_text")
        .agg(best.alias("_keep"), F.count(F.lit(1)).alias("_size"))
        .select("_hash", F.sha2(F.col("_text").cast("binary"), 256).alias("_sha"), "_keep", "_size")
    )
    return (
        rows.select("_id", *digest)
        .join(groups, ["_hash", "_sha"])
        .select(
            F.col("_id").alias(id_col), F.col("_keep").alias("keep_id"), F.col("_size").alias("group_size"),
            F.col("_id").eqNullSafe(F.col("_keep")).alias("kept"), F.col("_sha").alias("text_sha256"),
        )
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min") -> DataFrame:
    """The rows of `docs` that stay, with all their columns.

    Of rows that repeat an id with its text the one whose JSON form is least stays.
    """
    names = docs.columns
    keys = docs.select(id_col).agg(F.count(F.lit(1)), F.count_distinct(id_col)).first()
    kept_id, kept_sha, text, row = (fresh(names, n) for n in ("__kept_id__", "__kept_sha__", "__text__", "__row__"))
    stays = (
        exact_copies(docs, id_col, text_col, keep).filter("kept")
        .select(F.col(id_col).alias(kept_id), F.col("text_sha256").alias(kept_sha)).distinct()
    )
    found = docs.join(
        stays,
        F.col(id_col).eqNullSafe(F.col(kept_id)) & (F.sha2(whole_text(text_col).cast("binary"), 256) == F.col(kept_sha)),
        "left_semi",
    ).select(*names)
    if keys[0] == keys[1]:
        return found
    whole = F.struct(*names)
    one = found.groupBy(F.col(id_col).alias(kept_id), whole_text(text_col).alias(text)).agg(F.min_by(whole, F.to_json(whole)).alias(row))
    return one.select(f"{row}.*")
