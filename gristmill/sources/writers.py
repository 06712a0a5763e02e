"""Writers for model-input records, meta rows, vocabularies and ledgers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.functions.arrays import Layout
from gristmill.operators.bpe import Rules
from gristmill.session import cut_lineage, qualified
from gristmill.sources.fixed_width import TokenRecords

SPLITS = ("train", "val", "test")


def write_records(df: DataFrame, path: str) -> None:
    """`(…, split, input_ids)` as Parquet with one folder per split."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def write_token_records(df: DataFrame, path: str, length: int, order: str | None = None) -> None:
    """Fixed-width int32 files; with `order`, file order and row order follow that column."""
    df.sparkSession.dataSource.register(TokenRecords)
    rows = df if order is None else df.repartitionByRange(order).sortWithinPartitions(order)
    out = rows.select(F.lit(0).cast("bigint").alias("record_no"), F.col("input_ids").cast("array<int>"))
    out.write.format("token_records").option("length", length).mode("overwrite").save(qualified(df.sparkSession, path))


def write_split_files(df: DataFrame, path: str, length: int, order: str | None = None) -> None:
    """One fixed-width folder per split, below `path`."""
    rows = cut_lineage(df)  # encoded once, not once a split
    for split in SPLITS:
        write_token_records(rows.filter(F.col("split") == split), f"{path}/{split}", length, order)


def dataset_meta(records: DataFrame, vocab_size: int, length: int, layout: Layout) -> DataFrame:
    """One row: vocabulary size, record length, rows per split, special ids."""
    n = {s: F.count_if(F.col("split") == s).alias(f"{s}_samples") for s in SPLITS}
    return records.agg(*n.values()).select(
        F.lit(vocab_size).alias("vocab_size"), F.lit(length).alias("max_seq_length"),
        *[f"{s}_samples" for s in SPLITS],
        F.lit(layout.pad).alias("pad_token_id"), F.lit(layout.bos).alias("bos_token_id"),
        F.lit(layout.eos).alias("eos_token_id"), F.lit(layout.unk).alias("unk_token_id"),
    )


def write_meta(meta: DataFrame, path: str) -> None:
    meta.write.mode("overwrite").json(path)


def write_documents(df: DataFrame, path: str, per_file: int = 100_000) -> None:
    """One JSON document a line. The files are compressed, and as such a file is read in one piece, they are kept small."""
    df.write.option("compression", "lz4").option("maxRecordsPerFile", per_file).json(path)


def append_records(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Append to a shared ledger table; nothing already there is rewritten."""
    writer = df.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_rules(rules: Rules, spark, path: str) -> None:
    rules.vocab_df(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/vocab")
    rules.merges_df(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/merges")


def tokenizer_json(vocab: DataFrame, merges: DataFrame, special_tokens: DataFrame) -> DataFrame:
    """One row `value`: the saved tokenizer of `(id, token)`, `(left, right, id)` and `(token, id)`.

    One object holds the whole vocabulary, which its requested size bounds.
    """
    b64 = lambda c: F.translate(F.base64(c), "\r\n", "")
    entries = lambda df, k, v: df.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(k, v)))).alias("m"))
    parts = {
        "vocab": entries(vocab, F.col("id").cast("string").alias("k"), b64("token").alias("v")),
        "merges": entries(merges, F.concat_ws("|", b64("left"), b64("right")).alias("k"), F.col("id").alias("v")),
        "special_tokens": entries(special_tokens, F.col("token").alias("k"), F.col("id").alias("v")),
    }
    one = vocab.agg(F.count(F.lit(1)).cast("int").alias("vocab_size"))
    for name, part in parts.items():
        one = one.withColumn("_1", F.lit(1)).join(part.select(F.lit(1).alias("_1"), F.col("m").alias(name)), "_1").drop("_1")
    return one.select(F.to_json(F.struct("vocab_size", *parts)).alias("value"))


def write_tokenizer_json(vocab: DataFrame, merges: DataFrame, special_tokens: DataFrame, path: str) -> None:
    tokenizer_json(vocab, merges, special_tokens).coalesce(1).write.mode("overwrite").text(path)


def merges_tsv_lines(merges: DataFrame) -> DataFrame:
    """`left_id<TAB>right_id<TAB>id` lines in the order of `priority`."""
    return merges.orderBy("priority").select(F.concat_ws("\t", *[F.col(c).cast("string") for c in ("left_id", "right_id", "id")]).alias("value"))


def vocab_tsv_lines(vocab: DataFrame) -> DataFrame:
    """`token<TAB>id` lines in id order."""
    return vocab.orderBy("id").select(F.concat_ws("\t", "token", F.col("id").cast("string")).alias("value"))
