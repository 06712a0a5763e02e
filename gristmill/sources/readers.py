"""Corpora, vocabularies, merge rules, ledgers and file listings as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill.session import qualified, spread
from gristmill.sources.fixed_width import TokenRecords


def read_corpus(
    spark: SparkSession, path: str, format: str = "parquet", schema=None, columns: list[str] | None = None, **options
) -> DataFrame:
    """A corpus in any of Spark's file formats; plain text is one document per line.

    `columns` are selected first, so only they are read and, for a small input, spread out.
    """
    reader = spark.read.format(format).options(**options)
    rows = (reader.schema(schema) if schema else reader).load(path)
    return spread(rows.select(*columns) if columns else rows)


def read_token_records(spark: SparkSession, path: str, length: int) -> DataFrame:
    """`(record_no, input_ids)` of fixed-width int32 files; a partial last record is an error."""
    spark.dataSource.register(TokenRecords)
    return spark.read.format("token_records").option("length", length).load(qualified(spark, path))


def synthetic_records(spark: SparkSession, records: int, length: int, vocab_size: int, seed: int = 42) -> DataFrame:
    return random_records(spark.range(records), "id", length, vocab_size, seed)


def random_records(rows: DataFrame, key: str, length: int, vocab_size: int, seed: int = 42) -> DataFrame:
    """`(key, input_ids)` with reproducible ids in [0, vocab_size) for each row of a table."""
    ids = F.transform(
        F.sequence(F.lit(1), F.lit(length)),
        lambda x: F.pmod(F.xxhash64(F.col(key), x, F.lit(seed)), F.lit(vocab_size)).cast("int"),
    )
    return rows.select(key, ids.alias("input_ids"))


def _numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a vocabulary file with a number that grows in file order; several files have no order among them."""
    return spark.read.text(path).withColumn("line_no", F.monotonically_increasing_id())


def parse_vocab_lines(lines: DataFrame) -> DataFrame:
    """`(token, id)` from `token<TAB>id` lines, split at the first tab; the last line of a token wins."""
    at = F.instr("value", "\t")
    rows = lines.filter(at > 0).select(
        F.substring(F.col("value"), F.lit(1), at - 1).alias("token"),
        F.regexp_extract(F.substring(F.col("value"), at + 1, F.length("value")), r"^\s*([+-]?\d+)", 1)
        .try_cast("int").alias("id"),
        "line_no",
    )
    return rows.groupBy("token").agg(F.max_by("id", "line_no").alias("id"))


def read_vocab_tsv(spark: SparkSession, path: str) -> DataFrame:
    return parse_vocab_lines(_numbered_lines(spark, path))


def read_vocab_json(spark: SparkSession, path: str) -> DataFrame:
    """`(id, token BINARY)` of a JSON object `id -> base64`."""
    one = spark.read.text(path, wholetext=True).select(
        F.explode(F.from_json("value", "map<string,string>")).alias("id", "b64")
    )
    return one.select(F.col("id").cast("int").alias("id"), F.unbase64("b64").alias("token"))


MERGE_LINE = r"^\s*([+-]?\d+)\s+([+-]?\d+)\s+([+-]?\d+)"


def parse_merge_lines(lines: DataFrame, block: Column | None = None) -> DataFrame:
    """`(left_id, right_id, id, priority)`; priority counts only lines that parse, so none with a number beyond INT.

    A later rule for the same pair replaces the earlier one.
    """
    from gristmill.operators.blocks import positions

    good = lines.filter(F.col("value").rlike(MERGE_LINE)).select(
        *[F.regexp_extract("value", MERGE_LINE, i).try_cast("int").alias(n) for i, n in ((1, "left_id"), (2, "right_id"), (3, "id"))],
        "line_no",
    ).dropna(subset=["left_id", "right_id", "id"])
    block = F.shiftrightunsigned("line_no", 16) if block is None else block
    placed = positions(good, [], ["line_no"], block, "_p").withColumn("priority", F.col("_p") - 1)
    last = F.max(F.struct("priority", "id"))
    return placed.groupBy("left_id", "right_id").agg(last.alias("_l")).select("left_id", "right_id", "_l.id", "_l.priority")


def read_merges_tsv(spark: SparkSession, path: str) -> DataFrame:
    return parse_merge_lines(_numbered_lines(spark, path))


def read_merges_json(spark: SparkSession, path: str) -> DataFrame:
    """`(left, right, id)` of a JSON object `base64(left)|base64(right) -> id`."""
    one = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,int>")).alias("k", "id"))
    parts = F.split("k", r"\|")
    return one.select(F.unbase64(F.get(parts, F.lit(0))).alias("left"), F.unbase64(F.get(parts, F.lit(1))).alias("right"), "id")


def read_rules(spark: SparkSession, path: str, layout):
    """The byte-level merge rules that `write_rules` left; bounded by the vocabulary size."""
    from gristmill.operators.bpe import Merge, Rules

    rows = spark.read.parquet(f"{path}/merges").orderBy("rank").collect()
    merges = [Merge(bytes(r["left"]), bytes(r["right"]), r["id"], r["freq"]) for r in rows]
    return Rules(layout, merges, [bytes([b]) for b in range(256)])


# The saved tokenizer is one JSON object; bytes are base64, a merge's key is `left|right`. Fixed values.
TOKENIZER_FILE = "vocab_size int, vocab map<string,string>, merges map<string,int>, special_tokens map<string,int>"


def read_tokenizer_json(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables of a saved tokenizer: vocab `(id, token)`, merges `(left, right, id)`, special_tokens `(token, id)`.

    The file is bounded by its vocabulary; a field that is absent gives no rows.
    """
    text = spark.read.text(path, wholetext=True)
    one = text.select(F.from_json("value", TOKENIZER_FILE).alias("_t")).select("_t.*")
    vocab = one.select(F.explode("vocab").alias("id", "b64"))
    merges = one.select(F.explode("merges").alias("k", "id"))
    side = lambda i: F.unbase64(F.get(F.split("k", r"\|"), F.lit(i)))
    return {
        "vocab": vocab.select(F.col("id").try_cast("int").alias("id"), F.unbase64("b64").alias("token")),
        "merges": merges.select(side(0).alias("left"), side(1).alias("right"), "id"),
        "special_tokens": one.select(F.explode("special_tokens").alias("token", "id")),
    }


# Record schemas of the ledgers, one JSON document per run, tenant or corpus.
SPEND = "timestamp string, dataset string, gpu_type string, duration_hours double, cost_usd double, steps_trained bigint, phase string"
SCHEDULE = (
    "dataset string, config_path string, max_steps bigint, scheduled_date string, status string, started_at string, "
    "completed_at string, result_path string, error_message string"
)
LINEAGE = (
    "dataset_name string, dataset_hash string, start_timestamp string, end_timestamp string, initial_val_loss double, "
    "final_val_loss double, best_val_loss double, total_steps bigint, model_path string"
)
RUN_CONFIG = (
    "model_architecture:string,model_params_millions:double,vocab_size:bigint,d_model:bigint,n_layers:bigint,n_heads:bigint,"
    "max_seq_len:bigint,batch_size:bigint,gradient_accumulation:bigint,learning_rate:double,weight_decay:double,"
    "warmup_steps:bigint,max_steps:bigint,dataset:string,mixed_precision:boolean"
)
RUN_METRICS = (
    "final_loss:double,best_loss:double,initial_loss:double,loss_improvement:double,final_perplexity:double,best_perplexity:double,"
    "final_lr:double,peak_lr:double,avg_grad_norm:double,max_grad_norm:double,gradient_overflow_count:bigint,steps_completed:bigint,"
    "epochs_completed:double,tokens_processed:bigint,avg_step_time_ms:double,tokens_per_second:double,samples_per_second:double,"
    "checkpoints_saved:bigint,best_checkpoint_step:bigint,loss_history:array<double>,lr_history:array<double>,"
    "perplexity_history:array<double>,step_times:array<double>"
)
RUN_RESOURCES = (
    "gpu_type:string,gpu_memory_gb:double,peak_gpu_memory_gb:double,gpu_utilization_pct:double,cpu_memory_gb:double,disk_usage_gb:double"
)
RUN_COST = "estimated_cost:double,actual_cost:double,cost_per_step:double,cost_per_token:double,gpu_hours:double,gpu_type:string"
RUN = (
    "run_id string, run_name string, phase string, status string, error_message string, error_traceback string, "
    "started_at string, completed_at string, duration_seconds double, duration_hours double, "
    f"config struct<{RUN_CONFIG}>, metrics struct<{RUN_METRICS}>, resources struct<{RUN_RESOURCES}>, cost struct<{RUN_COST}>, "
    "checkpoint_path string, best_checkpoint_path string, tokenizer_path string, log_path string, tags array<string>, notes string"
)
LEDGERS: dict[str, str] = {
    "preprocessing_state": (
        "dataset_name string, dataset_hash string, split_ratios struct<train:double,validation:double,test:double>, "
        "max_seq_length int, vocab_size int, tokenizer_trained boolean, tokenizer_hash string, data_tokenized boolean, "
        "train_samples bigint, val_samples bigint, test_samples bigint, completed boolean"
    ),
    "spend": f"tenant string, monthly_budget double, safety_margin double, history array<struct<{SPEND}>>",
    "schedule": f"tenant string, runs array<struct<{SCHEDULE}>>",
    "lineage": f"tenant string, training_history array<struct<{LINEAGE}>>, current_dataset string, latest_model_path string, total_datasets_trained int",
    "progressive": "tenant string, completed_phases array<string>, current_phase string",
    "training_history": f"history array<struct<{RUN}>>",
    "run_result": RUN,
    "session": f"session_id string, session_name string, status string, runs array<struct<{RUN}>>",
    "versions": "model string, versions array<int>",
}
NESTED = {
    "spend": "history", "schedule": "runs", "lineage": "training_history", "progressive": "completed_phases",
    "training_history": "history", "session": "runs", "versions": "versions",
}


def read_ledger(spark: SparkSession, path: str, kind: str, multiline: bool = True) -> DataFrame:
    """Well-formed documents of one ledger kind; malformed ones are left out.

    One document per file, or one per line when `multiline` is off.
    """
    schema = T.StructType.fromDDL(LEDGERS[kind]).add("_corrupt_record", "string")
    text = spark.read.option("recursiveFileLookup", True).text(path, wholetext=multiline)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    docs = text.select(F.from_json("value", schema, options).alias("_d")).filter(F.col("_d").isNotNull()).select("_d.*")
    return docs.filter(F.col("_corrupt_record").isNull()).drop("_corrupt_record")


def ledger_records(docs: DataFrame, kind: str) -> DataFrame:
    """One row per record of a nested ledger, with the document's own fields beside it."""
    nested = NESTED[kind]
    outer = [c for c in docs.columns if c != nested]
    rows = docs.select(*outer, F.explode(nested).alias("record"))
    is_struct = isinstance(rows.schema["record"].dataType, T.StructType)
    if not is_struct:
        return rows
    inner = [F.col(f"record.{f}").alias(f if f not in outer else f"record_{f}") for f in rows.schema["record"].dataType.names]
    return rows.select(*outer, *inner)


def list_files(spark: SparkSession, root: str, pattern: str = "*.pt") -> DataFrame:
    """`(path, modificationTime, length)` below a folder; the contents are not read."""
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(root)
        .select("path", "modificationTime", "length")
    )
