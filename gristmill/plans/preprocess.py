"""The whole way from a table to split, fixed-length records."""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions.arrays import BYTES_FIRST, Layout, pad_to
from gristmill.operators.bpe import Rules, train_bpe
from gristmill.operators.corpus import as_corpus, cap_rows, nonblank, require_rows, vocabulary_sample
from gristmill.operators.encode import encode_texts
from gristmill.operators.split import SEED, SPLIT_VERSION, ratio_split
from gristmill.operators.words import word_table
from gristmill.sources.readers import read_rules
from gristmill.sources.writers import dataset_meta, write_meta, write_records, write_rules


def usable_texts(source: DataFrame, key: str, text: str | None = None, cap: int | None = None) -> DataFrame:
    """Cap first, then drop blank texts, so fewer than `cap` may be left."""
    return require_rows(nonblank(as_corpus(cap_rows(source, key, cap), key, text)))


def learn_vocabulary(texts: DataFrame, vocab_size: int, layout: Layout = BYTES_FIRST, sample: int | None = None) -> Rules:
    """Merge rules from the words of all texts, or of the first `sample` by key."""
    return train_bpe(word_table(vocabulary_sample(texts, size=sample)), vocab_size, layout)


def model_records(texts: DataFrame, rules: Rules, length: int, train: float = 0.9, validation: float = 0.05) -> DataFrame:
    """`(doc_id, split, input_ids)`: encoding and splitting are both narrow projections."""
    split = ratio_split(texts, "doc_id", train, validation)
    encoded = encode_texts(split, rules, most=length)
    return encoded.select("doc_id", "split", pad_to(F.col("ids"), length, rules.layout).alias("input_ids"))


STATE = "fingerprint string, tokenizer_trained boolean, data_tokenized boolean, completed boolean"


def read_state(spark: SparkSession, out: str) -> dict:
    """The state that the last run left below `out`; all false before the first."""
    try:
        row = spark.read.schema(STATE).json(f"{out}/state").first()
    except AnalysisException:
        row = None
    return row.asDict() if row else {"fingerprint": None, "tokenizer_trained": False, "data_tokenized": False, "completed": False}


def _write_state(spark: SparkSession, out: str, **state) -> None:
    spark.createDataFrame([tuple(state[c.split()[0]] for c in STATE.split(", "))], STATE).coalesce(1).write.mode("overwrite").json(f"{out}/state")


def preprocess(
    source: DataFrame, key: str, out: str, vocab_size: int, length: int, cap: int | None = None,
    layout: Layout = BYTES_FIRST, train: float = 0.9, validation: float = 0.05, name: str = "corpus",
) -> str:
    """Learn a vocabulary, write records, meta and rules below `out`; finished steps are not done again.

    A run with the same name, rows, texts, ratios, length, vocabulary size and layout as the one that
    left the outputs writes nothing; after a broken run it goes on with the first unfinished step.
    """
    spark = source.sparkSession
    texts = usable_texts(source, key, cap=cap)
    rows, content = texts.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("doc_id", "text"))).first()
    asked = f"{name}_{content}_{train}_{validation}_{length}_{vocab_size}_{rows}_{SEED}_{SPLIT_VERSION}_{layout.first_byte}"
    mark = hashlib.sha256(asked.encode()).hexdigest()[:16]
    state = read_state(spark, out)
    if state["fingerprint"] != mark:
        state = {"fingerprint": mark, "tokenizer_trained": False, "data_tokenized": False, "completed": False}
    if state["completed"]:
        return out
    if state["tokenizer_trained"]:
        rules = read_rules(spark, f"{out}/rules", layout)
    else:
        rules = learn_vocabulary(texts, vocab_size, layout)
        write_rules(rules, spark, f"{out}/rules")
        state["tokenizer_trained"] = True
        _write_state(spark, out, **state)
    if not state["data_tokenized"]:
        write_records(model_records(texts, rules, length, train, validation), f"{out}/records")
        state["data_tokenized"] = True
        _write_state(spark, out, **state)
    written = spark.read.parquet(f"{out}/records")
    write_meta(dataset_meta(written, len(rules.vocabulary()), length, layout), f"{out}/meta")
    _write_state(spark, out, **state | {"completed": True})
    return out
