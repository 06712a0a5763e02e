"""Which rows and which column make up the corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill.functions.text import is_nonblank
from gristmill.operators.blocks import nth_keys

# Text columns in order of preference.
TEXT_COLUMNS = ["text", "content", "story", "sentence"]


class EmptyCorpus(ValueError):
    """Nothing is left after filtering."""


def pick_text_column(schema: T.StructType) -> str:
    names = schema.names
    for name in TEXT_COLUMNS:
        if name in names:
            return name
    return names[0]


def as_corpus(df: DataFrame, key: str, text: str | None = None) -> DataFrame:
    """`(doc_id, text)` from any table; a non-string text column yields no usable rows."""
    text = text or pick_text_column(df.schema)
    is_string = isinstance(df.schema[text].dataType, T.StringType)
    value = F.col(text) if is_string else F.lit(None).cast("string")
    return df.select(F.col(key).alias("doc_id"), value.alias("text"))


def nonblank(df: DataFrame, text: str = "text") -> DataFrame:
    """Keep rows whose text is not blank; the text itself stays untrimmed."""
    return df.filter(is_nonblank(F.col(text)))


def require_rows(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise EmptyCorpus("no usable text is left")
    return df


def cap_rows(df: DataFrame, key: str, cap: int | None = None) -> DataFrame:
    """First `cap` rows by the unique `key`, of any orderable type; 0 and None mean all rows.

    The key at the cap's rank is looked up, so the cap is a plain filter and no task ever
    sorts `cap` rows. A row whose key is NULL has no place in the order and is left out by a cap.
    """
    if not cap:
        return df
    cuts = nth_keys(df, key, [cap])
    if cuts.inside_ties:
        raise ValueError(f"the key {key} is not unique, so the first {cap} rows are not defined")
    return df.filter(F.col(key) <= F.lit(cuts.keys[cap])) if cuts.keys else df


def vocabulary_sample(texts: DataFrame, key: str = "doc_id", size: int | None = None) -> DataFrame:
    """The first `size` texts by key (not a random sample) to learn a vocabulary from; all of them by default."""
    return cap_rows(texts, key, size)
