"""Word and symbol-pair frequencies of a corpus."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill.functions.text import pretokens


def word_table(docs: DataFrame, words: Column | None = None, key: str = "doc_id") -> DataFrame:
    """`(word, freq, first)`: how often and where first (document key, index) a word occurs.

    Counting happens before the shuffle, so a word that makes up much of the corpus still
    reaches its reducer as one row per task. A whole-number key and the index are packed into one
    number, which a hash aggregate can keep the least of: a long where the keys span less than 2^32,
    else a decimal. Other keys are sorted.
    """
    words = pretokens(F.col("text")) if words is None else words
    found = docs.select(F.col(key).alias("_doc"), F.posexplode(words).alias("_pos", "word")).groupBy("word")
    kind = docs.schema[key].dataType
    freq = F.count(F.lit(1)).alias("freq")
    if not isinstance(kind, T.IntegralType):
        return found.agg(freq, F.min(F.struct("_doc", "_pos")).alias("first"))
    lo, hi = docs.agg(F.min(key), F.max(key)).first()
    if lo is not None and hi - lo < 1 << 32:
        above = F.shiftleft(F.col("_doc").cast("bigint") - F.lit(lo).cast("bigint"), 31)
        doc = F.shiftrightunsigned("_f", 31) + F.lit(lo).cast("bigint")
        pos = F.col("_f").bitwiseAND(F.lit((1 << 31) - 1).cast("bigint"))
        first = F.struct(doc.cast(kind).alias("_doc"), pos.cast("int").alias("_pos")).alias("first")
        return found.agg(freq, F.min(above + F.col("_pos")).alias("_f")).select("word", "freq", first)
    lowest, width = F.lit(Decimal(1 << 63)), F.lit(Decimal(1 << 31))
    packed = ((F.col("_doc").cast("decimal(20, 0)") + lowest) * width + F.col("_pos").cast("decimal(10, 0)")).cast("decimal(38, 0)")
    pos = F.col("_f") % width
    doc = ((F.col("_f") - pos) / width).cast("decimal(21, 0)") - lowest
    first = F.struct(doc.cast("bigint").cast(kind).alias("_doc"), pos.cast("int").alias("_pos")).alias("first")
    return found.agg(freq, F.min(packed).alias("_f")).select("word", "freq", first)


def symbol_pairs(words: DataFrame, *carry: str) -> DataFrame:
    """One row per adjacent symbol pair: the carried columns, `at` and the two-symbol `pair`."""
    chars = words.select(*carry, F.split("symbols", "").alias("_c"))
    rest = F.size("_c") - 1
    zipped = F.arrays_zip(F.slice("_c", 1, rest).alias("l"), F.slice("_c", 2, rest).alias("r"))
    return chars.select(*carry, F.posexplode(zipped).alias("at", "_p")).select(
        *carry, "at", F.concat("_p.l", "_p.r").alias("pair")
    )


def pair_table(words: DataFrame, *more: Column) -> DataFrame:
    """`(pair, freq, first)` over `(symbols, freq, place)`; words of one symbol give no rows.

    `first` packs the place of the earliest word having the pair and the index in it, so
    the aggregate keeps two longs per pair. `more` are further aggregates.
    """
    at_bits = 25
    at = F.when(F.col("at") < 1 << at_bits, F.col("at")).otherwise(
        F.raise_error(F.lit("a word is too long to number its symbols")).cast("int")
    )
    return symbol_pairs(words, "freq", "place").groupBy("pair").agg(
        F.sum("freq").alias("freq"), F.min(F.shiftleft("place", at_bits) + at).alias("first"), *more
    )


def vocabulary_size(vocab: DataFrame, id_col: str = "id") -> DataFrame:
    """One row: the size by the largest id and by the number of ids; they differ where ids are missing. None gives 0."""
    return vocab.agg(F.coalesce(F.max(id_col) + 1, F.lit(0)).alias("by_id"), F.count_distinct(id_col).alias("by_count"))


def top_pairs(pairs: DataFrame, n: int, ties: str = "first") -> DataFrame:
    """The `n` most frequent pairs; ties by first occurrence, or by symbol order."""
    return pairs.orderBy(F.desc("freq"), ties).limit(n)
