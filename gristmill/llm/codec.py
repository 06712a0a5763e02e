"""Byte-level BPE encoding and decoding with a local rank file."""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import bounded_batches

# A text longer than this is cut before it is split by the pattern.
PART_CHARS = 8_192

# Right after one of these and right before a space or line feed every match of the pattern ends:
# no alternative has white space anywhere but at its start or alone.
BOUNDARY = re.compile(r"[0-9A-Za-z.,;:!?](?=[ \n])")


@functools.lru_cache(maxsize=4)
def encoding(rank_file: str, pattern: str):
    """The tiktoken encoding of a local rank file, read once per Python process."""
    import tiktoken

    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def parts(text: str, size: int = PART_CHARS) -> Iterator[str]:
    """Cut a long text where a match ends anyway, so the parts encode to the whole text's ids."""
    at = 0
    while len(text) - at > size and (cut := BOUNDARY.search(text, at + size)):
        yield text[at : cut.end()]
        at = cut.end()
    yield text[at:]


def encode_text(enc, text: str) -> list[int]:
    if len(text) <= PART_CHARS:
        return enc.encode_ordinary(text)
    return [i for part in parts(text) for i in enc.encode_ordinary(part)]


def encode(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): the token ids of each whole text; null and empty texts have none.

    Rows stay where they are; each row is encoded on its own, so repeated rows give equal ids.
    """
    bounded_batches(docs.sparkSession)

    def run(batches):
        enc = encoding(rank_file, pattern)
        for batch in batches:
            ids = [encode_text(enc, t) if t else [] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["_id", "ids"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    return rows.mapInArrow(run, "_id bigint, ids array<int>").withColumnRenamed("_id", id_col)


def decode(tokens: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """(id, bytes): the raw bytes of the ids; a token may end inside a character, so this is no string."""
    bounded_batches(tokens.sparkSession)

    def run(batches):
        enc = encoding(rank_file, pattern)
        for batch in batches:
            raw = [enc.decode_bytes(ids) if ids else b"" for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], names=["_id", "bytes"])

    rows = tokens.select(F.col(id_col).cast("bigint").alias("_id"), "ids")
    return rows.mapInArrow(run, "_id bigint, bytes binary").withColumnRenamed("_id", id_col)


def round_trip(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): encode, decode the ids and digest both in one pass."""
    bounded_batches(docs.sparkSession)

    def run(batches):
        enc = encoding(rank_file, pattern)
        for batch in batches:
            counts, ids_sha, raw_sha = [], [], []
            for text in batch.column(1).to_pylist():
                ids = encode_text(enc, text) if text else []
                counts.append(len(ids))
                ids_sha.append(hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest())
                raw_sha.append(hashlib.sha256(enc.decode_bytes(ids) if ids else b"").hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(raw_sha, pa.string())],
                names=["_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    schema = "_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(run, schema).withColumnRenamed("_id", id_col)
