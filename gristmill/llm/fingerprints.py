"""Document fingerprints: bottom-k sketches of word shingle hashes.

A sketch holds the k least distinct hashes, in order. Sketches of parts merge into the sketch of the
whole. From two sketches follow resemblance and containment, from one the number of shingles; while a
set has fewer than k members, all three are exact. Everything here is column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gristmill.llm.common import shuffle_partitions, whole_text

SIZE = 128
WIDTH = 5
_LEAST = -(1 << 63)


def sketch(text: Column, width: int = WIDTH, k: int = SIZE) -> Column:
    """The k least distinct hashes of the `width`-word shingles, as a sorted array<bigint>.

    Words are divided by white space; fewer words than `width` make one shingle, none an empty sketch.
    """
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    rolled = lambda h: F.transform(
        F.sequence(F.lit(0), F.size(h) - width), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(width)])
    )
    shingles = F.transform(
        F.array(hashes),
        lambda h: F.when(F.size(h) >= width, rolled(h)).when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(
            F.array().cast("array<bigint>")
        ),
    )
    return F.slice(F.sort_array(F.array_distinct(F.get(shingles, F.lit(0)))), 1, k)


def merged(a: Column, b: Column, k: int = SIZE) -> Column:
    """The sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = SIZE) -> Column:
    """Estimated share of common shingles among all of both; two empty sets are alike."""
    union = merged(a, b, k)
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(
        F.size(F.array_intersect(F.array_intersect(union, a), b)).cast("double") / F.greatest(F.size(union), F.lit(1))
    )


def distinct_shingles(a: Column, k: int = SIZE) -> Column:
    """Estimated number of distinct shingles."""
    spread = (F.element_at(a, k).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / spread)


def containment(a: Column, b: Column, k: int = SIZE) -> Column:
    """Estimated share of a's shingles that b has too; an empty set is in every set."""
    both = resemblance(a, b, k) * distinct_shingles(merged(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), both / distinct_shingles(a, k)))


def merged_over(sketches: DataFrame, keys: list[str], column: str = "sketch", k: int = SIZE) -> DataFrame:
    """The sketch of all rows of each key together; a key's hashes meet only k at a time."""
    hashes = sketches.select(*keys, F.explode(column).alias("_h")).distinct()
    rank = F.row_number().over(W.partitionBy(*keys).orderBy("_h"))
    return (
        hashes.withColumn("_rank", rank).filter(F.col("_rank") <= k)
        .groupBy(*keys).agg(F.sort_array(F.collect_list("_h")).alias(column))
    )


def printed(a: Column) -> Column:
    """A sketch as text: 16 hexadecimal digits for each hash."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def _beside_next(rows: DataFrame) -> DataFrame:
    """(_id, _text, _next): each text and that of the next row in the order of (id, text), after the last the first.

    Rows are dealt by ranges of the id, so the order needs one shuffle of the texts; the first row of
    a range also goes to the range before. The ranges' borders and first ids are as many values as
    there are shuffle partitions.
    """
    buckets = shuffle_partitions(rows.sparkSession)
    keyed = rows.withColumn("_key", F.coalesce("_id", F.lit(_LEAST)))
    shares = [i / buckets for i in range(1, buckets)]
    cuts = (keyed.agg(F.percentile_approx("_key", shares).alias("c")).first()["c"] or []) if shares else []
    borders = F.array(*[F.lit(c) for c in sorted(set(cuts))]).cast("array<bigint>")
    placed = keyed.withColumn("_bucket", F.size(F.filter(borders, lambda c: c <= F.col("_key"))))
    firsts = sorted(placed.groupBy("_bucket").agg(F.min("_key")).collect())
    here = F.struct(F.col("_bucket").alias("bucket"), F.lit(0).alias("wrap"), F.lit(False).alias("copy"))
    targets = F.array(here)
    if firsts:
        before = [firsts[-1], *firsts[:-1]]
        links = [(key, previous, int(i == 0)) for i, ((_, key), (previous, _)) in enumerate(zip(firsts, before))]
        of = lambda column: F.element_at(F.create_map(*[F.lit(x) for k, *v in links for x in (k, v[column])]), F.col("_key"))
        copy = F.struct(of(0).alias("bucket"), of(1).alias("wrap"), F.lit(True).alias("copy"))
        targets = F.when(F.col("_key").isin([k for k, *_ in links]), F.array(here, copy)).otherwise(targets)
    spread = placed.select("_id", "_text", "_key", F.inline(F.transform(targets, lambda t: t)).alias("_b", "_wrap", "_copy"))
    return spread.repartition(buckets, "_b")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, k: int = SIZE) -> DataFrame:
    """Fingerprints of each text and of its edited form, and how alike they are.

    The edited text has the last floor(n / 2) code points replaced by the first as many (or all) of
    the next document's, ids ascending, nulls first, then by text; the last document is followed by
    the first. One row per row of `docs`, repeated rows included: id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next, n_shingles (estimated). Null text counts as empty.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("_id"), whole_text(text_col).alias("_text"))
    order = W.partitionBy("_b").orderBy("_wrap", "_key", "_text")
    pairs = (
        _beside_next(rows).withColumn("_sketch", sketch(F.col("_text"), width, k))
        .select("_id", "_text", "_copy", "_sketch", F.lead("_text").over(order).alias("_next"), F.lead("_sketch").over(order).alias("_next_sketch"))
        .filter(~F.col("_copy"))
    )
    n = F.char_length("_text")
    half = F.floor(n / 2).cast("int")
    edited = (
        pairs.withColumn("_n", n.cast("bigint"))
        .withColumn("_edited", F.concat(F.substring("_text", F.lit(1), n - half), F.substring("_next", F.lit(1), half)))
        .withColumn("_edited_sketch", sketch(F.col("_edited"), width, k))
    )
    return edited.select(
        F.col("_id").alias(id_col), F.col("_n").alias("n_chars"), F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"),
        printed(F.col("_sketch")).alias("fingerprint"), printed(F.col("_edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("_sketch"), F.col("_edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("_sketch"), F.col("_next_sketch"), k).alias("near_next"),
        distinct_shingles(F.col("_sketch"), k).alias("n_shingles"),
    )
