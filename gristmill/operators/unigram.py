"""Unigram vocabulary: EM over the word table, expected counts summed by Spark."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions.arrays import SPECIALS_FIRST, Layout
from gristmill.operators.blocks import nth_keys
from gristmill.session import cut_lineage, scratch, spread

LONGEST_PIECE = 16
SEED_PIECES = 100_000
KEEP_SHARE = 0.75
LEAST_COUNT = 0.5
ARCS = "chars int, freq bigint, ids array<int>, spans array<int>"


def substring_counts(words: DataFrame, longest: int = LONGEST_PIECE) -> DataFrame:
    """`(piece, freq)` of every substring of up to `longest` characters."""
    n = F.length("word")
    starts = words.select("word", "freq", F.explode(F.sequence(F.lit(1), n)).alias("s"))
    ends = starts.select(
        "freq", "word", "s",
        F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), F.length("word") - F.col("s") + 1))).alias("n"),
    )
    return ends.groupBy(F.substring("word", F.col("s"), F.col("n")).alias("piece")).agg(F.sum("freq").alias("freq"))


def seed_pieces(words: DataFrame, size: int, longest: int = LONGEST_PIECE) -> DataFrame:
    """All single characters and the `size` repeated substrings with the highest freq x length, ties by piece."""
    counted = cut_lineage(
        substring_counts(words, longest).filter((F.length("piece") == 1) | (F.col("freq") > 1))
        .withColumn("score", F.col("freq") * F.length("piece"))
    )
    many = counted.filter(F.length("piece") > 1)
    cuts = nth_keys(many.select((-F.col("score")).alias("k")), "k", [size])
    if not cuts.keys:
        return counted
    last = -cuts.keys[size]
    above = counted.filter((F.length("piece") == 1) | (F.col("score") > last))
    tied = many.filter(F.col("score") == last).orderBy("piece").limit(size - many.filter(F.col("score") > last).count())
    return above.unionByName(tied)


def _expected(word: str, logp: dict[str, float], longest: int) -> list[tuple[str, float]]:
    """Posterior piece counts of one word (forward-backward over its segmentations)."""
    n = len(word)
    arcs = [
        (i, j, p) for i in range(n) for j in range(i + 1, min(n, i + longest) + 1)
        if (p := logp.get(word[i:j])) is not None
    ]
    low = float("-inf")

    def add(a: float, b: float) -> float:
        hi, lo = (a, b) if a > b else (b, a)
        return hi if lo == low else hi + math.log1p(math.exp(lo - hi))

    fwd, bwd = [0.0] + [low] * n, [low] * n + [0.0]
    for i, j, p in arcs:
        if fwd[i] > low:
            fwd[j] = add(fwd[j], fwd[i] + p)
    for i, j, p in reversed(arcs):
        if bwd[j] > low:
            bwd[i] = add(bwd[i], bwd[j] + p)
    if fwd[n] == low:
        return []
    return [
        (word[i:j], math.exp(fwd[i] + p + bwd[j] - fwd[n])) for i, j, p in arcs if fwd[i] > low and bwd[j] > low
    ]


@dataclass
class Lattice:
    """Words with all places of known pieces in them; an id stands for its place in `pieces`.

    `rows` is `(chars, freq, ids, spans)`; a span is the start times `longest`, plus the length, less one.
    """

    rows: DataFrame
    pieces: list[str]
    longest: int


def _prefix_tree(pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Steps `(node << 21) + code point` in order, the node that each leads to, and the piece of each node or -1."""
    nodes, steps = {"": 0}, {}
    for piece in pieces:
        at = 0
        for n, char in enumerate(piece, start=1):
            step = (at << 21) + ord(char)
            at = nodes.setdefault(piece[:n], len(nodes))
            steps[step] = at
    keys = np.array(sorted(steps), np.int64)
    piece_of = np.full(len(nodes), -1, np.int32)
    piece_of[[nodes[piece] for piece in pieces]] = np.arange(len(pieces))
    return keys, np.array([steps[k] for k in keys.tolist()], np.int64), piece_of


def lattice(words: DataFrame, pieces: Iterable[str]) -> Lattice:
    """Find all pieces in each word once; later rounds only need the ids. All places of a batch are walked side by side."""
    pieces = list(pieces)
    shipped = words.sparkSession.sparkContext.broadcast(_prefix_tree(pieces))
    longest = max(map(len, pieces), default=1)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, child, piece_of = shipped.value
        for batch in batches:
            texts = batch.column("word").to_pylist()
            chars = np.array([len(text) for text in texts], np.int64)
            code = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64)
            base = np.cumsum(chars) - chars
            word = np.repeat(np.arange(len(texts)), chars)
            left = (base + chars)[word] - np.arange(len(code))
            at, node = np.arange(len(code)), np.zeros(len(code), np.int64)
            found = []
            for n in range(longest if len(keys) else 0):
                inside = left[at] > n
                at, node = at[inside], node[inside]
                step = (node << 21) + code[at + n]
                place = np.minimum(np.searchsorted(keys, step), len(keys) - 1)
                there = keys[place] == step
                at, node = at[there], child[place[there]]
                hit = piece_of[node] >= 0
                found.append((at[hit], np.full(int(hit.sum()), n), piece_of[node[hit]]))
            at, size, ids = (np.concatenate(part) for part in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
            order = np.argsort(at, kind="stable")
            at, size, ids = at[order], size[order], ids[order]
            spans = (at - base[word[at]]) * longest + size
            yield _words_with_arcs(chars, batch.column("freq"), word[at], ids, spans)

    kept = words.select("word", F.col("freq").cast("bigint").alias("freq")).filter(F.length("word") > 0)
    return Lattice(kept.mapInArrow(find, ARCS), pieces, longest)


def _words_with_arcs(chars, freq: pa.Array, word: np.ndarray, ids: np.ndarray, spans: np.ndarray) -> pa.RecordBatch:
    ends = pa.array(np.r_[0, np.cumsum(np.bincount(word, minlength=len(freq)))].astype(np.int32))
    lists = [pa.ListArray.from_arrays(ends, pa.array(part.astype(np.int32))) for part in (ids, spans)]
    return pa.RecordBatch.from_arrays([pa.array(chars, pa.int32()), freq, *lists], ["chars", "freq", "ids", "spans"])


def _arcs(batch: pa.RecordBatch, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word, id and span of each arc whose piece is known."""
    ids = batch.column("ids").flatten().to_numpy()
    spans = batch.column("spans").flatten().to_numpy()
    word = np.repeat(np.arange(batch.num_rows), batch.column("ids").value_lengths().to_numpy())
    kept = np.flatnonzero(known[ids])
    return word[kept], ids[kept], spans[kept]


def written(found: Lattice, known: Iterable[str] | None = None) -> Lattice:
    """The lattice as a table of its own, without the pieces that are no longer known."""
    spark = found.rows.sparkSession
    rows = found.rows
    if known is not None:
        kept = set(known)
        shipped = spark.sparkContext.broadcast(np.array([piece in kept for piece in found.pieces]))

        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield _words_with_arcs(batch.column("chars"), batch.column("freq"), *_arcs(batch, shipped.value))

        rows = rows.mapInArrow(keep, ARCS)
    path = scratch(spark, "lattice")
    rows.write.parquet(path)
    return Lattice(spark.read.parquet(path), found.pieces, found.longest)


def _log_sums(total: np.ndarray, source: np.ndarray, target: np.ndarray, p: np.ndarray, rank: np.ndarray) -> None:
    """`total[target]` = log of the sum of exp(total[source] + p), rank after rank; arcs of a target share a rank."""
    rank = rank - rank.min()
    order = np.argsort(rank.astype(np.uint16) if rank.max() < 1 << 16 else rank, kind="stable")
    source, target, p, rank = source[order], target[order], p[order], rank[order]
    ends = np.flatnonzero(np.r_[rank[1:] != rank[:-1], True]) + 1
    begin = 0
    for end in ends:
        to = target[begin:end]
        value = total[source[begin:end]] + p[begin:end]
        new = np.r_[True, to[1:] != to[:-1]]
        heads = np.flatnonzero(new)
        most = np.maximum.reduceat(value, heads)
        most[np.isneginf(most)] = 0.0
        with np.errstate(divide="ignore"):
            total[to[heads]] = most + np.log(np.add.reduceat(np.exp(value - most[np.cumsum(new) - 1]), heads))
        begin = end


def _expected_of(batch: pa.RecordBatch, logp: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and expected counts of all arcs of a batch (forward-backward over all words side by side)."""
    chars = batch.column("chars").to_numpy().astype(np.int64)
    freq = batch.column("freq").to_numpy()
    word, ids, spans = _arcs(batch, logp > -np.inf)
    p, first, size = logp[ids], spans // longest, spans % longest + 1
    base = np.cumsum(chars + 1) - (chars + 1)
    start = base[word] + first
    end = start + size
    fwd = np.full(int((chars + 1).sum()), -np.inf)
    bwd = fwd.copy()
    fwd[base], bwd[base + chars] = 0.0, 0.0
    if len(ids):
        _log_sums(fwd, start, end, p, first + size)
        _log_sums(bwd, end, start, p, -first)
    whole = fwd[base + chars][word]
    used = np.flatnonzero((fwd[start] > -np.inf) & (bwd[end] > -np.inf) & (whole > -np.inf))
    start, end, p, word, ids = start[used], end[used], p[used], word[used], ids[used]
    return ids, np.exp(fwd[start] + p + bwd[end] - whole[used]) * freq[word]


def expected_counts(words: DataFrame | Lattice, logp: dict[str, float]) -> DataFrame:
    """E-step: `(piece, expected)` over the whole word table, given as words or with their pieces already found."""
    found = words if isinstance(words, Lattice) else lattice(words, logp)
    longest = found.longest
    shipped = found.rows.sparkSession.sparkContext.broadcast(
        (pa.array(found.pieces, pa.string()), np.array([logp.get(piece, -np.inf) for piece in found.pieces]))
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, shares = shipped.value
        sums, seen = np.zeros(len(shares)), np.zeros(len(shares), bool)
        for batch in batches:
            ids, counts = _expected_of(batch, shares, longest)
            sums += np.bincount(ids, counts, len(shares))
            seen[ids] = True
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pieces.take(pa.array(at)), pa.array(sums[at])], ["piece", "expected"])

    parts = found.rows.mapInArrow(count, "piece string, expected double")
    return parts.groupBy("piece").agg(F.sum("expected").alias("expected"))


def expected_counts_of_table(words: DataFrame, counts: DataFrame, longest: int) -> DataFrame:
    """E-step from counts `(piece, freq)` in a table of any size: no piece table on the driver or in a task.

    `words` has one row per word. A word meets the pieces that are its own substrings; words without a segmentation give nothing.
    """
    total = counts.agg(F.sum(F.col("freq").cast("double")).alias("total"))
    logp = counts.crossJoin(F.broadcast(total)).select("piece", (F.log(F.col("freq").cast("double")) - F.log("total")).alias("logp"))
    n = F.length("word")
    # A word has one row, so its pieces are told apart within it: an aggregate over all of them would hold them in memory.
    places = F.transform(F.sequence(F.lit(1), n), lambda s: F.transform(
        F.sequence(F.lit(1), F.least(F.lit(longest), n - s + 1)), lambda k: F.substring(F.col("word"), s, k)
    ))
    ends = words.filter(n > 0).select("word", "freq", F.explode(F.array_distinct(F.flatten(places))).alias("piece"))
    own = ends.join(logp, "piece").groupBy("word", "freq").agg(F.collect_list(F.struct("piece", "logp")).alias("pieces"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sums: dict[str, float] = {}
            for word, freq, pieces in zip(batch["word"], batch["freq"], batch["pieces"]):
                for piece, share in _expected(word, {p["piece"]: p["logp"] for p in pieces}, longest):
                    sums[piece] = sums.get(piece, 0.0) + share * freq
            yield pd.DataFrame({"piece": pd.Series(list(sums), dtype=str), "expected": pd.Series(list(sums.values()), dtype=float)})

    parts = own.mapInPandas(count, "piece string, expected double")
    return parts.groupBy("piece").agg(F.sum("expected").alias("expected"))


def log_shares(counts: dict[str, float]) -> dict[str, float]:
    total = math.log(sum(counts.values()))
    return {piece: math.log(c) - total for piece, c in counts.items()}


def train_unigram(
    words: DataFrame, vocab_size: int, layout: Layout = SPECIALS_FIRST, seed_size: int = SEED_PIECES,
    em_rounds: int = 2, least: float = LEAST_COUNT, longest: int = LONGEST_PIECE,
) -> DataFrame:
    """`(id, piece, logp)`: specials first, then pieces by falling probability.

    The piece table on the driver has at most `seed_size` entries plus the alphabet. Single
    characters are never pruned, so every seen word keeps a segmentation; longer pieces go as soon
    as fewer than `least` of them are expected. The pieces of each word are found once and
    written, and again without those that went whenever half of them did. Counts are rounded before they are ranked, so the
    order in which tasks are summed has no influence.
    """
    spark = words.sparkSession
    table = cut_lineage(words.select("word", "freq"))
    counts = {r.piece: float(r.freq) for r in seed_pieces(table, seed_size, longest).select("piece", "freq").toLocalIterator()}
    arcs, held = written(lattice(spread(table), counts)), len(counts)
    room = vocab_size - len(layout.specials)
    while True:
        for _ in range(em_rounds):
            found = {r.piece: round(r.expected, 6) for r in expected_counts(arcs, log_shares(counts)).collect()}
            counts = {p: max(found.get(p, 0.0), 1e-9) for p in counts if len(p) == 1 or found.get(p, 0.0) >= least}
        ranked = sorted(counts, key=lambda p: (-counts[p], p))
        if len(ranked) <= room or all(len(p) == 1 for p in ranked):
            break
        target = max(room, int(len(ranked) * KEEP_SHARE))
        single = sum(len(p) == 1 for p in ranked)
        longer = [p for p in ranked if len(p) > 1][: max(0, target - single)]
        counts = {p: counts[p] for p in [*(q for q in ranked if len(q) == 1), *longer]}
        if len(counts) * 2 < held:
            arcs, held = written(arcs, counts), len(counts)
    logp = log_shares(counts)
    rows = [(i, t, None) for t, i in sorted(layout.specials.items(), key=lambda x: x[1])]
    rows += [(len(rows) + i, p, logp[p]) for i, p in enumerate(ranked)]
    return spark.createDataFrame(rows, "id int, piece string, logp double")


def _best_split(word: str, pieces: dict[str, tuple[int, float]], longest: int, unk: int) -> list[int]:
    n = len(word)
    best = [0.0] + [float("-inf")] * n
    step: list[tuple[int, int]] = [(0, unk)] * (n + 1)
    for j in range(1, n + 1):
        for i in range(max(0, j - longest), j):
            hit = pieces.get(word[i:j])
            if hit is None and j - i > 1:
                continue
            score = best[i] + (hit[1] if hit else -100.0)
            if score > best[j]:
                best[j], step[j] = score, (i, hit[0] if hit else unk)
    ids, j = [], n
    while j:
        j, piece = step[j]
        ids.append(piece)
    return ids[::-1]


def unigram_encoder(spark: SparkSession, vocab: DataFrame, layout: Layout = SPECIALS_FIRST):
    """Arrow function STRING word -> ids of its most probable segmentation; unseen chars give UNK."""
    pieces = {r.piece: (r.id, r.logp) for r in vocab.filter("logp is not null").collect()}
    shipped = spark.sparkContext.broadcast((pieces, max(map(len, pieces)), layout.unk))

    @F.pandas_udf("array<int>")
    def encode(words: pd.Series) -> pd.Series:
        table, longest, unk = shipped.value
        return words.map(lambda w: _best_split(w, table, longest, unk))

    return encode


def wordpiece_encoder(spark: SparkSession, rules):
    """Arrow function STRING word -> ids, longest known piece first; no match makes the word UNK."""
    ids = {token: i for i, token in rules.vocabulary().items()}
    shipped = spark.sparkContext.broadcast((ids, max(map(len, ids)), rules.layout.unk))

    def split(word: str, table: dict[bytes, int], longest: int, unk: int) -> list[int]:
        out, at = [], 0
        while at < len(word):
            for end in range(min(len(word), at + longest), at, -1):
                piece = (b"##" if at else b"") + word[at:end].encode()
                if piece in table:
                    out.append(table[piece])
                    at = end
                    break
            else:
                return [unk]
        return out

    @F.pandas_udf("array<int>")
    def encode(words: pd.Series) -> pd.Series:
        return words.map(lambda w: split(w, *shipped.value))

    return encode
