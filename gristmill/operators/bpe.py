"""Learning merge rules: one Spark aggregation per round, many exact merges per round.

A word is a string with one character per symbol: code point 0-255 for the bytes, higher
ones for merged symbols. Replacing a two-character string left to right is then exactly
"merge this pair without overlap", and runs inside Spark's own `replace`.

A round counts all pairs and lists the most frequent ones. While these are widespread, it merges several that
can't influence each other (`choose_merges`) on all words. Once many of them occur in few distinct words
together, it fetches these words and merges on, one pair after the other, as long as they decide what comes
next (`merge_ahead`): an index leads from a pair to its words, and only words of a merged pair take counts from
their old pairs and give them to the new ones.
"""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Callable
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill.functions.arrays import BYTES_FIRST, SPECIALS_FIRST, Layout
from gristmill.functions.text import byte_string
from gristmill.operators.blocks import number_in_order
from gristmill.operators.words import pair_table, top_pairs
from gristmill.session import cut_lineage, spread

# Pairs that are listed.
CANDIDATES = 4_096
# Occurrences in distinct words that a round on the driver takes at most, and pairs for which it is worth while.
AHEAD, AHEAD_PAIRS = 50_000, 32
MERGES_PER_CUT = 32

MERGE_SCHEMA = T.StructType([
    T.StructField("left", T.BinaryType(), False),
    T.StructField("right", T.BinaryType(), False),
    T.StructField("rank", T.IntegerType(), False),
    T.StructField("id", T.IntegerType(), False),
    T.StructField("freq", T.LongType(), True),
])
VOCAB_SCHEMA = T.StructType([
    T.StructField("id", T.IntegerType(), False), T.StructField("token", T.BinaryType(), False),
])


def symbol_char(number: int) -> str:
    """Character standing for a symbol number, skipping the surrogate range."""
    return chr(number if number < 0xD800 else number + 0x800)


def symbol_number(char: str) -> int:
    return ord(char) if ord(char) < 0xD800 else ord(char) - 0x800


@dataclass
class Merge:
    left: bytes
    right: bytes
    id: int
    freq: int


@dataclass
class Rules:
    """A learnt vocabulary. Its size is bounded by the requested vocabulary size."""

    layout: Layout
    merges: list[Merge] = field(default_factory=list)
    alphabet: list[bytes] = field(default_factory=list)
    prefix: bytes = b""

    def vocabulary(self) -> dict[int, bytes]:
        vocab = {i: t.encode() for t, i in self.layout.specials.items()}
        vocab.update({self.layout.first_byte + i: token for i, token in enumerate(self.alphabet)})
        vocab.update({m.id: joined(m.left, m.right, self.prefix) for m in self.merges})
        return vocab

    def vocab_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(sorted(self.vocabulary().items()), VOCAB_SCHEMA)

    def merges_df(self, spark: SparkSession) -> DataFrame:
        rows = [(m.left, m.right, i, m.id, m.freq) for i, m in enumerate(self.merges)]
        return spark.createDataFrame(rows, MERGE_SCHEMA)


def joined(left: bytes, right: bytes, prefix: bytes = b"") -> bytes:
    """Token made by a merge; a continuation mark on the right part is dropped."""
    return left + (right[len(prefix):] if prefix and right.startswith(prefix) else right)


def choose_merges(listed: list[tuple[str, int]], floor: int, token_of, known: set[bytes], limit: int):
    """Pairs at the head of the list that one-at-a-time merging would take next, in order.

    A pair is taken while it shares no symbol with one already taken and makes a token not
    seen before. Merging can only lower the counts of pairs that share a symbol with it, and
    new pairs are at most as frequent as such a pair, so every taken pair must be strictly
    more frequent than all of them. Pairs that aren't listed are at most as frequent as `floor`. A pair of equal symbols overlaps itself and ends the round.
    """
    taken: list[tuple[str, int, bytes]] = []
    used: set[str] = set()
    made: set[bytes] = set()
    for pair, freq in listed[:limit]:
        token = token_of(pair)
        fresh = token not in known and token not in made
        if taken and (pair[0] in used or pair[1] in used or freq <= floor or not fresh):
            break
        taken.append((pair, freq, token))
        used.update(pair)
        made.add(token)
        if not fresh or pair[0] == pair[1]:
            break
    while len(taken) > 1:
        touching = max((f for p, f in listed[len(taken):] if p[0] in used or p[1] in used), default=0)
        if taken[-1][1] > touching:
            break
        used.difference_update(taken.pop()[0])
    return taken


def merged_symbols(pending: list[tuple[str, str]]) -> Column:
    """The symbol string after the pending merges.

    The list is filled up with replacements that never match: the rounds then share one
    generated program, which Spark compiles once and the JVM keeps optimised.
    """
    idle = chr(0x10FFFF) * 2
    symbols = F.col("symbols")
    for pair, made in [*pending, *[(idle, idle)] * (-len(pending) % MERGES_PER_CUT)]:
        symbols = F.replace(symbols, F.lit(pair), F.lit(made))
    return symbols


def numbered(words: DataFrame, order=("first",), place: str = "place") -> DataFrame:
    """Add the place of each row in a global order."""
    return number_in_order(words, list(order), place)


def having(words: DataFrame, pairs: list[str]) -> DataFrame:
    """Words that contain one of the pairs. One pattern, so that the symbols are worked out once for each word."""
    return words.filter(F.col("symbols").rlike("|".join("".join(f"\\x{{{ord(c):x}}}" for c in pair) for pair in pairs)))


def merge_ahead(
    words: list[tuple[str, int]], listed: list[tuple[str, int]], own: int, floor: int,
    merge: Callable[[str, int], tuple[str, bool]], limit: int, ties: str,
) -> dict[int, str]:
    """Merge one pair after the other while the words at hand decide which one is next; the words that changed.

    `words` are all words, in order of place, that contain one of the first `own` pairs of `listed`. Any pair
    made by a merge occurs in these words only, so counts and first places of the own and the new pairs are
    exact throughout. The other listed pairs only lose occurrences, all of them in these words, and a pair
    that is not listed is at most as frequent as `floor`. The loop goes on while the most
    frequent own pair is above all of them. `merge` records a pair and gives its symbol, and whether that
    symbol is new; a symbol that other words may have ends the round.
    """
    split = [list(symbols) for symbols, _ in words]
    count = dict(listed)
    where: dict[str, set[int]] = {pair: set() for pair, _ in listed[:own]}
    for i, w in enumerate(split):
        for a, b in zip(w, w[1:]):
            if a + b in where:
                where[a + b].add(i)
    mine = [(-count[pair], pair) for pair in where]
    others = [(-freq, pair) for pair, freq in listed[own:]]
    heapq.heapify(mine)
    heapq.heapify(others)
    changed: set[int] = set()

    def best(heap) -> int:
        while heap and -heap[0][0] != count[heap[0][1]]:
            heapq.heappop(heap)
        return -heap[0][0] if heap else 0

    def place(pair: str):
        if ties == "pair":
            return pair
        i = min(i for i in where[pair] if pair in map(str.__add__, split[i], split[i][1:]))
        return i, next(k for k, p in enumerate(map(str.__add__, split[i], split[i][1:])) if p == pair)

    while limit > 0:
        freq = best(mine)
        if freq <= max(best(others), floor):
            break
        tied = set()
        while best(mine) == freq:
            tied.add(heapq.heappop(mine)[1])
        pair = min(tied, key=place) if len(tied) > 1 else next(iter(tied))
        for other in tied - {pair}:
            heapq.heappush(mine, (-freq, other))
        symbol, fresh = merge(pair, freq)
        limit -= 1
        touched: set[str] = set()
        for i in where.pop(pair):
            w, joined_, k = split[i], [], 0
            while k < len(w):
                if k + 1 < len(w) and w[k] + w[k + 1] == pair:
                    joined_.append(symbol)
                    k += 2
                else:
                    joined_.append(w[k])
                    k += 1
            if len(joined_) == len(w):
                continue  # lost its occurrence to an earlier merge
            amount = words[i][1]
            for p in map(str.__add__, w, w[1:]):
                if p in count:
                    count[p] -= amount
                    touched.add(p)
            for p in map(str.__add__, joined_, joined_[1:]):
                if symbol in p and fresh:
                    where.setdefault(p, set()).add(i)
                    count.setdefault(p, 0)
                if p in count:
                    count[p] += amount
                    touched.add(p)
            split[i] = joined_
            changed.add(i)
        if not fresh:
            break
        for p in touched:
            heapq.heappush(mine if p in where else others, (-count[p], p))
    return {i: "".join(split[i]) for i in changed}


def learn_merges(
    words: DataFrame, alphabet: dict[bytes, str], first_id: int, wanted: int, layout: Layout,
    prefix: bytes = b"", ties: str = "first", batch: bool = True,
) -> Rules:
    """Merge rounds over `(symbols, freq, first)` until `wanted` rules exist or no pair is left."""
    char_of = dict(alphabet)
    bytes_of = {c: b for b, c in char_of.items()}
    next_symbol = 1 + max((symbol_number(c) for c in bytes_of), default=0)
    rules = Rules(layout, alphabet=list(alphabet), prefix=prefix)
    several = words.filter(F.length("symbols") > 1)
    base = numbered(several).select("symbols", "freq", "place").persist()
    pending: list[tuple[str, str]] = []

    def merge(pair: str, freq: int) -> tuple[str, bool]:
        nonlocal next_symbol
        left, right = bytes_of[pair[0]], bytes_of[pair[1]]
        token = joined(left, right, prefix)
        rules.merges.append(Merge(left, right, first_id + len(rules.merges), freq))
        fresh = token not in char_of
        if fresh:
            char_of[token] = symbol_char(next_symbol)
            bytes_of[char_of[token]] = token
            next_symbol += 1
        return char_of[token], fresh

    while len(rules.merges) < wanted:
        if len(pending) >= MERGES_PER_CUT:
            base, pending = recut(base, base.withColumn("symbols", merged_symbols(pending))), []
        now = base.withColumn("symbols", merged_symbols(pending))
        ask = CANDIDATES if batch else 1
        top = top_pairs(pair_table(now, F.count(F.lit(1)).alias("places")), ask, ties).select("pair", "freq", "places").collect()
        if not top:
            break
        listed, floor = [(r.pair, r.freq) for r in top], top[-1].freq if len(top) == ask else 0
        within = [i for i, places in enumerate(itertools.accumulate(r.places for r in top), start=1) if places <= AHEAD]
        own = within[-1] if within and batch else 0
        if own >= min(AHEAD_PAIRS, len(top)) > 0 and own:
            near = having(now, [pair for pair, _ in listed[:own]]).toArrow().sort_by("place")
            rows = list(zip(near.column("symbols").to_pylist(), near.column("freq").to_pylist()))
            changed = merge_ahead(rows, listed, own, floor, merge, wanted - len(rules.merges), ties)
            at = sorted(changed)
            merged = pa.table({"place": near.column("place").take(pa.array(at, pa.int64())), "_new": pa.array([changed[i] for i in at], pa.string())})
            merged = F.broadcast(base.sparkSession.createDataFrame(merged))  # at most AHEAD rows
            base = recut(base, now.join(merged, "place", "left").select(F.coalesce("_new", "symbols").alias("symbols"), "freq", "place"))
            pending = []
            continue
        taken = choose_merges(
            listed, floor, lambda p: joined(bytes_of[p[0]], bytes_of[p[1]], prefix), set(char_of), wanted - len(rules.merges)
        )
        pending += [(pair, merge(pair, freq)[0]) for pair, freq, _ in taken]
    base.unpersist()
    return rules


def recut(before: DataFrame, after: DataFrame) -> DataFrame:
    """The words that still have pairs, written and kept instead of `before`."""
    out = spread(cut_lineage(after.filter(F.length("symbols") > 1))).persist()
    before.unpersist()
    return out


def train_bpe(words: DataFrame, vocab_size: int, layout: Layout = BYTES_FIRST, batch: bool = True) -> Rules:
    """Byte-level merges over `(word, freq, first)`; 256 bytes and 4 specials take the first 260 ids."""
    start = words.select(byte_string(F.col("word")).alias("symbols"), "freq", "first")
    alphabet = {bytes([b]): chr(b) for b in range(256)}
    return learn_merges(start, alphabet, 260, vocab_size - 260, layout, batch=batch)


def train_wordpiece(
    words: DataFrame, vocab_size: int, layout: Layout = SPECIALS_FIRST, merges: int | None = None
) -> Rules:
    """Character merges where a `##` mark tells inner characters from leading ones.

    Specials and the alphabet come first; `merges` fixes the number of rules instead of the
    vocabulary size. Ties go to the lower symbol numbers.
    """
    chars = F.split("word", "")
    seen = (
        words.select(F.posexplode(chars).alias("at", "c"))
        .groupBy("c").agg(F.min("at").alias("lo"), F.max("at").alias("hi")).collect()
    )
    lead = sorted(r.c for r in seen if r.lo == 0)
    inner = sorted(r.c for r in seen if r.hi > 0)
    alphabet = {c.encode(): symbol_char(i + 1) for i, c in enumerate(lead)}
    alphabet.update({b"##" + c.encode(): symbol_char(len(lead) + i + 1) for i, c in enumerate(inner)})
    to_lead = "".join(alphabet[c.encode()] for c in lead)
    to_inner = "".join(alphabet[b"##" + c.encode()] for c in inner)
    first, rest = F.substring("word", 1, 1), F.substring(F.col("word"), F.lit(2), F.length("word"))
    start = words.select(
        F.concat(F.translate(first, "".join(lead), to_lead), F.translate(rest, "".join(inner), to_inner))
        .alias("symbols"), "freq", "first",
    )
    base = 4 + len(alphabet)
    wanted = vocab_size - base if merges is None else merges
    return learn_merges(start, alphabet, base, wanted, layout, prefix=b"##", ties="pair")
