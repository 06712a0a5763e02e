"""Text to ids and back."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill.functions.text import pretokens
from gristmill.operators.bpe import Rules
from gristmill.session import BROADCAST_ROWS, broadcast_if_small, cut_lineage

HOT_WORDS = 500_000
MEMO_WORDS = 250_000
# Rows of an Arrow batch that are Python objects at once, and words of which the distinct ones are encoded together.
ROWS_AT_ONCE, WORDS_AT_ONCE = 64, 1 << 18
# Bytes up to which words are merged side by side: a round takes one pair of each.
SHORT_BYTES = 64
# Words looked up in the table of hot words at once; that is indexed each time.
LOOKED_UP_AT_ONCE = 1 << 20
# Characters that a pre-token seldom exceeds on average.
CHARS_A_WORD = 10
IDS = T.ArrayType(T.IntegerType())
ANSWERS = "array<struct<word: string, ids: array<int>>>"


def _merge(tokens: list[bytes], ranks: dict[tuple[bytes, bytes], int]) -> list[bytes]:
    """Merge the lowest-ranked adjacent pair, leftmost first, until no rule applies."""
    n = len(tokens)
    nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, tokens[i], tokens[i + 1]) for i in range(n - 1) if (r := ranks.get((tokens[i], tokens[i + 1]))) is not None]
    heapq.heapify(heap)
    alive: list[bytes | None] = list(tokens)

    def offer(i: int) -> None:
        j = nxt[i]
        if i >= 0 and j < n and (r := ranks.get((alive[i], alive[j]))) is not None:
            heapq.heappush(heap, (r, i, alive[i], alive[j]))

    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = nxt[i]
        if alive[i] != left or j >= n or alive[j] != right:
            continue
        alive[i], alive[j] = left + right, None
        nxt[i] = nxt[j]
        if nxt[j] < n:
            prv[nxt[j]] = i
        offer(i)
        if prv[i] >= 0:
            offer(prv[i])
    return [t for t in alive if t is not None]


def _tables(rules: Rules):
    ranks = {(m.left, m.right): m.id for m in rules.merges}
    ids = {token: i for i, token in sorted(rules.vocabulary().items())}
    return ranks, ids, rules.layout.unk


def _word_ids(word: str, tables) -> list[int]:
    ranks, ids, unk = tables
    return [ids.get(t, unk) for t in _merge([bytes([b]) for b in word.encode()], ranks)]


def _pair_table(rules: Rules):
    """Pairs as sorted numbers of two symbols, the symbol each makes and the id of each symbol; a byte is its own symbol.

    None where merging a pair of a word at all its places at once could differ from one place after the other: where
    two rules make the same bytes or a rule comes before what makes its parts.
    """
    _, ids, unk = _tables(rules)
    symbol = {bytes([b]): b for b in range(256)}
    pairs, last = {}, -1
    size = 256 + len(rules.merges)
    for m in rules.merges:
        if m.id <= last or m.left not in symbol or m.right not in symbol or m.left + m.right in symbol:
            return None
        pairs[symbol[m.left] * size + symbol[m.right]] = symbol[m.left + m.right] = len(symbol)
        last = m.id
    codes = np.array(sorted(pairs), np.int64)
    made = np.array([pairs[c] for c in codes.tolist()], np.int64)
    return codes, made, np.array([ids.get(t, unk) for t in symbol], np.int32)


def _ids_of_short(words: pa.Array, pairs) -> pa.ListArray:
    """The ids of many words side by side: a round merges the lowest-ranked pair of each word, at all its places."""
    codes, made, id_of = pairs
    lengths = pc.binary_length(words).to_numpy()
    begin = np.frombuffer(words.buffers()[1], np.int32, 1, words.offset * 4)[0]
    symbols = np.frombuffer(words.buffers()[2] or b"", np.uint8, int(lengths.sum()), begin).astype(np.int64)
    of_word, none = np.repeat(np.arange(len(words)), lengths), len(id_of)
    ended: list[tuple[np.ndarray, np.ndarray]] = []
    while len(symbols) and len(codes):
        pair = symbols[:-1] * len(id_of) + symbols[1:]
        at = np.minimum(np.searchsorted(codes, pair), len(codes) - 1)
        found = np.r_[np.where((codes[at] == pair) & (of_word[:-1] == of_word[1:]), made[at], none), none]
        starts = np.flatnonzero(np.r_[True, of_word[1:] != of_word[:-1]])
        least = np.repeat(np.minimum.reduceat(found, starts), np.diff(np.r_[starts, len(symbols)]))
        places = np.flatnonzero((found == least) & (least != none))
        after = np.r_[False, np.diff(places) == 1]  # overlaps the place before: a run of one symbol
        if after.any():
            n = np.arange(len(places))
            places = places[(n - np.maximum.accumulate(np.where(after, 0, n))) % 2 == 0]
        symbols[places] = found[places]
        keep = least != none
        ended.append((of_word[~keep], symbols[~keep]))
        keep[places + 1] = False
        of_word, symbols = of_word[keep], symbols[keep]
    ended.append((of_word, symbols))
    of_word, symbols = (np.concatenate(x) for x in zip(*ended))
    offsets = np.cumsum(np.r_[0, np.bincount(of_word, minlength=len(words))])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(id_of[symbols[np.argsort(of_word, kind="stable")]]))


def _ids_of_distinct(words: pa.Array, ids_of: Callable, pairs=None) -> pa.ListArray:
    """The ids of each of the words: of short ones side by side where `pairs` allows it, of the others by `ids_of`."""
    short = np.zeros(len(words), bool) if pairs is None else pc.binary_length(words).to_numpy() <= SHORT_BYTES
    many, few = np.flatnonzero(short), np.flatnonzero(~short)
    one_by_one = pa.array(list(map(ids_of, words.take(pa.array(few)).to_pylist())), pa.list_(pa.int32()))
    if not len(many):
        return one_by_one
    ids = pa.concat_arrays([_ids_of_short(words.take(pa.array(many)), pairs).cast(one_by_one.type), one_by_one])
    return ids.take(pa.array(np.argsort(np.r_[many, few])))


def _in_pieces(batches: Iterator[pa.Array], ids_of: Callable) -> Iterator[pa.Array]:
    """The ids of each row, a few rows at a time: a batch holds thousands of texts."""
    for batch in batches:
        for at in range(0, len(batch), ROWS_AT_ONCE):
            rows = batch.slice(at, ROWS_AT_ONCE).to_numpy(zero_copy_only=False)
            yield pa.array([ids_of(row) for row in rows], pa.list_(pa.int32()))


def word_encoder(spark: SparkSession, rules: Rules):
    """Arrow function STRING -> ids of one word (or of a whole text, when given one)."""
    shipped = spark.sparkContext.broadcast(_tables(rules))

    @F.arrow_udf(IDS)
    def encode(words: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tables = shipped.value
        return _in_pieces(words, lambda w: None if w is None else _word_ids(w, tables))

    return encode


def _ids_of_rows(words: pa.ListArray, ids_of: Callable, pairs=None) -> pa.ListArray:
    """The ids of each row's words, one after the other; a null row has none. A word that comes several times is encoded once."""
    coded = words.flatten().dictionary_encode()
    ids = _ids_of_distinct(coded.dictionary, ids_of, pairs).take(coded.indices)
    starts = np.cumsum(np.r_[0, pc.fill_null(pc.list_value_length(words), 0).to_numpy()])
    offsets = ids.offsets.to_numpy()[starts] - ids.offsets[0].as_py()
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), ids.flatten())


def _slices(words: pa.ListArray) -> Iterator[pa.ListArray]:
    """Whole rows with about WORDS_AT_ONCE words."""
    ends = np.cumsum(pc.fill_null(pc.list_value_length(words), 0).to_numpy())
    at = 0
    while at < len(words):
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + WORDS_AT_ONCE, "right")))
        yield words.slice(at, end - at)
        at = end


def text_encoder(spark: SparkSession, rules: Rules):
    """Arrow function ARRAY<STRING> -> ids; each task encodes the distinct words of a few rows side by side.

    The corpus is not shuffled: pre-tokenising stays in the JVM, and words stay in Arrow. Words that can't be
    encoded side by side are looked up in a bounded per-task table.
    """
    shipped = spark.sparkContext.broadcast((_tables(rules), _pair_table(rules)))

    @F.arrow_udf(IDS)
    def encode(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        (tables, pairs), memo = shipped.value, {}

        def ids_of(word: str) -> list[int]:
            if word not in memo:
                if len(memo) >= MEMO_WORDS:
                    memo.clear()
                memo[word] = _word_ids(word, tables)
            return memo[word]

        for batch in texts:
            for rows in _slices(batch):
                yield _ids_of_rows(rows, ids_of, pairs)

    return encode


def first_pretokens(text: Column, most: int) -> Column:
    """The first `most` pre-tokens of a text, taken from its beginning alone where that shows them.

    What is cut off can change the last pre-token of the beginning, or the last two (an apostrophe and its letters).
    """
    begin = pretokens(F.substring(text, 1, CHARS_A_WORD * (most + 2)))
    enough = lambda words: F.when(F.size(words) >= most + 2, words).otherwise(pretokens(text))
    return F.slice(F.transform(F.array(begin), enough)[0], 1, most)  # an array of one, so that the beginning is taken apart once


def encode_texts(docs: DataFrame, rules: Rules, text: str = "text", out: str = "ids", most: int | None = None) -> DataFrame:
    """Add the content ids of each text; one narrow pass, no shuffle.

    With `most`, at least the first `most` ids are right: every pre-token gives one or more, so the
    pre-tokens after as many need no encoding when a record of that length is cut afterwards.
    """
    words = pretokens(F.col(text)) if most is None else first_pretokens(F.col(text), most)
    return docs.withColumn(out, text_encoder(docs.sparkSession, rules)(words))


def encode_whole_texts(docs: DataFrame, rules: Rules, text: str = "text", out: str = "ids") -> DataFrame:
    """Ids without pre-tokenisation: merges may cross word borders."""
    return docs.withColumn(out, word_encoder(docs.sparkSession, rules)(F.col(text)))


def _least_hot(counted: DataFrame) -> int:
    """The least frequency from which on there are at most HOT_WORDS words."""
    by_freq = sorted(counted.groupBy("freq").agg(F.count(F.lit(1))).collect(), reverse=True)
    least, words = 1 << 62, 0
    for freq, n in by_freq:
        words += n
        if words > HOT_WORDS:
            break
        least = freq
    return least


def _order_of_repeats(order: np.ndarray, texts: pa.ListArray, words_of_text: np.ndarray, ids: pa.ListArray) -> np.ndarray:
    """The words of a row with several texts, by their position, then by their ids."""
    several = pc.list_value_length(texts).to_numpy()
    if not len(several) or several.max() < 2:
        return order
    order, text, at = order.copy(), 0, 0
    for n in several:
        lengths = words_of_text[text:text + n]
        end = at + int(lengths.sum())
        if n > 1:
            pos = np.concatenate([np.arange(k) for k in lengths])
            key = list(zip(pos.tolist(), ids.take(pa.array(order[at:end])).to_pylist()))
            order[at:end] = order[at:end][sorted(range(end - at), key=key.__getitem__)]
        text, at = text + n, end
    return order


def _ids_by_table(texts: pa.ListArray, rare: pa.ListArray, hot_words: pa.Array, hot_ids: pa.ListArray) -> pa.ListArray:
    """The ids of the words of each row's texts, looked up among the hot words and those that come with the rows."""
    words = texts.flatten()
    words_of_text = pc.list_value_length(words).to_numpy()
    flat, found = words.flatten().dictionary_encode(), rare.flatten()
    at = pc.index_in(flat.dictionary, value_set=pa.concat_arrays([hot_words, found.field("word")]))
    if at.null_count:
        raise ValueError("a word of a text is not in the table of encoded words")
    ids = pa.concat_arrays([hot_ids, found.field("ids").cast(hot_ids.type)]).take(at)
    order = _order_of_repeats(flat.indices.to_numpy(), texts, words_of_text, ids)
    ends = np.cumsum(np.r_[0, words_of_text])[np.cumsum(np.r_[0, pc.list_value_length(texts).to_numpy()])]
    out = ids.take(pa.array(order, pa.int32()))
    return pa.ListArray.from_arrays(pa.array(out.offsets.to_numpy()[ends], pa.int32()), out.flatten())


def table_encoder(hot: DataFrame):
    """Arrow function (ARRAY<ARRAY<STRING>> words of texts, ARRAY<STRUCT<word, ids>>) -> ids, by lookup alone.

    The words and ids of `hot` are shipped; the second column has all other words of the row.
    """
    rows = hot.select("word", "ids").toArrow().combine_chunks()
    column = lambda name, kind: pa.concat_arrays([pa.array([], kind), *rows.column(name).cast(kind).chunks])
    shipped = hot.sparkSession.sparkContext.broadcast((column("word", pa.string()), column("ids", pa.list_(pa.int32()))))

    @F.arrow_udf(IDS)
    def encode(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, rare in batches:
            for at, n in _row_slices(texts):
                yield _ids_by_table(texts.slice(at, n), rare.slice(at, n), *shipped.value)

    return encode


def _row_slices(texts: pa.ListArray) -> Iterator[tuple[int, int]]:
    """Start and number of rows whose texts have about LOOKED_UP_AT_ONCE words together."""
    words = np.cumsum(np.r_[0, pc.list_value_length(texts.flatten()).to_numpy()])
    ends = words[np.cumsum(pc.list_value_length(texts).to_numpy())]
    at = 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + LOOKED_UP_AT_ONCE, "right")))
        yield at, end - at
        at = end


def encode_by_distinct_word(docs: DataFrame, rules: Rules, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`(key, ids)`: encode each distinct word once, then give every text the ids of its words in word order.

    The most frequent words (at most HOT_WORDS) go to all tasks. A text asks for each of its other words
    once; the answers meet the text by its key, so a word's occurrences are never shuffled. Rows of one key
    are taken as one text: their words go by position, then by ids. A null key has no ids.
    """
    known = F.col(key).isNotNull()
    counted = docs.select(F.explode(pretokens(F.col(text))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("freq"))
    # Written once: the count, the hot words and the join would each take the texts apart again.
    encoded = cut_lineage(counted.withColumn("ids", word_encoder(docs.sparkSession, rules)(F.col("word"))))
    texts = docs.groupBy(key).agg(F.collect_list(F.when(known, F.col(text))).alias("_texts"), F.count(F.lit(1)).alias("_rows"))
    if encoded.count() <= BROADCAST_ROWS:
        hot = encoded
        texts = texts.withColumn("_rare", F.array().cast(ANSWERS))
    else:
        hot = encoded.filter(F.col("freq") >= _least_hot(encoded))
        asked = docs.filter(known).select(key, F.explode(F.array_distinct(pretokens(F.col(text)))).alias("word"))
        rare = asked.join(F.broadcast(hot.select("word")), "word", "left_anti").join(encoded.drop("freq"), "word")
        texts = texts.join(rare.groupBy(key).agg(F.collect_list(F.struct("word", "ids")).cast(ANSWERS).alias("_rare")), key, "left")
    words = F.transform("_texts", lambda t: pretokens(t))
    ids = texts.withColumn("ids", table_encoder(hot)(words, F.col("_rare")))
    return ids.select(key, "ids", F.explode(F.sequence(F.lit(1), F.col("_rows"))).alias("_row")).drop("_row")


def vocabulary_lookup(rows: DataFrame, vocab: DataFrame, token: str, unk: int | None) -> DataFrame:
    """Add `id` of each token; a token outside the vocabulary gets `unk` (or NULL)."""
    found = rows.join(broadcast_if_small(vocab.select(F.col("token").alias(token), "id")), token, "left")
    return found if unk is None else found.withColumn("id", F.coalesce("id", F.lit(unk)))


def tokens_of_ids(rows: DataFrame, vocab: DataFrame, key: str, ids: str) -> DataFrame:
    """`(key, pos, id, token)` for each known id of an id array; unknown ids are dropped."""
    flat = rows.select(key, F.posexplode(ids).alias("pos", "id"))
    return flat.join(broadcast_if_small(vocab.select("id", "token")), "id").select(key, "pos", "id", "token")


def decoded(ids: Column, rules: Rules) -> Column:
    """Text of an id array; specials are skipped and invalid UTF-8 is replaced.

    The vocabulary is one constant array indexed by id, so decoding is a projection.
    """
    mark = chr(0x100)
    vocab = rules.vocabulary()
    special = set(rules.layout.specials.values())
    entries = [
        "" if i in special else vocab.get(i, b"").decode("latin-1") for i in range(max(vocab) + 1)
    ]
    table = F.split(F.lit(mark.join(entries)), mark)
    raw = F.encode(F.array_join(F.transform(ids, lambda i: F.get(table, i)), ""), "ISO-8859-1")
    return F.make_valid_utf8(raw.cast("string"))


def _whole_numbers(rows: DataFrame, value: str) -> bool:
    kind = rows.schema[value].dataType
    return isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.IntegralType)


def agreement(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """`(key, same)`: does each shared key carry the same value on both sides?

    Arrays of whole numbers stand in the join as the SHA-256 of all their elements, written out: 32 bytes each.
    """
    digest = _whole_numbers(left, value) and _whole_numbers(right, value)
    shown = F.unhex(F.sha2(F.col(value).cast("string").cast("binary"), 256)) if digest else F.col(value)
    other = right.select(key, shown.alias("_other"))
    return left.select(key, shown.alias(value)).join(other, key).select(key, F.col(value).eqNullSafe(F.col("_other")).alias("same"))


def agreement_report(compared: DataFrame) -> DataFrame:
    """One row: total, matches, mismatches and the match rate (0 for no rows)."""
    total, matches = F.count(F.lit(1)), F.count_if("same")
    return compared.agg(
        total.alias("total"), matches.alias("matches"), (total - matches).alias("mismatches"),
        F.coalesce(F.try_divide(matches, total), F.lit(0.0)).alias("rate"),
    )
