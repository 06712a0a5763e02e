"""The encoder by distinct words and the comparison of two encoders: rows of odd keys, and what they move."""

import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gristmill.functions.arrays import BYTES_FIRST
from gristmill.functions.text import pretokens
from gristmill.operators import bpe, encode, words

TEXTS = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def rules(spark):
    rows = [(i, f"the word{i % 7} and the word{i % 3} then or {i}") for i in range(40)]
    return bpe.train_bpe(words.word_table(spark.createDataFrame(rows, TEXTS)), 275)


@pytest.fixture(params=[(1_000, 1_000), (3, 2), (3, 0)], ids=["all known", "two hot", "none hot"])
def limits(request, monkeypatch):
    monkeypatch.setattr(encode, "BROADCAST_ROWS", request.param[0])
    monkeypatch.setattr(encode, "HOT_WORDS", request.param[1])
    return request.param


def expected(rows, rules, found):
    """Rows of one key as one text: words by position, then by ids; nothing for a null key."""
    tables, of_key = encode._tables(rules), {}
    for (key, _), ws in zip(rows, found):
        of_key.setdefault(key, []).extend((pos, encode._word_ids(w, tables)) for pos, w in enumerate(ws or []))
    return sorted((str(k), [] if k is None else [i for _, ids in sorted(of_key[k]) for i in ids]) for k, _ in rows)


def test_repeated_and_null_keys(spark, rules, limits, monkeypatch):
    monkeypatch.setattr(encode, "LOOKED_UP_AT_ONCE", 5)
    rows = [(1, "then the word1 word1"), (1, "the word2"), (2, None), (2, "ö und the the the"), (3, ""), (4, None),
            (None, "the word"), (None, "or"), (5, "word5 word5"), (5, "word5 word5"), (6, "only  here\n")]
    texts = spark.createDataFrame(rows, TEXTS).coalesce(1)
    found = [r.w for r in texts.select(pretokens(F.col("text")).alias("w")).collect()]
    got = encode.encode_by_distinct_word(texts, rules)
    assert got.columns == ["doc_id", "ids"]
    assert sorted((str(r.doc_id), r.ids) for r in got.collect()) == expected(rows, rules, found)


def test_words_are_asked_for_once_a_text_and_occurrences_stay(spark, rules, limits):
    """Every occurrence went through the join with its position and its ids, and again to its text."""
    rows = [(i, f"rare{i} " * 50 + "the the") for i in range(20)]
    got = encode.encode_by_distinct_word(spark.createDataFrame(rows, TEXTS), rules)
    plan = got._jdf.queryExecution().analyzed().toString()
    assert "posexplode" not in plan
    assert plan.count("array_distinct") == (0 if limits[0] > 3 else 1)


def test_a_word_that_no_table_has_is_an_error():
    words_of = pa.array([[["a", "b"]]])
    none = pa.array([[]], pa.list_(pa.struct([("word", pa.string()), ("ids", pa.list_(pa.int32()))])))
    with pytest.raises(ValueError, match="not in the table"):
        encode._ids_by_table(words_of, none, pa.array(["a"]), pa.array([[7]], pa.list_(pa.int32())))


@pytest.mark.parametrize("kind", ["array<int>", "array<bigint>"])
def test_agreement_joins_no_arrays(spark, kind):
    """The ids of both encoders went through the shuffle of the join."""
    schema = f"k int, v {kind}"
    left = spark.createDataFrame([(1, [1, 2]), (2, [12]), (3, []), (4, None), (5, [1, None]), (6, [3]), (7, [-1])], schema)
    right = spark.createDataFrame([(1, [1, 2]), (2, [1, 2]), (3, None), (4, None), (5, [1]), (6, [3]), (8, [1])], "k int, v array<int>")
    compared = encode.agreement(left, right, "k", "v")
    assert dict(map(tuple, compared.collect())) == {1: True, 2: False, 3: False, 4: True, 5: False, 6: True}
    join = re.search(r"Join Inner.*", compared._jdf.queryExecution().optimizedPlan().toString(), re.S)[0]
    assert join.count("sha2(") == 2


def test_agreement_of_other_values_compares_them(spark):
    left = spark.createDataFrame([(1, 0.0, True), (2, None, None)], "k int, v double, w boolean")
    right = spark.createDataFrame([(1, -0.0, False), (2, None, None)], "k int, v double, w boolean")
    assert dict(map(tuple, encode.agreement(left, right, "k", "v").collect())) == {1: True, 2: True}
    assert dict(map(tuple, encode.agreement(left, right, "k", "w").collect())) == {1: False, 2: True}


def random_rules(rng, merges, alphabet):
    """Rules whose parts are bytes or made before, no two of which make the same bytes."""
    known, made = [bytes([c]) for c in alphabet], []
    while len(made) < merges:
        left, right = rng.choice(known), rng.choice(known)
        if left + right not in known:
            made.append(bpe.Merge(left, right, 260 + len(made), 1))
            known.append(left + right)
    return bpe.Rules(BYTES_FIRST, made, [bytes([b]) for b in range(256)])


def test_short_words_are_merged_side_by_side(monkeypatch):
    """Each word was merged for itself, on a heap of its pairs."""
    rng = random.Random(7)
    for merges in (0, 1, 5, 60):
        rules = random_rules(rng, merges, b"ab\xc3\xa4")
        tables, pairs = encode._tables(rules), encode._pair_table(rules)
        texts = ["".join(rng.choices("abä", k=rng.choice([0, 1, 2, 5, 12, 40]))) for _ in range(300)] + ["", "a" * 30, "b" * 64, "ä" * 33]
        asked = []
        got = encode._ids_of_distinct(pa.array(["skipped", *texts]).slice(1), lambda w: asked.append(w) or encode._word_ids(w, tables), pairs)
        assert got.to_pylist() == [encode._word_ids(w, tables) for w in texts]
        assert all(len(w.encode()) > encode.SHORT_BYTES for w in asked) and "ä" * 33 in asked
    assert encode._ids_of_distinct(pa.array([], pa.string()), None, pairs).to_pylist() == []


def test_rules_that_need_one_merge_after_the_other_have_no_pair_table():
    m = bpe.Merge
    of = lambda *merges: encode._pair_table(bpe.Rules(BYTES_FIRST, list(merges), [bytes([b]) for b in range(256)]))
    assert of(m(b"a", b"b", 260, 1), m(b"ab", b"c", 261, 1)) is not None
    assert of(m(b"a", b"b", 260, 1), m(b"ab", b"c", 261, 1), m(b"b", b"c", 262, 1), m(b"a", b"bc", 263, 1)) is None
    assert of(m(b"ab", b"c", 260, 1), m(b"a", b"b", 261, 1)) is None
    assert of(m(b"a", b"b", 261, 1), m(b"b", b"c", 260, 1)) is None
