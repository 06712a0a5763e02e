"""An output is used again only if every condition holds."""

import pytest

from gristmill.operators.ledger import reusable_outputs

GOOD = dict(
    fingerprint="f", files_exist=True, completed=True, tokenizer_trained=True, data_tokenized=True, meta_length=256, meta_vocab=10, tokens=10
)
BAD = [
    {"fingerprint": "g"}, {"files_exist": False}, {"completed": False}, {"tokenizer_trained": False}, {"data_tokenized": False},
    {"meta_length": 128}, {"meta_vocab": 11}, {"tokens": 11}, {"meta_vocab": 9, "tokens": 9}, {"fingerprint": None}, {"files_exist": None},
]


@pytest.fixture(scope="module")
def reusable(spark):
    cases = [GOOD, *({**GOOD, **change} for change in BAD)]
    schema = (
        "corpus int, fingerprint string, files_exist boolean, completed boolean, tokenizer_trained boolean, "
        "data_tokenized boolean, meta_length int, meta_vocab int, tokens int"
    )
    rows = spark.createDataFrame([(i, *case.values()) for i, case in enumerate(cases)], schema)
    asked = spark.createDataFrame(
        [(i, "f", 256, 10) for i in range(len(cases) + 1)], "corpus int, fingerprint string, max_seq_length int, vocab_size int"
    )
    manifest = rows.select("corpus", "fingerprint", "files_exist", "completed", "tokenizer_trained", "data_tokenized")
    out = reusable_outputs(asked, manifest, rows.select("corpus", "meta_length", "meta_vocab"), rows.select("corpus", "tokens"))
    return {r.corpus: r.reusable for r in out.collect()}


def test_good_output_is_used_again(reusable):
    assert reusable[0] is True


@pytest.mark.parametrize("case", range(len(BAD)))
def test_each_condition_matters(reusable, case):
    assert reusable[case + 1] is False


def test_corpus_without_output(reusable):
    assert reusable[len(BAD) + 1] is False


def test_encoders_hold_a_few_rows_of_a_batch_at_a_time(spark):
    """Whole batches of texts as Python objects took the memory of an executor; nulls and batch borders keep their rows."""
    import pyarrow as pa
    from pyspark.sql import functions as F

    from gristmill.functions.arrays import BYTES_FIRST
    from gristmill.operators import bpe, encode

    pieces = list(encode._in_pieces(iter([pa.array(["ab"] * 150 + [None])]), lambda t: None if t is None else [1, 2]))
    assert [len(p) for p in pieces] == [64, 64, 23] and pieces[2].to_pylist()[-2:] == [[1, 2], None]
    rules = bpe.Rules(BYTES_FIRST, alphabet=[bytes([b]) for b in range(256)])
    rows = spark.range(300).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 7 > 0, F.concat(F.lit("é "), F.col("id").cast("string"))).alias("text"))
    first = BYTES_FIRST.first_byte
    want = {i: [first + b for b in f"é {i}".encode()] if i % 7 else None for i in range(300)}
    assert {r.doc_id: r.ids for r in encode.encode_whole_texts(rows, rules).collect()} == want
    assert {r.doc_id: r.ids for r in encode.encode_texts(rows, rules).collect()} == {i: ids or [] for i, ids in want.items()}


def test_first_places_are_packed_into_longs_where_the_keys_allow(spark):
    from gristmill.operators import words

    low, high = -(1 << 63), (1 << 63) - 1
    for ids, long in (([5, 7, 9], True), ([low, low + 1, low + (1 << 32) - 1], True), ([high - (1 << 32) + 1, high, None], True), ([0, 1 << 32, 3], False), ([low, high, 0], False), ([None], False)):
        docs = spark.createDataFrame(list(zip(ids, ["b a", "a a c", "c b"])), "doc_id bigint, text string")
        table = words.word_table(docs)
        want = {}
        for i, text in zip(ids, ["b a", "a a c", "c b"]):
            for at, word in enumerate(text.replace(" ", "| ").split("|")):
                place = (i, at) if i is not None else (high + 1, at)
                want[word] = (want.get(word, (0,))[0] + 1, min(place, want.get(word, (0, place))[1]))
        got = {r.word: (r.freq, (high + 1, 0) if r.first._doc is None else tuple(r.first)) for r in table.collect()}
        assert got == {w: (n, place if place[0] <= high else (high + 1, 0)) for w, (n, place) in want.items()}
        assert ("decimal(38,0)" in table._jdf.queryExecution().optimizedPlan().toString().lower()) != long


def test_words_are_looked_up_once_for_many_rows():
    """Every occurrence of a word was a Python object and a lookup of its own."""
    import pyarrow as pa

    from gristmill.operators import encode

    asked = []
    ids_of = lambda w: asked.append(w) or [len(w)] * len(w)
    rows = pa.array([["x", "xx"], None, [], ["xx", "", "x"] * 50, ["x"]])
    for part, want in ((rows, [[1, 2, 2], [], [], [2, 2, 1] * 50, [1]]), (rows.slice(1, 3), [[], [], [2, 2, 1] * 50])):
        asked.clear()
        assert encode._ids_of_rows(part, ids_of).to_pylist() == want
        assert sorted(asked) == ["", "x", "xx"]


def test_slices_are_whole_rows_of_about_so_many_words(monkeypatch):
    import pyarrow as pa

    from gristmill.operators import encode

    monkeypatch.setattr(encode, "WORDS_AT_ONCE", 4)
    rows = pa.array([["a"] * n if n is not None else None for n in (1, 2, 9, None, 0, 4, 1)])
    assert [[len(r or []) for r in part.to_pylist()] for part in encode._slices(rows)] == [[1, 2], [9], [0, 0, 4], [1]]


def test_first_pretokens_come_from_the_beginning_of_a_text(spark, monkeypatch):
    """Whole texts were taken apart for their first words; what stands at the cut must not change them."""
    import random

    from pyspark.sql import functions as F

    from gristmill.functions.text import pretokens
    from gristmill.operators import encode

    rng = random.Random(5)
    bits = ["a", "We", " ", "  ", "\n", "'", "'re", "'ll", "7", "é", "\U0001f600", "!?", "longwordlongword" * 3]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 40))) for _ in range(400)] + [None, "", " " * 90, "x" * 500 + " y z"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    for chars in (1, 2, 4):
        monkeypatch.setattr(encode, "CHARS_A_WORD", chars)
        got = rows.select(encode.first_pretokens(F.col("text"), 6).alias("got"), F.slice(pretokens(F.col("text")), 1, 6).alias("want"))
        assert got.filter(~F.col("got").eqNullSafe(F.col("want"))).collect() == []
