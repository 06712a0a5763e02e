"""Properties: same result by another way, after repartitioning, or after a round trip."""

import base64
import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gristmill.functions import arrays as A
from gristmill.functions import text as X
from gristmill.operators import bpe, corpus, encode, ledger, split, unigram, words
from gristmill.plans.preprocess import preprocess

SF = "/root/testdata/sf0.001"


def one_at_a_time(counts: dict[str, int], wanted: int):
    """Plain merge learning over words in first-seen order."""
    parts = {w: [bytes([b]) for b in w.encode()] for w in counts}
    out = []
    for _ in range(wanted):
        pairs: Counter = Counter()
        for w, n in counts.items():
            for pair in zip(parts[w], parts[w][1:]):
                pairs[pair] += n
        if not pairs:
            break
        best = max(pairs, key=pairs.get)
        out.append((*best, pairs[best]))
        for w, p in parts.items():
            new: list[bytes] = []
            for s in p:
                if new and new[-1:] == [best[0]] and s == best[1] and not getattr(new, "joined", False):
                    new[-1] = _Joined(best[0] + best[1])
                else:
                    new.append(s)
            parts[w] = [bytes(s) for s in new]
    return out


class _Joined(bytes):
    """A symbol made in this pass; it takes no part in a further merge of the pass."""

    def __eq__(self, other):
        return False

    __hash__ = bytes.__hash__


@pytest.mark.parametrize("seed", range(3))
def test_batched_merges_equal_single_merges(spark, seed):
    rng = random.Random(seed)
    texts = [" ".join("".join(rng.choice("abc" if seed else "a") for _ in range(rng.randint(1, 7))) for _ in range(12)) for _ in range(6)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    counts: dict[str, int] = {}
    for i, t in enumerate(texts):
        for w in spark.createDataFrame([(t,)], "t string").select(X.pretokens(F.col("t"))).first()[0]:
            counts[w] = counts.get(w, 0) + 1
    rules = bpe.train_bpe(words.word_table(docs), 260 + 25)
    assert [(m.left, m.right, m.freq) for m in rules.merges] == one_at_a_time(counts, 25)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")


@pytest.fixture(scope="module")
def rules(spark, docs):
    return bpe.train_bpe(words.word_table(docs), 260 + 60)


def test_three_encoders_and_decode(docs, rules):
    a = encode.encode_texts(docs, rules)
    b = encode.encode_by_distinct_word(docs, rules)
    report = encode.agreement_report(encode.agreement(a, b, "doc_id", "ids")).first()
    assert report.total == report.matches == docs.count() and report.rate == 1.0
    for encoded in (a, encode.encode_whole_texts(docs, rules)):
        assert encoded.filter(encode.decoded(F.col("ids"), rules) != F.col("text")).isEmpty()


def test_distinct_word_encoding_with_hot_words(docs, rules, monkeypatch):
    monkeypatch.setattr(encode, "BROADCAST_ROWS", 10)
    monkeypatch.setattr(encode, "HOT_WORDS", 7)
    split_join = encode.encode_by_distinct_word(docs, rules)
    assert encode.agreement_report(encode.agreement(encode.encode_texts(docs, rules), split_join, "doc_id", "ids")).first().mismatches == 0


def test_empty_text_keeps_its_row(spark, rules):
    df = spark.createDataFrame([(1, ""), (2, "x")], "doc_id bigint, text string")
    assert {r.doc_id: r.ids for r in encode.encode_by_distinct_word(df, rules).collect()} == {1: [], 2: [120]}


def test_agreement_of_no_rows(spark):
    none = spark.createDataFrame([], "k int, v int")
    assert encode.agreement_report(encode.agreement(none, none, "k", "v")).first().rate == 0.0


@pytest.mark.parametrize("parts", [1, 7])
def test_partitioning_changes_nothing(docs, parts):
    df = docs.repartition(parts)
    first = words.word_table(df).orderBy("word").collect()
    assert first == words.word_table(docs).orderBy("word").collect()
    assert sorted(split.permute(df.select("doc_id"), "doc_id").collect()) == sorted(split.permute(docs.select("doc_id"), "doc_id").collect())


def test_splits_are_disjoint_and_whole(docs):
    out = split.ratio_split(docs, "doc_id", 0.5, 0.3)
    assert out.count() == docs.count() == out.select("doc_id").distinct().count()


def test_cap_before_blank_filter_and_empty_guard(spark):
    rows = [(i, "  \x1c") for i in range(5)] + [(9, "text"), (10, "​")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(r.doc_id for r in corpus.nonblank(df).collect()) == [9, 10]
    assert [r.doc_id for r in corpus.nonblank(corpus.cap_rows(df, "doc_id", 6)).collect()] == [9]
    with pytest.raises(corpus.EmptyCorpus):
        corpus.require_rows(corpus.nonblank(corpus.cap_rows(df, "doc_id", 3)))
    assert corpus.cap_rows(df, "doc_id", 0).count() == corpus.cap_rows(df, "doc_id", None).count() == 7


def test_cap_needs_a_unique_key(spark):
    twice = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "doc_id bigint, text string")
    with pytest.raises(ValueError, match="not unique"):
        corpus.cap_rows(twice, "doc_id", 1)
    assert corpus.cap_rows(twice, "doc_id", 2).count() == 2


def test_split_inside_equal_leading_bits(spark, monkeypatch):
    df = spark.range(40)
    want = {r.id: r["split"] for r in split.ratio_split(df, "id", 0.5, 0.25).collect()}
    monkeypatch.setattr(split, "_leading_bits", lambda h: F.conv(F.substring(h, 1, 15), 16, 10).cast("bigint") * 0 + 7)
    assert {r.id: r["split"] for r in split.ratio_split(df, "id", 0.5, 0.25).collect()} == want


def test_text_column_choice(spark):
    schema = spark.createDataFrame([], "id int, sentence string, content string").schema
    assert corpus.pick_text_column(schema) == "content"
    assert corpus.as_corpus(spark.createDataFrame([(1, 2)], "a int, b int"), "a").first().text is None


def test_byte_views(spark):
    text = "hé 你\n\U0001f600"
    row = spark.createDataFrame([(text,)], "t string").select(
        X.utf8_bytes(F.col("t")).alias("b"), X.printable_bytes(F.col("t")).alias("p"), X.utf8_bytes(F.lit("")).alias("e")
    ).first()
    assert b"".join(bytes(x) for x in row.b) == text.encode() and row.e == []
    assert len(row.p) == len(text.encode()) and " " not in row.p and "\n" not in row.p


def test_byte_level_alphabet_matches_the_tokenizers_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    assert {chr(c) for c in X.printable_code_points()} == set(tokenizers.pre_tokenizers.ByteLevel.alphabet())


def test_wordpiece_and_unigram_cover_the_corpus(spark, docs):
    table = words.word_table(docs, X.plain_words(F.col("text")))
    pieces = bpe.train_wordpiece(table, 0, merges=15)
    vocab = pieces.vocabulary()
    ids = table.select("word", unigram.wordpiece_encoder(spark, pieces)(F.col("word")).alias("ids")).collect()
    for r in ids:
        tokens = [vocab[i].decode() for i in r.ids]
        assert tokens[0] + "".join(t[2:] for t in tokens[1:]) == r.word
    uni = unigram.train_unigram(table, 1500, seed_size=2500, em_rounds=1)
    assert uni.count() <= max(1500, uni.filter("length(piece) = 1").count() + 4)
    by_id = {r.id: r.piece for r in uni.collect()}
    for r in table.select("word", unigram.unigram_encoder(spark, uni)(F.col("word")).alias("ids")).collect():
        assert "".join(by_id[i] for i in r.ids) == r.word
    unseen = spark.createDataFrame([("你",)], "word string")
    assert unseen.select(unigram.unigram_encoder(spark, uni)(F.col("word"))).first()[0] == [3]


def test_300_merges_of_the_corpus(spark, docs):
    counts: dict[str, int] = {}
    for r in docs.select("doc_id", X.pretokens(F.col("text")).alias("w")).orderBy("doc_id").collect():
        for w in r.w:
            counts[w] = counts.get(w, 0) + 1
    rules = bpe.train_bpe(words.word_table(docs), 260 + 300)
    assert [(m.left, m.right, m.freq) for m in rules.merges] == one_at_a_time(counts, 300)


def test_whole_preprocessing(spark, tmp_path):
    source = spark.read.parquet(f"{SF}/documents.parquet")
    out = preprocess(source, "doc_id", str(tmp_path / "out"), vocab_size=280, length=32)
    records = spark.read.parquet(f"{out}/records")
    assert {r["split"]: r["n"] for r in split.split_sizes(records, "input_ids").collect()} == {"train": 180, "val": 10, "test": 10}
    assert records.filter(F.size("input_ids") != 32).isEmpty()
    meta = json.loads(next((tmp_path / "out" / "meta").glob("part-*.json")).read_text())
    assert (meta["vocab_size"], meta["train_samples"], meta["pad_token_id"]) == (280, 180, 256)
    vocab = {r.id: bytes(r.token) for r in spark.read.parquet(f"{out}/rules/vocab").collect()}
    assert vocab[256] == b"<PAD>" and vocab[97] == b"a" and len(vocab) == 280
    assert base64.b64encode(vocab[98]) == b"Yg=="


def test_preprocessing_is_reused_and_resumed(spark, tmp_path, monkeypatch):
    from gristmill.plans import preprocess as job

    source = spark.createDataFrame([(f"k{i}", f"some text number {i}") for i in range(40)], "name string, text string")
    args = {"key": "name", "out": str(tmp_path / "out"), "vocab_size": 265, "length": 12}

    def broken(*_):
        raise OSError("disk full")

    with monkeypatch.context() as m:
        m.setattr(job, "write_records", broken)
        with pytest.raises(OSError):
            preprocess(source, **args)
    assert job.read_state(spark, args["out"])["tokenizer_trained"]
    with monkeypatch.context() as m:
        m.setattr(job, "learn_vocabulary", broken)  # not needed again
        preprocess(source, **args)
        before = sorted((p, p.stat().st_mtime_ns) for p in (tmp_path / "out").rglob("*"))
        m.setattr(job, "write_records", broken)
        preprocess(source, **args)
    assert sorted((p, p.stat().st_mtime_ns) for p in (tmp_path / "out").rglob("*")) == before
    fewer = source.filter("name <> 'k3'")
    preprocess(fewer, **args)
    assert spark.read.parquet(f"{args['out']}/records").count() == 39


def test_word_table_of_any_key(spark):
    rows = [(-5, "b a"), (3, "a a b"), (7, "c"), (2**63 - 1, "d"), (-(2**63), "d e")]
    for kind in ("bigint", "string"):
        df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("doc_id", F.col("doc_id").cast(kind))
        table = words.word_table(df, F.split("text", " "))
        got = {r.word: (r.freq, int(r["first"]["_doc"]), r["first"]["_pos"]) for r in table.collect()}
        assert {w: g[0] for w, g in got.items()} == {"a": 3, "b": 2, "c": 1, "d": 2, "e": 1}
        if kind == "bigint":
            assert got["a"][1:] == (-5, 1) and got["d"][1:] == (-(2**63), 0) and got["c"][1:] == (7, 0)
            assert "SortAggregate" not in table._jdf.queryExecution().toString()


def test_nothing_is_cut_by_default(spark):
    from gristmill.plans.preprocess import learn_vocabulary, model_records, usable_texts

    source = spark.createDataFrame([(i, f"word{i} " + "zz " * 50) for i in range(30)], "doc_id bigint, text string")
    texts = usable_texts(source, "doc_id")
    assert texts.count() == 30
    rules = learn_vocabulary(texts, 262)
    assert rules.merges[0].freq == 30 * 50  # a space and a z come first of the pairs that are as frequent
    short = {r.doc_id: r.input_ids for r in model_records(texts, rules, 16).collect()}
    whole = encode.encode_texts(texts, rules).withColumn("input_ids", A.pad_to(F.col("ids"), 16, rules.layout))
    assert short == {r.doc_id: r.input_ids for r in whole.collect()}


def test_expected_piece_counts_by_enumeration(spark):
    import math

    logp = {p: math.log(w) for p, w in {"a": 0.3, "b": 0.2, "ab": 0.25, "ba": 0.1, "aba": 0.05}.items()}

    def segmentations(word):
        if not word:
            yield []
        for n in range(1, len(word) + 1):
            if word[:n] in logp:
                for rest in segmentations(word[n:]):
                    yield [word[:n], *rest]

    want: Counter = Counter()
    counted = [("abab", 3), ("aba", 2), ("bbb", 1), ("axb", 5)]
    for word, n in counted:
        all_of = [(s, math.exp(sum(logp[p] for p in s))) for s in segmentations(word)]
        total = sum(w for _, w in all_of)
        for s, w in all_of:
            for p in s:
                want[p] += n * w / total
    df = spark.createDataFrame(counted, "word string, freq bigint")
    got = {r.piece: r.expected for r in unigram.expected_counts(df, logp).collect()}
    assert got == pytest.approx(dict(want))


def test_the_recommended_tier_is_kept_without_sorting(spark):
    """The least of a struct with a name in it can't be kept in place, so Spark sorted all of a task's rows."""
    rows = [(1, "H100", 5, True), (1, "A10G", 2, True), (1, "T4", 1, False), (2, "T4", 1, False), (3, "A100-40GB", 3, True), (4, "T4", 1, None)]
    sweep = spark.createDataFrame(rows, "p int, gpu string, gpu_order int, within_safety boolean")
    out = ledger.recommended_gpu(sweep, "p")
    assert {r.p: r.gpu for r in out.collect()} == {1: "A10G", 2: "T4", 3: "A100-40GB", 4: "T4"}
    assert "Sort" not in out._jdf.queryExecution().executedPlan().toString()


def test_key_difference_reads_each_side_once_and_sorts_nothing(spark):
    """Two anti joins computed and sorted both sides twice."""
    left = spark.createDataFrame([(1,), (1,), (2,), (2,), (None,)], "k bigint")
    right = spark.createDataFrame([(2,), (3,), (None,), (None,)], "k bigint")
    out = ledger.key_difference(left, right, "k", "a", "b")
    assert Counter(map(tuple, out.collect())) == Counter({(1, "a"): 2, (3, "b"): 1, (None, "a"): 1, (None, "b"): 2})
    big = ledger.key_difference(spark.range(10).toDF("k"), spark.range(5).toDF("k"), "k")
    plan = big._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Sort" not in plan and plan.count("Range (") == 2


@pytest.mark.parametrize("most", [1_000, 3])
def test_distinct_words_are_counted_and_encoded_once(spark, monkeypatch, most):
    """The texts were taken apart for the count, for the hot words and for the join again."""
    rows = [(i, f"word{i % 7} and word{i % 3} or {i}") for i in range(40)]
    texts = spark.createDataFrame(rows, "doc_id bigint, text string")
    rules = bpe.train_bpe(words.word_table(texts), 270)
    monkeypatch.setattr(encode, "BROADCAST_ROWS", most)
    monkeypatch.setattr(encode, "HOT_WORDS", 2)
    cut = []
    monkeypatch.setattr(encode, "cut_lineage", lambda df, keep=encode.cut_lineage: cut.append(df.columns) or keep(df))
    got = encode.encode_by_distinct_word(texts, rules)
    assert cut == [["word", "freq", "ids"]]
    plan = got._jdf.queryExecution().analyzed().toString()
    assert plan.count("regexp_extract_all") == (1 if most > 3 else 2)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, encode.encode_texts(texts, rules).select("doc_id", "ids").collect()))
