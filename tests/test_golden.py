"""Fixed expected values."""

import pytest
from pyspark.sql import functions as F

from gristmill.functions import arrays as A
from gristmill.functions import scalars as S
from gristmill.operators import bpe, ledger, sampling, split, words
from gristmill.operators.encode import decoded, text_encoder, encode_texts

CORPUS = [(0, "low low lower lowest"), (1, "newer newest")]


@pytest.fixture(scope="module")
def lows(spark):
    return spark.createDataFrame(CORPUS, "doc_id bigint, text string")


def merges(rules):
    return [(m.left, m.right, m.id, m.freq) for m in rules.merges]


EXPECTED = [
    (b"l", b"o", 260, 4), (b"lo", b"w", 261, 4), (b" ", b"low", 262, 3), (b" low", b"e", 263, 2),
    (b"s", b"t", 264, 2), (b"n", b"e", 265, 2),
]


@pytest.mark.parametrize("batch", [True, False])
def test_first_merges(lows, batch):
    assert merges(bpe.train_bpe(words.word_table(lows), 266, batch=batch)) == EXPECTED


def test_training_stops_without_pairs(spark):
    one = spark.createDataFrame([(0, "a b")], "doc_id bigint, text string")
    rules = bpe.train_bpe(words.word_table(one), 400)
    assert merges(rules) == [(b" ", b"b", 260, 1)]


def test_encode_with_specials(spark, lows):
    rules = bpe.train_bpe(words.word_table(lows), 263)
    text = spark.createDataFrame([(0, "low lower")], "doc_id bigint, text string")
    row = encode_texts(text, rules).select(A.wrap(F.col("ids"), rules.layout).alias("ids")).first()
    assert row.ids == [258, 261, 262, 101, 114, 259]


def test_later_rule_wins_for_equal_bytes(spark):
    rules = bpe.Rules(A.BYTES_FIRST, alphabet=[bytes([b]) for b in range(256)])
    rules.merges = [bpe.Merge(b"a", b"b", 260, 1), bpe.Merge(b"ab", b"c", 261, 1), bpe.Merge(b"b", b"c", 262, 1), bpe.Merge(b"a", b"bc", 263, 1)]
    got = spark.range(1).select(text_encoder(spark, rules)(F.array(F.lit("abc"))).alias("i")).first().i
    assert got == [263]


def test_decode_skips_specials_and_repairs_utf8(spark):
    rules = bpe.Rules(A.BYTES_FIRST, alphabet=[bytes([b]) for b in range(256)])
    samples = [b"ok", b"\xc3", b"a\xe2\x82z", b"\xff\xfeq", b"\xf0\x9f\x98\x80", b"\xe2\x28\xa1"]
    rows = [(i, [258, *s, 9999, 259]) for i, s in enumerate(samples)]
    out = spark.createDataFrame(rows, "k int, ids array<int>").select("k", decoded(F.col("ids"), rules).alias("t")).collect()
    assert {r.k: r.t for r in out} == {i: s.decode("utf-8", "replace") for i, s in enumerate(samples)}


@pytest.mark.parametrize("n,sizes", [
    (5000, (4500, 250, 250)), (500, (450, 25, 25)), (200, (180, 10, 10)), (1000, (900, 50, 50)), (7, (6, 0, 1)), (1, (0, 0, 1)),
])
def test_split_sizes(spark, n, sizes):
    rows = split.ratio_split(spark.range(n), "id").groupBy("split").count().collect()
    counts = {r["split"]: r["count"] for r in rows}
    assert tuple(counts.get(s, 0) for s in ("train", "val", "test")) == sizes


@pytest.mark.parametrize("n,digest", [(5000, "ddae5253a7c1e44d"), (500, "b92cdcc5d653ae89")])
def test_fingerprint(spark, n, digest):
    ratios = S.ratios_text(F.lit(0.9), F.lit(0.05), F.lit(0.05))
    parts = [F.lit("roneneldan/TinyStories"), ratios, *[F.lit(str(x)) for x in (256, 10000, n, 42, 2)]]
    assert spark.range(1).select(S.fingerprint(*parts)).first()[0] == digest


def test_padding_and_labels(spark):
    df = spark.createDataFrame([(0, [32, 72, 66, 5]), (1, [32])], "k int, ids array<int>")
    padded = df.select("k", A.pad_to(F.col("ids"), 5, A.SPECIALS_FIRST).alias("x"))
    out = {r.k: r for r in padded.select("k", "x", A.model_input(F.col("x"), 0).alias("r")).collect()}
    assert out[0].x == [1, 32, 72, 66, 2]
    assert (out[1].x, out[1].r.attention_mask, out[1].r.labels) == ([1, 32, 2, 0, 0], [1, 1, 1, 0, 0], [1, 32, 2, -1, -1])
    pairs = padded.filter("k = 1").select(F.inline(A.next_token_pairs(F.col("x"), A.label_ids(F.col("x"), 0)))).collect()
    assert [tuple(p) for p in pairs] == [(1, 32), (32, 2), (2, -1), (0, -1)]


PROFILES = [
    ("default", 10000, 384, 6, 1536, 50000, 18.0, (2.29, 2.02, 2.75, 3.06, 2.86)),
    ("small", 32000, 512, 8, 2048, 20000, 49.9, (0.92, 0.81, 1.10, 1.22, 1.15)),
    ("medium", 50000, 768, 16, 3072, 50000, 189.4, (4.34, 3.82, 5.21, 5.79, 5.43)),
    ("large", 50000, 1024, 24, 4096, 75000, 453.9, (13.75, 12.10, 16.50, 18.33, 17.19)),
    ("xlarge", 50000, 1280, 28, 5120, 90000, 798.0, (16.50, 14.52, 19.80, 22.00, 20.625)),
]


def test_cost_sweep(spark):
    rows = [(p[0], *p[1:6], 1024, 0.0) for p in PROFILES]
    names = "profile string, vocab_size int, d_model int, num_layers int, d_ff int, max_steps int, seq_len int, spent double"
    out = ledger.cost_sweep(spark.createDataFrame(rows, names), 30.0).collect()
    for name, *_, params, costs in PROFILES:
        mine = sorted((r for r in out if r.profile == name), key=lambda r: r.gpu_order)
        assert {r.params_m for r in mine} == {params}
        assert [r.cost for r in mine] == pytest.approx(costs, abs=0.0051)


def test_budget_warning_text(spark):
    cols = S.budget_columns(F.lit(28.0), F.lit(0.0), F.lit(30.0))
    row = spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()
    assert row.within_budget and not row.within_safety
    assert row.warning == "Cost $28.00 exceeds safety margin. Only $27.00 available (90% of budget)."
    high = S.budget_columns(F.lit(25.0), F.lit(0.0), F.lit(30.0))["warning"]
    assert spark.range(1).select(high).first()[0] == "Warning: This will use 83.3% of monthly budget."


@pytest.mark.parametrize("step,lr", [(1, 3e-7), (500, 1.5e-4), (1000, 3e-4), (25500, 1.55000192e-4), (50000, 1.0e-5)])
def test_expected_lr(spark, step, lr):
    got = spark.range(1).select(S.expected_lr(F.lit(step), 3e-4, 1000, 50000)).first()[0]
    assert got == pytest.approx(lr, rel=1e-6)


def test_lr_without_decay_length_is_null(spark):
    assert spark.range(1).select(S.expected_lr(F.lit(7), 3e-4, 5, 5)).first()[0] is None


def test_sampling(spark):
    scored = spark.createDataFrame([(0, t, float(x)) for t, x in {1: 2, 2: 1, 3: 1, 4: 0, 5: -1}.items()], "seq_id int, token_id int, logit double")
    kept = sampling.softmax(sampling.top_k(scored, 2))
    probs = {r.token_id: r.prob for r in kept.collect()}
    assert probs == pytest.approx({1: 0.576117, 2: 0.211942, 3: 0.211942}, abs=1e-6)
    assert [r.token_id for r in sampling.top_p(kept, 0.5).collect()] == [1]
    assert sampling.greedy(scored).first().token_id == 1


def test_batch_fit_when_weights_do_not_fit(spark):
    big = S.fitting_batch(F.lit(50000), F.lit(8192), F.lit(80), F.lit(32768), F.lit(1024), F.lit(16))
    assert spark.range(1).select(big).first()[0] is None
