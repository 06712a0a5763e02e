"""Unigram training by plain enumeration, with all seeds and rounds."""

import math
from collections import Counter

import __spark_entry__ as entry_point
from gristmill.functions import text as X
from gristmill.operators import unigram, words
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def segmentations(word, share, longest=16):
    """(pieces, probability) of every way to cut a word."""
    if not word:
        return [([], 1.0)]
    return [
        ([word[:n], *rest], share[word[:n]] * p)
        for n in range(1, min(longest, len(word)) + 1) if word[:n] in share for rest, p in segmentations(word[n:], share, longest)
    ]


def by_hand(freq, room, size, rounds, longest=16, least=0.5, keep=0.75):
    seeds = Counter()
    for w, n in freq.items():
        for i in range(len(w)):
            for j in range(i + 1, min(len(w), i + longest) + 1):
                seeds[w[i:j]] += n
    many = sorted((p for p, n in seeds.items() if len(p) > 1 and n > 1), key=lambda p: (-seeds[p] * len(p), p))
    counts = {p: float(n) for p, n in seeds.items() if len(p) == 1} | {p: float(seeds[p]) for p in many[:size]}
    while True:
        for _ in range(rounds):
            total = sum(counts.values())
            share, found = {p: c / total for p, c in counts.items()}, Counter()
            for w, n in freq.items():
                ways = segmentations(w, share, longest)
                every = sum(p for _, p in ways)
                for pieces, p in ways:
                    for piece in pieces:
                        found[piece] += n * p / every
            counts = {p: max(round(found[p], 6), 1e-9) for p in counts if len(p) == 1 or round(found[p], 6) >= least}
        ranked = sorted(counts, key=lambda p: (-counts[p], p))
        if len(ranked) <= room or all(len(p) == 1 for p in ranked):
            total = sum(counts.values())
            return {p: math.log(c / total) for p, c in counts.items()}
        single = [p for p in ranked if len(p) == 1]
        longer = [p for p in ranked if len(p) > 1][: max(0, max(room, int(len(ranked) * keep)) - len(single))]
        counts = {p: counts[p] for p in [*single, *longer]}


def test_training_by_enumeration(spark):
    freq = {"lower": 5, "lowest": 3, "newer": 6, "newest": 4, "slow": 2, "wide": 3, "widest": 2, "low": 7}
    table = spark.createDataFrame(list(freq.items()), "word string, freq bigint")
    for size, rounds in ((100_000, 2), (12, 1)):
        got = {r.piece: r.logp for r in unigram.train_unigram(table, 24, seed_size=size, em_rounds=rounds).collect() if r.logp is not None}
        want = by_hand(freq, 20, size, rounds)
        assert set(got) == set(want) and all(abs(got[p] - want[p]) < 1e-4 for p in want)


def test_registered_training_takes_the_defaults(spark, monkeypatch):
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    table = words.word_table(frame, X.plain_words(F.col("text")))
    seeds = unigram.substring_counts(table).filter("length(piece) > 1 and freq > 1").count()
    assert seeds > 4_000
    taken, pieces = [], unigram.seed_pieces
    rounds, count = [], unigram.expected_counts
    monkeypatch.setattr(unigram, "seed_pieces", lambda t, size, *a: taken.append(size) or pieces(t, size, *a))
    monkeypatch.setattr(unigram, "expected_counts", lambda t, shares: rounds.append(len(shares)) or count(t, shares))
    rows = entry_point.queries()["K04_unigram_train"](spark, SF).collect()
    singles = table.select(F.explode(F.split("word", "")).alias("c")).filter("c <> ''").distinct().count()
    assert taken == [100_000] and rounds[0] == singles + min(seeds, 100_000) and len(rounds) % 2 == 0
    assert len(rows) <= 3_000 and [r.id for r in rows] == list(range(len(rows)))


def test_expected_counts_need_no_piece_table(spark, monkeypatch):
    freq = {"lower": 5, "lowest": 3, "newer": 6, "你好嗎": 4, "x": 1}
    table = spark.createDataFrame(list(freq.items()), "word string, freq bigint")
    counts = unigram.substring_counts(table, 3).filter("length(piece) = 1 or freq > 1")
    shares = unigram.log_shares({r.piece: float(r.freq) for r in counts.collect()})
    want = {r.piece: r.expected for r in unigram.expected_counts(table, shares).collect()}
    got = {r.piece: r.expected for r in unigram.expected_counts_of_table(table, counts, 3).collect()}
    assert set(got) == set(want) and all(abs(got[p] - want[p]) < 1e-9 for p in want)

    def refuse(*_):
        raise AssertionError("the pieces came to the driver")

    monkeypatch.setattr(unigram, "log_shares", refuse)
    assert entry_point.queries()["K04_expected_counts"](spark, SF).count() > 100


def test_pieces_are_found_once_and_dropped_later(spark, monkeypatch):
    freq = {"lower": 5, "newest": 4, "": 9, "你好嗎😀": 4, "q": 2, "ab" * 2_000: 3}
    table = spark.createDataFrame(list(freq.items()), "word string, freq bigint")
    pieces = {"lo": 3.0, "low": 2.0, "e": 5.0, "er": 1.0, "w": 2.0, "n": 1.0, "es": 1.0, "t": 1.0, "s": 1.0, "你": 1.0, "好嗎": 2.0, "😀": 1.0, "a": 1e-9, "b": 1e-9, "ab": 1e-9}
    whole = unigram.lattice(table, pieces)
    for known in (pieces, {p: c for p, c in pieces.items() if p not in ("er", "ab")}, {"e": 1.0}):
        shares = unigram.log_shares(known)
        want = Counter()
        for word, n in freq.items():
            for piece, share in unigram._expected(word, shares, 3):
                want[piece] += n * share
        for given in (table, whole, unigram.written(whole, known)):
            got = {r.piece: r.expected for r in unigram.expected_counts(given, shares).collect()}
            assert set(got) == set(want) and all(math.isclose(got[p], want[p], rel_tol=1e-9) for p in want)

    found, find = [], unigram.lattice
    monkeypatch.setattr(unigram, "lattice", lambda t, p: found.append(len(p)) or find(t, p))
    unigram.train_unigram(table, 14, seed_size=1_000)
    assert len(found) == 1


def test_pieces_of_a_word_are_told_apart_without_an_aggregate(spark):
    freq = {"banana": 2, "anna": 3, "": 1, "😀a😀a": 5}
    table = spark.createDataFrame(list(freq.items()), "word string, freq bigint")
    counts = unigram.substring_counts(table, 3).filter("length(piece) = 1 or freq > 1")
    shares = unigram.log_shares({r.piece: float(r.freq) for r in counts.collect()})
    want = {r.piece: r.expected for r in unigram.expected_counts(table, shares).collect()}
    frame = unigram.expected_counts_of_table(table, counts, 3)
    got = {r.piece: r.expected for r in frame.collect()}
    assert set(got) == set(want) and all(abs(got[p] - want[p]) < 1e-9 for p in want)
    # Nothing is grouped by word, count and piece at once.
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Aggregate [word" in line and "piece" in line.split("]")[0]]
