"""Both kinds of rounds of merge learning against one merge at a time."""

import random

import pytest

from gristmill.operators import bpe, words
from gristmill.operators.bpe import merge_ahead


def corpus(spark, seed, letters="abcd", n=80):
    rng = random.Random(seed)
    texts = [" ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(12)) for _ in range(n)]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def listed(rules):
    return [(m.left, m.right, m.id, m.freq) for m in rules.merges]


@pytest.mark.parametrize("ahead,pairs", [(0, 1), (60, 1)])
def test_rounds_agree_with_one_merge_at_a_time(spark, monkeypatch, ahead, pairs):
    table = words.word_table(corpus(spark, 11)).cache()
    want = listed(bpe.train_bpe(table, 260 + 12, batch=False))
    monkeypatch.setattr(bpe, "AHEAD", ahead)
    monkeypatch.setattr(bpe, "AHEAD_PAIRS", pairs)
    monkeypatch.setattr(bpe, "CANDIDATES", 12)  # the list ends early, so its floor counts
    assert listed(bpe.train_bpe(table, 260 + 12)) == want


def test_wordpieces_ahead(spark, monkeypatch):
    table = words.word_table(corpus(spark, 12, "ab", 20)).cache()
    want = listed(bpe.train_wordpiece(table, 0, merges=12))
    monkeypatch.setattr(bpe, "AHEAD", 0)
    assert listed(bpe.train_wordpiece(table, 0, merges=12)) == want


def naive(split, limit):
    """One merge at a time over (symbols, freq), ties by first place."""
    split, out = [(list(w), f) for w, f in split], []
    for k in range(limit):
        count, first = {}, {}
        for i, (w, f) in enumerate(split):
            for j, p in enumerate(map(str.__add__, w, w[1:])):
                count[p] = count.get(p, 0) + f
                first.setdefault(p, (i, j))
        if not count:
            break
        pair = min(count, key=lambda p: (-count[p], first[p]))
        out.append((pair, count[pair]))
        symbol = chr(0x4E00 + k)
        split = [(list("".join(w).replace(pair, symbol)), f) for w, f in split]
    return out


@pytest.mark.parametrize("seed", range(6))
def test_merge_ahead_on_plain_lists(seed):
    rng = random.Random(seed)
    split = [("".join(rng.choice("aab" if seed % 2 else "abcde") for _ in range(rng.randint(2, 9))), rng.randint(1, 4)) for _ in range(60)]
    count: dict[str, int] = {}
    for w, f in split:
        for p in map(str.__add__, w, w[1:]):
            count[p] = count.get(p, 0) + f
    order = sorted(count.items(), key=lambda x: -x[1])
    taken = []

    def merge(pair, freq):
        taken.append((pair, freq))
        return chr(0x4E00 + len(taken) - 1), True

    changed = merge_ahead(split, order, len(order), 0, merge, 25, "first")
    assert taken == naive(split, 25)
    for i, (w, _) in enumerate(split):
        for k, (pair, _) in enumerate(taken):
            w = w.replace(pair, chr(0x4E00 + k))
        assert changed.get(i, split[i][0]) == w


def test_merge_ahead_stops_where_others_may_come_first():
    taken = []

    def merge(pair, freq):
        taken.append((pair, freq))
        return chr(0x4E00 + len(taken)), True

    merge_ahead([("abx", 5), ("aby", 3)], [("ab", 8), ("cd", 6), ("by", 3)], 1, 2, merge, 9, "first")
    assert taken == [("ab", 8)]  # what is left has 5 at most, and cd has 6
    taken.clear()
    merge_ahead([("abx", 5)], [("ab", 5)], 1, 5, merge, 9, "first")
    assert taken == []  # a pair that isn't listed may be as frequent
