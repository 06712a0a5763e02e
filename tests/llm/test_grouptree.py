"""The count-vector join against comparison of all pairs."""

import random
import re

import numpy as np
import pytest

from gristmill.llm import grouptree, shingles

SCHEMA = "doc_id bigint, text string, _doc int, _n string, component_id int, _set int, _shard int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "n", 2, 3, 4) for i, t in rows], SCHEMA)


def shingle_sets(texts, width):
    out = []
    for t in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out.append({tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set())
    return out


def brute(rows, width=3, percent=90):
    sets = shingle_sets([t for _, t in rows], width)
    label = list(range(len(rows)))
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, rows[i][1] or ""))
    for x in range(len(rows)):
        for y in range(x):
            both = len(sets[x] & sets[y])
            if sets[x] and 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
                a, b = label[x], label[y]
                label = [b if v == a else v for v in label]
    first = {}
    for i in order:
        first.setdefault(label[i], rows[i][0])
    return sorted(((rows[i][0], len(sets[i]), first[label[i]]) for i in range(len(rows))), key=repr)


def family(rng, words, copies, edits):
    """A text and copies of it with up to so many words changed."""
    base = [f"w{rng.randrange(5_000)}" for _ in range(words)]
    out = []
    for _ in range(copies):
        text = list(base)
        for _ in range(rng.randrange(edits + 1)):
            text[rng.randrange(words)] = f"e{rng.randrange(10**9)}"
        out.append(" ".join(text))
    return out


def texts(seed):
    rng = random.Random(seed)
    line = " ".join(f"line{i}" for i in range(60))
    found = [f"{line} {t}" if k % 3 == 0 else t for k, t in enumerate(family(rng, 300, 25, 9) + family(rng, 40, 8, 2) + family(rng, 12, 6, 1))]
    found += [f"{line} " + " ".join(f"u{rng.randrange(10**9)}" for _ in range(rng.randrange(20, 60))) for _ in range(15)]
    found += ["", None, " \n\t", "one", "one", "ONE", "one two", "a b c", "a b c d", "Äpfel ÄPFEL äpfel x", found[0], "x " * 500]
    nine = [f"n{i}" for i in range(12)]
    return [*found, " ".join(nine[:11]), " ".join(nine)]  # 9 and 10 shingles, 9 of them common


def result(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("seed", range(2))
def test_against_all_pairs(spark, seed):
    rows = list(enumerate(texts(seed), start=5))
    assert result(grouptree.jaccard_components(frame(spark, rows).repartition(5))) == brute(rows)


@pytest.mark.parametrize("percent", [80, 90])
def test_shards_cut_into_blocks(spark, monkeypatch, percent):
    monkeypatch.setattr(grouptree, "SHARD", 5)
    rows = list(enumerate(texts(7)))
    assert result(grouptree.jaccard_components(frame(spark, rows), percent=percent)) == brute(rows, percent=percent)


def test_ids_that_repeat_or_are_null(spark):
    rows = [(None, "a b c d e f g h i j k l"), (3, "a b c d e f g h i j k l"), (3, "x"), (3, "x"), (9, None), (None, "")]
    assert result(grouptree.jaccard_components(frame(spark, rows))) == brute(rows)
    assert grouptree.jaccard_components(frame(spark, [])).collect() == []


def test_long_texts(spark):
    words = [f"w{i}" for i in range(60_000)]
    rows = [(1, " ".join(words)), (2, " ".join([*words[:30_000], "other", *words[30_000:]])), (3, " ".join(words[:50_000]))]
    assert [r[2] for r in result(grouptree.jaccard_components(frame(spark, rows)))] == [1, 1, 3]


@pytest.mark.parametrize("percent", [60, 90])
def test_tree_leaves_every_pair_whose_bound_allows_it(percent):
    draw = np.random.default_rng(percent)
    points = draw.integers(0, 4, (700, grouptree.GROUPS)).astype(np.int32)
    points[350:] = np.maximum(points[:350] - (draw.random((350, grouptree.GROUPS)) < 0.06), 0)
    got = {tuple(sorted((int(a), int(b)))) for i, j in grouptree.CountTree(points, percent).pairs() for a, b in zip(i, j)}
    size, want = points.sum(axis=1), set()
    for a in range(len(points)):
        both = np.minimum(points[a], points[a + 1 :]).sum(axis=1)
        other = size[a + 1 :]
        fits = (both * (100 + percent) >= percent * (size[a] + other)) & (100 * np.minimum(size[a], other) >= percent * np.maximum(size[a], other))
        want |= {(a, a + 1 + int(b)) for b in np.flatnonzero(fits)}
    assert got == want and len(want) > 100


def test_prefix_length_is_enough():
    for percent in (80, 85, 90):
        for n in range(1, 60):
            least = min((k for m in range(1, 80) for k in range(1, min(n, m) + 1) if (n, m) != (k, k) and 100 * k >= percent * (n + m - k)), default=None)
            assert grouptree.prefix_length(n, percent) == 0 if least is None else grouptree.prefix_length(n, percent) >= n - least + 1


def test_word_hashes_do_not_depend_on_segments(monkeypatch):
    text = "one  two\nthree " + "x" * 50 + " last\t"
    raw = np.frombuffer(text.encode(), np.uint8)
    whole = shingles.word_hashes(raw)
    assert len(whole) == 5
    for segment in (1, 2, 3, 7, 10, 64):
        monkeypatch.setattr(shingles, "SEGMENT", segment)
        shingles._powers.cache_clear()
        assert (shingles.word_hashes(raw) == whole).all()
    monkeypatch.undo()
    shingles._powers.cache_clear()
