"""Embedding whitening against numpy's symmetric eigensolver, and on odd rows."""

import math
import random

import numpy as np
import pytest

from gristmill.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, label int, component string, _x int, _id int"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, None, "c", 1, 2) for i, v in vectors], SCHEMA)


def brute(vectors, k=4):
    """{(id, component): (deviation, whitened)}, shares and n, by the definition."""
    x = {i: [math.floor(256 * float(np.float32(c))) for c in v] for i, v in vectors}
    fit = np.array(sorted({tuple(v) for v in x.values()}))
    n, sums = len(fit), fit.sum(axis=0)
    centred = (n * fit - sums) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    out = {}
    for i, v in x.items():
        off = (n * np.array(v) - sums) / n
        out[i] = int(((n * np.array(v, object) - sums) ** 2).sum()), (off @ axes[:, :k]) / np.sqrt(values[:k])
    return out, values[:k] / values.sum(), n


def compare(rows, vectors, k):
    want, shares, n = brute(vectors, k)
    got = {(r.vec_id, r.component): r for r in rows}
    assert sorted(got) == sorted((i, c) for i in want for c in range(1, k + 1))
    for c in range(1, k + 1):
        a = np.array([got[i, c].whitened for i in want])
        b = np.array([want[i][1][c - 1] for i in want])
        assert np.abs(a - b * np.sign(a @ b)).max() < 1e-9
    for (i, c), r in got.items():
        assert r.n == n and r.deviation == want[i][0] and r.identity_error < 1e-9
        assert math.isclose(r.explained, shares[c - 1], rel_tol=1e-9)


def test_against_eigh_with_copies_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 1)  # many blocks
    draw = np.random.default_rng(5)
    base = (draw.standard_normal((150, 6)) * [3, 2, 1, 0.5, 0.2, 0.1]).astype(np.float32)
    vectors = [(i, base[i % 120].tolist()) for i in range(150)]
    odd = [(500, None), (501, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (502, [math.nan] * 6), (503, [math.inf] * 6), (504, [1.0]), (505, [])]
    compare(whitening.whiten(frame(spark, vectors + odd).repartition(7)).collect(), vectors, 4)


def test_ids_repeat_and_are_null(spark):
    vectors = [(None, [1.0, 0.0]), (3, [0.0, 2.0]), (3, [0.0, 2.0]), (4, [-0.0, -1.0])]
    rows = whitening.whiten(frame(spark, vectors)).collect()
    assert sorted((r.vec_id is None, r.vec_id or 0, r.component) for r in rows) == [
        (False, 3, 1), (False, 3, 1), (False, 3, 2), (False, 3, 2), (False, 4, 1), (False, 4, 2), (True, 0, 1), (True, 0, 2)
    ]
    assert {r.n for r in rows} == {3}


def test_less_variance_than_components(spark):
    line = [(i, [float(i), 2.0 * i, 5.0]) for i in range(9)]
    assert {r.component for r in whitening.whiten(frame(spark, line)).collect()} == {1}
    for vectors in ([], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0])], [(1, [])], [(1, None)]):
        assert whitening.whiten(frame(spark, vectors)).collect() == []


def test_huge_entries_stay_exact(spark):
    rows = whitening.whiten(frame(spark, [(1, [2.0**40, 0.0]), (2, [0.0, 1.0]), (3, [3.0, 4.0]), (4, [1e30, 1.0])])).collect()
    assert {r.deviation for r in rows} == {None} and all(math.isfinite(r.whitened) for r in rows)


def test_deviation_beyond_vectorised_range():
    centre = whitening.Centre(3, [1 << 40, 5])
    x = np.array([[1 << 38, 2], [0, 0]])
    assert centre.deviations(x) == [None if (v := sum((3 * int(a) - s) ** 2 for a, s in zip(row, centre.sums))) >= 1 << 63 else v for row in x]


@pytest.mark.parametrize("size", [1, 2, 3, 20])
def test_dqds_is_accurate_for_small_values(size):
    """Against exact rational Sturm counts: relative errors, not errors relative to the largest value."""
    from fractions import Fraction

    rng = random.Random(size)
    diagonal, above = [2.0 ** -rng.randrange(30) for _ in range(size)], [2.0 ** -rng.randrange(30) for _ in range(size - 1)]

    def below(x):  # how many squares of singular values are less than x, by exact arithmetic
        a, b = [Fraction(v) for v in diagonal], [Fraction(v) for v in above]
        count, pivot = 0, None
        for k in range(size):
            corner = a[k] ** 2 + (b[k - 1] ** 2 if k else 0) - x
            pivot = corner - ((a[k - 1] * b[k - 1]) ** 2 / pivot if k else 0)
            pivot = pivot or Fraction(1, 10**60)
            count += pivot < 0
        return count

    near = Fraction(1, 10**13)
    for k, v in enumerate(whitening.dqds(diagonal, above)):
        assert below(Fraction(v) * (1 - near)) < size - k <= below(Fraction(v) * (1 + near))


@pytest.mark.parametrize("seed", range(4))
def test_equal_values_have_orthogonal_vectors(seed):
    rng = np.random.default_rng(seed)
    turn = lambda: np.linalg.qr(rng.standard_normal((24, 24)))[0]
    matrix = turn() @ np.diag([4.0] * 5 + [4.0 - 1e-11] * 2 + [1.0] * 17) @ turn()
    squares, axes = whitening.right_vectors(np.linalg.qr(matrix, mode="r"), 9)
    assert np.allclose(squares, [16.0] * 7 + [1.0] * 2, rtol=1e-10)
    assert np.abs(axes.T @ axes - np.eye(9)).max() < 1e-12
    assert np.abs(matrix.T @ matrix @ axes - axes * squares).max() < 1e-8
