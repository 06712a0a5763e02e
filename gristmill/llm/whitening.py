"""Whitening of embeddings with a bidiagonal qd solver.

1. Blocks of centred rows go through QR, each block together with the triangle of the blocks before it;
   the triangles of the tasks are merged in a tree until one is left. It has the singular values and the
   right singular vectors of the whole centred table, and its size is that of the dimension squared.
2. Householder reflections from both sides make the triangle bidiagonal.
3. Differential quotient-difference steps with shifts (dqds) find the squares of the singular values. No
   step subtracts except the shift, which is a proven lower bound, so small values are as accurate as
   large ones.
4. Twisted factorisations of the shifted product give each vector: of the stationary and the progressive
   form of the step, joined where the twist is least, two short products give the vector. Vectors of
   nearly equal values are made orthogonal.

Only sums, triangles and the result of step 4 come to the driver, all bounded by the dimension.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import Steps, bounded_batches, whole_groups

EPS = float(np.finfo(float).eps)
# Rows of a block of the factorisation, at least twice the dimension.
BLOCK_ROWS = 1_024
# Bytes of triangles that one task merges.
MERGE_BYTES = 64 << 20
# Values closer than this share of the larger one count as nearly equal.
CLOSE = 1e-3
_LONG = 1 << 62


# ------------------------------------------------------------------ the solver


def bidiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal and superdiagonal of an equivalent upper bidiagonal matrix, and the reflectors from the right."""
    a = np.array(matrix, float)
    d = a.shape[1]
    right: list[np.ndarray] = []
    for k in range(d):
        v = _reflector(a[k:, k])
        a[k:, k:] -= np.outer(v, 2.0 * (v @ a[k:, k:]))
        if k < d - 1:
            v = _reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= np.outer(2.0 * (a[k:, k + 1 :] @ v), v)
            right.append(v)
    return np.diagonal(a).copy(), np.diagonal(a, 1).copy(), right


def _reflector(x: np.ndarray) -> np.ndarray:
    """Unit vector whose reflection takes x to a multiple of the first axis; zero where there is nothing to do."""
    scale = np.abs(x).max(initial=0.0)
    if scale == 0 or not np.abs(x[1:]).max(initial=0.0):
        return np.zeros(len(x))
    v = x / scale
    v[0] += math.copysign(float(np.linalg.norm(v)), v[0])
    return v / np.linalg.norm(v)


def dqds(diagonal, superdiagonal) -> list[float]:
    """Squares of the singular values of an upper bidiagonal matrix, falling."""
    found: list[float] = []
    blocks = [([float(x) ** 2 for x in diagonal], [float(x) ** 2 for x in superdiagonal], 0.0)]
    tiny = EPS * EPS
    while blocks:
        q, e, moved = blocks.pop()
        while len(q) > 2:
            if e[-1] <= tiny * (moved + q[-1]):
                found.append(moved + q.pop())
                e.pop()
                continue
            cut = next((k for k in range(len(e) - 1) if e[k] <= tiny * (moved + min(q[k], q[k + 1]))), None)
            if cut is not None:
                blocks.append((q[: cut + 1], e[:cut], moved))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if 1.5 * q[0] < q[-1]:
                q.reverse()
                e.reverse()
            shift = _below_least(q, e)
            after = _step(q, e, shift) or _step(q, e, shift := 0.0)
            q, e = after
            moved += shift
        if len(q) == 2:
            # the larger root of the two-by-two product, then the smaller one from the determinant
            gap = q[0] + e[0] - q[1]
            large = 0.5 * (q[0] + e[0] + q[1] + math.sqrt(gap * gap + 4 * e[0] * q[1]))
            found += [moved + large, moved + (q[0] * (q[1] / large) if large else 0.0)]
        elif q:
            found.append(moved + q[0])
    return sorted(found, reverse=True)


def _below_least(q: list[float], e: list[float]) -> float:
    """A lower bound of the least square: one over the trace of the inverse, from a step without shift."""
    d, total = q[0], 0.0
    for k in range(len(e)):
        if d <= 0:
            return 0.0
        total += 1 / d
        d *= q[k + 1] / (d + e[k])
    if d <= 0:
        return 0.0
    total += 1 / d
    return (1 - 8 * len(q) * EPS) / total if math.isfinite(total) else 0.0


def _step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One dqds step, None where the shift was too large."""
    new_q, new_e, d = [], [], q[0] - shift
    for k in range(len(e)):
        if d < 0:
            return None
        total = d + e[k]
        if total == 0:  # a zero column: nothing couples it to the next one
            new_q.append(0.0)
            new_e.append(0.0)
            d = q[k + 1] - shift
            continue
        ratio = q[k + 1] / total
        new_q.append(total)
        new_e.append(e[k] * ratio)
        d = d * ratio - shift
    if d < 0:
        return None
    return [*new_q, d], new_e


def _twisted(d: np.ndarray, l: np.ndarray, value: float) -> tuple[np.ndarray, float]:
    """Vector of L D L' nearest to `value` from the twisted factorisation with the least twist, and a better value."""
    m = len(d)
    least = np.finfo(float).tiny / EPS
    nonzero = lambda x: x if abs(x) > least else math.copysign(least, x)
    for _ in range(3):
        s, lower = np.empty(m), np.empty(m - 1)
        s[0] = -value
        for k in range(m - 1):
            lower[k] = d[k] * l[k] / nonzero(d[k] + s[k])
            s[k + 1] = lower[k] * l[k] * s[k] - value
        p, upper = np.empty(m), np.empty(m - 1)
        p[-1] = d[-1] - value
        for k in range(m - 2, -1, -1):
            t = d[k] / nonzero(d[k] * l[k] * l[k] + p[k + 1])
            upper[k] = l[k] * t
            p[k] = p[k + 1] * t - value
        twist = s + p + value
        r = int(np.nanargmin(np.abs(twist)))
        z = np.zeros(m)
        z[r] = 1.0
        for k in range(r - 1, -1, -1):
            z[k] = -lower[k] * z[k + 1]
        for k in range(r, m - 1):
            z[k + 1] = -upper[k] * z[k]
        size = float(z @ z)
        change = float(twist[r]) / size
        value += change
        if abs(change) <= EPS * abs(value):
            break
    return z / math.sqrt(size), value


def _solve(d: np.ndarray, l: np.ndarray, value: float, y: np.ndarray) -> np.ndarray:
    """A solution of (L D L' - value) x = y, for inverse iteration."""
    m, x = len(d), y.copy()
    least = EPS * float(d.max(initial=0.0)) * EPS or np.finfo(float).tiny
    pivot, lower, s = np.empty(m), np.empty(m - 1), -value
    for k in range(m):
        pivot[k] = d[k] + s if abs(d[k] + s) > least else math.copysign(least, d[k] + s)
        if k < m - 1:
            lower[k] = d[k] * l[k] / pivot[k]
            s = lower[k] * l[k] * s - value
    for k in range(m - 1):
        x[k + 1] -= lower[k] * x[k]
    x /= pivot
    for k in range(m - 2, -1, -1):
        x[k] -= lower[k] * x[k + 1]
    return x


def _apart(z: np.ndarray, others: list[np.ndarray]) -> tuple[np.ndarray, float]:
    """z without its parts along the others, made a unit vector, and the share of it that was left."""
    for _ in range(2):
        for o in others:
            z = z - (z @ o) * o
    left = float(np.linalg.norm(z))
    return (z / left if left else z), left


def right_vectors(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """Squares of the `wanted` largest singular values of a square matrix, falling, and their right unit vectors as columns.

    Values that rounding can't tell from zero are left out, so there may be fewer.
    """
    scale = float(np.abs(matrix).max(initial=0.0))
    size = matrix.shape[1]
    if not scale:
        return np.empty(0), np.empty((size, 0))
    diagonal, above, right = bidiagonal(matrix / scale)
    norm = max(float(np.abs(diagonal).max()), float(np.abs(above).max(initial=0.0)))
    # A zero on the diagonal becomes as large as the rounding of the reflections was.
    diagonal = np.where(np.abs(diagonal) < EPS * norm, np.copysign(EPS * norm, diagonal), diagonal)
    above = np.where(np.abs(above) <= EPS * np.minimum(np.abs(diagonal[:-1]), np.abs(diagonal[1:])), 0.0, above)
    edges = [0, *(np.flatnonzero(above == 0) + 1).tolist(), size]
    values = sorted(
        ((value, a, b) for a, b in zip(edges, edges[1:]) for value in dqds(diagonal[a:b], above[a : b - 1])), reverse=True
    )
    floor = (8 * size * EPS) ** 2 * values[0][0]
    found: list[tuple[float, int, np.ndarray]] = []
    draw = np.random.default_rng(1)
    for value, a, b in values[:wanted]:
        if value <= floor:
            break
        d, l = diagonal[a:b] ** 2, above[a : b - 1] / diagonal[a : b - 1]
        z, better = _twisted(d, l, value) if b - a > 1 else (np.ones(1), value)
        close = [o for v, at, o in found if at == a and v - value <= CLOSE * v]
        z, left = _apart(z, close)
        tries = 0
        while left < 0.5 and tries < 5:  # the same vector again: another one of the nearly equal values
            z, _ = _apart(draw.standard_normal(b - a), close)
            for _ in range(3):
                z = _solve(d, l, value, z)
                z, left = _apart(z / np.linalg.norm(z), close)
            tries += 1
        found.append((better if not close else value, a, z))
    vectors = np.zeros((size, len(found)))
    for k, (_, a, z) in enumerate(found):
        vectors[a : a + len(z), k] = z
    for k in range(len(right) - 1, -1, -1):
        v = right[k]
        vectors[k + 1 :] -= np.outer(v, 2.0 * (v @ vectors[k + 1 :]))
    top = vectors[np.abs(vectors).argmax(axis=0), np.arange(len(found))] if found else np.empty(0)
    return np.array([v for v, _, _ in found]) * scale * scale, vectors * np.where(top < 0, -1.0, 1.0)


# ------------------------------------------------------------------ the table


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """(_id, _x) of the rows whose vector has only finite entries, and their length; x = floor(256 * entry).

    Vectors of another length than the most frequent one (of equally frequent ones the longest) go too.
    A value beyond BIGINT becomes the nearest BIGINT.
    """
    entries = F.col(vector_col).cast("array<double>")
    finite = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(math.inf)))
    whole = rows.select(
        F.col(id_col).alias("_id"), F.when(finite, F.transform(entries, lambda c: F.floor(c * 256))).alias("_x")
    ).filter(F.col("_x").isNotNull())
    usual = whole.groupBy(F.size("_x").alias("_d")).agg(F.count(F.lit(1)).alias("_n")).orderBy(F.desc("_n"), F.desc("_d")).first()
    length = usual["_d"] if usual else 0
    return whole.filter(F.size("_x") == length), length


def _matrix(column: pa.ChunkedArray | pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)


@dataclass
class Centre:
    """Rows and sums of the fit list."""

    n: int
    sums: list[int]

    def centred(self, x: np.ndarray) -> np.ndarray:
        most = int(np.abs(x).max(initial=0)) if x.min(initial=0) > -(1 << 63) else 1 << 63
        if self.n * most + max(map(abs, self.sums)) < _LONG:
            return (self.n * x - np.array(self.sums, np.int64)) / self.n  # one rounding per entry
        return x.astype(float) - np.array([float(Fraction(s, self.n)) for s in self.sums])

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)², exact; None beyond BIGINT."""
        most = int(np.abs(x).max(initial=0)) if x.min(initial=0) > -(1 << 63) else 1 << 63
        widest = max([most, *map(abs, self.sums)])
        squares = sum(s * s for s in self.sums)
        if x.shape[1] * most * widest < _LONG:
            own, cross = (x * x).sum(axis=1).tolist(), (x * np.array(self.sums, np.int64)).sum(axis=1).tolist()
            exact = (self.n * self.n * a - 2 * self.n * b + squares for a, b in zip(own, cross))
        else:
            exact = (sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums)) for row in x.tolist())
        return [value if value < 1 << 63 else None for value in exact]


def _centre(fit: DataFrame, length: int) -> Centre:
    def run(batches):
        n, sums = 0, [0] * length
        for batch in batches:
            x = _matrix(batch.column(0), length)
            wide = x.astype(object) if np.abs(x.astype(float)).max(initial=0.0) * max(1, len(x)) >= _LONG else x
            n, sums = n + len(x), [a + int(b) for a, b in zip(sums, wide.sum(axis=0))]
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(length), pa.int32()), pa.array([n] * length, pa.int64()), pa.array(sums, pa.decimal128(38, 0))],
                names=["_at", "_n", "_s"],
            )

    parts = fit.select("_x").mapInArrow(run, "_at int, _n bigint, _s decimal(38,0)")
    total = sorted(map(tuple, parts.groupBy("_at").agg(F.sum("_n"), F.sum("_s")).collect()))
    return Centre(total[0][1], [int(t[2]) for t in total]) if total else Centre(0, [])


def _triangle(steps: Steps, fit: DataFrame, centre: Centre, length: int) -> np.ndarray:
    """The triangle of the QR factorisation of all centred rows."""

    def blocks(batches):
        r, rows = np.empty((0, length)), max(BLOCK_ROWS, 2 * length)
        for batch in batches:
            x = _matrix(batch.column(0), length)
            for at in range(0, len(x), rows):
                r = np.linalg.qr(np.vstack([r, centre.centred(x[at : at + rows])]), mode="r")
        if len(r):
            yield _factor(TaskContext.get().partitionId(), r)

    def merge(batches):
        for table in whole_groups(batches):
            group = table.column(0).to_numpy()
            starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            for a, b in zip(starts, [*starts[1:], len(group)]):
                r = np.empty((0, length))
                for raw in table.column(1).slice(a, b - a):
                    r = np.linalg.qr(np.vstack([r, np.frombuffer(raw.as_py(), float).reshape(-1, length)]), mode="r")
                yield _factor(int(group[a]), r)

    schema = "_part bigint, _r binary"
    fan = max(2, MERGE_BYTES // (8 * length * length))
    level, at = steps.keep("factors-0", fit.select("_x").mapInArrow(blocks, schema)), 0
    while level.count() > 1:
        grouped = level.select(F.floor(F.col("_part") / fan).alias("_group"), "_part", "_r").repartition("_group")
        rows = grouped.sortWithinPartitions("_group", "_part").select("_group", "_r").mapInArrow(merge, schema)
        level, at = steps.keep(f"factors-{at + 1}", rows), at + 1
        steps.drop(f"factors-{at - 1}")
    r = np.frombuffer(level.first()["_r"], float).reshape(-1, length)
    return np.vstack([r, np.zeros((length - len(r), length))])


def _factor(part: int, r: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int64()), pa.array([np.ascontiguousarray(r).tobytes()], pa.binary())], names=["_part", "_r"]
    )


def _identity_error(fit: DataFrame, white, length: int, k: int) -> float:
    """Largest absolute entry of the covariance of the whitened fit list minus the identity."""

    def run(batches):
        n, mean, spread = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = white(_matrix(batch.column(0), length))
            if not len(w):
                continue
            own = w.mean(axis=0)
            off, total = own - mean, n + len(w)
            spread += (w - own).T @ (w - own) + np.outer(off, off) * (n * len(w) / total)
            mean, n = mean + off * (len(w) / total), total
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([n], pa.int64()), pa.array([mean.tolist()], pa.list_(pa.float64())), pa.array([spread.ravel().tolist()], pa.list_(pa.float64()))],
                names=["_n", "_m", "_s"],
            )

    parts = fit.select("_x").mapInArrow(run, "_n bigint, _m array<double>, _s array<double>")
    m = [F.col("_m")[i] for i in range(k)]
    total = parts.agg(
        F.sum("_n"), *[F.sum(F.col("_n") * m[i]) for i in range(k)],
        *[F.sum(F.col("_s")[i * k + j] + F.col("_n") * m[i] * m[j]) for i in range(k) for j in range(k)],
    ).first()
    n, mean = total[0], np.array(total[1 : k + 1]) / total[0]
    covariance = np.array(total[k + 1 :]).reshape(k, k) / n - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(k)).max())


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 4) -> DataFrame:
    """For each row and component: id, component, n, deviation, whitened, explained, identity_error.

    Rows go whose vector is null, holds a null or an entry that is not finite, or has another length than
    the most frequent one. An entry c becomes x = floor(256 * c), a whole number; -0.0 is 0. The n different
    x-vectors are the fit list, S their sum: a copy counts once. `component` counts the eigenvectors of the
    covariance (divisor n) from 1 by falling eigenvalue; their largest entry is positive. `whitened` is
    (x - S/n) on the component over the root of its eigenvalue, `explained` its share of the trace,
    `deviation` the exact sum of (n x - S)², null beyond BIGINT. `identity_error` is one value for all rows,
    measured on the whitened fit list. Repeated and null ids are rows like others. A component without
    variance (all vectors equal, fewer vectors than dimensions) gives no rows, so one vector, an empty
    table or empty vectors give none. Other columns are not read.
    """
    spark = rows.sparkSession
    bounded_batches(spark)
    steps = Steps(spark, "whitening")
    vectors, length = integer_vectors(rows, id_col, vector_col)
    id_type = vectors.schema["_id"].dataType.simpleString()
    schema = f"_id {id_type}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    out = [F.col("_id").alias(id_col), "component", "n", "deviation", "whitened", "explained", "identity_error"]
    values = np.empty(0)
    if length:
        fit = steps.keep("fit", vectors.select("_x").distinct())
        centre = _centre(fit, length)
        r = _triangle(steps, fit, centre, length)
        squares, axes = right_vectors(r, components)
        values = squares / centre.n
    if not len(values):
        return spark.createDataFrame([], schema).select(*out)
    explained = (squares / float((r * r).sum())).tolist()
    k, turn = len(values), axes / np.sqrt(values)

    def white(x: np.ndarray) -> np.ndarray:
        return centre.centred(x) @ turn

    error = _identity_error(fit, white, length, k)

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(1), length)
            m = len(x)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                    pa.array(np.full(m * k, centre.n), pa.int64()),
                    pa.array([v for v in centre.deviations(x) for _ in range(k)], pa.int64()), pa.array(white(x).ravel()),
                    pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error)),
                ],
                names=["_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return vectors.mapInArrow(run, schema).select(*out)
