"""Whitening of vectors by their singular values.

Centred rows are reduced block by block to triangles by QR, and these in a tree to one; its squared singular values over
the number of rows are the eigenvalues of the covariance, which is never formed, so that small ones keep their digits.
The triangle is brought to bidiagonal form by Householder reflections; the dqds iteration finds its singular values, to
high relative accuracy; twisted factorisations give the right singular vectors, which the reflections carry back.
Spark reads all rows three times: for sums, for triangles, for the check of the whitened rows; what reaches the
driver has the size of one vector, or of one triangle, whatever the number of rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histload.llm.tables import stored

#: Entries become floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
#: Entries beyond this are not exact in a double.
GREATEST = 1 << 53
#: Triangles that one task brings together.
FAN_IN = 16
#: Singular values below this part of the greatest have no direction that rows could be whitened along.
LEAST = 1e-11
#: Rows that are worked on at once have so many entries at most.
STEP = 1 << 20

_EPS = np.finfo(float).eps


# ---------------------------------------------------------------- bidiagonal singular values and vectors


def householder(x: np.ndarray) -> tuple[np.ndarray, float, float]:
    """v, beta and alpha, so that (1 - beta v v') x = alpha e1."""
    norm = float(np.linalg.norm(x))
    if norm == 0.0 or not len(x):
        return np.zeros_like(x), 0.0, 0.0
    alpha = -norm if x[0] >= 0 else norm
    v = x.copy()
    v[0] -= alpha
    return v, 2.0 / float(v @ v), alpha


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray, float]]]:
    """The diagonal and superdiagonal of U' r V, and the reflections whose product is V."""
    a, d = r.astype(float).copy(), r.shape[1]
    diagonal, above, right = np.zeros(d), np.zeros(max(d - 1, 0)), []
    for k in range(d):
        v, beta, diagonal[k] = householder(a[k:, k].copy())
        if beta:
            a[k:, k:] -= np.outer(beta * v, v @ a[k:, k:])
        if k < d - 1:
            v, beta, above[k] = householder(a[k, k + 1 :].copy())
            if beta:
                a[k:, k + 1 :] -= np.outer(a[k:, k + 1 :] @ v, beta * v)
            right.append((k + 1, v, beta))
    return diagonal, above, right


def _dqds(q: np.ndarray, e: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray, float]:
    """One differential quotient-difference step with a shift, and the least d on its way; a negative one says that the
    shift is beyond the smallest value."""
    new_q, new_e, d = np.empty_like(q), np.empty_like(e), q[0] - shift
    least = d
    for i in range(len(e)):
        new_q[i] = d + e[i]
        if new_q[i] <= 0.0:
            return q, e, -1.0
        ratio = q[i + 1] / new_q[i]
        new_e[i] = e[i] * ratio
        d = d * ratio - shift
        least = min(least, d)
        if not least >= 0.0:
            return q, e, -1.0
    new_q[-1] = d
    return new_q, new_e, least


def squared_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """The squares of the singular values of a bidiagonal matrix, falling, by dqds with deflation."""
    work = [(diagonal * diagonal, above * above, 0.0)]
    found = []
    while work:
        q, e, shifted = work.pop()
        shift, turns = 0.0, 0
        while len(q):
            n = len(q)
            if n == 1:
                found.append(q[0] + shifted)
                break
            # an entry that no longer counts splits the matrix
            scale = shifted + np.minimum(q[:-1] + np.append(0.0, e[:-1]), q[1:] + e)
            gone = np.flatnonzero(e <= (0.25 * _EPS) ** 2 * (scale + np.maximum(q[:-1], q[1:])))
            if len(gone):
                k = int(gone[-1])
                if k == n - 2:
                    found.append(q[-1] + shifted)
                    q, e = q[:-1], e[:-1]
                else:
                    work.append((q[: k + 1], e[:k], shifted))
                    q, e = q[k + 1 :], e[k + 1 :]
                shift, turns = 0.0, 0
                continue
            turns += 1
            while True:
                new_q, new_e, least = _dqds(q, e, shift)
                if least >= 0.0:
                    break
                shift = 0.25 * shift if shift > 0.01 * _EPS * (shifted + q[-1]) else 0.0
            q, e, shifted = new_q, new_e, shifted + shift
            # the next shift: a bound from below of the smallest value, from the last two rows
            t = 0.5 * (q[-2] + e[-1] + q[-1])
            det = q[-2] * q[-1]
            root = math.sqrt(max(t * t - det, 0.0))
            small = det / (t + root) if t + root > 0 else 0.0
            shift = max(0.0, min(small - math.sqrt(e[-1] * small) if e[-1] < 0.25 * small else 0.5 * small, least))
            if turns > 40 * n:
                shift = 0.0
            if turns > 400 * n:
                raise ArithmeticError("dqds does not converge")
    return np.sort(np.array(found))[::-1]


def twisted(diagonal: np.ndarray, above: np.ndarray, square: float) -> np.ndarray:
    """The right singular vector to a squared singular value, of the twisted factorisation with the least pivot."""
    n = len(diagonal)
    if n == 1:
        return np.ones(1)
    tiny = max(_EPS * float(np.max(np.abs(diagonal)) + (np.max(np.abs(above)) if n > 1 else 0.0)), 1e-150)
    a = np.where(np.abs(diagonal) < tiny, tiny, diagonal)
    pivots, lower = a * a, above / a[:-1]
    floor = tiny * tiny

    def sound(x: float) -> float:
        return x if abs(x) > floor * _EPS else -floor * _EPS

    # from above: L+ D+ L+' = L D L' - square
    down, s = np.empty(n - 1), np.empty(n)
    s[0] = -square
    for i in range(n - 1):
        pivot = sound(s[i] + pivots[i])
        down[i] = pivots[i] * lower[i] / pivot
        s[i + 1] = down[i] * lower[i] * s[i] - square
    # from below: U- D- U-' = L D L' - square
    up, p = np.empty(n - 1), np.empty(n)
    p[-1] = pivots[-1] - square
    for i in range(n - 2, -1, -1):
        pivot = sound(pivots[i] * lower[i] ** 2 + p[i + 1])
        up[i] = pivots[i] * lower[i] / pivot
        p[i] = p[i + 1] * pivots[i] / pivot - square
    k = int(np.argmin(np.abs(s + p + square)))
    z = np.zeros(n)
    z[k] = 1.0
    with np.errstate(over="ignore", invalid="ignore"):
        for i in range(k - 1, -1, -1):
            z[i] = -down[i] * z[i + 1]
        for i in range(k, n - 1):
            z[i + 1] = -up[i] * z[i]
    z = np.nan_to_num(z, nan=0.0, posinf=1e300, neginf=-1e300)
    z /= np.abs(z).max()
    return z / np.linalg.norm(z)


def _parts(diagonal: np.ndarray, above: np.ndarray) -> list[tuple[int, int]]:
    """Where a bidiagonal matrix falls apart: vectors of different parts share no entry."""
    size = float(np.max(np.abs(diagonal), initial=0.0) + np.max(np.abs(above), initial=0.0))
    cuts = [0, *(np.flatnonzero(np.abs(above) <= 0.5 * _EPS * size) + 1).tolist(), len(diagonal)]
    return list(zip(cuts[:-1], cuts[1:]))


def right_singular(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared singular values of a square matrix, falling, and its right singular vectors as columns."""
    d = r.shape[1]
    scale = float(np.max(np.abs(r), initial=0.0))
    if not scale:
        return np.zeros(d), np.eye(d)
    diagonal, above, right = bidiagonal(r / scale)
    values, columns = [], []
    for a, b in _parts(diagonal, above):
        inner = above[a : b - 1]
        for square in squared_values(diagonal[a:b], inner):
            z = np.zeros(d)
            z[a:b] = twisted(diagonal[a:b], inner, float(square))
            values.append(float(square))
            columns.append(z)
    order = np.argsort(-np.array(values), kind="stable")
    squares, z = np.array(values)[order], np.array(columns)[order]
    _separate(squares, z, diagonal, above)
    vectors = z.T
    for k, v, beta in reversed(right):
        if beta:
            vectors[k:] -= np.outer(beta * v, v @ vectors[k:])
    return squares * scale * scale, vectors


def _separate(squares: np.ndarray, z: np.ndarray, diagonal: np.ndarray, above: np.ndarray) -> None:
    """The factorisations cannot tell the vectors of values that lie close together apart. Their space is found by inverse
    iteration on the matrix [0 B'; B 0], which knows small values as well as large ones, or is what the others leave if
    they are the last; within it the vectors are turned to where the matrix is diagonal."""
    rng, i, n = np.random.default_rng(1), 0, len(squares)
    b = np.diag(diagonal) + np.diag(above, 1)
    while i < n:
        j = i + 1
        while j < n and squares[j - 1] - squares[j] <= 1e-5 * squares[j - 1] + _EPS * squares[0]:
            j += 1
        if j - i > 1:
            group = z[i:j].T + 0.01 * rng.standard_normal((n, j - i))
            if j < n:
                shift = math.sqrt(float(squares[i:j].mean())) * (1 + 8 * _EPS)
                both = np.block([[np.zeros((n, n)), b.T], [b, np.zeros((n, n))]]) - shift * np.eye(2 * n)
                pair = np.vstack([group, b @ group / shift])
                for _ in range(3):
                    pair = np.linalg.qr(np.linalg.solve(both, pair))[0]
                group = pair[:n]
            for _ in range(2):
                group = np.linalg.qr(group - z[:i].T @ (z[:i] @ group))[0]
            z[i:j] = np.linalg.svd(b @ group, full_matrices=False)[2] @ group.T
        i = j


# ---------------------------------------------------------------- vectors in Spark


def scaled(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, x): each vector's entries as whole numbers. Vectors that are null or empty, or hold a null or an entry that is
    not finite or too large to be exact, are left out; so are those that do not have the commonest length, of
    several the greatest."""
    c = F.col(vector)
    sound = lambda v: F.coalesce(F.abs(F.lit(SCALE) * v.cast("double")) < F.lit(float(GREATEST - OFFSET)), F.lit(False)) & ~F.isnan(v)
    rows = vectors.where(c.isNotNull() & (F.size(c) > 0) & F.coalesce(F.forall(c, sound), F.lit(False)))
    rows = rows.select(F.col(key).cast("long").alias("vec_id"), F.transform(c, lambda v: F.floor(F.lit(SCALE) * v.cast("double")) + OFFSET).alias("x"))
    sizes = rows.groupBy(F.size("x").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("size")).limit(1).collect()
    return rows.where(F.size("x") == sizes[0]["size"]) if sizes else rows


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            size = max(1, STEP // max(1, pc.list_value_length(batch.column("x"))[0].as_py()))
            for a in range(0, batch.num_rows, size):
                yield batch.slice(a, size)


def _totals(vectors: DataFrame) -> tuple[int, list[int]]:
    """The number of vectors, and the exact sum of each of their entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in _steps(batches):
            x = _matrix(batch.column("x"))
            # of halves of 32 bits, so that no sum leaves 64
            high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
            part = [(int(h) << 32) + int(lo) for h, lo in zip(high, low)]
            total = part if total is None else [a + b for a, b in zip(total, part)]
            n += len(x)
        if n:
            at = pa.array(range(len(total)), pa.int32())
            yield pa.RecordBatch.from_arrays([at, pa.array([n] * len(total)), pa.array([str(t) for t in total])], ["at", "n", "total"])

    sums = vectors.select("x").mapInArrow(run, "at int, n long, total string")
    rows = sums.groupBy("at").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).orderBy("at").collect()
    return (rows[0]["n"], [int(r["total"]) for r in rows]) if rows else (0, [])


def _centred(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """n * x - total, exact: of whole numbers, or of Python's where they leave 64 bits."""
    if n * max(int(np.abs(x).max(initial=0)), 1) < 1 << 62:
        return n * x - np.array(total, np.int64)
    return n * x.astype(object) - np.array(total, object)


def _triangles(vectors: DataFrame, n: int, total: list[int]) -> np.ndarray:
    """The triangle of all centred rows."""
    d = len(total)

    def reduced(stacked: np.ndarray) -> np.ndarray:
        out = np.zeros((d, d))
        r = np.linalg.qr(stacked, mode="r")
        out[: len(r)] = r
        return out

    def emitted(r: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        if r is not None:
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()], pa.binary())], ["r"])

    def of_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for batch in _steps(batches):
            rows = _centred(_matrix(batch.column("x")), n, total).astype(float) / n
            r = reduced(rows if r is None else np.vstack([r, rows]))
        yield from emitted(r)

    def of_triangles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for batch in batches:
            for one in batch.column("r").to_pylist():
                one = np.frombuffer(one).reshape(d, d)
                r = one if r is None else reduced(np.vstack([r, one]))
        yield from emitted(r)

    parts = stored(vectors.select("x").mapInArrow(of_rows, "r binary").withColumn("at", F.monotonically_increasing_id()), "triangles")
    while (left := parts.count()) > 1:
        groups = -(-left // FAN_IN)
        parts = parts.repartition(groups, "at") if groups > 1 else parts.coalesce(1)
        parts = stored(parts.select("r").mapInArrow(of_triangles, "r binary").withColumn("at", F.monotonically_increasing_id()), "triangles")
    rows = parts.collect()
    return np.frombuffer(rows[0]["r"]).reshape(d, d)


def _deviation(d: np.ndarray) -> list[int | None]:
    """The sum of squares of each row of whole numbers, exact; null where a long does not hold it."""
    if d.dtype != object and int(np.abs(d).max(initial=0)) ** 2 * d.shape[1] < 1 << 63:
        return (d * d).sum(axis=1).tolist()
    sums = [sum(int(v) * int(v) for v in row) for row in d]
    return [s if s < 1 << 63 else None for s in sums]


def whitened(vectors: DataFrame, most: int = 32) -> DataFrame:
    """Of (vec_id, x), x an array of whole numbers of one length, up to ``most`` components: (vec_id, component, n, deviation,
    whitened, explained, identity_error).

    A row for each input row, repeated ones and null ids too, and component. Components are numbered from 1 by falling
    eigenvalue; equal ones are in any order. There are fewer than ``most`` if there are fewer dimensions, or fewer
    along which rows differ; where all rows are equal, there is none and no row. The sum of squares is null where it
    exceeds a long. ``identity_error`` is measured on the whitened rows themselves.
    """
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    n, total = _totals(vectors)
    spark = vectors.sparkSession
    if not n:
        return spark.createDataFrame([], schema)
    squares, directions = right_singular(_triangles(vectors, n, total))
    trace = float(squares.sum())
    k = int(min(most, (np.sqrt(np.maximum(squares, 0)) > LEAST * math.sqrt(max(squares[0], 0.0))).sum()))
    if not k:
        return spark.createDataFrame([], schema)
    explained = squares[:k] / trace
    onto = directions[:, :k] * np.sqrt(n / squares[:k])

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, held = np.zeros((k, k)), np.zeros(k)
        for batch in _steps(batches):
            w = (_centred(_matrix(batch.column("x")), n, total).astype(float) / n) @ onto
            gram, held = gram + w.T @ w, held + w.sum(axis=0)
        values = np.concatenate([gram.ravel(), held])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(values)), pa.int32()), pa.array(values)], ["at", "v"])

    sums = vectors.select("x").mapInArrow(measured, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).orderBy("at").collect()
    sums = np.array([r["v"] for r in sums])
    covariance = sums[: k * k].reshape(k, k) / n - np.outer(sums[k * k :], sums[k * k :]) / n**2
    error = float(np.abs(covariance - np.eye(k)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _steps(batches):
            d = _centred(_matrix(batch.column("x")), n, total)
            w, m = (d.astype(float) / n) @ onto, batch.num_rows
            repeat = np.repeat(np.arange(m), k)
            arrays = [
                batch.column("vec_id").take(pa.array(repeat)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, n, np.int64)),
                pa.array(_deviation(d), pa.int64()).take(pa.array(repeat)),
                pa.array(w.ravel()),
                pa.array(np.tile(explained, m)),
                pa.array(np.full(m * k, error)),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.mapInArrow(run, schema)
