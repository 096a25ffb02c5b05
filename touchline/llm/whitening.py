"""Whitening of embeddings: their main directions, scaled so that every one has variance 1.

The rows are centred by their exact mean and reduced block by block with QR, so that squares are never formed: R'R is the
scatter matrix. Triangles are merged in rounds until few are left; their size depends on the dimension alone. R is made
bidiagonal by Householder reflections. The squares of its diagonals are a qd array, whose dqds sweeps give the
singular values to high relative accuracy. Each direction comes from the twisted factorisation of B'B - s^2 at the index where the
residual is smallest, with Rayleigh corrections; close singular values get further twist indices and are made orthogonal.

Entries become whole numbers, floor(64 c) + 1000000; sums, means times n and deviations are exact. Equal vectors count once
in the fit.

Defined cases: vectors that are null or empty, or hold null, non-finite entries or such that 64 c fits no long, are left
out, and so are vectors of another length than most (of equally frequent lengths the largest counts); directions without
variance are not returned, so a table of equal vectors gives no rows; a deviation that fits no long is null; repeated
rows and null ids get rows of their own; an empty table gives no rows; other columns are not read. The largest entry of a
direction is positive.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from touchline.session import materialize

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
MERGE_BYTES = 64 << 20  # of partial results that one task or the driver merges
_EPS = float(np.finfo(float).eps)
_LONG = 2**63


# Singular values and directions of a small triangle.


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """u and t such that x - t u (u'x) has only its first entry left."""
    norm = np.linalg.norm(x)
    if norm == 0:
        return x, 0.0
    u = x / norm
    u[0] += math.copysign(1.0, u[0])
    return u, 2.0 / float(u @ u)


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and upper diagonal of B, and V, with r = U B V' and orthogonal U, V."""
    a, size = r.astype(float).copy(), r.shape[1]
    v = np.eye(size)
    for k in range(size):
        u, t = _reflector(a[k:, k])
        a[k:, k:] -= t * np.outer(u, u @ a[k:, k:])
        if k + 2 < size:
            u, t = _reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= t * np.outer(a[k:, k + 1 :] @ u, u)
            v[:, k + 1 :] -= t * np.outer(v[:, k + 1 :] @ u, u)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def _sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float, bool]:
    """A dqds transform: the new q and e, the smallest d, and whether only the last d is negative."""
    d, least = q[0] - shift, math.inf
    new_q, new_e = [], []
    for i in range(len(e)):
        if d < 0:
            return q, e, d, False
        least = min(least, d)
        total = d + e[i]
        ratio = q[i + 1] / total if total else math.inf
        new_q.append(total)
        new_e.append(e[i] * ratio if total else 0.0)
        d = (d * ratio if total else q[i + 1]) - shift
    new_q.append(d)
    return new_q, new_e, min(least, d), d < 0


def dqds(q: list[float], e: list[float], base: float = 0.0) -> list[float]:
    """The eigenvalues of a positive qd array plus ``base``, by sweeps with shifts that keep it positive."""
    found, small = [], (4 * _EPS) ** 2
    q, e, sweeps = list(q), list(e), 0  # sweeps since a value was found
    while len(q) > 1:
        if e[-1] <= small * (base + q[-1]):
            found.append(base + q.pop())
            e.pop()
            sweeps = 0
            continue
        split = next((i for i in range(len(e) - 2, -1, -1) if e[i] <= small * (base + min(q[i], q[i + 1]))), None)
        if split is not None:
            found += dqds(q[split + 1 :], e[split + 1 :], base)
            q, e = q[: split + 1], e[:split]
            continue
        # The smaller eigenvalue of the last two rows, less what couples them with the others.
        above = e[-2] if len(e) > 1 else 0.0
        x, z, y2 = q[-2] + above, q[-1] + e[-1], q[-2] * e[-1]
        mean, half = (x + z) / 2, (x - z) / 2
        root = mean + math.sqrt(half * half + y2)
        shift = max(0.0, (x * z - y2) / root - (math.sqrt(q[-3] * above) if len(q) > 2 else 0.0)) if root else 0.0
        shift = shift or max(0.0, min(q[-1], q[-2]) * 0.25)
        for attempt in range(4):
            new_q, new_e, least, late = _sweep(q, e, shift)
            if least >= 0:
                break
            shift = max(0.0, shift + least) if late and attempt == 0 else shift / 4 if attempt < 2 else 0.0
        else:
            new_q, new_e, least, _ = _sweep(q, e, 0.0)
            shift = 0.0
        q, e, base, sweeps = new_q, new_e, base + shift, sweeps + 1
        if sweeps > 1000:
            raise ArithmeticError("dqds does not converge")
    return found + [base + x for x in q]


def _twisted(q: np.ndarray, l: np.ndarray, value: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Multipliers from the top and from the bottom of L D L' - value, and the residual at every twist index."""
    n, tiny = len(q), np.finfo(float).tiny
    up, down = np.zeros(max(n - 1, 0)), np.zeros(max(n - 1, 0))
    s, p = np.zeros(n), np.zeros(n)
    s[0] = -value
    for i in range(n - 1):
        d = (s[i] + q[i]) or tiny
        up[i] = l[i] * q[i] / d
        s[i + 1] = up[i] * l[i] * s[i] - value
    p[-1] = q[-1] - value
    for i in range(n - 2, -1, -1):
        d = (q[i] * l[i] * l[i] + p[i + 1]) or tiny
        t = q[i] / d
        down[i] = l[i] * t
        p[i] = p[i + 1] * t - value
    return up, down, s + p + value


def _unrolled(up: np.ndarray, down: np.ndarray, twist: int) -> np.ndarray:
    """The vector that solves the twisted factorisation at this index."""
    z = np.zeros(len(up) + 1)
    z[twist] = 1.0
    for i in range(twist - 1, -1, -1):
        z[i] = -up[i] * z[i + 1]
    for i in range(twist, len(down)):
        z[i + 1] = -down[i] * z[i]
    return z


def _direction(q: np.ndarray, l: np.ndarray, value: float, close: list[np.ndarray]) -> np.ndarray:
    """The eigenvector for one value, orthogonal to those of the values ``close`` to it."""
    at = value
    for _ in range(6):
        up, down, residual = _twisted(q, l, at)
        if not np.isfinite(residual).all():
            at *= 1 + 2 * _EPS
            continue
        twist = int(np.abs(residual).argmin())
        z = _unrolled(up, down, twist)
        change = residual[twist] / float(z @ z)
        if close or abs(change) <= 2 * _EPS * at:
            break
        if abs(at + change - value) > 1e-8 * value:  # towards a neighbour: the value from dqds stands
            break
        at += change
    best = (0.0, np.zeros(len(q)))
    for twist in np.abs(residual).argsort()[: len(close) + 1]:
        z = _unrolled(up, down, int(twist))
        left = _without(z / np.linalg.norm(z), close)
        best = max(best, (float(np.linalg.norm(left)), left), key=lambda b: b[0])
        if best[0] > 0.5:
            break
    return best[1] / (best[0] or 1.0)


def _directions(q: np.ndarray, l: np.ndarray, values: list[float]) -> np.ndarray:
    """Eigenvectors, as columns, for falling values of one block, each near the one before. Where twists do not tell several
    nearly equal ones apart, inverse iteration with all of them together does."""
    found: list[np.ndarray] = []
    for value in values:
        found.append(_direction(q, l, value, found))
    vectors, wanted = np.column_stack(found), np.array(values)
    if len(values) == 1:
        return vectors
    product = np.diag(q + np.concatenate([[0.0], l * l * q[:-1]])) + np.diag(l * q[:-1], 1) + np.diag(l * q[:-1], -1)
    apart = np.abs(vectors.T @ vectors - np.eye(len(values))).max()
    if apart < 1e-12 and np.abs(product @ vectors - vectors * wanted).max() < 1e-12 * wanted[0]:
        return vectors
    beside = product - np.eye(len(q)) * (wanted.mean() + 1e-9 * wanted[0])
    vectors = np.cos(np.outer(np.arange(1, len(q) + 1), np.arange(1, len(values) + 1)) ** 2)
    for _ in range(8):
        vectors, _ = np.linalg.qr(np.linalg.solve(beside, vectors))
    inner, turn = np.linalg.eigh(vectors.T @ (product @ vectors - vectors * wanted[0]))
    return vectors @ turn[:, ::-1]


def _without(z: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """z less its parts along the others, twice for the rounding."""
    for other in others * 2:
        z = z - (other @ z) * other
    return z


def singular(r: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """The squares of the largest ``most`` singular values that are not zero, falling, their right vectors as columns, and
    the sum of all squares."""
    diagonal, upper, v = bidiagonal(r)
    size, scale = len(diagonal), max(np.abs(diagonal).max(initial=0), np.abs(upper).max(initial=0))
    if scale == 0:
        return np.zeros(0), np.zeros((size, 0)), 0.0
    diagonal, upper = diagonal / scale, upper / scale
    diagonal = np.where(np.abs(diagonal) < 1e-20, 1e-20, diagonal)  # keeps the qd array positive
    least = np.minimum(np.abs(diagonal[:-1]), np.abs(diagonal[1:]))
    upper = np.where(np.abs(upper) <= size * _EPS * least, 0.0, upper)
    bounds = [0, *(np.flatnonzero(upper == 0) + 1).tolist(), size]
    values = []
    for first, last in zip(bounds, bounds[1:]):
        q, e = diagonal[first:last] ** 2, upper[first : last - 1] ** 2
        values += [(value, first, last) for value in dqds(q.tolist(), e.tolist())]
    values.sort(reverse=True)
    total = math.fsum(value for value, _, _ in values)
    kept = [x for x in values if x[0] > 1e-22 * values[0][0]]
    clusters: list[list[int]] = []  # a chain of values of a block, each near the one before
    last_of: dict[int, list[int]] = {}
    for k, (value, first, _) in enumerate(kept):
        before = last_of.get(first)
        if before and kept[before[-1]][0] - value <= 1e-3 * value:
            before.append(k)
        elif k < most:
            last_of[first] = [k]
            clusters.append(last_of[first])
    kept = kept[:most]
    vectors = np.zeros((size, len(kept)))
    for cluster in clusters:
        _, first, last = kept[cluster[0]]
        found = _directions(diagonal[first:last] ** 2, upper[first : last - 1] / diagonal[first : last - 1], [values[k][0] for k in cluster])
        for k, y in zip(cluster, found.T):
            if k < len(kept):
                vectors[first:last, k] = y
    turned = v @ vectors
    largest = np.abs(turned).argmax(axis=0)
    turned = turned * np.where(turned[largest, np.arange(len(kept))] < 0, -1.0, 1.0)
    return np.array([value for value, _, _ in kept]) * scale**2, turned, total * scale**2


# The rows.


@dataclass
class Whitening:
    """What a fit gives: the number of vectors, their sums, the directions as columns, their variances, the trace, and how
    far the covariance of the whitened vectors is from the identity."""

    n: int
    sums: np.ndarray
    directions: np.ndarray
    variances: np.ndarray
    trace: float
    identity_error: float = 0.0

    @property
    def explained(self) -> list[float]:
        return [float(e / self.trace) for e in self.variances]

    def whitened(self, deviations: np.ndarray) -> np.ndarray:
        return (deviations.astype(float) / self.n) @ (self.directions / np.sqrt(self.variances))


def whole_numbers(vectors: DataFrame) -> DataFrame:
    """vec_id and x, for the vectors that count."""
    good = F.forall("embedding", lambda c: F.coalesce((F.abs(c.cast("double")) < 2.0**56), F.lit(False)))
    x = F.transform("embedding", lambda c: F.floor(c.cast("double") * SCALE) + SHIFT)
    valid = vectors.filter("embedding is not null and size(embedding) > 0").filter(good).select("vec_id", x.alias("x"))
    usual = valid.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return valid.filter(F.size("x") == (usual["d"] if usual else 0))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch.column(batch.schema.get_field_index("x")).flatten().to_numpy()
    return flat.reshape(batch.num_rows, -1)


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n x - S, exactly: as longs, or as Python's whole numbers where those could overflow."""
    if max(int(np.abs(x).max()) * n, max(abs(int(s)) for s in sums)) < _LONG // 2:
        return n * x - sums.astype(np.int64)
    return n * x.astype(object) - sums


def _squares(deviations: np.ndarray) -> list[int | None]:
    largest = max(int(deviations.max()), -int(deviations.min()))
    if largest * largest * deviations.shape[1] < _LONG:
        return (deviations * deviations).sum(axis=1).tolist()
    found = (deviations.astype(object) ** 2).sum(axis=1)
    return [int(s) if s < _LONG else None for s in found]


def reduced(rows: DataFrame, partial: Callable, merge: Callable, item_bytes: int):
    """``partial`` of every record batch, merged in a task and then in rounds of tasks that each take a bounded number; the driver
    merges the last few. None for an empty table."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _folded((partial(b) for b in batches if b.num_rows), merge)

    def refold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _folded((pickle.loads(p) for b in batches for p in b.column(0).to_pylist()), merge)

    at_once = max(2, MERGE_BYTES // item_bytes)
    now = materialize(rows.mapInArrow(fold, "part binary"), "partials")
    while (waiting := now.count()) > at_once:
        now = materialize(now.repartition(-(-waiting // at_once)).mapInArrow(refold, "part binary"), "partials")
    result = None
    for row in now.collect():
        part = pickle.loads(row.part)
        result = part if result is None else merge(result, part)
    return result


def _folded(parts: Iterator, merge: Callable) -> Iterator[pa.RecordBatch]:
    result = None
    for part in parts:
        result = part if result is None else merge(result, part)
    if result is not None:
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(result)], pa.binary())], ["part"])


def _add(a: tuple, b: tuple) -> tuple:
    return a[0] + b[0], a[1] + b[1]


def _sums(batch: pa.RecordBatch) -> tuple[int, np.ndarray]:
    x = _matrix(batch)
    if int(np.abs(x).max()) * len(x) < _LONG:
        return len(x), x.sum(axis=0).astype(object)
    return len(x), x.astype(object).sum(axis=0)


def _triangle(rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows, mode="r")


def _merged_triangles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _triangle(np.vstack([a, b]))


def _merged_moments(a: tuple, b: tuple) -> tuple:
    """Number, mean and centred products of two sets together."""
    n, apart = a[0] + b[0], b[1] - a[1]
    return n, a[1] + apart * (b[0] / n), a[2] + b[2] + np.outer(apart, apart) * (a[0] * b[0] / n)


def fit(x: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the distinct vectors of ``whole_numbers``; None if there are none."""
    distinct = materialize(x.select("x").distinct(), "vectors")
    totals = reduced(distinct, _sums, _add, 1024)
    if totals is None:
        return None
    n, sums = totals
    size = len(sums)

    def triangle(batch: pa.RecordBatch) -> np.ndarray:
        return _triangle(_deviations(_matrix(batch), n, sums).astype(float) / n)

    squares, directions, total = singular(_square(reduced(distinct, triangle, _merged_triangles, 8 * size * size), size), components)
    found = Whitening(n, sums, directions, squares / n, total / n)
    if len(squares):

        def moments(batch: pa.RecordBatch) -> tuple:
            y = found.whitened(_deviations(_matrix(batch), n, sums))
            mean = y.mean(axis=0)
            return len(y), mean, (y - mean).T @ (y - mean)

        count, _, products = reduced(distinct, moments, _merged_moments, 8 * (len(squares) + 1) ** 2)
        found.identity_error = float(np.abs(products / count - np.eye(len(squares))).max())
    return found


def _square(r: np.ndarray, size: int) -> np.ndarray:
    """R with rows of zeros below where there were fewer vectors than dimensions."""
    return np.vstack([r, np.zeros((size - len(r), size))])


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """A row per vector (vec_id, embedding) that counts and per component: vec_id, component from 1, n, deviation (the sum of
    squares of n x - S), whitened, explained (share of the trace), identity_error."""
    x = whole_numbers(vectors)
    id_type = dict(vectors.dtypes)["vec_id"]
    found = fit(x, components)
    if found is None:
        schema = f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return vectors.sparkSession.createDataFrame([], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                deviations = _deviations(_matrix(batch), found.n, found.sums)
                y = found.whitened(deviations)
                ends = np.arange(0, y.size + 1, max(1, y.shape[1]), dtype=np.int32) if y.shape[1] else np.zeros(len(y) + 1, np.int32)
                whitened = pa.ListArray.from_arrays(pa.array(ends), pa.array(y.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_squares(deviations), pa.int64()), whitened], ["vec_id", "deviation", "y"])

    rows = x.mapInArrow(run, f"vec_id {id_type}, deviation long, y array<double>")
    rows = rows.select("vec_id", "deviation", F.posexplode("y").alias("k", "whitened"))
    shares = F.array(*[F.lit(s) for s in found.explained]) if len(found.variances) else F.array().cast("array<double>")
    return rows.select(
        "vec_id", (F.col("k") + 1).cast("int").alias("component"), F.lit(found.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("k")).alias("explained"), F.lit(found.identity_error).alias("identity_error"),
    )
