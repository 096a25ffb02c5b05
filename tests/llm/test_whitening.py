"""Whitening: the solver against numpy, the query against a plain computation, odd vectors."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from touchline.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def check_solver(a, most):
    size = a.shape[1]
    squares, vectors, total = whitening.singular(np.vstack([a, np.zeros((max(0, size - len(a)), size))]), most)
    wanted = np.linalg.svd(a, compute_uv=False) ** 2
    rank = int((wanted > 1e-22 * wanted[0]).sum()) if wanted[0] else 0
    assert len(squares) == min(most, rank)
    assert np.allclose(squares, wanted[: len(squares)], rtol=1e-11, atol=0)
    assert total == pytest.approx(wanted.sum(), rel=1e-12)
    if len(squares):
        assert np.abs(vectors.T @ vectors - np.eye(len(squares))).max() < 1e-10
        assert np.abs(a.T @ (a @ vectors) - vectors * squares).max() < 1e-11 * squares[0]


def test_solver_on_random_and_graded_matrices():
    rng = np.random.default_rng(1)
    for size in (1, 2, 3, 7, 16, 64):
        check_solver(rng.normal(size=(3 * size + 5, size)), 16)
    check_solver(rng.normal(size=(300, 40)) * np.logspace(0, -8, 40), 40)
    check_solver(rng.normal(size=(9, 30)), 16)
    check_solver(np.zeros((5, 4)), 4)
    check_solver(np.ones((5, 4)), 4)


def test_solver_on_equal_and_close_values():
    rng = np.random.default_rng(2)
    for _ in range(30):
        size = int(rng.integers(2, 60))
        left, right = (np.linalg.qr(rng.normal(size=(size, size)))[0] for _ in range(2))
        values = rng.choice([1, 2, 3, 5.5], size) * (1 + rng.choice([0, 1e-15, 1e-13, 1e-10, 1e-6], size))
        check_solver(left @ np.diag(values) @ right, 16)
    steep = np.diag(np.abs(np.arange(41) - 20.0) + 6) + np.diag(np.ones(40), 1) + np.diag(np.ones(40), -1)
    check_solver(np.linalg.cholesky(steep).T, 41)  # pairs of values that agree to rounding in one block


def test_dqds_is_accurate_for_small_values():
    # The inverse of this bidiagonal matrix is known, so the product of the values is exact.
    q, e = [4.0**-k for k in range(20)], [4.0**-k / 7 for k in range(19)]
    found = whitening.dqds(q, e)
    assert math.fsum(map(math.log, found)) == pytest.approx(math.fsum(map(math.log, q)), rel=1e-13)


def check(rows, found, components=16):
    good = [(i, e) for i, e, _ in rows if e and all(c is not None and math.isfinite(c) for c in e)]
    sizes = Counter(len(e) for _, e in good)
    size = max(sizes, key=lambda s: (sizes[s], s))
    x = [(i, tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in e)) for i, e in good if len(e) == size]
    distinct = sorted({v for _, v in x})
    n, sums = len(distinct), [sum(c) for c in zip(*distinct)]
    centred = np.array([[(n * c - s) / n for c, s in zip(v, sums)] for v in distinct])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    rank = min(components, int((values > 1e-12 * values[0]).sum()))
    wanted = sorted(((i, sum((n * c - s) ** 2 for c, s in zip(v, sums))) for i, v in x for _ in range(rank)), key=repr)
    assert sorted(((r.vec_id, r.deviation) for r in found), key=repr) == wanted
    assert all(r.n == n and r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9) and r.identity_error < 1e-9 for r in found)
    by_id = defaultdict(set)
    for i, v in x:
        by_id[i].add(v)
    whitened = defaultdict(dict)
    for r in found:
        if len(by_id[r.vec_id]) == 1:
            whitened[r.vec_id][r.component] = r.whitened
    signs = {}
    for i, parts in whitened.items():
        (v,) = by_id[i]
        plain = (np.array([(n * c - s) / n for c, s in zip(v, sums)]) @ vectors[:, :rank]) / np.sqrt(values[:rank])
        for k, value in parts.items():
            if abs(value) > 1e-6:
                sign = signs.setdefault(k, math.copysign(1, value * plain[k - 1]))
                assert value * sign == pytest.approx(plain[k - 1], rel=1e-6, abs=1e-7)


def test_query_against_numpy(make, spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in table.collect()]
    rows += [(None, rows[0][1], 1), (rows[1][0], rows[1][1], 1), (90_001, rows[2][1], None), (90_002, None, 1), (90_003, [], 1)]
    rows += [(90_004, [None, *rows[0][1][1:]], 1), (90_005, [float("nan"), *rows[0][1][1:]], 1), (90_006, [float("-inf"), *rows[0][1][1:]], 1), (90_007, [1.0, 2.0], 1)]
    found = whitening.whiten(make(rows, SCHEMA, ("x", "component", "d", "count", "whitened")))
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(rows, found.collect())


def test_triangles_merge_in_rounds(make, monkeypatch):
    monkeypatch.setattr(whitening, "MERGE_BYTES", 1)
    rng = np.random.default_rng(3)
    rows = [(i, [float(c) for c in rng.normal(size=5) * [5, 4, 3, 2, 1]], 1) for i in range(200)]
    check(rows, whitening.whiten(make(rows, SCHEMA).repartition(7), 3).collect(), 3)


def test_few_equal_and_large_vectors(make):
    assert whitening.whiten(make([], SCHEMA)).count() == 0
    assert whitening.whiten(make([(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1)], SCHEMA)).count() == 0
    rows = [(1, [1e10, 0.0], 1), (2, [-1e10, 1.0], 1), (3, [1e30, 1.0], 1)]
    found = whitening.whiten(make(rows, SCHEMA)).collect()
    assert {(r.vec_id, r.component, r.deviation) for r in found} == {(1, 1, None), (2, 1, None)}
    assert sorted(round(r.whitened, 9) for r in found) == [-1, 1]
