"""The comparison of two blocks: exact, and with far fewer distances than all where vectors have few dimensions."""

import numpy as np
import pytest

from touchline.operators import knn


def brute(x, y, ids, k, limit):
    far = np.sqrt(((x[:, None] - y[None]) ** 2).sum(2))
    return {(r, i) for r in range(len(x)) for f, i in sorted((f, i) for f, listed in zip(far[r], ids) for i in listed)[:k] if f <= limit[r]}


@pytest.mark.parametrize("size, digits", [(2, 1), (5, 9), (40, 9)])
def test_nearest_of_a_block_is_exact(monkeypatch, size, digits):
    monkeypatch.setattr(knn, "BOX_ROWS", 8)
    monkeypatch.setattr(knn, "MATRIX", 2000)
    rng = np.random.default_rng(size)
    y = np.unique(rng.normal(size=(400, size)).round(digits), axis=0)
    x = np.concatenate([y[:100], rng.normal(size=(50, size)).round(digits)])
    ids = [[i] if i % 3 else [i, 1000 + i] for i in range(len(y))]
    for limit in (np.full(len(x), np.inf), np.where(np.arange(len(x)) % 2, 1.0, np.inf)):
        at, found, distance = knn._nearest(x, y, ids, 6, limit)
        assert {(a, i) for a, i, d in zip(at, found, distance) if d <= limit[a]} == brute(x, y, ids, 6, limit)


def test_nearest_with_names_and_few_vectors():
    x, y = np.array([[0.0], [5.0]]), np.array([[0.0], [0.0], [9.0]])
    at, found, distance = knn._nearest(x, y, [["b"], ["a", "c"], ["z"]], 2, np.array([np.inf, 3.0]))
    assert list(zip(at.tolist(), found, distance.tolist())) == [(0, "a", 0.0), (0, "b", 0.0)]


def test_work_of_a_row_does_not_grow_with_the_block(monkeypatch):
    """Eight times the vectors cost a row less than twice the distances; comparing all with all costs eight times."""
    plain, counted = knn._distances, []
    monkeypatch.setattr(knn, "_distances", lambda x, y: counted.append(len(x) * len(y)) or plain(x, y))
    rng, per_row = np.random.default_rng(3), []
    for n in (2000, 16000):
        y = rng.normal(size=(n, 3))
        counted.clear()
        knn._nearest(y, y, [[i] for i in range(n)], 6, np.full(n, np.inf))
        per_row.append(sum(counted) / n)
    assert per_row[1] < 2 * per_row[0] and per_row[1] < 2000


def test_vectors_of_several_lengths_are_an_error():
    with pytest.raises(ValueError):
        knn._matrix([[1.0, 2.0, 3.0], [1.0]])
