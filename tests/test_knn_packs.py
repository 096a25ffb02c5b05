"""Exact neighbours where few cells can be ruled out: packed blocks that pass by, and no shuffle of vectors."""

import numpy as np
import pytest

from touchline.operators import knn


def brute(rows, k):
    usable = [(i, np.array(v, "float64")) for i, v in rows if v is not None and not np.isnan(v).any()]
    found = set()
    for n, (i, v) in enumerate(usable):
        if i is not None:
            near = sorted((float(np.sqrt(((v - w) ** 2).sum())), j) for j, w in usable if j is not None and j != i)[:k]
            found |= {(i, j, place + 1, round(d, 6)) for place, (d, j) in enumerate(near)}
    return found


def small_steps(monkeypatch):
    """Small blocks and sides, so that a few hundred vectors take the way of many."""
    for name, value in (("BLOCK_ROWS", 24), ("SIDE_BYTES", 6000), ("WAITING", 500), ("PARTS_SENT", 0), ("MATRIX", 400), ("LEAST_ROWS", 4)):
        monkeypatch.setattr(knn, name, value)


@pytest.mark.parametrize("kind, name", [("float", int), ("double", "p{:04d}".format)])
def test_packed_search_is_exact(spark, monkeypatch, kind, name):
    small_steps(monkeypatch)
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(260, 6)).astype("float32").round(2)
    vectors[200:230] = vectors[:30]  # two players each
    vectors[230:260] = vectors[99]  # more players than are listed by the vector
    rows = [(name(i), v.tolist()) for i, v in enumerate(vectors)] + [(name(900), None), (name(901), [float("nan")] * 6), (None, vectors[3].tolist())]
    points = spark.createDataFrame(rows, f"player_id {'int' if name is int else 'string'}, features array<{kind}>").repartition(5)
    found = knn.nearest_neighbours(points, 7)
    got = [(r.player_id, r.neighbour, r.rank, round(r.distance, 6)) for r in found.collect()]
    plain = [(i, np.array(v, "float32" if kind == "float" else "float64") if v else None) for i, v in rows]
    assert len(got) == len(set(got)) == 260 * 7 and set(got) == brute(plain, 7)


def test_both_ways_agree_and_the_packed_one_shuffles_no_vectors(spark, monkeypatch):
    plans, materialize = {}, knn.materialize

    def watched(df, label):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return materialize(df, label)

    monkeypatch.setattr(knn, "materialize", watched)
    rng = np.random.default_rng(8)
    points = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(300, 40)))], "player_id long, features array<double>")
    answers = lambda: {(r.player_id, r.neighbour, r.rank, round(r.distance, 9)) for r in knn.nearest_neighbours(points, 5).collect()}
    monkeypatch.setattr(knn, "PARTS_SENT", 1 << 30)
    sent = answers()
    assert "knn-packs" not in plans and "CartesianProduct" not in plans["knn-nearest"]
    small_steps(monkeypatch)
    assert answers() == sent and len(sent) == 1500
    carrying = [line for line in plans["knn-nearest"].splitlines() if "Exchange" in line]
    assert "CartesianProduct" in plans["knn-nearest"] and carrying and all("cell#" in line for line in carrying)


def test_floats_travel_as_floats(spark, monkeypatch):
    small_steps(monkeypatch)
    seen, materialize = {}, knn.materialize
    monkeypatch.setattr(knn, "materialize", lambda df, label: seen.setdefault(label, materialize(df, label)))
    points = spark.createDataFrame([(i, [i / 3, -0.0]) for i in range(40)], "player_id long, features array<float>")
    knn.nearest_neighbours(points, 3).collect()
    assert dict(seen["knn-blocks"].dtypes)["x"] == "array<array<float>>"
