"""The hash index against exact neighbours, at two sizes, on clustered, repeated and odd vectors."""

import numpy as np
import pytest

from touchline.operators import knn, vector_index

SCHEMA = "player_id long, features array<double>"


def clustered(n, size=12, seed=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, size)) * 3
    return [(i, [float(c) for c in centres[i % 20] + rng.normal(size=size)]) for i in range(n)]


@pytest.mark.parametrize("n", [800, 4000])
def test_recall(spark, n):
    points = spark.createDataFrame(clustered(n), SCHEMA).repartition(5)
    asked = points.filter("player_id % 50 = 0")
    options = vector_index.Options(tables=4, probes=8, bucket_rows=64)
    found = vector_index.approximate_neighbours(points, 10, options)
    truth = vector_index.brute_force(points, asked, 10, block=7)
    recall = vector_index.measured_recall(found, truth).first()
    assert recall.pairs == 10 * n // 50 and recall.recall >= 0.9
    # A visit reads one bucket, of 64 vectors or a little more: far fewer than all.
    assert options.tables * (1 + options.probes) < options.tables * 2 ** int(np.ceil(np.log2(n / 64))) or n < 2000


def test_brute_force_is_exact(spark):
    points = spark.createDataFrame(clustered(300), SCHEMA)
    exact = {(r.player_id, r.neighbour): r.distance for r in knn.nearest_neighbours(points, 5).collect()}
    found = {(r.player_id, r.neighbour): r.distance for r in vector_index.brute_force(points, points, 5, block=50).collect()}
    assert found.keys() == exact.keys() and all(abs(found[p] - exact[p]) < 1e-9 for p in found)


def test_one_bucket_is_exact_and_odd_vectors(spark):
    rows = clustered(60) + [(100 + i, clustered(1)[0][1]) for i in range(30)]  # many equal vectors
    rows += [(200, None), (201, [None] * 12), (202, [float("nan")] * 12)]
    points = spark.createDataFrame(rows, SCHEMA)
    key = lambda r: (r.player_id, r.rank)
    exact, found = (sorted(df.collect(), key=key) for df in (knn.nearest_neighbours(points, 4), vector_index.approximate_neighbours(points, 4)))
    assert [(r.player_id, r.neighbour, r.rank) for r in found] == [(r.player_id, r.neighbour, r.rank) for r in exact]
    assert vector_index.approximate_neighbours(spark.createDataFrame([], SCHEMA), 4).count() == 0


def test_heavy_buckets_get_more_bits(spark):
    rng = np.random.default_rng(6)
    close = [(i, [float(c) for c in rng.normal(size=8) * 1e-3]) for i in range(1500)]  # one dense spot
    wide = [(5000 + i, [float(c) for c in rng.normal(size=8) * 100]) for i in range(1500)]
    points = spark.createDataFrame(close + wide, SCHEMA)
    options = vector_index.Options(tables=4, probes=8, bucket_rows=20)
    found = vector_index.approximate_neighbours(points, 3, options)
    truth = vector_index.brute_force(points, points.filter("player_id % 50 = 0"), 3)
    assert vector_index.measured_recall(found, truth).first().recall > 0.5


def test_options_grow_until_the_recall_is_reached(spark):
    points = spark.createDataFrame(clustered(1500), SCHEMA)
    first = vector_index.Options(tables=1, probes=1, bucket_rows=16)
    options, found = vector_index.options_for(points, points.filter("player_id % 50 = 0"), 10, 0.9, first)
    assert options.tables > 1 and options.probes == options.tables and found.count() > 0
