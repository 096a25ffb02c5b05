"""Cells of the hash index: a vector travels once to each cell that it looks into, and finds there what its buckets hold."""

import numpy as np
import pyarrow as pa

from touchline.operators import vector_index


def test_a_vector_travels_once_to_each_cell():
    rng = np.random.default_rng(2)
    n, bits, probes = 300, 10, 16
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(n)), pa.array(list(rng.normal(size=(n, 6))), pa.list_(pa.float64()))], names=["vid", "vec"])
    planes, middle = rng.normal(size=(2, vector_index.PLANES, 6)), np.zeros((2, vector_index.PLANES))
    rows = {}
    for what in ("members", "home", "others"):
        coded = pa.Table.from_batches(list(vector_index._coder(planes, middle, bits, probes, [2, 10, 18], {}, what)(iter([batch]))))
        rows[what] = coded.to_pylist()
    assert len(rows["members"]) == len(rows["home"]) == 2 * n
    seen = [(r["vid"], r["table"], r["depth"], r["prefix"]) for what in ("home", "others") for r in rows[what]]
    assert len(seen) == len(set(seen)) <= 2 * n * 4
    codes = {}
    for r in rows["home"] + rows["others"]:
        assert all(c >> (vector_index.PLANES - 2) == r["prefix"] for c in r["codes"])
        codes.setdefault((r["vid"], r["table"]), []).extend(r["codes"])
    assert all(len(c) == len(set(c)) == 1 + probes for c in codes.values())
    own = {(r["vid"], r["table"]): r["code"] for r in rows["members"]}
    assert all(r["codes"][0] == own[r["vid"], r["table"]] for r in rows["home"])


def test_players_asked_for_alone_get_what_they_get_among_all(spark):
    rng = np.random.default_rng(7)
    data = [(i, [float(c) for c in rng.normal(size=6)]) for i in range(900)]
    points = spark.createDataFrame(data, "player_id long, features array<double>")
    options = vector_index.Options(tables=2, probes=4, bucket_rows=30)
    found = lambda df: {(r.player_id, r.neighbour, r.rank) for r in df.collect()}
    every = found(vector_index.approximate_neighbours(points, 5, options))
    some = found(vector_index.approximate_neighbours(points, 5, options, asked=points.filter("player_id % 50 = 0")))
    assert some == {r for r in every if r[0] % 50 == 0} and len(some) > 80


def test_small_cells_find_the_same(spark, monkeypatch):
    rng = np.random.default_rng(8)
    data = [(i, [float(c) for c in rng.normal(size=6) * (0.01 if i % 3 else 1)]) for i in range(1200)]
    points = spark.createDataFrame(data, "player_id long, features array<float>")
    options = vector_index.Options(tables=2, probes=6, bucket_rows=20)
    found = lambda: {(r.player_id, r.neighbour, r.rank, r.distance) for r in vector_index.approximate_neighbours(points, 4, options).collect()}
    whole = found()
    for name, rows in (("CELL_ROWS", 40), ("MOST_ROWS", 160), ("VISITS", 50)):
        monkeypatch.setattr(vector_index, name, rows)
    assert found() == whole
