import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window, functions as F

from gathered import rows
from touchline.operators import features, knn, market, skew


@pytest.fixture(scope="module")
def points(spark):
    rnd = random.Random(4)
    data = [(i, rnd.choice("aab"), rnd.choice([1.0, 2.0, 2.0, rnd.random() * 9, None]), rnd.randint(0, 40)) for i in range(400)]
    return spark.createDataFrame(data, "id int, g string, v double, t int").cache()


def test_ranks(points):
    window = Window.partitionBy("g").orderBy(F.col("v").desc())
    valued = points.filter("v is not null")
    plain = valued.select("id", F.rank().over(window), F.dense_rank().over(window), F.round(F.percent_rank().over(window), 9))
    got = features.rank_in_group(points, ["g"], "v").filter("v is not null")
    assert rows(got.select("id", "value_rank", "value_dense_rank", F.round("value_percent_rank", 9))) == rows(plain)


def test_quantiles(points):
    got = features.exact_quantiles(points, ["g"], "v", {"a": 0.0, "b": 0.3, "c": 0.5, "d": 1.0})
    plain = points.groupBy("g").agg(F.percentile("v", [0.0, 0.3, 0.5, 1.0]).alias("q")).select("g", *[F.col("q")[i] for i in range(4)])
    for mine, theirs in zip(rows(got.select("g", "a", "b", "c", "d")), rows(plain)):
        assert mine[0] == theirs[0] and np.allclose(mine[1:], theirs[1:])


@pytest.mark.parametrize("n", [1, 2, 5, 30])
def test_moving_average_over_chunks(points, n):
    window = Window.partitionBy("g").orderBy("t", "id").rowsBetween(-(n - 1), 0)
    plain = points.select("id", F.round(F.avg("v").over(window), 9))
    got = features.moving_average(points, ["g"], ["t", "id"], {"v": "m"}, n, F.floor(F.col("t") / 3))
    assert rows(got.select("id", F.round("m", 9))) == rows(plain)


def test_standardise(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (4.0, 5.0)], "a double, b double")
    got = np.array([tuple(r) for r in features.standardise(df, ["a", "b"]).collect()])
    assert np.allclose(sorted(got[:, 0]), (np.arange(4) - 1.5) / np.sqrt(1.25)) and (got[:, 1] == 0).all()


def test_features_and_minutes(spark):
    df = spark.createDataFrame([(1, 600.0, None, 2.0), (2, 100.0, 1.0, 3.0), (3, 900.0, 1.0, 5.0)], "player_id int, Min double, Gls double, Ast double")
    with pytest.warns(UserWarning, match="xG"):
        matrix = features.feature_matrix(df, ["Min", "Gls", "Ast", "xG"], ["player_id"])
    assert {r.player_id: r.features for r in matrix.collect()} == {1: [-1.0, -1.0, -1.0], 3: [1.0, 1.0, 1.0]}
    with pytest.raises(ValueError):
        features.model_features(df, ["zz"])


def brute(data, k):
    ids, vectors = [i for i, _ in data], np.array([v for _, v in data], dtype=float)
    out = set()
    for i, a in enumerate(ids):
        far = sorted((round(float(np.sqrt(((vectors[i] - vectors[j]) ** 2).sum())), 9), b) for j, b in enumerate(ids) if j != i)
        out |= {(a, b, rank, d) for rank, (d, b) in enumerate(far[:k], 1)}
    return out


def neighbours(df, k):
    return {(r.player_id, r.neighbour, r.rank, round(r.distance, 9)) for r in knn.nearest_neighbours(df, k).collect()}


@pytest.mark.parametrize("copies", [0, 150])
def test_neighbours_against_brute_force(spark, monkeypatch, copies):
    """Small blocks, heavy keys, and a third of all rows with one and the same vector."""
    monkeypatch.setattr(knn, "BLOCK_ROWS", 20)
    monkeypatch.setattr(knn, "HEAVY_BLOCKS", 2)
    monkeypatch.setattr(skew, "LIGHT_ROWS", 10)
    rnd = random.Random(copies)
    data = [(i, [round(rnd.gauss(c, 1), 2) for c in rnd.choice([(0, 0, 0), (9, 9, 0), (0, 9, 9)])]) for i in range(300)]
    data += [(1000 + i, data[0][1]) for i in range(copies)]
    rnd.shuffle(data)
    df = spark.createDataFrame(data, "player_id int, features array<double>")
    assert neighbours(df, 6) == brute(data, 6)


def test_few_players(spark):
    df = spark.createDataFrame([(1, [0.0]), (2, [1.0]), (3, [-0.0])], "player_id int, features array<double>")
    assert neighbours(df, 10) == brute([(1, [0.0]), (2, [1.0]), (3, [-0.0])], 10)
    assert knn.nearest_neighbours(df.limit(0), 3).count() == 0


def test_one_player(spark):
    df = spark.createDataFrame([("a", [0.0, 0.0]), ("b", [3.0, 4.0]), ("c", [0.0, 0.0])], "player_id string, features array<double>")
    assert [tuple(r) for r in knn.nearest_to(df, "a", 5).collect()] == [("c", 0.0), ("b", 5.0)]
    stored = knn.nearest_neighbours(df, 2)
    assert [r.neighbour for r in knn.similar_players(stored, "a", 1).collect()] == ["c"]
    assert knn.nearest_to(df, "zz").count() == 0
    with pytest.raises(ValueError):
        knn.similar_players(stored, "a", 21)


def test_newest_row(spark):
    df = spark.createDataFrame([(1, "2023", 5), (1, "2024", 6), (2, "2022", 7)], "player_id int, season string, x int")
    assert rows(knn.one_row_per_player(df, newest=[F.col("season").desc()])) == [(1, "2024", 6), (2, "2022", 7)]


@pytest.fixture(scope="module")
def valued(spark):
    rnd = random.Random(1)
    data = [(i, [rnd.gauss(0, 1), rnd.gauss(0, 1)]) for i in range(300)]
    data = [(i, f"n{i}", f, float(np.expm1(12 + f[0]))) for i, f in data]
    df = spark.createDataFrame(data, "player_id int, player_name string, features array<double>, latest_mv_eur double")
    return df.withColumn("label", F.log1p("latest_mv_eur")).cache()


def test_value_model(spark, valued, tmp_path):
    model = market.fit_values(valued, trees=20, depth=6)
    scored = market.predict_values(valued, model)
    assert market.log_rmse(scored).first()[0] < 0.4
    gaps = market.value_gaps(scored)
    best = market.undervalued(gaps, 20).collect()
    assert len(best) == 20 and all(r.value_diff_eur > 0 for r in best) and best == sorted(best, key=lambda r: -r.value_diff_eur)
    share = {r.feature: r.importance for r in market.importances(spark, model, ["x", "noise"]).collect()}
    assert share["x"] > 0.9 and abs(sum(share.values()) - 1) < 1e-9
    parts = market.attributions(valued, model, ["x", "noise"], ["player_id"]).groupBy("feature").agg(F.avg(F.abs("contribution"))).collect()
    assert dict(map(tuple, parts))["x"] > 0.5 > dict(map(tuple, parts))["noise"]
    market.save_model(model, f"{tmp_path}/m")
    assert rows(market.predict_values(valued, market.load_model(f"{tmp_path}/m")).select("player_id", "predicted_log")) == rows(scored.select("player_id", "predicted_log"))


def test_out_of_fold_scores_every_row_worse(valued):
    scored = market.predict_out_of_fold(valued, F.col("player_id"), folds=2, trees=10, depth=6)
    inside = market.predict_values(valued, market.fit_values(valued, trees=10, depth=6))
    assert scored.count() == 300 and market.log_rmse(scored).first()[0] > market.log_rmse(inside).first()[0]


def test_population(spark):
    df = spark.createDataFrame([("FW", 5, 100001.0), ("GK", 9, 9e9), (None, 9, 9e9), ("FW", 4, 9e9), ("FW", 9, 100000.0), ("FW", 9, None)], "pos string, MatchesPlayed int, latest_mv_eur double")
    assert market.valued_players(df).count() == 1


def test_probes_carry_places_but_no_vectors():
    """What a block asks of another cell are places of its rows, one short row per cell; the vectors follow by a join."""
    x, pivots = np.array([[0.0, 0.1], [0.2, 0.0]]), np.array([[0.0, 0.0], [1.0, 0.0], [50.0, 0.0]])
    block = pd.DataFrame({"cell": [0], "chunk": [0], "x": [list(x)], "limit": [[0.1, 2.0]]})
    found = pd.concat(knn._probe(pivots, np.array([0.3, 0.3, 0.3]))(iter([block])))
    assert list(found.columns) == ["cell", "chunk", "target", "at"]
    assert [(r.target, list(r.at)) for r in found.itertuples(index=False)] == [(1, [1])]
