import random

from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import RandomForestRegressor

from touchline.operators import market
from touchline.plans.catalogue import models


def test_rows_keep_their_nodes_and_the_forest_is_the_same(spark):
    rnd = random.Random(5)
    data = [([rnd.random(), float(rnd.randint(0, 4))], rnd.random()) for _ in range(500)]
    rows = spark.createDataFrame(data, "features array<double>, label double").coalesce(2)
    model = market.fit_values(rows, trees=4, depth=5)
    assert model.getCacheNodeIds()
    walking = RandomForestRegressor(featuresCol="v", labelCol="label", numTrees=4, maxDepth=5, featureSubsetStrategy="all", seed=market.SEED, maxMemoryInMB=512)
    plain = walking.fit(rows.select(array_to_vector("features").alias("v"), "label"))
    assert model.toDebugString.split("\n")[1:] == plain.toDebugString.split("\n")[1:]


def test_training_reads_the_sold_lines_once(spark, tmp_path, monkeypatch):
    parts = [(i, f"name {i}", ["STANDARD", "PROMO", "LARGE", None][i % 4] if i % 3 else "SMALL", "b", 7, 1000.0 + i) for i in range(1, 60)] + [(None, "n", "SMALL", "b", 1, 2000.0)]
    lines = [(k, n % 7 + 1, p, p % 5 if p else 1, 30.0 + n, "RNA"[n % 3]) for k, p in enumerate([*range(1, 70), None]) for n in range(p % 3 * 10 + 4 if p else 30)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_type string, p_brand string, p_size int, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_returnflag string").write.parquet(f"{tmp_path}/lineitem.parquet")
    wanted = {r.player_id: r for r in models.valued_players(spark, str(tmp_path)).collect()}
    matrix = {r.player_id for r in models.feature_matrix(spark, str(tmp_path)).collect()}
    read, names = models.read, []
    monkeypatch.setattr(models, "read", lambda spark, folder, name: names.append(name) or read(spark, folder, name))
    found = models._training(spark, str(tmp_path)).collect()
    assert sorted(names) == ["lineitem", "part"]
    assert len(found) == len({r.player_id for r in found}) > 5 and {r.player_id for r in found} == wanted.keys() & matrix
    assert all(r.MatchesPlayed == wanted[r.player_id].MatchesPlayed and r.latest_mv_eur == wanted[r.player_id].latest_mv_eur for r in found)
