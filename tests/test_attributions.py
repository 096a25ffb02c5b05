import random

import pytest

from touchline.operators import market

NAMES = ["x", "y", "z"]


def walked(model, features):
    """Contributions and base by a walk over the model's own nodes."""
    credits, base = [0.0] * len(features), 0.0
    for tree in model.trees:
        node = tree._java_obj.rootNode()
        base += node.prediction() / len(model.trees)
        while node.subtreeDepth():
            split = node.split()
            following = node.leftChild() if features[split.featureIndex()] <= split.threshold() else node.rightChild()
            credits[split.featureIndex()] += (following.prediction() - node.prediction()) / len(model.trees)
            node = following
    return credits, base


@pytest.mark.parametrize("n, trees, depth, limit", [(30, 3, 2, 500_000), (400, 6, 5, 500_000), (60, 4, 4, 0)])
def test_contributions_add_up(spark, monkeypatch, n, trees, depth, limit):
    monkeypatch.setattr(market, "BROADCAST_NODES", limit)
    rnd = random.Random(n)
    data = [(i, [rnd.random(), float(rnd.randint(0, 3)), 1.0]) for i in range(n)]
    rows = spark.createDataFrame([(i, v, v[0] * 3 + v[1]) for i, v in data], "id int, features array<double>, label double")
    model = market.fit_values(rows, trees=trees, depth=depth)
    got = {}
    for r in market.path_attributions(rows, model, NAMES, ["id"]).collect():
        got.setdefault(r["id"], {"base": r["base"]})[r["feature"]] = r["contribution"]
    predicted = {r["id"]: r["predicted_log"] for r in market.predict_values(rows, model).collect()}
    assert got.keys() == dict(data).keys()
    for i, v in data[:40]:
        credits, base = walked(model, v)
        assert [got[i][c] for c in NAMES] == pytest.approx(credits, abs=1e-9) and got[i]["base"] == pytest.approx(base)
        assert sum(got[i].values()) == pytest.approx(predicted[i], abs=1e-9) and got[i]["z"] == 0


def test_rows_are_not_multiplied_by_trees_and_levels(spark):
    """A forest that a task can hold is walked inside it: no join, and one shuffle, of a row per key."""
    rnd = random.Random(5)
    rows = spark.createDataFrame([(i, [rnd.random(), rnd.random()], rnd.random()) for i in range(200)], "id int, features array<double>, label double")
    found = market.path_attributions(rows, market.fit_values(rows, trees=3, depth=3), ["x", "y"], ["id"])
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert "Join" not in plan and plan.count("Exchange") == 1


def test_rows_without_numbers_and_repeated_keys(spark, monkeypatch):
    rnd = random.Random(6)
    rows = spark.createDataFrame([(i, [rnd.random(), rnd.random()], rnd.random()) for i in range(200)], "id int, features array<double>, label double")
    model = market.fit_values(rows, trees=3, depth=3)
    odd = spark.createDataFrame([(1, None), (2, [None, 0.3]), (3, [float("nan"), 0.1]), (4, [0.2, 0.4]), (4, [0.9, 0.1]), (None, [0.1, 0.2])], "id int, features array<double>")
    both = []
    for limit in (500_000, 0):
        monkeypatch.setattr(market, "BROADCAST_NODES", limit)
        both.append({(r["id"], r["feature"]): (r["contribution"], r["base"]) for r in market.path_attributions(odd, model, ["x", "y"], ["id"]).collect()})
    assert both[0].keys() == both[1].keys() and len(both[0]) == 10
    assert all(both[0][key] == pytest.approx(both[1][key]) for key in both[0])
