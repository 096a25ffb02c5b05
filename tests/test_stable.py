"""One-to-one matching against plain deferred acceptance, numbers within keys, and closed crosswalks against plain search."""

import random

import pytest
from gathered import rows
from pyspark.sql import functions as F

from touchline.operators import closure, stable


def accepted(prefs, ranks):
    """Deferred acceptance, one proposal at a time. prefs: left -> rights in order; ranks: right -> {left: rank}."""
    held, free, at = {}, sorted(prefs), {l: 0 for l in prefs}
    while free:
        l = free.pop()
        while at[l] < len(prefs[l]):
            r = prefs[l][at[l]]
            at[l] += 1
            if r not in held or ranks[r][l] < ranks[r][held[r]]:
                if r in held:
                    free.append(held[r])
                held[r] = l
                break
    return sorted((l, r) for r, l in held.items())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_stable_pairs(spark, seed):
    rng = random.Random(seed)
    edges = [(l, 100 + r, rng.randint(1, 4), rng.randint(1, 4)) for l in range(25) for r in range(20) if rng.random() < 0.35]
    edges += [(l, 100, 1, rng.randint(1, 3)) for l in range(25, 60)]  # one that everybody wants
    prefs, ranks = {}, {}
    for l, r, a, b in edges:
        prefs.setdefault(l, []).append((a, r))
        ranks.setdefault(r, {})[l] = (b, l)
    wanted = accepted({l: [r for _, r in sorted(p)] for l, p in prefs.items()}, ranks)
    df = spark.createDataFrame([*edges, *edges[:5], (None, 100, 1, 1)], "l int, r int, a int, b int")
    assert rows(stable.stable_pairs(df, "l", "r", [F.col("a")], [F.col("b")])) == sorted(wanted, key=repr)


def test_numbers_within_keys(spark):
    data = [("hot", i) for i in range(500)] + [("b", 3), ("b", 1), ("c", 9)]
    df = spark.createDataFrame(random.Random(1).sample(data, len(data)), "k string, v int").repartition(6)
    found = {(r.k, r.v): r.nth for r in stable.numbered(df, ["k"], ["v"]).collect()}
    assert found == {**{("hot", i): i + 1 for i in range(500)}, ("b", 1): 1, ("b", 3): 2, ("c", 9): 1}


LEFT = "row_id long, player_norm string, player_fl string, club_norm string, birth_year int, dob_iso string"
RIGHT = "player_id long, player_norm string, player_fl string, club_norm string, birth_year int, dob_iso string, dob string, market_value_eur long, age int"


def test_losers_get_the_next_candidate_and_scores_fill_up(spark):
    left = spark.createDataFrame([(i, "ann lee", "ann lee", "fc", 1990, None) for i in range(4)] + [(9, "bo", "bo", None, None, None), (10, "bob", "bob", None, None, None)], LEFT)
    right = spark.createDataFrame(
        [(50, "ann lee", "ann lee", "fc", 1990, None, None, 5, 30), (51, "ann lee", "ann lee", "fc", 1990, None, None, 9, 30), (52, "ann lee", "ann lee", "other", 1990, None, None, 1, 30),
         (53, "ann lee", "ann lee", "fc", 1990, None, None, None, 30), (60, "bobo", "bobo", None, 1, None, None, 7, 3), (61, "boo", "boo", None, 2, None, None, 8, 3)],
        RIGHT,
    )
    scored = spark.createDataFrame([(9, 60, 95.0), (10, 60, 99.0), (9, 61, 91.0), (10, 61, 90.0), (0, 60, 100.0)], "row_id long, player_id long, score double")
    found = {r.row_id: (r.player_id, r.stage, r.score) for r in stable.resolve_stable(left, right, scored=scored).collect()}
    assert found == {0: (51, 10, None), 1: (50, 10, None), 2: (52, 40, None), 3: (None, None, None), 9: (61, 80, 91.0), 10: (60, 80, 99.0)}
    assert {r.player_id for r in stable.resolve_stable(left.limit(0), right).collect()} == set()
    assert {r.player_id for r in stable.resolve_stable(left, right.limit(0)).collect()} == {None}


def test_groups(spark):
    rng = random.Random(7)
    edges = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1400)] + [(2000, i) for i in range(2001, 2300)] + [(7, None), (5000, 5000)]
    near = {}
    for a, b in edges:
        if b is not None:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    root = {}
    for start in sorted(near):
        todo = [start] if start not in root else []
        while todo:
            x = todo.pop()
            if x not in root:
                root[x] = start
                todo += near[x]
    assert dict(rows(closure.groups(spark.createDataFrame(rng.sample(edges, len(edges)), "a int, b int")))) == root
    assert closure.groups(spark.createDataFrame([], "a int, b int")).count() == 0


def test_contradictions(spark):
    pairs = spark.createDataFrame([("x", 1, "y", 5), ("x", 2, "z", 6), ("y", 5, "z", 6), ("x", 3, "y", 9), ("x", 4, "y", None)], "source_a string, id_a int, source_b string, id_b int")
    closed = closure.crosswalk_closure(pairs)
    assert closed.count() == 6 and closed.select("player_uuid").distinct().count() == 2
    found = [tuple(r)[1:] for r in closure.contradictions(closed, pairs).collect()]
    assert found == [("x", 2, "1", "2", 3)]


def test_numbers_are_joined_by_a_shuffle(spark):
    df = spark.range(20).selectExpr("id % 2 as k", "id as v")
    assert "strategy=merge" in stable.numbered(df, ["k"], ["v"])._jdf.queryExecution().optimizedPlan().toString()
