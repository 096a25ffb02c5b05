import random

import pytest
from pyspark.sql import functions as F

from gathered import rows
from touchline.operators import skew


@pytest.fixture(scope="module")
def sides(spark):
    rnd = random.Random(3)
    left = [(i, rnd.choice([1, 1, 1, 1, 2, 3, None, 9]), rnd.choice("ab")) for i in range(300)]
    right = [(k, c, f"{k}{c}") for k in (1, 2, 3, 4) for c in "ab"] + [(None, "a", "null")]
    return spark.createDataFrame(left, "id int, k int, c string"), spark.createDataFrame(right, "k int, c string, v string")


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_cut_join_equals_plain_join(sides, how):
    left, right = sides
    plain = left.join(right, ["k", "c"], how).select(*(["id", "k", "c", "v"] if how in ("left", "inner") else ["id", "k", "c"]))
    assert rows(skew.skew_join(left, right, ["k", "c"], how, light_rows=3)) == rows(plain)


def test_both_sides_cut(sides):
    left, _ = sides
    other = left.select("k", "c", F.col("id").alias("other"))
    got = skew.skew_join(left, other, ["k", "c"], "inner", both=True, light_rows=3)
    assert rows(got.select("id", "other")) == rows(left.join(other, ["k", "c"]).select("id", "other"))


def test_null_safe(sides):
    left, right = sides
    got = skew.skew_join(left, right, ["k", "c"], "inner", null_safe=True, light_rows=3)
    on = left.k.eqNullSafe(right.k) & left.c.eqNullSafe(right.c)
    assert rows(got.select("id", "v")) == rows(left.join(right, on).select("id", "v"))


def test_heavy_key_is_cut(sides):
    left, right = sides
    heavy = {r.k: r._pieces for r in skew.heavy_keys(left, ["k"], 50).collect()}
    assert set(heavy) == {1} and heavy[1] >= 2
    marked = skew._join_pieces(left, skew.heavy_keys(left, ["k"], 10), ["k"], "_n")
    per_piece = marked.groupBy("k", skew._own_piece(["id"], "_n").alias("p")).count().agg(F.max("count")).first()[0]
    assert per_piece < left.filter("k = 1").count() / 4


def test_join_plan_has_no_pairwise_comparison(sides):
    left, right = sides
    plan = skew.skew_join(left, right, ["k", "c"], "left")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_top_rows_are_cut_before_the_shuffle(sides):
    left, _ = sides
    top = skew.top_rows(left, ["k"], [F.col("id").desc()], 2)
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()
    wanted = {}
    for i, k, _ in sorted(left.collect(), reverse=True):
        wanted.setdefault(k, []).append(i)
    assert {(r.k, r.id) for r in top.collect()} == {(k, i) for k, ids in wanted.items() for i in ids[:2]}


def test_rows_at_max_and_unique(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 4, "c"), (2, 1, "d")], "k int, v int, x string")
    assert rows(skew.rows_at_max(df, ["k"], "v").select("k", "x")) == [(1, "a"), (1, "b"), (2, "d")]
    assert rows(skew.keep_unique(df, ["k"])) == [(2, 1, "d")]


def test_large_joins_are_merged_and_rows_dealt(spark):
    """Tables that Spark takes for small by their files are not broadcast where both grow; rows are dealt by their number."""
    df = spark.range(1000).selectExpr("id % 10 as k", "id as v")
    right = spark.range(10).selectExpr("id as k", "id as w")
    joined = skew.skew_join(df, right, ["k"], "inner", large=True)
    assert "strategy=merge" in joined._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, skew.skew_join(df, right, ["k"], "inner").collect()))
    dealt = skew.spread_rows(df, 100)
    assert dealt.rdd.getNumPartitions() == 10 and sorted(map(tuple, dealt.collect())) == sorted(map(tuple, df.collect()))
    assert skew.spread_rows(df, 1000) is df
