import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from touchline.operators import quality
from touchline.session import scratch_path

SCHEMA = "id int, k int, low double, high double, kind string, parent int"


def broken_rules(rows, parents):
    copies = Counter((r[0], r[1]) for r in rows)
    for r in rows:
        reasons = ["low above high"] if r[2] is not None and r[3] is not None and r[2] > r[3] else []
        reasons += ["low is null"] if r[2] is None else []
        reasons += ["kind outside its domain"] if r[4] is not None and r[4] not in "ab" else []
        reasons += ["parent without a parent"] if r[5] is not None and r[5] not in parents else []
        yield r, reasons + (["repeated id, k"] if copies[r[0], r[1]] > 1 else [])


@pytest.mark.parametrize("n", [0, 40, 3000])
def test_gate(spark, n):
    rnd = random.Random(n)
    some = lambda *values: rnd.choice([None, *values])
    rows = [(some(1, 2, i, i, i), some(0, i % 2), some(1.0, 2.0, 3.0), some(2.0, 5.0), some("a", "b", "c"), some(1, 2, 3, 9)) for i in range(n)]
    df = spark.createDataFrame(rows, SCHEMA)
    parents = spark.createDataFrame([(1,), (2,), (2,), (3,), (None,)], "p int")
    passed, broken = quality.gate(
        df, scratch_path(spark, "gate"), ["id", "k"], [("low", "high")], ["low"], {"kind": ["a", "b"]}, {"parent": (parents, "p")}
    )
    wanted = list(broken_rules(rows, {1, 2, 3}))
    assert passed.columns == df.columns
    assert sorted(map(repr, (tuple(r) for r in passed.collect()))) == sorted(repr(r) for r, why in wanted if not why)
    assert sorted(repr((tuple(r)[:6], r["reasons"])) for r in broken.collect()) == sorted(repr((r, why)) for r, why in wanted if why)


def test_gate_without_rules_lets_all_pass(spark):
    passed, broken = quality.gate(spark.range(5).toDF("a"), scratch_path(spark, "gate"))
    assert passed.count() == 5 and broken.count() == 0


def test_merged_statistics_after_a_refresh(spark):
    rnd = random.Random(1)
    data = [(i % 6, None if i % 9 == 0 else rnd.gauss(1e6 * (i % 6), 10), float(i % 40)) for i in range(20_000)]
    df = spark.createDataFrame([*data, (7, None, None)], "part int, a double, b double")
    stored = quality.partition_statistics(df.filter("part <> 3"), ["part"], ["a", "b"])
    fresh = quality.partition_statistics(df.filter("part = 3"), ["part"], ["a", "b"])
    merged = {r["column"]: r for r in quality.describe_merged(stored.unionByName(fresh)).collect()}
    exact = {r["column"]: r for r in quality.describe(df, ["a", "b"]).collect()}
    for c, place in (("a", 1), ("b", 2)):
        values = sorted(r[place] for r in data if r[place] is not None)
        got, true = merged[c], exact[c]
        assert (got["n"], got["nulls"], got["min"], got["max"]) == (true["n"], true["nulls"], true["min"], true["max"])
        assert got["mean"] == pytest.approx(true["mean"], rel=1e-9) and got["std"] == pytest.approx(true["std"], rel=1e-6)
        assert got["n_unique"] == pytest.approx(true["n_unique"], rel=quality.DISTINCT_ERROR)
        for name, q in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)):
            below, upto = sum(v < got[name] for v in values) / len(values), sum(v <= got[name] for v in values) / len(values)
            assert below - quality.RANK_ERROR <= q <= upto + quality.RANK_ERROR


def test_merged_statistics_of_nothing(spark):
    empty = spark.createDataFrame([(1, None)], "part int, a double")
    row = quality.describe_merged(quality.partition_statistics(empty, ["part"], ["a"])).first()
    assert (row["n"], row["nulls"], row["mean"], row["std"], row["q50"], row["n_unique"]) == (0, 1, None, None, None, 0)
    assert quality.describe_merged(quality.partition_statistics(empty.limit(0), ["part"], ["a"])).count() == 0
