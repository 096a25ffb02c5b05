"""Connected groups and prefix sums against plain Python."""

import random

from pyspark.sql import functions as F

from touchline.llm import common


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 50)] + [(200, 200)]
    edges += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    label = {}

    def find(x):
        while label.setdefault(x, x) != x:
            x = label[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        label[b] = a
    linked = {x for e in edges if e[0] != e[1] for x in e}
    found = common.components(spark.createDataFrame(edges, "a long, b long").repartition(3)).collect()
    assert sorted((r.id, r.component) for r in found) == sorted((x, find(x)) for x in linked)
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_offsets(spark):
    rows = [(k, c, i, i % 7) for k in ("a", None) for c in range(5) for i in range(20)]
    df = spark.createDataFrame(rows, "k string, c int, i int, n long").repartition(4)
    got = common.offsets(df, "n", ["k"], "c", [F.col("i")]).collect()
    for key in ("a", None):
        total = 0
        for r in sorted((r for r in got if r.k == key), key=lambda r: (r.c, r.i)):
            assert r.start == total
            total += r.n


def test_count_words(spark):
    texts = [None, "", " ", "a", " a\tb\x0bc ", "a\u00a0b"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(common.count_words("t")).collect()] == [0, 0, 0, 1, 3, 1]
