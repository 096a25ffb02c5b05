import random
from functools import reduce

import pytest
from pyspark.sql import functions as F, types as T

from gathered import rows
from touchline.operators import columns, consolidate, merge
from touchline.schemas import FIELD_PLAYERS


def test_names():
    assert columns.unique_names(["a", "a", "a__dup1", "a"]) == ["a", "a__dup1", "a__dup1__dup1", "a__dup2"]
    assert merge.merge_names({"x": ["k", "a"], "y": ["k", "a"], "z": ["k", "a", "b"]}, ["k"]) == {"x": ["a"], "y": ["a__r"], "z": ["a__r__dup1", "b"]}
    assert columns.resolve_names(["t1_Sh", "stats_Gls"], {"shooting_Sh": "Shots", "stats_Gls": "Gls", "x_Zz": "Z"}) == {"Shots": "t1_Sh", "Gls": "stats_Gls"}
    with pytest.raises(ValueError):
        columns.resolve_names(["t1_Att"], {"passing_Att": "PassAtt", "keepers_Att": "GKAtt"})


def test_prefix_ties_go_by_alphabet(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "Player int, zz_a int, bb_b int, Goals int")
    assert columns.add_prefix(df, "t0").columns == ["Player", "zz_a", "bb_b", "bb_Goals"]
    assert columns.add_prefix(df.select("Player", "Goals"), "t0").columns == ["Player", "t0_Goals"]


def test_flatten_and_repeats(spark):
    schema = T.StructType([T.StructField("a", T.StructType([T.StructField("b", T.IntegerType()), T.StructField("", T.IntegerType())])), T.StructField("c", T.IntegerType())])
    assert columns.flatten(spark.createDataFrame([((1, 2), 3)], schema)).columns == ["a_b", "a", "c"]
    twice = spark.createDataFrame([(1, 2)], "x int, y int").toDF("x", "x")
    assert rows(columns.first_of_each(twice)) == [(1,)]
    assert columns.ensure_unique(twice).columns == ["x", "x__dup1"]


def test_conform_types(spark):
    df = spark.createDataFrame([("7", "x", "12.0", "1.5")], "player_id string, age string, Gls string, xG string")
    out = columns.conform(df, FIELD_PLAYERS)
    assert out.schema == FIELD_PLAYERS
    row = out.first()
    assert (row.player_id, row.age, row.Gls, row.xG, row.dob) == (7, None, 12, 1.5, None)


def test_merge_equals_chained_outer_joins(spark):
    rnd = random.Random(2)
    frames = {n: spark.createDataFrame([(k, rnd.random()) for k in rnd.sample(range(12), 6)], f"k int, {n} double") for n in "abc"}
    chained = reduce(lambda x, y: x.join(y, "k", "full"), frames.values())
    merged = merge.outer_merge(frames, ["k"], {})
    assert rows(merged.select("k", "a", "b", "c")) == rows(chained.select("k", "a", "b", "c"))
    assert merged._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


@pytest.fixture(scope="module")
def tables(spark):
    key = "league string, season string, Player string"
    stats = [
        ("ENG1", "2024", "José  Núñez", "GK", "A", "25-123", "1,234"), ("ENG1", "2024", "JOSE NUNEZ", "DF", "B", "26", "1"),
        ("ARG1", "2024", "Jose Nunez", "DF", None, "x-1", "2"), ("ENG1", "2024", None, "DF", "C", "20", "3"),
        ("ENG1", "2024", "Łukasz", "MF", "C", None, "4"),
    ]
    shooting = [("ENG1", "2024", "Jose Nunez", 3, 5), ("ENG1", "2024", "Extra Man", 1, 0)]
    keepers = [("ENG1", "2024", "jose nunez", "7", "0"), ("ENG1", "2024", "lukasz", "9", "10")]
    return {
        "stats": spark.createDataFrame(stats, f"{key}, Pos string, Squad string, Age string, Gls string"),
        "shooting": spark.createDataFrame(shooting, f"{key}, Sh int, SoT int"),
        "keepers": spark.createDataFrame(keepers, f"{key}, Saves string, SoTA string"),
        "teams": spark.createDataFrame([("ENG1", "2024", "x")], "league string, season string, Squad string"),
    }


def test_player_table(tables):
    raw = merge.merge_stat_tables(tables)
    done = {(r.league, r.Player, r.Squad): r for r in merge.processed_players(raw).collect()}
    assert set(done) == {
        ("ENG1", "jose nunez", "A"), ("ENG1", "jose nunez", "B"), ("ARG1", "jose nunez", ""), ("ENG1", "lukasz", "C"), ("ENG1", "extra man", ""),
    }
    first, second = done["ENG1", "jose nunez", "A"], done["ENG1", "jose nunez", "B"]
    assert (first.IsGK, first.Gls, first.Age, first.GK_Saves) == (True, 1234.0, 25.34, 7.0)
    assert (second.IsGK, second.Gls, second.Age, second.GK_Saves) == (False, 1.0, 26.0, None)
    assert (first.Shots, second.Shots, second.SoT) == (3.0, 3.0, 3.0)
    assert done["ARG1", "jose nunez", ""].Age is None
    assert done["ENG1", "lukasz", "C"].player_raw == "Łukasz" and done["ENG1", "lukasz", "C"].Gls == 4.0


def test_name_key_alone_keeps_the_first_row(tables):
    done = merge.processed_players(merge.merge_stat_tables(tables, ["Player"])).filter("league = 'ENG1' and Player = 'jose nunez'")
    assert done.count() == 1


def test_no_named_row_disappears(tables):
    raw = merge.merge_stat_tables(tables).select("Player", "Squad", "league", "shooting_Sh", "keepers_Saves").collect()
    assert {(r.league, r.Player) for r in raw} == {("ENG1", "jose nunez"), ("ARG1", "jose nunez"), ("ENG1", "lukasz"), ("ENG1", "extra man")}
    assert {r.shooting_Sh for r in raw if r.Player == "extra man"} == {1}
    assert {r.stat_table: r.n_rows for r in merge.nameless_rows(tables).collect()} == {"stats": 1, "shooting": 0, "keepers": 0}


def test_percentages(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 800.0), (None, 3.0)], "a double, b double")
    assert [r[0] for r in df.select(merge.percent("a", "b")).collect()] == [0.0, 0.12, 0.0]


def test_keepers_attach_once(spark):
    players = spark.createDataFrame([("a", "x"), ("a", None), ("b", "x")], "Player string, Squad string")
    keepers = spark.createDataFrame([("a", "x", 1.0), ("a", "x", 2.0), ("a", None, 3.0)], "Player string, Squad string, GK_GA double")
    assert rows(merge.attach_keepers(players, keepers)) == [("a", "x", 1.0), ("a", None, 3.0), ("b", "x", None)]


def test_cleaning(spark):
    df = spark.createDataFrame(
        [(1, None, "jose n", "river", "2000-02-29", "0.0", "k", "1000"), (2, "nan", "b", None, None, "31", "k", "bad")],
        "player_id int, Player string, player_norm string, Squad string, dob string, age string, join_method string, market_value_eur string",
    )
    out = consolidate.clean_players(df, F.lit("2021-02-28").cast("date"))
    assert out.columns == ["player_id", "player_name", "club", "dob", "age", "market_value_eur"]
    assert rows(out) == [(1, "jose n", "river", "2000-02-29", 21, 1000.0), (2, "b", None, None, 31, None)]


def test_valued_rows(spark):
    df = spark.createDataFrame([(1, "a", "€ 5"), (2, "b", "0"), (3, "c", None), (4, "d", "€ 1.200.000,50")], "player_id int, Player string, market_value_eur string")
    out = consolidate.valued_rows(df)
    assert [tuple(r) for r in out.select("player_id", "player_name", "market_value_eur").collect()] == [(4, "d", 1200000.5), (1, "a", 5.0)]


def test_split_and_backfill(spark):
    df = spark.createDataFrame(
        [(1, 1, "true", "DF", "A", ""), (1, 2, "false", "GK", "nan", "x"), (2, 3, "", "DF, gk", None, None), (3, 4, None, "DF", "C", "y"), (None, 5, "nan", None, "", "z")],
        "player_id int, n int, IsGK string, Pos string, player_name string, club string",
    )
    filled = consolidate.backfill(df, "player_id", ["player_name", "club"], ["n"])
    assert {r.n: (r.player_name, r.club) for r in filled.collect()} == {1: ("A", "x"), 2: ("A", "x"), 3: (None, None), 4: ("C", "y"), 5: (None, "z")}
    parts = consolidate.split_keepers(df)
    assert [sorted(r.n for r in p.collect()) for p in parts] == [[1, 3], [2, 4], [5]]
