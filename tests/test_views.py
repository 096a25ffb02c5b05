import pytest
from pyspark.sql import functions as F

from gathered import rows
from touchline.functions.parse import season_start
from touchline.operators import quality, serving, views


@pytest.fixture(scope="module")
def facts(spark):
    data = [
        ("p", "2022", "a", 1, 0, 90, 0.1), ("p", "2023", "a", 2, 1, 90, 0.2), ("p", "2023", "b", 3, 1, 90, 0.4), ("p", "2024", "b", 4, 1, 90, 0.6),
        ("q", "2021", "c", 7, 0, 10, None),
    ]
    return spark.createDataFrame(data, "player_uuid string, season_id string, team_id string, goals int, assists int, minutes int, xg_per90 double").withColumn("xa_per90", F.col("xg_per90"))


def test_current_season_keeps_ties(facts):
    assert rows(views.current_season(facts.filter("season_id <= '2023'")).select("player_uuid", "team_id")) == [("p", "a"), ("p", "b"), ("q", "c")]


def test_last_seasons(facts):
    by_rows = {r.player_uuid: r for r in views.last_seasons_agg(facts, by="rows", ties=[F.col("team_id")]).collect()}
    assert (by_rows["p"].goals_3y, by_rows["p"].minutes_3y, round(by_rows["p"].xg_per90_avg_3y, 4)) == (9, 270, 0.4)
    by_seasons = {r.player_uuid: r for r in views.last_seasons_agg(facts).collect()}
    assert (by_seasons["p"].goals_3y, round(by_seasons["p"].xg_per90_avg_3y, 4)) == (10, 0.325)
    assert by_seasons["q"].xg_per90_avg_3y is None
    with pytest.raises(ValueError):
        views.last_seasons_agg(facts, by="years")


@pytest.fixture(scope="module")
def view(spark):
    field = spark.createDataFrame(
        [(1, "José 100%", "Racing", "FW", "LaLiga", "2023-2024", 5.0, 1), (1, "José 100%", "Boca", "FW", "LaLiga", "2024-2025", None, 2), (2, "Josefa_x", "Boca", "MF", "LaLiga", "2024", 9.0, 3)],
        "player_id int, player_name string, club string, Pos string, league_name string, season_code string, market_value_eur double, Gls int",
    )
    keepers = spark.createDataFrame([(3, "Iker", "Boca", "GK", "Serie A", "2022", 4.0, 9)], "player_id int, player_name string, club string, Pos string, league_name string, season_code string, market_value_eur double, GK_CS int")
    return views.player_view(field, keepers, season_order=season_start(F.col("season_code"))).cache()


def test_player_view(view):
    assert rows(view.select("player_id", "latest_mv_eur", "Gls", "GK_CS")) == [(1, 5.0, 1, None), (1, 5.0, 2, None), (2, 9.0, 3, None), (3, 4.0, None, 9)]


def test_hierarchy(view):
    assert [r[0] for r in views.leagues(view).collect()] == ["LaLiga", "Serie A"]
    assert [r.team_name for r in views.clubs_by_league(view, "laliga").collect()] == ["Boca", "Racing"]
    assert [r.full_name for r in views.players_by_club(view, "boca").collect()] == ["Iker", "Josefa_x", "José 100%"]


def test_search_takes_wildcards_literally(view):
    assert [r.player_uuid for r in serving.search_players(view, "JOS").collect()] == [2, 1]
    assert [r.player_uuid for r in serving.search_players(view, "0%").collect()] == [1]
    assert [r.player_uuid for r in serving.search_players(view, "a_").collect()] == [2]
    assert serving.search_players(view, "jos", limit=1).count() == 1


def test_details_and_ids(spark, view):
    assert [r.season_code for r in serving.player_details(view, 1).collect()] == ["2024-2025", "2023-2024"]
    assert serving.player_details(view, 1, "2023-2024").count() == 1 and serving.player_details(view, 99).count() == 0
    ids = spark.createDataFrame([(1,), (3,), (3,)], "player_id int")
    assert rows(serving.players_with_ids(view, ids).select("player_id")) == [(1,), (1,), (3,)]


def test_page_and_limits(view):
    page = serving.page(view, [F.col("player_id"), F.col("season_code")], 2, 3).collect()
    assert [(r.player_id, r.page, r.page_size, r.total) for r in page] == [(3, 2, 3, 4)]
    with pytest.raises(ValueError):
        serving.page(view, [F.col("player_id")], 0)
    with pytest.raises(ValueError):
        serving.check_similar_count(21)
    assert serving.check_similar_count(20) == 20


def test_opportunity_limit(spark):
    ranked = spark.range(500).select(F.col("id").alias("player_uuid"), F.col("id").alias("value_diff_eur"))
    assert serving.top_opportunities(ranked, 1000).count() == 200 and serving.top_opportunities(ranked).first().player_uuid == 499


def test_matches(spark):
    data = [("p", "2025-10-18", "Racing", "Racing", 2, "River", 1), ("p", "2025-10-11", "Racing", "Boca", 1, "Racing", 1), ("p", "2025-10-05", "Racing", "Racing", 0, "Ind", 1)]
    matches = spark.createDataFrame(data, "player string, date string, team string, home_team string, home_score int, away_team string, away_score int")
    recent = serving.recent_matches(matches, "player", "team", 5)
    assert rows(recent.select("date", "result")) == [("2025-10-05", "L"), ("2025-10-11", "D"), ("2025-10-18", "W")]
    assert [m.result for m in serving.match_lists(recent, "player").first().recent_matches] == ["W", "D", "L"]


def test_totals(spark):
    stats = spark.createDataFrame([("p", "Liga", 15, 1200, 3, 4), ("p", "Copa", 4, 350, 1, 1)], "player string, competition string, matches int, minutes int, goals int, assists int")
    total = serving.competition_totals(stats, "player", "competition", ["matches", "minutes", "goals", "assists"]).filter("is_total").collect()
    assert [tuple(r)[1:] for r in total] == [("Total", True, 19, 1550, 4, 5)]


def test_quality(spark):
    df = spark.createDataFrame([("a", 3, 2, True, 1.0, "fbref"), ("a", 1, 2, False, 1.0, "x"), ("b", None, 2, None, 1.0, None)], "k string, SoT int, Shots int, IsGK boolean, GK_A double, source string")
    report = quality.quality_report(df, ["k"], [("SoT", "Shots")], ["SoT"], ["GK_A"], allowed={"source": ["fbref"]}, distinct=["k"]).first().asDict()
    assert report == {"n_rows": 3, "duplicate_keys": 1, "SoT_above_Shots": 1, "null_SoT": 1, "keeper_values_of_others": 2, "bad_source": 1, "distinct_k": 2}
    parents = spark.createDataFrame([("a",)], "id string")
    assert rows(quality.orphans(df, parents, "k", "id")) == [("b", 1)]
    assert rows(quality.value_counts(df, "k", 1)) == [("a", 2)]


@pytest.mark.parametrize("n", [40, 2000])
def test_only_touched_players_are_computed_again(spark, n):
    from touchline.session import scratch_path
    from touchline.sources import snapshots

    schema = "player_uuid int, season_id int, goals int, league_code string, season_code string"
    facts = [(i % (n // 4) if i % 11 else None, 2018 + i % 5, i % 7, "ab"[i % 3 == 0], str(2018 + i % 5)) for i in range(n)]
    compute = lambda rows: views.last_seasons_agg(rows, sums={"goals": "goals"}, means={}, by="seasons")
    root = scratch_path(spark, "facts")
    first = snapshots.commit(root, {"t": spark.createDataFrame(facts, schema)})
    view = compute(snapshots.read_table(spark, root, "t"))
    assert snapshots.changed_rows(spark, root, "t", first, first).count() == 0
    part = [r for r in facts if r[3:] == ("b", "2022")]
    load = [(r[0], r[1], r[2] + 100, *r[3:]) for r in part[1::2]] + [(-5, 2022, 1, "b", "2022")]
    second = snapshots.commit(root, {"t": spark.createDataFrame(load, schema)}, spark.createDataFrame(part, schema))
    changed = snapshots.changed_rows(spark, root, "t", first, second)
    assert changed.count() == len(part) + len(load)
    now = snapshots.read_table(spark, root, "t")
    stay, anew = views.recomputed(view, now, changed, compute)
    touched = {r[0] for r in [*part, *load]}
    assert rows(stay.unionByName(anew)) == rows(compute(now))
    assert {r[0] for r in rows(anew)} <= touched and not {r[0] for r in rows(stay)} & touched
