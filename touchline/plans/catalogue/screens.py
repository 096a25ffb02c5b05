"""Views and the queries behind the scouting screens."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.functions.parse import season_start
from touchline.operators import name_index, paging, serving, views
from touchline.operators.features import goals_prevented, per_90, ratio
from touchline.plans.catalogue.tables import SEASON_FACTS, UNION_VIEW, consolidated, read, rounded, season_facts
from touchline.session import materialize, scratch_path
from touchline.sources import snapshots

SUMS = {"goals": "goals_3y", "assists": "assists_3y", "minutes": "minutes_3y"}
MEANS = {"xg_per90": "xg_per90_avg_3y", "xa_per90": "xa_per90_avg_3y"}


def _facts(spark, folder):
    facts = season_facts(spark, folder)
    return facts.withColumns(
        {"xg_per90": per_90(F.col("xg"), F.col("minutes")), "xa_per90": per_90(F.col("xa"), F.col("minutes"))}
    )


def _view(spark, folder):
    return views.player_view(*consolidated(spark, folder), season_order=season_start(F.col("season_code")))


def _rounded_means(df):
    return df.withColumns({c: rounded(c) for c in MEANS.values()})


def last3_agg(spark, folder):
    ties = [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]
    return _rounded_means(views.last_seasons_agg(_facts(spark, folder), sums=SUMS, means=MEANS, by="rows", ties=ties))


def last3_by_season(spark, folder):
    return _rounded_means(views.last_seasons_agg(_facts(spark, folder), sums=SUMS, means=MEANS, by="seasons"))


_SUMMED = """player_uuid, CAST(sum(goals) AS BIGINT) AS goals_3y, CAST(sum(assists) AS BIGINT) AS assists_3y,
       CAST(sum(minutes) AS BIGINT) AS minutes_3y, round(avg(xg * 90 / minutes), 4) + 0.0 AS xg_per90_avg_3y,
       round(avg(xa * 90 / minutes), 4) + 0.0 AS xa_per90_avg_3y"""


def current_season(spark, folder):
    return views.current_season(season_facts(spark, folder)).select(
        "player_uuid", "season_id", "competition_id", "team_id", "minutes", "goals", "o_orderkey"
    )


def value_latest(spark, folder):
    events = read(spark, folder, "events").select(
        F.col("user_id").alias("player_uuid"), F.to_date("ts").alias("as_of_date"), F.col("value").alias("value_eur")
    )
    return views.latest_value(events).withColumn("as_of_date", F.date_format("as_of_date", "yyyy-MM-dd"))


def union_view(spark, folder):
    return _view(spark, folder)


def leagues(spark, folder):
    return views.leagues(_view(spark, folder))


def clubs_by_league(spark, folder):
    return views.clubs_by_league(_view(spark, folder))


def clubs_of_one_league(spark, folder):
    return views.clubs_by_league(_view(spark, folder), "europe")


def players_by_club(spark, folder):
    return views.players_by_club(_view(spark, folder), "Nation_3")


def search_name(spark, folder):
    return serving.search_players(_view(spark, folder), "ER#00000001", limit=25)


def search_indexed(spark, folder):
    """The search over stored postings, after a refresh that has given the players of one league other names."""
    players, partition, root = _view(spark, folder), ["league_name", "season_code"], scratch_path(spark, "names")
    name_index.index_names(players, root, partition=partition)
    asia = players.filter("league_name = 'ASIA'").withColumn("player_name", F.concat("player_name", F.lit(" Jr")))
    name_index.index_names(asia, root, partition=partition)
    return name_index.search_names(spark, root, "er#0000000", 40)


def last3_after_refresh(spark, folder):
    """The view after a load that changes some facts of one team and drops others; ``anew`` marks what had to be computed."""
    facts = _facts(spark, folder).withColumns({"league_code": F.col("team_id"), "season_code": F.col("season_id").cast("string")})
    root, compute = scratch_path(spark, "facts"), lambda rows: views.last_seasons_agg(rows, sums=SUMS, means=MEANS, by="seasons")
    first = snapshots.commit(root, {"facts": facts})
    view = materialize(compute(snapshots.read_table(spark, root, "facts")), "view")
    team = facts.filter("team_id = 'P'")
    second = snapshots.commit(root, {"facts": team.filter("o_orderkey % 4 <> 0").withColumn("goals", F.col("goals") + 10)}, team)
    changed = snapshots.changed_rows(spark, root, "facts", first, second)
    stay, anew = views.recomputed(view, snapshots.read_table(spark, root, "facts"), changed, compute)
    return _rounded_means(stay.withColumn("anew", F.lit(False)).unionByName(anew.withColumn("anew", F.lit(True))))


def detail_by_id(spark, folder):
    return serving.player_details(_view(spark, folder), 42)


def detail_of_season(spark, folder):
    return serving.player_details(_view(spark, folder), 42, "2022")


def in_ids(spark, folder):
    shoppers = read(spark, folder, "orders").filter(F.col("o_totalprice") > 400000).select(F.col("o_custkey").alias("player_id"))
    return serving.players_with_ids(_view(spark, folder), shoppers).select("player_id", "player_name", "club", "season_code")


def page_list(spark, folder):
    players = _view(spark, folder).select("player_id", "player_name", "Pos", "latest_mv_eur")
    order = [F.col("latest_mv_eur").desc_nulls_last(), F.col("player_id"), F.col("player_name")]
    return serving.page(players, order, number=3, size=25).withColumn("total", F.col("total").cast("long"))


def page_seek(spark, folder):
    """The last page of all players by value."""
    players = _view(spark, folder).select("player_id", "player_name", "Pos", "latest_mv_eur")
    order = [F.col("latest_mv_eur").desc_nulls_last(), F.col("player_id"), F.col("player_name")]
    path = scratch_path(spark, "ranks")
    paging.store_ranks(players, order, path, range_rows=500)
    return paging.page_seek(spark, path, players.schema, paging.page_count(spark, path, 25), 25)


def totals_rollup(spark, folder):
    facts = season_facts(spark, folder).withColumn("matches", F.lit(1))
    return serving.competition_totals(facts, "player_uuid", "competition_id", ["matches", "minutes", "goals", "assists"])


def _matches(spark, folder):
    """Lineitems as matches of the ordered part's player: home and away side, both scores."""
    lines = read(spark, folder, "lineitem")
    return lines.select(
        F.col("l_partkey").alias("player"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
        F.col("l_linestatus").alias("team"),
        F.lit("O").alias("home_team"),
        F.lit("F").alias("away_team"),
        (F.col("l_quantity") % 4).cast("long").alias("home_score"),
        (F.col("l_suppkey") % 3).alias("away_score"),
        "l_orderkey",
        "l_extendedprice",
    )


def recent_matches(spark, folder):
    ties = [F.col("l_orderkey").desc(), F.col("l_extendedprice").desc()]
    return serving.recent_matches(_matches(spark, folder), "player", "team", 5, ties=ties)


def recent_results(spark, folder):
    ties = [F.col("l_orderkey").desc(), F.col("l_extendedprice").desc()]
    lists = serving.match_lists(serving.recent_matches(_matches(spark, folder), "player", "team", 3, ties=ties).select(
        "player", "date", "result", "l_orderkey", "l_extendedprice"
    ), "player")
    line = lambda m: F.concat_ws(" ", m["date"], m["result"])
    return lists.select("player", F.array_join(F.transform("recent_matches", line), ", ").alias("results"))


_MATCHES = """matches AS (
  SELECT l_partkey AS player, strftime(l_shipdate, '%Y-%m-%d') AS date, l_linestatus AS team, 'O' AS home_team,
         'F' AS away_team, CAST(l_quantity AS BIGINT) % 4 AS home_score, l_suppkey % 3 AS away_score, l_orderkey, l_extendedprice
  FROM lineitem),
recent AS (
  SELECT *, CASE WHEN (CASE WHEN team = home_team THEN home_score - away_score ELSE away_score - home_score END) > 0 THEN 'W'
                 WHEN home_score = away_score THEN 'D' ELSE 'L' END AS result,
         row_number() OVER (PARTITION BY player ORDER BY date DESC, l_orderkey DESC, l_extendedprice DESC) AS place
  FROM matches)"""


def ratios(spark, folder):
    lines = read(spark, folder, "lineitem").groupBy("l_partkey").agg(
        F.sum("l_quantity").alias("minutes"), F.sum("l_tax").alias("xg"), F.sum("l_discount").alias("conceded")
    )
    return lines.select(
        "l_partkey",
        rounded(per_90(F.col("xg"), F.col("minutes"))).alias("xg_per90"),
        rounded(ratio(F.col("xg"), F.col("conceded"))).alias("xg_per_conceded"),
        rounded(goals_prevented(F.col("xg"), F.col("conceded"))).alias("goals_prevented"),
    )


QUERIES = {
    "last3_agg": (last3_agg, f"""
WITH {SEASON_FACTS}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY player_uuid ORDER BY season_id DESC, o_orderdate DESC, o_orderkey DESC) AS place
  FROM facts)
SELECT {_SUMMED} FROM ranked WHERE place <= 3 GROUP BY player_uuid"""),
    "last3_by_season": (last3_by_season, f"""
WITH {SEASON_FACTS}, ranked AS (
  SELECT *, dense_rank() OVER (PARTITION BY player_uuid ORDER BY season_id DESC) AS place FROM facts)
SELECT {_SUMMED} FROM ranked WHERE place <= 3 GROUP BY player_uuid"""),
    "current_season": (current_season, f"""
WITH {SEASON_FACTS}
SELECT player_uuid, season_id, competition_id, team_id, minutes, goals, o_orderkey
FROM facts JOIN (SELECT player_uuid, max(season_id) AS season_id FROM facts GROUP BY player_uuid) USING (player_uuid, season_id)"""),
    "value_latest": (value_latest, """
WITH dated AS (SELECT user_id AS player_uuid, CAST(ts AS DATE) AS as_of_date, value AS value_eur FROM events)
SELECT player_uuid, value_eur, strftime(as_of_date, '%Y-%m-%d') AS as_of_date
FROM dated JOIN (SELECT player_uuid, max(as_of_date) AS as_of_date FROM dated GROUP BY player_uuid) USING (player_uuid, as_of_date)"""),
    "union_view": (union_view, f"WITH {UNION_VIEW} SELECT * FROM player_view"),
    "leagues": (leagues, f"WITH {UNION_VIEW} SELECT DISTINCT league_name FROM player_view"),
    "clubs_by_league": (clubs_by_league, f"WITH {UNION_VIEW} SELECT DISTINCT league_name, club AS team_name FROM player_view"),
    "clubs_of_one_league": (clubs_of_one_league, f"""
WITH {UNION_VIEW} SELECT DISTINCT league_name, club AS team_name FROM player_view WHERE league_name ILIKE 'europe'"""),
    "players_by_club": (players_by_club, f"""
WITH {UNION_VIEW} SELECT DISTINCT player_id AS player_uuid, player_name AS full_name, "Pos" AS primary_position
FROM player_view WHERE lower(club) = 'nation_3'"""),
    "search_name": (search_name, f"""
WITH {UNION_VIEW} SELECT DISTINCT player_id AS player_uuid, player_name AS full_name, "Pos" AS primary_position
FROM player_view WHERE player_name ILIKE '%ER#00000001%' ORDER BY full_name, player_uuid LIMIT 25"""),
    "search_indexed": (search_indexed, f"""
WITH {UNION_VIEW}, renamed AS (SELECT player_id, player_name || CASE WHEN league_name = 'ASIA' THEN ' Jr' ELSE '' END AS full_name, "Pos" FROM player_view)
SELECT DISTINCT player_id AS player_uuid, full_name, "Pos" AS primary_position FROM renamed WHERE full_name ILIKE '%ER#0000000%'
ORDER BY full_name, player_uuid, primary_position LIMIT 40"""),
    "last3_after_refresh": (last3_after_refresh, f"""
WITH {SEASON_FACTS}, later AS (SELECT * REPLACE (CASE WHEN team_id = 'P' THEN goals + 10 ELSE goals END AS goals) FROM facts WHERE team_id <> 'P' OR o_orderkey % 4 <> 0),
ranked AS (SELECT *, dense_rank() OVER (PARTITION BY player_uuid ORDER BY season_id DESC) AS place FROM later)
SELECT {_SUMMED}, player_uuid IN (SELECT player_uuid FROM facts WHERE team_id = 'P') AS anew FROM ranked WHERE place <= 3 GROUP BY player_uuid"""),
    "detail_by_id": (detail_by_id, f"WITH {UNION_VIEW} SELECT * FROM player_view WHERE player_id = 42"),
    "detail_of_season": (detail_of_season, f"""
WITH {UNION_VIEW} SELECT * FROM player_view WHERE player_id = 42 AND season_code = '2022'"""),
    "in_ids": (in_ids, f"""
WITH {UNION_VIEW} SELECT player_id, player_name, club, season_code FROM player_view
WHERE player_id IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)"""),
    "page_list": (page_list, f"""
WITH {UNION_VIEW} SELECT player_id, player_name, "Pos", latest_mv_eur, 3 AS page, 25 AS page_size,
  (SELECT count(*) FROM player_view) AS total
FROM player_view ORDER BY latest_mv_eur DESC NULLS LAST, player_id, player_name LIMIT 25 OFFSET 50"""),
    "page_seek": (page_seek, f"""
WITH {UNION_VIEW}, placed AS (SELECT player_id, player_name, "Pos", latest_mv_eur, count(*) OVER () AS total,
  row_number() OVER (ORDER BY latest_mv_eur DESC NULLS LAST, player_id, player_name) AS place FROM player_view)
SELECT player_id, player_name, "Pos", latest_mv_eur, CAST((total + 24) // 25 AS INTEGER) AS page, 25 AS page_size, total
FROM placed WHERE (place - 1) // 25 = (total - 1) // 25"""),
    "totals_rollup": (totals_rollup, f"""
WITH {SEASON_FACTS}
SELECT player_uuid, CASE WHEN grouping(competition_id) = 1 THEN 'Total' ELSE competition_id END AS competition_id,
       grouping(competition_id) = 1 AS is_total, count(*) AS matches, CAST(sum(minutes) AS BIGINT) AS minutes,
       CAST(sum(goals) AS BIGINT) AS goals, CAST(sum(assists) AS BIGINT) AS assists
FROM facts GROUP BY GROUPING SETS ((player_uuid, competition_id), (player_uuid))"""),
    "recent_matches": (recent_matches, f"""
WITH {_MATCHES} SELECT * EXCLUDE (place) FROM recent WHERE place <= 5"""),
    "recent_results": (recent_results, f"""
WITH {_MATCHES} SELECT player, string_agg(date || ' ' || result, ', ' ORDER BY date DESC, result DESC, l_orderkey DESC, l_extendedprice DESC) AS results
FROM recent WHERE place <= 3 GROUP BY player"""),
    "ratios": (ratios, """
WITH sums AS (SELECT l_partkey, sum(l_quantity) AS minutes, sum(l_tax) AS xg, sum(l_discount) AS conceded FROM lineitem GROUP BY 1)
SELECT l_partkey, round(xg * 90 / nullif(minutes, 0), 4) + 0.0 AS xg_per90, round(xg / nullif(conceded, 0), 4) + 0.0 AS xg_per_conceded,
       round(xg - conceded, 4) + 0.0 AS goals_prevented
FROM sums"""),
}
