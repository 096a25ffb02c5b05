"""Features, ranks, nearest players and the value model."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from touchline.operators import features, knn, market, serving, vector_index
from touchline.plans import season_build
from touchline.plans.catalogue.tables import UNION_VIEW, read, rounded
from touchline.plans.catalogue.screens import _view
from touchline.session import materialize, scratch_path
from touchline.sources import writers


def rolling_avg(spark, folder):
    events = read(spark, folder, "events").select("event_id", "user_id", "ts", "value")
    means = features.moving_average(
        events, ["user_id"], ["ts", "event_id"], {"value": "mean_of_5"}, 5, F.date_trunc("day", "ts")
    )
    return means.select("event_id", "user_id", rounded("mean_of_5").alias("mean_of_5"))


def rank_in_group(spark, folder):
    lines = read(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_extendedprice")
    ranked = features.rank_in_group(lines, ["l_returnflag"], "l_extendedprice", prefix="price")
    return ranked.withColumn("price_percent_rank", rounded("price_percent_rank", 6))


def rank_of_counts(spark, folder):
    """Ranks when few values are shared by many rows."""
    lines = read(spark, folder, "lineitem").select("l_orderkey", "l_linestatus", "l_linenumber", "l_quantity")
    return features.rank_in_group(lines, ["l_linestatus", "l_linenumber"], "l_quantity", ascending=True).drop("value_percent_rank")


def group_quantiles(spark, folder):
    events = read(spark, folder, "events")
    found = features.exact_quantiles(events, ["event_type"], "value", {"q10": 0.1, "q50": 0.5, "q75": 0.75, "q100": 1.0})
    return found.select("event_type", *[rounded(c).alias(c) for c in ("q10", "q50", "q75", "q100")])


def standardise(spark, folder):
    lines = read(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", F.lit(7.0).alias("constant")
    )
    names = ["l_quantity", "l_extendedprice", "constant"]
    return features.standardise(lines, names).withColumns({c: rounded(c) for c in names})


def _stat_table(spark, folder):
    """Sold lines per part as the season statistics of a player."""
    return (
        read(spark, folder, "lineitem")
        .groupBy(F.col("l_partkey").alias("player_id"))
        .agg(
            F.sum("l_quantity").alias("Min"), F.count(F.lit(1)).alias("MatchesPlayed"), F.sum("l_linenumber").alias("Gls"),
            F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity"))).alias("Shots"), F.max("l_suppkey").alias("Tkl"),
        )
        .withColumns({"season_code": F.lit("2024"), "club": F.lit("c")})
    )


_STATS = """stats AS (
  SELECT l_partkey AS player_id, sum(l_quantity) AS "Min", count(*) AS "MatchesPlayed", sum(l_linenumber) AS "Gls",
         coalesce(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END), 0) AS "Shots", max(l_suppkey) AS "Tkl" FROM lineitem GROUP BY 1),
played AS (SELECT * FROM stats WHERE "Min" >= 500),
moments AS (SELECT avg("Min") AS a0, stddev_pop("Min") AS d0, avg("MatchesPlayed") AS a1, stddev_pop("MatchesPlayed") AS d1, avg("Gls") AS a2, stddev_pop("Gls") AS d2,
  avg("Shots") AS a3, stddev_pop("Shots") AS d3, avg("Tkl") AS a4, stddev_pop("Tkl") AS d4 FROM played),
scaled AS (SELECT player_id, ("Min" - a0) / d0 AS f0, ("MatchesPlayed" - a1) / d1 AS f1, ("Gls" - a2) / d2 AS f2, ("Shots" - a3) / d3 AS f3, ("Tkl" - a4) / d4 AS f4
  FROM played, moments)"""


def feature_matrix(spark, folder):
    matrix = features.feature_matrix(_stat_table(spark, folder), features.FIELD_FEATURES, ["player_id"])
    return matrix.select("player_id", *[rounded(F.col("features")[i]).alias(f"f{i}") for i in range(5)])


def feature_matrix_of_season(spark, folder):
    """One season of a table of two."""
    season = F.when(F.year("l_shipdate") < 1996, "early").otherwise("late")
    stats = read(spark, folder, "lineitem").groupBy(F.col("l_partkey").alias("player_id"), season.alias("season_code")).agg(
        F.sum("l_quantity").alias("Min"), F.sum("l_linenumber").alias("Gls")
    )
    matrix = features.feature_matrix(stats, ["Min", "Gls"], ["player_id", "season_code"], season="late")
    return matrix.select("player_id", "season_code", *[rounded(F.col("features")[i]).alias(f"f{i}") for i in range(2)])


def knn_players(spark, folder):
    near = season_build.build_neighbours(_stat_table(spark, folder), features.FIELD_FEATURES, 5)
    return near.select("player_id", "neighbour", F.col("rank").cast("int").alias("rank"), rounded("distance").alias("distance"))


def knn_two_rows(spark, folder):
    """Parts with a row per line status: both rows are points, and no neighbours of each other."""
    table = (
        read(spark, folder, "lineitem")
        .groupBy(F.col("l_partkey").alias("player_id"), F.col("l_linestatus").alias("club"))
        .agg(F.sum("l_quantity").alias("Min"), F.count(F.lit(1)).alias("MatchesPlayed"), F.sum("l_linenumber").alias("Gls"))
    )
    near = season_build.build_neighbours(table, features.FIELD_FEATURES, 3)
    return near.select("player_id", "club", "rank", rounded("distance").alias("distance"))


def knn_keepers(spark, folder):
    """Suppliers as goalkeepers, by the keeper features that their lines can stand for."""
    table = (
        read(spark, folder, "lineitem")
        .groupBy(F.col("l_suppkey").alias("player_id"))
        .agg(F.sum("l_quantity").alias("GK_Min"), F.count(F.lit(1)).alias("GK_SoTA"), F.sum("l_linenumber").alias("GK_Saves"), F.max("l_partkey").alias("GK_GA"))
    )
    near = season_build.build_neighbours(table, features.KEEPER_FEATURES, 5, minutes="GK_Min")
    return near.select("player_id", "neighbour", "rank", rounded("distance").alias("distance"))


def _points(spark, folder):
    return read(spark, folder, "embeddings").select(F.col("vec_id").alias("player_id"), F.col("embedding").alias("features"))


def knn_exact(spark, folder):
    near = knn.nearest_neighbours(_points(spark, folder), 10)
    return near.select("player_id", "neighbour", F.col("rank").cast("int").alias("rank"), rounded("distance").alias("distance"))


def knn_approx(spark, folder):
    """The index over all vectors, held against brute force for every vector whose number is a multiple of 50: true distances,
    at most ten neighbours each and never the vector itself, and a recall of 0.9 or more."""
    points = _points(spark, folder)
    asked = points.filter(F.col("player_id") % 50 == 0)
    truth = materialize(vector_index.brute_force(points, asked, 10), "truth")
    _, found = vector_index.options_for(points, asked, 10, 0.9, truth=truth)
    reached = vector_index.measured_recall(found, truth).select("pairs", (F.col("recall") >= 0.9).alias("recall_reached"))
    of = lambda name, vec: points.select(F.col("player_id").alias(name), F.transform("features", lambda v: v.cast("double")).alias(vec))
    both = found.join(of("player_id", "_x"), "player_id").join(of("neighbour", "_y"), "neighbour")
    squares = F.aggregate(F.zip_with("_x", "_y", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda a, b: a + b)
    facts = both.agg(
        F.count_distinct("player_id").alias("players"), (F.max("rank") <= 10).alias("ten_at_most"), (F.max(F.abs(F.sqrt(squares) - F.col("distance"))) < 1e-9).alias("true_distances"),
        (F.count_if(F.col("player_id") == F.col("neighbour")) == 0).alias("never_itself"), (F.count_distinct("player_id", "neighbour") == F.count(F.lit(1))).alias("each_once"),
    )
    return facts.crossJoin(reached)  # one row each


def knn_one(spark, folder):
    near = knn.nearest_to(_points(spark, folder), 7, 20)
    return near.select("neighbour", rounded("distance").alias("distance"))


def knn_stored(spark, folder):
    """Neighbours stored as a table; the five of number 7 read back."""
    path = scratch_path(spark, "neighbours")
    writers.write_parquet(knn.nearest_neighbours(_points(spark, folder), 10), path)
    near = knn.similar_players(spark.read.parquet(path), 7, 5)
    return near.select("neighbour", rounded("distance").alias("distance"))


def knn_details(spark, folder):
    """Five players like number 7 with the facts of all their seasons."""
    near = knn.nearest_to(_points(spark, folder), 7, 5).withColumn("distance", rounded("distance"))
    columns = {"player_name": "full_name", "Pos": "primary_position", "season_code": "season_id", "club": "team_name", "latest_mv_eur": "value_eur", "Gls": "Gls"}
    return knn.with_details(near, _view(spark, folder), columns=columns)


def knn_details_all(spark, folder):
    """The 50 nearest of every vector with facts of their seasons."""
    near = knn.nearest_neighbours(_points(spark, folder), 50)
    near = near.select("player_id", "neighbour", F.col("rank").cast("int").alias("rank"), rounded("distance").alias("distance"))
    return knn.with_details(near, _view(spark, folder), columns={"player_name": "full_name", "season_code": "season_id"})


_PAIRS = """pairs AS (
  SELECT a.vec_id AS player_id, b.vec_id AS neighbour, sqrt(list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda p: (CAST(p[1] AS DOUBLE) - CAST(p[2] AS DOUBLE)) ** 2))) AS distance
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id{where})"""


def _facts(spark, folder, stats=None):
    """Parts as valued players: type as position, brand as club, sold lines as matches, from ``stats`` where they are counted already."""
    if stats is None:
        sold = read(spark, folder, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count(F.lit(1)).alias("MatchesPlayed"))
    else:
        sold = stats.select(F.col("player_id").alias("p_partkey"), "MatchesPlayed")
    part = read(spark, folder, "part").join(sold, "p_partkey", "left")
    return part.select(
        F.col("p_partkey").alias("player_id"), F.col("p_name").alias("player_name"),
        F.when(F.col("p_type") == "PROMO", "GK").when(F.col("p_type") != "LARGE", F.col("p_type")).alias("pos"),
        F.lit("c").alias("club"), F.col("p_brand").alias("league_name"), F.lit("2024").alias("season_code"),
        F.when(F.col("p_partkey") % 17 != 0, F.round(F.col("p_retailprice") * 110)).alias("latest_mv_eur"),
        F.col("p_size").alias("age"), "MatchesPlayed",
    )


_FACTS = """facts AS (
  SELECT p_partkey AS player_id, p_name AS player_name, CASE p_type WHEN 'PROMO' THEN 'GK' WHEN 'LARGE' THEN NULL ELSE p_type END AS pos, 'c' AS club, p_brand AS league_name,
    '2024' AS season_code, CASE WHEN p_partkey % 17 <> 0 THEN round(p_retailprice * 110) END AS latest_mv_eur, p_size AS age, "MatchesPlayed"
  FROM part LEFT JOIN (SELECT l_partkey, count(*) AS "MatchesPlayed" FROM lineitem GROUP BY 1) ON p_partkey = l_partkey),
valued AS (SELECT * FROM facts WHERE pos <> 'GK' AND "MatchesPlayed" >= 5 AND latest_mv_eur > 100000)"""


def valued_players(spark, folder):
    return market.valued_players(_facts(spark, folder))


def training_rows(spark, folder):
    matrix = features.feature_matrix(_stat_table(spark, folder), features.FIELD_FEATURES, ["player_id", "season_code", "club"])
    rows = market.training_rows(matrix, market.valued_players(_facts(spark, folder)))
    return rows.select("player_id", rounded("label").alias("label"), *[rounded(F.col("features")[i]).alias(f"f{i}") for i in range(5)])


def _bucketed(spark, df, label):
    """The frame stored in buckets; its name goes at once, its files stay."""
    table = f"{label}_{uuid.uuid4().hex}"
    stored = writers.write_bucketed(df, table, scratch_path(spark, label), 16)
    spark.sql(f"DROP TABLE {table}")
    return stored


def training_rows_bucketed(spark, folder):
    matrix = features.feature_matrix(_stat_table(spark, folder), features.FIELD_FEATURES, ["player_id", "season_code", "club"])
    players = market.valued_players(_facts(spark, folder))
    rows = market.training_rows_bucketed(_bucketed(spark, matrix, "matrix"), _bucketed(spark, players, "players"))
    return rows.select("player_id", rounded("label").alias("label"), *[rounded(F.col("features")[i]).alias(f"f{i}") for i in range(5)])


def _by_group_mean(spark, folder):
    """The simplest value model: the mean log value of the position."""
    rows = market.valued_players(_facts(spark, folder)).withColumn("label", F.log1p("latest_mv_eur"))
    means = rows.groupBy("pos").agg(F.avg("label").alias("predicted_log"))
    return rows.join(means, "pos")


def value_opportunities_baseline(spark, folder):
    best = market.undervalued(market.value_gaps(_by_group_mean(spark, folder)))
    return best.withColumns({c: rounded(c) for c in ("predicted_value_eur", "value_diff_eur", "value_ratio")})


def value_opportunities_served(spark, folder):
    """The stored list as JSON, and the 50 best read back."""
    path = scratch_path(spark, "opportunities")
    best = value_opportunities_baseline(spark, folder).select("player_uuid", "full_name", "value_diff_eur")
    writers.write_json(best, path)
    return serving.top_opportunities(spark.read.schema(best.schema).json(path))


def value_rmse(spark, folder):
    return market.log_rmse(_by_group_mean(spark, folder)).withColumn("rmse", rounded("rmse", 6))


_MEANS = """scored AS (SELECT v.*, avg(ln(1 + latest_mv_eur)) OVER (PARTITION BY pos) AS predicted_log, ln(1 + latest_mv_eur) AS label FROM valued v),
gaps AS (SELECT *, latest_mv_eur AS actual_value_eur, exp(predicted_log) - 1 AS predicted_value_eur, exp(predicted_log) - 1 - latest_mv_eur AS value_diff_eur,
  (exp(predicted_log) - 1) / (latest_mv_eur + 1) AS value_ratio FROM scored)"""

_FEATURES = ["Min", "MatchesPlayed", "Gls", "Shots", "Tkl"]


def _training(spark, folder):
    """Written, as a forest passes over its rows several times; the sold lines are read once for features and facts."""
    on = ["player_id", "season_code", "club"]
    stats = materialize(_stat_table(spark, folder), "stat-rows")
    matrix = features.feature_matrix(stats, features.FIELD_FEATURES, on)
    return materialize(market.training_rows(matrix, market.valued_players(_facts(spark, folder, stats)), on), "training-rows")


def _as_facts(scored, listed, rmse_bound=None):
    """One row of what must hold for any forest: rows scored and listed, the gaps' identities, the list's order and length."""
    gaps = market.value_gaps(scored)
    off = F.abs(F.col("value_diff_eur") - (F.col("predicted_value_eur") - F.col("actual_value_eur"))) + F.abs(
        F.col("value_ratio") * (F.col("actual_value_eur") + 1) - F.col("predicted_value_eur")
    )
    whole = gaps.agg(
        F.count(F.lit(1)).alias("n_scored"), (F.max(off / F.col("actual_value_eur")) < 1e-9).alias("gaps_hold"),
        F.count_if(F.col("value_diff_eur") > 0).alias("_below"), F.sqrt(F.avg(F.pow(F.col("label") - F.col("predicted_log"), 2))).alias("_rmse"),
        F.stddev_pop("label").alias("_spread"),
    )
    parts = listed.agg(
        F.struct(F.count(F.lit(1)).alias("listed"), F.min("value_diff_eur").alias("least"), F.count_distinct("player_uuid").alias("players")).alias("parts")
    ).scalar()
    return whole.withColumn("_list", parts).select(
        "n_scored", "gaps_hold",
        (F.col("_list.listed") == F.least("_below", F.lit(market.KEPT))).alias("list_is_full"),
        (F.coalesce("_list.least", F.lit(1.0)) > 0).alias("all_below_value"), (F.col("_list.players") == F.col("_list.listed")).alias("players_once"),
        (F.col("_rmse") < F.col("_spread")).alias("better_than_mean"),
    )


def value_opportunities_in_sample(spark, folder):
    """Facts of the list that scores the rows its forest was trained on."""
    rows = _training(spark, folder)
    scored = materialize(market.predict_values(rows, market.fit_values(rows)), "scored")
    return _as_facts(scored, market.undervalued(market.value_gaps(scored)))


def value_opportunities_out_of_fold(spark, folder):
    """Facts of the list whose players are scored by forests that have not seen them."""
    scored = materialize(market.predict_out_of_fold(_training(spark, folder), F.col("player_id")), "scored")
    return _as_facts(scored, market.undervalued(market.value_gaps(scored))).drop("better_than_mean")


def value_importances(spark, folder):
    """Each feature's share is one of a whole."""
    shares = market.importances(spark, market.fit_values(_training(spark, folder)), _FEATURES)
    total = shares.agg(F.round(F.sum("importance"), 6).alias("total")).scalar()
    return shares.select("feature", F.col("importance").between(0, 1).alias("is_share"), total.alias("total"))


def value_attributions(spark, folder):
    """A contribution per row and feature; a feature that no split uses contributes nothing."""
    rows = _training(spark, folder)
    found = market.attributions(rows, market.fit_values(rows), _FEATURES, ["player_id"])
    return found.select("player_id", "feature", (F.abs("contribution") < 10).alias("is_small"))


def value_path_attributions(spark, folder):
    """Per player: a contribution of every feature, and whether they and the base add up to the forest's own prediction."""
    rows = _training(spark, folder).select("player_id", "features", "label")
    model = market.fit_values(rows)
    found = market.path_attributions(rows, model, _FEATURES, ["player_id"]).groupBy("player_id").agg(
        F.count("contribution").alias("n_features"), (F.sum("contribution") + F.first("base")).alias("_sum")
    )
    scored = market.predict_values(rows, model).select("player_id", "predicted_log")
    return found.join(scored, "player_id").select("player_id", "n_features", (F.abs(F.col("_sum") - F.col("predicted_log")) < 1e-9).alias("adds_up"))


QUERIES = {
    "rolling_avg": (rolling_avg, """
SELECT event_id, user_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 4) + 0.0 AS mean_of_5 FROM events"""),
    "rank_in_group": (rank_in_group, """
SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, l_extendedprice, rank() OVER w AS price_rank, dense_rank() OVER w AS price_dense_rank,
       round(percent_rank() OVER w, 6) + 0.0 AS price_percent_rank FROM lineitem WINDOW w AS (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC)"""),
    "rank_of_counts": (rank_of_counts, """
SELECT l_orderkey, l_linestatus, l_linenumber, l_quantity, rank() OVER w AS value_rank, dense_rank() OVER w AS value_dense_rank
FROM lineitem WINDOW w AS (PARTITION BY l_linestatus, l_linenumber ORDER BY l_quantity)"""),
    "group_quantiles": (group_quantiles, """
SELECT event_type, round(quantile_cont(value, 0.1), 4) + 0.0 AS q10, round(quantile_cont(value, 0.5), 4) + 0.0 AS q50,
       round(quantile_cont(value, 0.75), 4) + 0.0 AS q75, round(max(value), 4) + 0.0 AS q100 FROM events GROUP BY 1"""),
    "standardise": (standardise, """
WITH m AS (SELECT avg(l_quantity) AS a, stddev_pop(l_quantity) AS b, avg(l_extendedprice) AS c, stddev_pop(l_extendedprice) AS d FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, round((l_quantity - a) / b, 4) + 0.0 AS l_quantity, round((l_extendedprice - c) / d, 4) + 0.0 AS l_extendedprice, 0.0::DOUBLE AS constant
FROM lineitem, m"""),
    "feature_matrix": (feature_matrix, f"""
WITH {_STATS} SELECT player_id, round(f0, 4) + 0.0 AS f0, round(f1, 4) + 0.0 AS f1, round(f2, 4) + 0.0 AS f2, round(f3, 4) + 0.0 AS f3, round(f4, 4) + 0.0 AS f4 FROM scaled"""),
    "feature_matrix_of_season": (feature_matrix_of_season, """
WITH s AS (SELECT l_partkey AS player_id, sum(l_quantity) AS m, sum(l_linenumber) AS g FROM lineitem WHERE year(l_shipdate) >= 1996 GROUP BY 1 HAVING m >= 500)
SELECT player_id, 'late' AS season_code, round((m - avg(m) OVER ()) / stddev_pop(m) OVER (), 4) + 0.0 AS f0, round((g - avg(g) OVER ()) / stddev_pop(g) OVER (), 4) + 0.0 AS f1 FROM s"""),
    "knn_players": (knn_players, f"""
WITH {_STATS}, pairs AS (SELECT a.player_id, b.player_id AS neighbour,
  sqrt((a.f0 - b.f0) ** 2 + (a.f1 - b.f1) ** 2 + (a.f2 - b.f2) ** 2 + (a.f3 - b.f3) ** 2 + (a.f4 - b.f4) ** 2) AS distance
  FROM scaled a JOIN scaled b ON a.player_id <> b.player_id),
r AS (SELECT *, row_number() OVER (PARTITION BY player_id ORDER BY distance, neighbour) AS place FROM pairs)
SELECT player_id, neighbour, CAST(place AS INTEGER) AS rank, round(distance, 4) + 0.0 AS distance FROM r WHERE place <= 5"""),
    "knn_two_rows": (knn_two_rows, """
WITH played AS (SELECT l_partkey AS player_id, l_linestatus AS club, sum(l_quantity) AS m, count(*) AS n, sum(l_linenumber) AS g FROM lineitem GROUP BY ALL HAVING m >= 500),
scaled AS (SELECT player_id, club, (m - avg(m) OVER ()) / stddev_pop(m) OVER () AS f0, (n - avg(n) OVER ()) / stddev_pop(n) OVER () AS f1, (g - avg(g) OVER ()) / stddev_pop(g) OVER () AS f2 FROM played),
pairs AS (SELECT a.player_id, a.club, sqrt((a.f0 - b.f0) ** 2 + (a.f1 - b.f1) ** 2 + (a.f2 - b.f2) ** 2) AS distance FROM scaled a JOIN scaled b ON a.player_id <> b.player_id),
r AS (SELECT *, row_number() OVER (PARTITION BY player_id, club ORDER BY distance) AS place FROM pairs)
SELECT player_id, club, CAST(place AS INTEGER) AS rank, round(distance, 4) + 0.0 AS distance FROM r WHERE place <= 3"""),
    "knn_keepers": (knn_keepers, """
WITH played AS (SELECT l_suppkey AS player_id, sum(l_quantity) AS m, count(*) AS n, sum(l_linenumber) AS g, max(l_partkey) AS p FROM lineitem GROUP BY ALL HAVING m >= 500),
scaled AS (SELECT player_id, (m - avg(m) OVER ()) / stddev_pop(m) OVER () AS f0, (n - avg(n) OVER ()) / stddev_pop(n) OVER () AS f1, (g - avg(g) OVER ()) / stddev_pop(g) OVER () AS f2,
  (p - avg(p) OVER ()) / stddev_pop(p) OVER () AS f3 FROM played),
pairs AS (SELECT a.player_id, b.player_id AS neighbour, sqrt((a.f0 - b.f0) ** 2 + (a.f1 - b.f1) ** 2 + (a.f2 - b.f2) ** 2 + (a.f3 - b.f3) ** 2) AS distance FROM scaled a JOIN scaled b ON a.player_id <> b.player_id),
r AS (SELECT *, row_number() OVER (PARTITION BY player_id ORDER BY distance, neighbour) AS place FROM pairs)
SELECT player_id, neighbour, CAST(place AS INTEGER) AS rank, round(distance, 4) + 0.0 AS distance FROM r WHERE place <= 5"""),
    "knn_exact": (knn_exact, f"""
WITH {_PAIRS.format(where="")}, r AS (SELECT *, row_number() OVER (PARTITION BY player_id ORDER BY distance, neighbour) AS place FROM pairs)
SELECT player_id, neighbour, CAST(place AS INTEGER) AS rank, round(distance, 4) + 0.0 AS distance FROM r WHERE place <= 10"""),
    "knn_approx": (knn_approx, """
SELECT count(*) AS players, true AS ten_at_most, true AS true_distances, true AS never_itself, true AS each_once, 10 * count(*) FILTER (vec_id % 50 = 0) AS pairs, true AS recall_reached FROM embeddings"""),
    "knn_one": (knn_one, f"""
WITH {_PAIRS.format(where=" WHERE a.vec_id = 7")} SELECT neighbour, round(distance, 4) + 0.0 AS distance FROM pairs ORDER BY pairs.distance, neighbour LIMIT 20"""),
    "knn_details": (knn_details, f"""
WITH {_PAIRS.format(where=" WHERE a.vec_id = 7")}, {UNION_VIEW},
five AS (SELECT neighbour, round(distance, 4) + 0.0 AS distance FROM pairs ORDER BY pairs.distance, neighbour LIMIT 5)
SELECT neighbour, distance, player_name AS full_name, "Pos" AS primary_position, season_code AS season_id, club AS team_name, latest_mv_eur AS value_eur, "Gls"
FROM five JOIN player_view ON neighbour = player_id"""),
    "knn_details_all": (knn_details_all, f"""
WITH {_PAIRS.format(where="")}, {UNION_VIEW},
near AS (SELECT *, row_number() OVER (PARTITION BY player_id ORDER BY distance, neighbour) AS place FROM pairs)
SELECT near.player_id, neighbour, CAST(place AS INTEGER) AS rank, round(distance, 4) + 0.0 AS distance, player_name AS full_name, season_code AS season_id
FROM near JOIN player_view v ON neighbour = v.player_id WHERE place <= 50"""),
    "knn_stored": (knn_stored, f"""
WITH {_PAIRS.format(where=" WHERE a.vec_id = 7")} SELECT neighbour, round(distance, 4) + 0.0 AS distance FROM pairs ORDER BY pairs.distance, neighbour LIMIT 5"""),
    "valued_players": (valued_players, f"WITH {_FACTS} SELECT * FROM valued"),
    "training_rows_bucketed": (training_rows_bucketed, f"""
WITH {_STATS}, {_FACTS} SELECT player_id, round(ln(1 + latest_mv_eur), 4) + 0.0 AS label, round(f0, 4) + 0.0 AS f0, round(f1, 4) + 0.0 AS f1, round(f2, 4) + 0.0 AS f2,
  round(f3, 4) + 0.0 AS f3, round(f4, 4) + 0.0 AS f4 FROM valued JOIN scaled USING (player_id)"""),
    "training_rows": (training_rows, f"""
WITH {_STATS}, {_FACTS} SELECT player_id, round(ln(1 + latest_mv_eur), 4) + 0.0 AS label, round(f0, 4) + 0.0 AS f0, round(f1, 4) + 0.0 AS f1, round(f2, 4) + 0.0 AS f2,
  round(f3, 4) + 0.0 AS f3, round(f4, 4) + 0.0 AS f4 FROM valued JOIN scaled USING (player_id)"""),
    "value_opportunities_baseline": (value_opportunities_baseline, f"""
WITH {_FACTS}, {_MEANS} SELECT player_id AS player_uuid, player_name AS full_name, pos AS primary_position, club AS team_name, league_name, age, season_code, actual_value_eur,
  round(predicted_value_eur, 4) + 0.0 AS predicted_value_eur, round(value_diff_eur, 4) + 0.0 AS value_diff_eur, round(value_ratio, 4) + 0.0 AS value_ratio, "MatchesPlayed"
FROM gaps WHERE gaps.value_diff_eur > 0 ORDER BY gaps.value_diff_eur DESC, player_id LIMIT 200"""),
    "value_opportunities_served": (value_opportunities_served, f"""
WITH {_FACTS}, {_MEANS}, r AS (SELECT player_id AS player_uuid, player_name AS full_name, round(value_diff_eur, 4) + 0.0 AS value_diff_eur
  FROM gaps WHERE gaps.value_diff_eur > 0 ORDER BY gaps.value_diff_eur DESC, player_id LIMIT 200)
SELECT * FROM r ORDER BY value_diff_eur DESC, player_uuid LIMIT 50"""),
    "value_rmse": (value_rmse, f"WITH {_FACTS}, {_MEANS} SELECT round(sqrt(avg((label - predicted_log) ** 2)), 6) + 0.0 AS rmse FROM gaps"),
    "value_opportunities_in_sample": (value_opportunities_in_sample, f"""
WITH {_STATS}, {_FACTS} SELECT count(*) AS n_scored, true AS gaps_hold, true AS list_is_full, true AS all_below_value, true AS players_once, true AS better_than_mean
FROM valued JOIN scaled USING (player_id)"""),
    "value_opportunities_out_of_fold": (value_opportunities_out_of_fold, f"""
WITH {_STATS}, {_FACTS} SELECT count(*) AS n_scored, true AS gaps_hold, true AS list_is_full, true AS all_below_value, true AS players_once
FROM valued JOIN scaled USING (player_id)"""),
    "value_importances": (value_importances, """
SELECT unnest(['Min', 'MatchesPlayed', 'Gls', 'Shots', 'Tkl']) AS feature, true AS is_share, 1.0::DOUBLE AS total"""),
    "value_path_attributions": (value_path_attributions, f"""
WITH {_STATS}, {_FACTS} SELECT player_id, CAST(5 AS BIGINT) AS n_features, true AS adds_up FROM valued JOIN scaled USING (player_id)"""),
    "value_attributions": (value_attributions, f"""
WITH {_STATS}, {_FACTS} SELECT player_id, feature, true AS is_small FROM valued JOIN scaled USING (player_id), (SELECT unnest(['Min', 'MatchesPlayed', 'Gls', 'Shots', 'Tkl']) AS feature)"""),
}
