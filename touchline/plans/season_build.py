"""The batch flows: stat tables to player table, two sources to consolidated tables, tables to models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from touchline.operators import consolidate, features, knn, market, merge, resolve, views
from touchline.session import materialize
from touchline.sources import writers


def build_player_table(tables: dict[str, DataFrame], keys: Sequence[str] = ("Player", "Squad")) -> tuple[DataFrame, DataFrame]:
    """Raw wide table and processed player table for every league and season in the input."""
    raw = merge.merge_stat_tables(tables, keys)
    return raw, merge.processed_players(raw)


def match_values(
    players: DataFrame, roster: DataFrame, season_year: int | Column, scope: Sequence[str] = ("league", "season"), **options
) -> DataFrame:
    """Processed players with the market value, id, date of birth and age of their roster row.

    The players' own age moves to ``Age_stats``, since Spark does not tell ``Age`` from ``age``.
    """
    own = players.withColumnRenamed("Age", "Age_stats") if "Age" in players.columns else players
    with_id = own.withColumn("row_id", F.sha2(F.concat_ws("\x1f", *scope, "Player", F.coalesce("Squad", F.lit(""))), 256))
    age = next((c for c in ("AgeYears", "Age_stats") if c in own.columns), None)
    left = resolve.add_keys(with_id, "Player", "Squad", "Born" if "Born" in own.columns else None, age, season_year)
    left = left.withColumnsRenamed({"birth_year": "birth_year_fb", "dob_iso": "dob_fb"}).withColumns(
        {"birth_year": F.col("birth_year_fb"), "dob_iso": F.col("dob_fb")}
    )
    right = resolve.add_keys(roster, "player_name", "club_name", "dob", "age", season_year)
    # both sides are read by several steps of the cascade
    return resolve.resolve(materialize(left, "keyed-players"), materialize(right, "keyed-roster"), scope, **options)


def load_consolidated(joined: DataFrame, folder: str, order: Sequence[str]) -> DataFrame:
    """Refresh the two consolidated tables together, one partition per (league, season); returns the undecided rows."""
    joined = materialize(joined, "joined")
    field, keepers, undecided = consolidate.consolidated(joined, order)
    loaded = joined.select("league_code", "season_code").distinct()
    writers.refresh_together({f"{folder}/field_players_all": field, f"{folder}/goalkeepers_all": keepers}, loaded)
    return undecided


def build_neighbours(
    table: DataFrame, candidates: Sequence[str], k: int = 10, player: str = "player_id", row: Sequence[str] = ("season_code", "club"), minutes: str = "Min"
) -> DataFrame:
    """Nearest rows of other players of one table (field players or goalkeepers), from standardised features.

    Every row with enough minutes is a point, so a player may have several, told apart by ``row``; none of them is a
    neighbour of the player's own. Gives the row, ``neighbour`` with its row (``neighbour_...``), ``rank`` and ``distance``.
    """
    own = [c for c in row if c in table.columns]
    named = table.withColumn("_row", F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (player, *own)]))
    matrix = features.feature_matrix(named, candidates, ["_row", player, *own], minutes=minutes)
    points = materialize(knn.one_row_per_player(matrix, "_row"), "points")
    # so many rows of one player at most can stand between a row and its k-th other neighbour
    most = points.groupBy(player).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1
    near = knn.nearest_neighbours(points.select("_row", "features"), k + most - 1, "_row")
    facts = points.select("_row", player, *own)
    other = facts.select(F.col("_row").alias("neighbour"), F.col(player).alias("_other"), *[F.col(c).alias(f"neighbour_{c}") for c in own])
    pairs = near.join(facts, "_row").join(other, "neighbour").filter(F.col(player) != F.col("_other")).drop("neighbour")
    place = F.row_number().over(Window.partitionBy("_row").orderBy("rank")).cast("int")
    kept = pairs.withColumn("rank", place).filter(F.col("rank") <= k).withColumnRenamed("_other", "neighbour")
    return kept.select(player, *own, "neighbour", *[f"neighbour_{c}" for c in own], "rank", "distance")


def build_opportunities(view: DataFrame, table: DataFrame, mode: str = "out_of_fold", depth: int = 10, n: int = market.KEPT) -> DataFrame:
    """Undervalued players. ``in_sample`` scores the rows the forest was trained on; ``out_of_fold`` does not."""
    on = ["player_id", "season_code", "club"]
    matrix = features.feature_matrix(table, features.FIELD_FEATURES, on)
    facts = market.valued_players(view.withColumnRenamed("Pos", "pos"))
    rows = materialize(market.training_rows(matrix, facts, on), "training-rows")
    if mode == "in_sample":
        scored = market.predict_values(rows, market.fit_values(rows, depth=depth))
    elif mode == "out_of_fold":
        scored = market.predict_out_of_fold(rows, F.col("player_id"), depth=depth)
    else:
        raise ValueError("mode is 'in_sample' or 'out_of_fold'")
    return market.undervalued(market.value_gaps(scored), n)


def player_view(spark: SparkSession, folder: str) -> DataFrame:
    """The combined player view over the stored consolidated tables."""
    from touchline.functions.parse import season_start

    field = spark.read.parquet(f"{folder}/field_players_all")
    keepers = spark.read.parquet(f"{folder}/goalkeepers_all")
    return views.player_view(field, keepers, season_order=season_start(F.col("season_code")))
