"""Queries behind the scouting screens: search, details, lists, pages, matches and totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from touchline.functions.parse import season_start
from touchline.operators.skew import top_rows

MAX_SIMILAR = 20
MAX_OPPORTUNITIES = 200


def contains_text(c: Column, text: str) -> Column:
    """Substring in any case; percent and underscore in the text stand for themselves."""
    return F.contains(F.lower(c), F.lower(F.lit(text)))


def search_players(
    view: DataFrame, text: str, limit: int = 10, player: str = "player_id", name: str = "player_name", pos: str = "Pos"
) -> DataFrame:
    """Distinct players whose name contains the text, by name and id."""
    return (
        view.filter(contains_text(F.col(name), text))
        .select(F.col(player).alias("player_uuid"), F.col(name).alias("full_name"), F.col(pos).alias("primary_position"))
        .distinct()
        .orderBy("full_name", "player_uuid", "primary_position")
        .limit(limit)
    )


def player_details(
    view: DataFrame, player_id, season=None, player: str = "player_id", season_col: str = "season_code"
) -> DataFrame:
    """All seasons of one player, newest first, or one season of it. An unknown player gives no rows."""
    rows = view.filter(F.col(player) == F.lit(player_id))
    if season is not None:
        rows = rows.filter(F.col(season_col) == F.lit(season))
    return rows.orderBy(season_start(F.col(season_col)).desc_nulls_last(), F.col(season_col).desc_nulls_last())


def players_with_ids(view: DataFrame, ids: DataFrame, player: str = "player_id") -> DataFrame:
    """Rows of the listed players. A semi join never multiplies rows, so heavy players are left to adaptive execution."""
    return view.join(ids.select(player).distinct(), player, "left_semi")


def page(df: DataFrame, order: Sequence[Column], number: int = 1, size: int = 25) -> DataFrame:
    """One page of a sorted list, with ``page``, ``page_size`` and the ``total`` count on every row."""
    if number < 1 or size < 1:
        raise ValueError("page and page size start at 1")
    total = df.agg(F.count(F.lit(1))).scalar()
    rows = df.orderBy(*order).offset((number - 1) * size).limit(size)
    return rows.select(
        "*", F.lit(number).alias("page"), F.lit(size).alias("page_size"), total.alias("total")
    )


def check_similar_count(n: int) -> int:
    if n > MAX_SIMILAR:
        raise ValueError(f"at most {MAX_SIMILAR} similar players can be asked for")
    return n


def top_opportunities(ranked: DataFrame, limit: int = 50, by: str = "value_diff_eur", tie: str = "player_uuid") -> DataFrame:
    """The best of the stored opportunity list; more than 200 are never served."""
    return ranked.orderBy(F.col(by).desc(), F.col(tie)).limit(min(limit, MAX_OPPORTUNITIES))


def recent_matches(
    matches: DataFrame,
    player: str,
    team: str,
    n: int = 5,
    day: str = "date",
    home: str = "home_team",
    away: str = "away_team",
    home_score: str = "home_score",
    away_score: str = "away_score",
    ties: Sequence[Column] = (),
) -> DataFrame:
    """Each player's last ``n`` matches, newest first, with W, D or L as the player's team saw it."""
    at_home = F.col(team) == F.col(home)
    ahead = F.when(at_home, F.col(home_score) - F.col(away_score)).when(
        F.col(team) == F.col(away), F.col(away_score) - F.col(home_score)
    )
    result = F.when(ahead > 0, "W").when(ahead == 0, "D").when(ahead < 0, "L")
    return top_rows(matches, [player], [F.col(day).desc(), *ties], n).withColumn("result", result)


def match_lists(recent: DataFrame, player: str, day: str = "date") -> DataFrame:
    """Recent matches as one sorted array per player; the input holds at most n rows of each."""
    fields = [day] + [c for c in recent.columns if c not in (player, day)]
    return recent.groupBy(player).agg(
        F.sort_array(F.collect_list(F.struct(*fields)), asc=False).alias("recent_matches")
    )


def competition_totals(stats: DataFrame, player: str, competition: str, sums: Sequence[str]) -> DataFrame:
    """Sums per player and competition, and under them the player's ``Total`` row."""
    rolled = (
        stats.rollup(player, competition)
        .agg(F.grouping_id().alias("_level"), *[F.sum(F.coalesce(F.col(c), F.lit(0))).alias(c) for c in sums])
        .filter(F.col("_level") < 3)
    )
    is_total = F.col("_level") == 1
    return rolled.select(
        player,
        F.when(is_total, F.lit("Total")).otherwise(F.col(competition)).alias(competition),
        is_total.alias("is_total"),
        *sums,
    )
