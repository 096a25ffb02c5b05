"""Latest season, last seasons, latest value, and the combined player view."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from touchline.operators.skew import rows_at_max, skew_join, top_rows

SUMS = {"goals": "goals_3y", "assists": "assists_3y", "minutes": "minutes_3y"}
MEANS = {"xg_per90": "xg_per90_avg_3y", "xa_per90": "xa_per90_avg_3y"}


def current_season(stats: DataFrame, player: str = "player_uuid", season: str = "season_id") -> DataFrame:
    """Every row of each player's latest season."""
    return rows_at_max(stats, [player], season)


def latest_value(values: DataFrame, player: str = "player_uuid", day: str = "as_of_date", value: str = "value_eur") -> DataFrame:
    """The most recent market value per player; equal dates stay."""
    return rows_at_max(values.select(player, value, day), [player], day)


def last_seasons_agg(
    stats: DataFrame,
    player: str = "player_uuid",
    season: str = "season_id",
    sums: dict[str, str] = SUMS,
    means: dict[str, str] = MEANS,
    n: int = 3,
    by: str = "seasons",
    ties: Sequence[Column] = (),
) -> DataFrame:
    """Sums and means over each player's last ``n`` seasons.

    ``by="rows"`` counts rows, so two clubs in one season use up two of them (``ties`` orders rows of a season);
    ``by="seasons"`` counts seasons. The latter adds up each season first, so at most one row per player and
    season is ranked.
    """
    totals = [F.sum(c).alias(a) for c, a in sums.items()]
    if by == "rows":
        recent = top_rows(stats, [player], [F.col(season).desc_nulls_last(), *ties], n)
        return recent.groupBy(player).agg(*totals, *[F.avg(c).alias(a) for c, a in means.items()])
    if by != "seasons":
        raise ValueError("by is 'rows' or 'seasons'")
    per_season = stats.groupBy(player, season).agg(
        *totals,
        *[F.sum(c).alias(f"_s_{a}") for c, a in means.items()],
        *[F.count(c).alias(f"_n_{a}") for c, a in means.items()],
    )
    recent = top_rows(per_season, [player], [F.col(season).desc_nulls_last()], n)
    return recent.groupBy(player).agg(
        *[F.sum(a).alias(a) for a in sums.values()],
        *[F.try_divide(F.sum(f"_s_{a}"), F.sum(f"_n_{a}")).alias(a) for a in means.values()],
    )


def recomputed(
    view: DataFrame, now: DataFrame, changed: DataFrame, compute: Callable[[DataFrame], DataFrame], player: str = "player_uuid"
) -> tuple[DataFrame, DataFrame]:
    """A view per player after a refresh: its rows that stay, and those of the players that the refresh touched.

    ``changed`` holds all rows of the replaced partitions, old and new; ``compute`` makes the view out of facts and sees all
    facts of the touched players, those of unchanged partitions too. Players without facts now are in neither part.
    """
    touched = changed.select(player).distinct()
    on = view[player].eqNullSafe(touched[player])
    facts = now.join(touched.withColumnRenamed(player, "_touched"), F.col(player).eqNullSafe(F.col("_touched")), "left_semi")
    return view.join(touched, on, "left_anti"), compute(facts)


def player_view(
    field: DataFrame,
    keepers: DataFrame,
    player: str = "player_id",
    season: str = "season_code",
    value: str = "market_value_eur",
    season_order: Column | None = None,
) -> DataFrame:
    """Field players and goalkeepers together, with each player's newest known value as ``latest_mv_eur``."""
    both = field.unionByName(keepers, allowMissingColumns=True)
    order = F.col(season) if season_order is None else season_order
    known = F.when(F.col(value).isNotNull(), F.struct(order.alias("season"), F.col(value).alias("value")))
    newest = both.groupBy(player).agg(F.max(known)["value"].alias("latest_mv_eur"), F.count(F.lit(1)).alias("_rows"))
    return skew_join(both, newest.drop("_rows"), [player], "left", counts=newest)


def leagues(view: DataFrame, league: str = "league_name") -> DataFrame:
    return view.select(league).filter(F.col(league).isNotNull()).distinct().orderBy(league)


def clubs_by_league(view: DataFrame, wanted: str | None = None, league: str = "league_name", club: str = "club") -> DataFrame:
    """Clubs of one league (any case), or of every league."""
    pairs = view.select(league, F.col(club).alias("team_name"))
    if wanted is not None:
        pairs = pairs.filter(F.lower(league) == wanted.lower())
    return pairs.filter(F.col("team_name").isNotNull()).distinct().orderBy(league, "team_name")


def players_by_club(
    view: DataFrame, wanted: str, club: str = "club", player: str = "player_id", name: str = "player_name", pos: str = "Pos"
) -> DataFrame:
    """Players of one club (any case), by name."""
    return (
        view.filter(F.lower(club) == wanted.lower())
        .select(F.col(player).alias("player_uuid"), F.col(name).alias("full_name"), F.col(pos).alias("primary_position"))
        .distinct()
        .orderBy("full_name", "player_uuid", "primary_position")
    )
