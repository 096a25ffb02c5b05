"""Joined rows to the clean consolidated tables: names, clubs, ages, values, keeper split, partition columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from touchline.functions.parse import (
    age_on, first_filled, flag, is_blank, league_title, money_loose, number_or_null, trimmed,
)
from touchline.functions.text import is_goalkeeper_token
from touchline.operators.columns import col, conform, existing, order_columns
from touchline.operators.skew import skew_join
from touchline.schemas import (
    CLUB_COLUMNS, FIELD_PLAYERS, FRONT_COLUMNS, GOALKEEPERS, NAME_COLUMNS, REDUNDANT_COLUMNS,
)


def filled_from(df: DataFrame, columns: Sequence[str]) -> Column:
    """First non-blank of the columns the table has, trimmed."""
    present = existing(df, columns)
    return trimmed(first_filled(*[col(c) for c in present])) if present else F.lit(None).cast("string")


def clean_players(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Canonical name and club, age recomputed from the date of birth, numeric value, leading columns first.

    Names and clubs are taken before the columns they come from are dropped.
    """
    today = F.current_date() if as_of is None else as_of
    year = col("birth_year_fb") if "birth_year_fb" in df.columns else None
    new = {"player_name": filled_from(df, NAME_COLUMNS[1:]), "club": filled_from(df, CLUB_COLUMNS[1:])}
    if "dob" in df.columns or year is not None:
        dob = F.when(~is_blank(col("dob")), col("dob").cast("string")) if "dob" in df.columns else F.lit(None).cast("string")
        recomputed = age_on(dob, today, year)
        new["age"] = F.coalesce(recomputed, number_or_null(col("age")).cast("int")) if "age" in df.columns else recomputed
    if "market_value_eur" in df.columns:
        new["market_value_eur"] = number_or_null(col("market_value_eur"))
    # Spark does not tell "Age" from "age": the new column has taken the old one's place
    drop = [c for c in REDUNDANT_COLUMNS if c in df.columns and c.lower() not in new]
    return order_columns(df.withColumns(new).drop(*drop), FRONT_COLUMNS)


def valued_rows(df: DataFrame) -> DataFrame:
    """Rows with a value above zero, the value parsed from loose text; highest first."""
    new = {
        "player_name": filled_from(df, NAME_COLUMNS),
        "club": filled_from(df, CLUB_COLUMNS),
        "market_value_eur": money_loose(col("market_value_eur")),
    }
    kept = df.withColumns(new).filter(F.col("market_value_eur") > 0)
    drop = [c for c in REDUNDANT_COLUMNS if c in kept.columns]
    return order_columns(kept.drop(*drop), FRONT_COLUMNS).orderBy(F.col("market_value_eur").desc(), "player_id")


def backfill(df: DataFrame, key: str, columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Blank values take the key's first non-blank value by ``order``.

    Only rows with something to fill are joined, and the first values come from one aggregation.
    """
    filled = [F.when(~is_blank(col(c)), F.struct(*[col(o) for o in order], col(c).alias("_value"))) for c in columns]
    blank = reduce(lambda a, b: a | b, [is_blank(col(c)) for c in columns])
    firsts = df.groupBy(key).agg(
        *[F.min(f)["_value"].alias(f"_first_{i}") for i, f in enumerate(filled)], F.count_if(blank).alias("_rows")
    )
    joined = skew_join(df.filter(blank), firsts.drop("_rows"), [key], "left", counts=firsts)
    repaired = joined.withColumns(
        {c: F.when(is_blank(col(c)), col(f"_first_{i}")).otherwise(col(c)) for i, c in enumerate(columns)}
    )
    return df.filter(~blank).unionByName(repaired.select(*df.columns))


def keeper_flag(df: DataFrame) -> DataFrame:
    """``IsGK`` as a boolean: the stated flag, else whether GK is one of the positions, else null."""
    stated = flag(col("IsGK")) if "IsGK" in df.columns else F.lit(None).cast("boolean")
    listed = is_goalkeeper_token(col("Pos")) if "Pos" in df.columns else F.lit(None).cast("boolean")
    return df.withColumn("IsGK", F.coalesce(stated, listed))


def split_keepers(df: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Goalkeepers, field players, and rows for which neither flag nor position says which."""
    flagged = keeper_flag(df)
    return flagged.filter(F.col("IsGK")), flagged.filter(~F.col("IsGK")), flagged.filter(F.col("IsGK").isNull())


def with_partition(df: DataFrame, league: Column, season: Column) -> DataFrame:
    return df.withColumns({"league_code": F.lower(league), "season_code": season, "league_name": league_title(league)})


def consolidated(df: DataFrame, order: Sequence[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Field players and goalkeepers in the consolidated schemas, and the undecided rows."""
    named = df.withColumns({"player_name": filled_from(df, NAME_COLUMNS), "club": filled_from(df, CLUB_COLUMNS)})
    whole = backfill(named, "player_id", ["player_name", "club"], order) if "player_id" in named.columns else named
    keepers, field, undecided = split_keepers(whole)
    return conform(field, FIELD_PLAYERS), conform(keepers, GOALKEEPERS), undecided
