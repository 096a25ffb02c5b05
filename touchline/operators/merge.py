"""One row per player from many stat tables, and the metrics derived from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from touchline.functions.parse import age_in_years, number_or_null, number_or_zero, text_or_empty
from touchline.functions.text import is_goalkeeper_text, name_key
from touchline.operators.columns import add_prefix, col, existing, first_of_each, flatten, resolve_names, unique_names
from touchline.operators.skew import skew_join, top_rows
from touchline.schemas import FIELD_METRICS, KEEPER_METRICS, TEXT_COLUMNS


def merge_names(tables: dict[str, Sequence[str]], keys: Sequence[str]) -> dict[str, list[str]]:
    """Output names of each table's columns in the wide table; a clash gets ``__r`` or ``__dupN``."""
    flat, owner = [], []
    taken = set(keys)
    for label, columns in tables.items():
        for c in columns:
            if c in keys:
                continue
            name = f"{c}__r" if c in taken else c
            flat.append(name)
            owner.append(label)
        taken.update(flat)
    named = unique_names([*keys, *flat])[len(keys):]
    result: dict[str, list[str]] = {label: [] for label in tables}
    for label, name in zip(owner, named):
        result[label].append(name)
    return result


def outer_merge(tables: dict[str, DataFrame], keys: Sequence[str], order: dict[str, Sequence[str]]) -> DataFrame:
    """Full outer merge of many tables on ``keys``, one row per key, the first row of each table's key by ``order``.

    Every table is stacked as one struct column and folded by a single aggregation, so there is one shuffle for
    any number of tables, and repeats of a key are reduced before it. ``min_by`` replaces the separate
    de-duplication.
    """
    keys = list(keys)
    names = merge_names({label: df.columns for label, df in tables.items()}, keys)
    structs = {}
    for label, df in tables.items():
        body = [c for c in df.columns if c not in keys]
        structs[label] = F.struct(*[col(c).alias(n) for c, n in zip(body, names[label])]) if body else F.struct(F.lit(1).alias("_"))
    stacked = None
    for label, df in tables.items():
        rank = F.struct(*[col(c) for c in order[label]]) if order.get(label) else F.struct(F.lit(0).alias("_"))
        part = df.select(*keys, structs[label].alias(f"_row_{label}"), rank.alias(f"_ord_{label}"))
        stacked = part if stacked is None else stacked.unionByName(part, allowMissingColumns=True)
    merged = stacked.groupBy(*keys).agg(
        *[F.min_by(f"_row_{label}", f"_ord_{label}").alias(f"_row_{label}") for label in tables]
    )
    return merged.select(
        *keys, *[F.col(f"_row_{label}")[n].alias(n) for label in tables for n in names[label]]
    )


def prepare_table(df: DataFrame, prefix: str, player: str = "Player", keep: Sequence[str] = ()) -> DataFrame | None:
    """One landed stat table, keyed by the normalised name; None when it has no player column.

    The spelling as landed stays in ``player_raw``; rows without a name are left out.
    """
    df = first_of_each(flatten(df))
    if player not in df.columns:
        return None
    df = df.withColumn("player_raw", col(player)).withColumn(player, name_key(col(player)))
    return add_prefix(df.filter(col(player) != ""), prefix, {player, "player_raw", *keep})


def nameless_rows(tables: dict[str, DataFrame], player: str = "Player") -> DataFrame:
    """Rows per table that have no player name and so cannot be merged: ``stat_table``, ``n_rows``."""
    counts = None
    for label, df in tables.items():
        df = first_of_each(flatten(df))
        if player in df.columns:
            one = df.filter(name_key(col(player)) == "").agg(F.lit(label).alias("stat_table"), F.count(F.lit(1)).alias("n_rows"))
            counts = one if counts is None else counts.unionByName(one)
    if counts is None:
        raise ValueError("no stat table has a player column")
    return counts


def merge_stat_tables(
    tables: dict[str, DataFrame], keys: Sequence[str] = ("Player", "Squad"), partition: Sequence[str] = ("league", "season")
) -> DataFrame:
    """All stat tables of all leagues and seasons to the wide raw table, in one job; no row with a name is lost.

    A player who moved has a row per club. Tables that know only the first key (no ``Squad``) are merged on that, and
    their numbers, which are those of the whole season, stand on each of the player's rows.
    """
    on, by_name = [*partition, *keys], [*partition, keys[0]]
    ready: dict[tuple[str, ...], dict[str, DataFrame]] = {tuple(on): {}, tuple(by_name): {}}
    for label, df in tables.items():
        table = prepare_table(df, label, keys[0], keep=on)
        if table is None or any(k not in table.columns for k in by_name):
            continue
        own = on if all(k in table.columns for k in on) else by_name
        ready[tuple(own)][label] = table.withColumnRenamed("player_raw", f"{label}_player_raw")
    merged = [
        outer_merge(group, own, {label: [c for c in df.columns if c not in own] for label, df in group.items()})
        for own, group in ready.items()
        if group
    ]
    if not merged:
        raise ValueError("no stat table has the key columns")
    if len(merged) == 1:
        return merged[0]
    clubs, players = merged
    taken = {c: f"{c}__r" for c in players.columns if c in clubs.columns and c not in by_name}
    return clubs.join(players.withColumnsRenamed(taken), by_name, "full")


def percent(part: str, whole: str) -> Column:
    """Share in percent, half to even at two decimals; nothing to divide by gives 0."""
    share = F.try_divide(col(part), F.nullif(col(whole), F.lit(0))) * 100
    return F.bround(F.coalesce(share, F.lit(0.0)), 2)


def attach_keepers(players: DataFrame, keepers: DataFrame, on: Sequence[str] = ("Player", "Squad")) -> DataFrame:
    """Left join of goalkeeper metrics on (player, squad) when both have a squad, else on the player.

    Keepers are reduced to one row per key first, so no row is repeated; a missing squad matches a missing squad.
    """
    on = [k for k in on if k in players.columns and k in keepers.columns]
    metrics = [c for c in keepers.columns if c not in on]
    one = top_rows(keepers, on, [col(c).asc_nulls_last() for c in metrics])
    return skew_join(players, one, on, "left", null_safe=True)


def derive_metrics(df: DataFrame, pos: str = "Pos") -> DataFrame:
    """Goalkeeper flag, percentages, capped shots on target, years of age, and no keeper numbers for others."""
    have = set(df.columns)
    new: dict[str, Column] = {}
    keeper = F.coalesce(col("IsGK").cast("boolean"), F.lit(False)) if "IsGK" in have else is_goalkeeper_text(col(pos))
    new["IsGK"] = keeper
    for c in [c for c in df.columns if c.startswith("GK_")]:
        new[c] = F.when(keeper, number_or_null(col(c)))
    if {"GK_Saves", "GK_SoTA"} <= have and "GK_SavePct" not in have:
        numbers = df.withColumns({c: number_or_null(col(c)) for c in ("GK_Saves", "GK_SoTA")})
        df = numbers.withColumn("GK_SavePct", percent("GK_Saves", "GK_SoTA"))
        new["GK_SavePct"] = F.when(keeper, col("GK_SavePct"))
    if {"PassCmp", "PassAtt"} <= have:
        new["PassCmpPct"] = percent("PassCmp", "PassAtt")
    if {"SoT", "Shots"} <= have:
        new["SoT"] = F.when(col("SoT") > col("Shots"), col("Shots")).otherwise(col("SoT"))
    if "Age" in have and "AgeYears" not in have:
        new["AgeYears"] = age_in_years(col("Age"))
    return df.withColumns(new)


def processed_players(raw: DataFrame, partition: Sequence[str] = ("league", "season")) -> DataFrame:
    """The wide raw table to the processed player table.

    The raw table has one row per key, so a player's keeper metrics stand on the same row and need no join.
    Age is parsed from its text; other unreadable numbers are 0.
    """
    picked = [col(c) for c in existing(raw, partition)]
    found = resolve_names(raw.columns, FIELD_METRICS)
    # key columns carry their final names already
    found = {target: found.get(target, target) for target in FIELD_METRICS.values() if target in found or target in raw.columns}
    for target, source in found.items():
        if target in TEXT_COLUMNS:
            value = text_or_empty(col(source))
        elif target == "Age":
            value = age_in_years(col(source))
        else:
            value = number_or_zero(col(source))
        picked.append(value.alias(target))
    picked += [col(source).alias(target) for source, target in KEEPER_METRICS.items() if source in raw.columns]
    spelled = [col(c) for c in raw.columns if c.endswith("_player_raw")]
    if spelled:
        picked.append(F.coalesce(*spelled).alias("player_raw"))
    return derive_metrics(raw.select(*picked))
