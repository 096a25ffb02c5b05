"""Schemas of the landed, processed and consolidated tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Source column -> serving column of the stat tables.
FIELD_METRICS = {
    "Player": "Player",
    "stats_Nation": "Nation",
    "stats_Pos": "Pos",
    "stats_Squad": "Squad",
    "stats_Age": "Age",
    "stats_Born": "Born",
    "stats_90s": "MatchesPlayed",
    "stats_Gls": "Gls",
    "stats_Ast": "Ast",
    "stats_xG": "xG",
    "stats_xAG": "xAG",
    "shooting_Sh": "Shots",
    "shooting_SoT": "SoT",
    "passing_Cmp": "PassCmp",
    "passing_Att": "PassAtt",
    "passing_Cmp%": "PassCmpPct",
    "defense_Tkl": "Tkl",
    "defense_TklW": "TklW",
    "defense_Blocks": "Blocks",
    "defense_Int": "Int",
}
KEEPER_METRICS = {
    "keepers_GA": "GK_GA",
    "keepers_GA90": "GK_GA90",
    "keepers_SoTA": "GK_SoTA",
    "keepers_Saves": "GK_Saves",
    "keepers_Save%": "GK_SavePct",
    "keepers_CS": "GK_CS",
    "keepers_CS%": "GK_CSPct",
    "keepers_PKatt": "GK_PKAtt",
    "keepers_PKA": "GK_PKA",
    "keepers_PKsv": "GK_PKsv",
    "keepers_PKm": "GK_PKm",
    "keepersadv_PSxG": "GK_PSxG",
    "keepersadv_PSxG/SoT": "GK_PSxG_per_SoT",
    "keepersadv_PSxG+/-": "GK_PSxG_PlusMinus",
    "keepersadv_/90": "GK_PSxG_PlusMinus_per90",
    "keepersadv_Cmp": "GK_PassCmp",
    "keepersadv_Att": "GK_PassAtt",
    "keepersadv_Cmp%": "GK_PassCmpPct",
    "keepersadv_Att (GK)": "GK_GKPassAtt",
    "keepersadv_Thr": "GK_Throws",
    "keepersadv_Launch%": "GK_LaunchPct",
    "keepersadv_AvgLen": "GK_AvgLen",
    "keepersadv_Stp": "GK_CrossesStp",
    "keepersadv_Stp%": "GK_CrossesStpPct",
    "keepersadv_#OPA": "GK_OPA",
    "keepersadv_#OPA/90": "GK_OPA90",
    "keepersadv_AvgDist": "GK_OPA_AvgDist",
}
# Column names and their order in the landed and consolidated tables.
TEXT_COLUMNS = ["Player", "Nation", "Pos", "Squad", "Born"]
FRONT_COLUMNS = ["player_id", "player_name", "club", "Nation", "Pos", "dob", "age", "market_value_eur"]
FIELD_ORDER = [
    "MatchesPlayed", "Gls", "Ast", "xG", "xAG", "Shots", "SoT", "PassCmp", "PassAtt", "PassCmpPct",
    "Tkl", "TklW", "Blocks", "Int",
]
KEEPER_ORDER = list(KEEPER_METRICS.values())
NAME_COLUMNS = ["player_name", "Player", "player_fl", "player_norm"]
CLUB_COLUMNS = ["club", "club_norm", "Squad"]
REDUNDANT_COLUMNS = [
    "Player", "player_fl", "player_norm", "club_norm", "Squad", "join_method", "dob_fb", "birth_year_fb",
    "Age", "AgeYears", "Born",
]

# Whole-number metrics of the consolidated tables; the other metrics are doubles.
_WHOLE = {
    "Gls", "Ast", "Shots", "SoT", "PassCmp", "PassAtt", "Tkl", "TklW", "Blocks", "Int", "GK_GA", "GK_SoTA",
    "GK_Saves", "GK_CS", "GK_PKAtt", "GK_PKA", "GK_PKsv", "GK_PKm", "GK_PassCmp", "GK_PassAtt", "GK_GKPassAtt",
    "GK_Throws", "GK_CrossesStp", "GK_OPA",
}
_FRONT_TYPES = {"player_id": T.LongType(), "dob": T.DateType(), "age": T.IntegerType(), "market_value_eur": T.DoubleType()}


def _table(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def _consolidated(metrics: list[str]) -> T.StructType:
    front = {c: _FRONT_TYPES.get(c, T.StringType()) for c in FRONT_COLUMNS}
    body = {c: T.IntegerType() if c in _WHOLE else T.DoubleType() for c in metrics}
    tail = {c: T.StringType() for c in ("league_name", "league_code", "season_code")}
    return _table(**front, **body, **tail)


FIELD_PLAYERS = _consolidated(FIELD_ORDER)
GOALKEEPERS = _consolidated(KEEPER_ORDER)
