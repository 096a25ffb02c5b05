"""Which market-value row belongs to which statistics row: exact keys first, similar names last.

All exact steps run as one join. Each left row is turned into one key per step, joined to the right side reduced to
one row per key, and the earliest step that hit wins. Rows still open go to the fuzzy steps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from touchline.functions.parse import birth_year, iso_date_or_null
from touchline.functions.text import club_key, first_last, match_text
from touchline.operators.fuzzy import similar_in_club, similar_near_year
from touchline.operators.skew import skew_join, spread_rows, top_rows
from touchline.session import materialize

# stage -> (key family, year shift on the left side, label); families 21 and 41 accept unique right keys only
STAGES = [
    (10, "norm_club_year", 0, "key+birth_year"),
    (20, "fl_club_year", 0, "first+last+club+birth_year"),
    (21, "fl_club_year_once", 1, "first+last+club+birth_year±1"),
    (22, "fl_club_year_once", -1, "first+last+club+birth_year±1"),
    (30, "fl_dob", 0, "first+last+dob"),
    (40, "fl_year", 0, "first+last+birth_year"),
    (41, "fl_year_once", 1, "first+last+birth_year±1(unique)"),
    (42, "fl_year_once", -1, "first+last+birth_year±1(unique)"),
    (50, "norm_club", 0, "key_no_year"),
]
CLUB_STAGE, GLOBAL_STAGE = 60, 70
PAYLOAD = ["market_value_eur", "player_id", "dob", "age"]
KEYS = ["player_norm", "player_fl", "club_norm", "birth_year", "dob_iso"]


def add_keys(df: DataFrame, name: str, club: str, dob: str | None, age: str | None, season_year: int | Column) -> DataFrame:
    """The matching keys: normalised name, first and last word, club, year of birth, exact date of birth."""
    born = F.col(dob) if dob else F.lit(None).cast("string")
    years = F.col(age) if age else F.lit(None).cast("string")
    keyed = df.withColumn("player_norm", match_text(F.col(name)))
    return keyed.withColumns(
        {
            "player_fl": first_last(F.col("player_norm")),
            "club_norm": F.when(F.col(club).isNotNull(), club_key(F.col(club))),
            "birth_year": birth_year(born, years, season_year),
            "dob_iso": iso_date_or_null(born),
        }
    )


_PARTS = {
    "norm_club_year": ("player_norm", "club_norm", "year"),
    "fl_club_year": ("player_fl", "club_norm", "year"),
    "fl_club_year_once": ("player_fl", "club_norm", "year"),
    "fl_dob": ("player_fl", "dob_iso"),
    "fl_year": ("player_fl", "year"),
    "fl_year_once": ("player_fl", "year"),
    "norm_club": ("player_norm", "club_norm"),
}


def _key_parts(df: DataFrame, scope: Sequence[str], *others: Column | str) -> DataFrame:
    """The key columns as text, empty ones as null."""
    texts = [*scope, "player_norm", "player_fl", "club_norm", "dob_iso"]
    return df.select(*others, "birth_year", *[F.nullif(F.col(c).cast("string"), F.lit("")).alias(c) for c in texts])


def _key(family: str, scope: Sequence[str], shift: int, null_safe_year: bool) -> Column:
    """Key parts joined by a separator that occurs in none of them; ``concat`` is null when any part is."""
    year = (F.col("birth_year") + shift if shift else F.col("birth_year")).cast("string")
    if null_safe_year and not family.endswith("_once"):
        year = F.coalesce(year, F.lit("?"))
    parts = [*[F.col(c) for c in scope], *[year if c == "year" else F.col(c) for c in _PARTS[family]]]
    return F.concat(*[x for part in parts for x in (part, F.lit("\x1f"))])


def _left_keys(left: DataFrame, scope: Sequence[str], null_safe_year: bool) -> DataFrame:
    entries = [
        F.struct(F.lit(stage).alias("stage"), F.lit(family).alias("family"), _key(family, scope, shift, null_safe_year).alias("key"))
        for stage, family, shift, _ in STAGES
    ]
    keyed = spread_rows(_key_parts(left, scope, "row_id")).select("row_id", F.explode(F.array(*entries)).alias("e"))
    return keyed.select("row_id", "e.stage", "e.family", "e.key").filter(F.col("key").isNotNull())


def _right_keys(right: DataFrame, scope: Sequence[str], null_safe_year: bool) -> DataFrame:
    """One row per (family, key): the most valuable, then the lowest id; ``once`` families need a single row.

    Rows without a value count for uniqueness but are never the answer.
    """
    entries = [F.struct(F.lit(family).alias("family"), _key(family, scope, 0, null_safe_year).alias("key")) for family in _PARTS]
    payload = F.struct((-F.col("market_value_eur")).alias("by_value"), F.col("player_id").alias("by_id"), *PAYLOAD)
    match = F.when(F.col("market_value_eur").isNotNull(), payload).alias("match")
    best = (
        spread_rows(_key_parts(right, scope, match))
        .select(F.explode(F.array(*entries)).alias("e"), "match")
        .select("e.family", "e.key", "match")
        .filter(F.col("key").isNotNull())
        .groupBy("family", "key")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("match").alias("match"))
    )
    usable = F.col("match").isNotNull() & (~F.col("family").endswith("_once") | (F.col("rows") == 1))
    return best.filter(usable).select("family", "key", "match")


def exact_matches(left: DataFrame, right: DataFrame, scope: Sequence[str] = (), null_safe_year: bool = False) -> DataFrame:
    """``row_id, stage, method`` and the matched payload for every left row that some exact step resolves."""
    hits = skew_join(
        _left_keys(left, scope, null_safe_year), _right_keys(right, scope, null_safe_year), ["family", "key"],
        "inner", spread=["row_id"], large=True,
    )
    first = hits.groupBy("row_id").agg(F.min(F.struct("stage", "match")).alias("hit"))
    labels = F.create_map(*[F.lit(x) for stage, _, _, label in STAGES for x in (stage, label)])
    return first.select(
        "row_id",
        F.col("hit.stage").alias("stage"),
        F.element_at(labels, F.col("hit.stage")).alias("join_method"),
        *[F.col(f"hit.match.{c}").alias(c) for c in PAYLOAD],
    )


def attach(left: DataFrame, matches: DataFrame) -> DataFrame:
    """Left rows with what was found for them; exactly one output row per input row."""
    return left.join(matches.hint("merge"), "row_id", "left")


def resolve(
    left: DataFrame,
    right: DataFrame,
    scope: Sequence[str] = (),
    fuzzy: bool = True,
    club_threshold: float = 90,
    global_threshold: float = 93,
    one_to_one: bool = False,
    null_safe_year: bool = False,
) -> DataFrame:
    """Left rows with market value, id, dob, age, ``join_method`` and ``stage`` of the matching right row.

    ``left`` has ``row_id`` (unique) and the key columns of ``add_keys``; ``right`` has the same keys and the payload.
    ``scope`` (league, season) keeps several leagues and seasons apart in one run. ``one_to_one`` lets each right
    row serve one left row only: the earliest step, then the best score.
    """
    found = exact_matches(left, right, scope, null_safe_year).withColumn("score", F.lit(None).cast("double"))
    if fuzzy:
        # every step works on what the steps before left open, so each result is written once
        found = materialize(found, "exact-matches")
        keys = left.select("row_id", *scope, *KEYS)
        open_rows = materialize(keys.join(found.select("row_id").hint("merge"), "row_id", "left_anti"), "open-rows")
        valued = materialize(right.select(*scope, *KEYS, *[c for c in PAYLOAD if c not in KEYS]), "roster")
        in_club = similar_in_club(open_rows, valued, PAYLOAD, scope, club_threshold).withColumn("stage", F.lit(CLUB_STAGE))
        in_club = materialize(in_club, "club-matches")
        still_open = materialize(open_rows.join(in_club.select("row_id").hint("merge"), "row_id", "left_anti"), "still-open")
        anywhere = similar_near_year(still_open, valued, PAYLOAD, scope, global_threshold).withColumn(
            "stage", F.lit(GLOBAL_STAGE)
        )
        found = found.unionByName(in_club).unionByName(anywhere)
    if one_to_one:
        found = best_per_right(found)
    return attach(left, found)


def best_per_right(found: DataFrame) -> DataFrame:
    """Each right id serves the left row with the earliest step, then the best score, then the lowest row id."""
    with_id = found.filter(F.col("player_id").isNotNull())
    order = [F.col("stage"), F.col("score").desc_nulls_last(), F.col("row_id")]
    return top_rows(with_id, ["player_id"], order).unionByName(found.filter(F.col("player_id").isNull()))


def breakdown(resolved: DataFrame) -> DataFrame:
    """Rows per matching method; unmatched rows have the empty method."""
    method = F.regexp_replace(F.coalesce("join_method", F.lit("")), r"\(\d.*\)$", "")
    return resolved.groupBy(method.alias("join_method")).agg(F.count(F.lit(1)).alias("n_rows"))


def match_totals(resolved: DataFrame) -> DataFrame:
    """Total, matched and unmatched rows."""
    return resolved.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("market_value_eur").alias("matched"),
        F.count_if(F.col("market_value_eur").isNull()).alias("unmatched"),
    )


def unmatched(resolved: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Unresolved rows with the columns that help to see why."""
    return resolved.filter(F.col("market_value_eur").isNull()).select(*[c for c in columns if c in resolved.columns])


def crosswalk(resolved: DataFrame, left_id: str, left_source: str = "fbref", right_source: str = "transfermarkt") -> DataFrame:
    """``player_uuid, source, source_player_id`` for both sources.

    The uuid is a hash of the right id where one was found, so every left id of one right player shares it;
    unmatched rows are hashed by their left id.
    """
    own, other = F.col(left_id).cast("string"), F.col("player_id").cast("string")
    uuid = F.sha2(
        F.when(other.isNotNull(), F.concat_ws(":", F.lit(right_source), other)).otherwise(
            F.concat_ws(":", F.lit(left_source), own)
        ),
        256,
    )
    pairs = F.array(
        F.struct(uuid.alias("player_uuid"), F.lit(left_source).alias("source"), own.alias("source_player_id")),
        F.struct(uuid.alias("player_uuid"), F.lit(right_source).alias("source"), other.alias("source_player_id")),
    )
    rows = resolved.select(F.explode(pairs).alias("p")).select("p.*").filter(F.col("source_player_id").isNotNull())
    # a source id seen with several right players keeps one uuid, as the pair (source, id) is a key
    return rows.groupBy("source", "source_player_id").agg(F.min("player_uuid").alias("player_uuid")).select(
        "player_uuid", "source", "source_player_id"
    )
