"""Feature columns: assembly, scaling, moving averages, ranks, quantiles and ratios."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from touchline.operators.columns import col, existing
from touchline.operators.skew import skew_join
from touchline.session import materialize

# Features of the two similarity models, and the minutes a row needs.
FIELD_FEATURES = [
    "Min", "MatchesPlayed", "Gls", "Ast", "xG", "xAG", "Shots", "KeyPasses", "CrdY", "CrdR", "Tkl", "Int",
]
KEEPER_FEATURES = [
    "GK_Min", "GK_MatchesPlayed", "GK_SoTA", "GK_Saves", "GK_SavePct", "GK_GA", "GK_CS", "GK_PSxG",
    "GK_PSxG_PlusMinus", "GK_PSxG_PlusMinus_per90", "GK_OPA90", "GK_PassCmp", "GK_PassAtt", "GK_PassCmpPct",
]
ID_COLUMNS = ["player_id", "player_uuid"]
SEASON_COLUMNS = ["season_code", "season_id", "season"]
MIN_MINUTES = 500


def model_features(df: DataFrame, candidates: Sequence[str]) -> list[str]:
    """Candidates the table has; the missing ones are reported, since a missing column switches its filter off."""
    import warnings

    found = existing(df, candidates)
    if not found:
        raise ValueError(f"none of the features {list(candidates)} exists")
    missing = [c for c in candidates if c not in found]
    if missing:
        warnings.warn(f"features not in the table: {missing}", stacklevel=2)
    return found


def enough_minutes(df: DataFrame, minutes: str = "Min", least: float = MIN_MINUTES) -> DataFrame:
    """Players with enough minutes; no filter when the table has no minutes."""
    return df.filter(col(minutes) >= least) if minutes in df.columns else df


def filled(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Features as doubles, null as 0."""
    return df.withColumns({c: F.coalesce(col(c).cast("double"), F.lit(0.0)) for c in features})


def standardise(df: DataFrame, features: Sequence[str], out: str | None = None) -> DataFrame:
    """Subtract the mean and divide by the population deviation, found in one pass; a constant column only shifts.

    With ``out`` the scaled values go to one array column, else they replace the features.
    """
    moments = df.agg(
        F.struct(
            *[F.avg(col(c)).alias(f"m{i}") for i, c in enumerate(features)],
            *[F.stddev_pop(col(c)).alias(f"s{i}") for i, c in enumerate(features)],
        ).alias("moments")
    ).scalar()
    scaled = []
    for i, c in enumerate(features):
        spread = F.col("_moments")[f"s{i}"]
        scaled.append((col(c) - F.col("_moments")[f"m{i}"]) / F.when(spread == 0, F.lit(1.0)).otherwise(spread))
    # the moments are one struct column, so the single-row aggregation runs once
    with_moments = df.withColumn("_moments", moments)
    result = {out: F.array(*scaled)} if out else dict(zip(features, scaled))
    return with_moments.withColumns(result).drop("_moments")


def feature_matrix(df: DataFrame, candidates: Sequence[str], keys: Sequence[str], season: str | None = None, minutes: str = "Min") -> DataFrame:
    """``keys`` and the scaled ``features`` array of all rows that pass the minutes filter."""
    if season is not None:
        season_col = existing(df, SEASON_COLUMNS)
        if season_col:
            df = df.filter(F.col(season_col[0]) == season)
    names = model_features(df, candidates)
    # written once: the moments and the scaled rows would each work the table out
    kept = [k for k in keys if k in df.columns]
    ready = materialize(filled(enough_minutes(df, minutes), names).select(*dict.fromkeys([*kept, *names])), "feature-rows")
    return standardise(ready, names, "features").select(*kept, "features")


def per_90(total: Column, minutes: Column) -> Column:
    return F.try_divide(total * 90, minutes)


def goals_prevented(expected: Column, conceded: Column) -> Column:
    return expected - conceded


def ratio(part: Column, whole: Column) -> Column:
    return F.try_divide(part, F.nullif(whole, F.lit(0)))


def moving_average(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: dict[str, str], n: int, chunk: Column
) -> DataFrame:
    """Mean of the last ``n`` rows of the key, the row itself included.

    ``chunk`` cuts each key's history into pieces that never overlap in ``order`` (a month, a day, an hour), so that
    one long history is spread over many tasks. Each piece also gets the last n - 1 rows before it: they come from
    a table of the last n - 1 rows of every piece, which is the only part that is ordered per key.
    """
    keys, order = list(keys), list(order)
    rows = df.withColumn("_chunk", chunk)
    needed = [*keys, "_chunk", *order, *values]
    last = Window.partitionBy(*keys, "_chunk").orderBy(*[F.col(c).desc() for c in order])
    tails = (
        rows.select(*dict.fromkeys(needed))
        .withColumn("_from_end", F.row_number().over(last))
        .filter(F.col("_from_end") <= max(n - 1, 1))
        .withColumn("_at", F.row_number().over(Window.partitionBy(*keys).orderBy("_chunk", F.col("_from_end").desc())))
    )
    starts = tails.groupBy(*keys, F.col("_chunk").alias("_next")).agg(F.min("_at").alias("_start"))
    offset = F.explode(F.sequence(F.lit(1), F.lit(max(n - 1, 1)))).alias("_gap")
    carried = (
        tails.select("*", offset)
        .withColumn("_start", F.col("_at") + F.col("_gap"))
        .join(starts, [*keys, "_start"])
        .filter(F.col("_next") > F.col("_chunk"))
        .select(*[F.col("_next").alias("_chunk") if c == "_chunk" else F.col(c) for c in dict.fromkeys(needed)])
        .withColumn("_carried", F.lit(True))
    )
    both = rows.withColumn("_carried", F.lit(False))
    if n > 1:
        both = both.unionByName(carried, allowMissingColumns=True)
    window = Window.partitionBy(*keys, "_chunk").orderBy(*[F.col(c) for c in order]).rowsBetween(-(n - 1), 0)
    averaged = both.withColumns({out: F.avg(c).over(window) for c, out in values.items()})
    return averaged.filter(~F.col("_carried")).drop("_chunk", "_carried")


def rows_per_value(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    return df.filter(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("n_rows"))


def value_positions(df: DataFrame, group: Sequence[str], value: str, ascending: bool = True) -> DataFrame:
    """Per group and distinct value: how many rows (``below``) and values (``distinct_below``) come before it.

    Rows are counted per distinct value first, so a frequent value is one row. The values are dealt out by ranges of
    (group, value), as many as Spark is set to, and written; sums run inside a range and over the totals of a group's
    ranges, so no task sorts a whole group and groups of different scale do not share a range.
    """
    group = list(group)
    ranged = rows_per_value(df, group, value).repartitionByRange(*group, value).withColumn("part", F.spark_partition_id())
    counts = materialize(ranged, "value-ranges")
    direction = (lambda c: c.asc()) if ascending else (lambda c: c.desc())
    totals = counts.groupBy(*group, "part").agg(F.sum("n_rows").alias("b_rows"), F.count(F.lit(1)).alias("b_values"))
    before = Window.partitionBy(*group).orderBy(direction(F.col("part"))).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    offsets = totals.select(
        *[F.col(c).alias(f"_{c}") for c in group],
        F.col("part").alias("_part"),
        F.coalesce(F.sum("b_rows").over(before), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum("b_values").over(before), F.lit(0)).alias("values_before"),
        F.sum("b_rows").over(whole).alias("group_rows"),
    )
    inside = Window.partitionBy(*group, "part").orderBy(direction(F.col(value)))
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*group, "part")]
    return counts.join(offsets, reduce(lambda a, b: a & b, same)).select(
        *group,
        value,
        "n_rows",
        (F.col("rows_before") + F.coalesce(F.sum("n_rows").over(earlier), F.lit(0))).alias("below"),
        (F.col("values_before") + F.row_number().over(inside) - 1).alias("distinct_below"),
        "group_rows",
    )


def rank_in_group(
    df: DataFrame, group: Sequence[str], value: str, ascending: bool = False, prefix: str = "value"
) -> DataFrame:
    """``rank``, ``dense_rank`` and ``percent_rank`` of a value within its group; rows without a value have none."""
    places = value_positions(df, group, value, ascending).select(
        *group,
        value,
        (F.col("below") + 1).alias(f"{prefix}_rank"),
        (F.col("distinct_below") + 1).alias(f"{prefix}_dense_rank"),
        F.coalesce(F.try_divide(F.col("below"), F.col("group_rows") - 1), F.lit(0.0)).alias(f"{prefix}_percent_rank"),
    )
    counts = rows_per_value(df, group, value).withColumnRenamed("n_rows", "_rows")
    return skew_join(df, places, [*group, value], "left", counts=counts)


def exact_quantiles(df: DataFrame, group: Sequence[str], value: str, shares: dict[str, float]) -> DataFrame:
    """Exact quantiles per group, linear between neighbouring rows."""
    return quantiles_at(value_positions(df, group, value), group, value, shares)


def quantiles_at(places: DataFrame, group: Sequence[str], value: str, shares: dict[str, float]) -> DataFrame:
    """Quantiles from the output of ``value_positions``: the values at the wanted positions, by one aggregation."""
    picks, results = [], []
    for name, share in shares.items():
        at = F.lit(float(share)) * (F.col("group_rows") - 1)
        for end, place in (("low", F.floor(at)), ("high", F.ceil(at))):
            holds = (place >= F.col("below")) & (place < F.col("below") + F.col("n_rows"))
            picks.append(F.max(F.when(holds, F.col(value))).alias(f"_{name}_{end}"))
        picks.append(F.max(at - F.floor(at)).alias(f"_{name}_part"))
        low, high, part = (F.col(f"_{name}_{x}") for x in ("low", "high", "part"))
        results.append((low + (high - low) * part).alias(name))
    return places.groupBy(*group).agg(*picks).select(*group, *results)
