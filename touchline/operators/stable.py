"""One-to-one matching in which nobody loses for good: who is turned down is offered the next best candidate.

``stable_pairs`` runs rounds of proposals over explicit candidates until no row moves. ``resolve_stable`` does the same for
the exact steps without forming the pairs of a key: both sides prefer the earlier step, and within a key all left rows agree
on the order of the right ones and the other way round, so that the n-th open row on one side belongs to the n-th on the other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from touchline.operators.resolve import PAYLOAD, STAGES, _PARTS, _key, _key_parts, _left_keys, attach
from touchline.operators.skew import skew_join, spread_rows
from touchline.session import materialize

SCORED_STAGE = 80


def stable_pairs(
    candidates: DataFrame, left: str, right: str, left_order: Sequence[Column], right_order: Sequence[Column]
) -> DataFrame:
    """``left, right``: the stable matching that is best for the left rows. The orders rank a row's candidates, first ones
    preferred; ties go to the lower id.

    Each round every left row proposes to its best candidate left; a right row keeps the best proposal and strikes all
    candidates it likes less, on whoever's list they stand. Rounds end when no right row has two proposals. A left row whose
    list is empty stays alone.
    """
    now = candidates.select(
        F.col(left).alias("l"), F.col(right).alias("r"), F.struct(*left_order, F.col(right).alias("_id")).alias("lo"), F.struct(*right_order, F.col(left).alias("_id")).alias("ro")
    )
    now = now.filter(F.col("l").isNotNull() & F.col("r").isNotNull())
    # of several rows for one pair each side counts its best
    now = materialize(now.groupBy("l", "r").agg(F.min("lo").alias("lo"), F.min("ro").alias("ro")), "candidates")
    while True:
        best = now.groupBy("l").agg(F.min(F.struct("lo", "ro", "r")).alias("b")).select("l", "b.r", "b.ro")
        held = materialize(best.groupBy("r").agg(F.min("ro").alias("held"), F.count(F.lit(1)).alias("proposals")), "proposals")
        if held.filter("proposals > 1").isEmpty():
            return best.select(F.col("l").alias(left), F.col("r").alias(right))
        kept = skew_join(now, held.select("r", "held"), ["r"], "left", spread=["l"], large=True)
        now = materialize(kept.filter(F.col("held").isNull() | (F.col("ro") <= F.col("held"))).drop("held"), "candidates")


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "nth") -> DataFrame:
    """Adds the place of each row within its key, from 1. Rows are sorted in ranges, so that a key with much of the data spreads
    over tasks; a task numbers its own rows and adds what the ranges before hold of the key."""
    ranged = df.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id())
    ranged = materialize(ranged, "ranges")
    local = Window.partitionBy(*keys, "_range").orderBy(*order)
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_n"))
    bases = counts.select(*keys, "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    joined = ranged.withColumn("_local", F.row_number().over(local)).join(bases.hint("merge"), [*keys, "_range"])
    return joined.select(*df.columns, (F.col("_base") + F.col("_local")).alias(out))


def _offers(right: DataFrame, scope: Sequence[str]) -> DataFrame:
    """family, key, player_id, by_value, match: one row per family of each valued right row, the most valuable of an id."""
    entries = [F.struct(F.lit(f).alias("family"), _key(f, scope, 0, False).alias("key")) for f in _PARTS]
    payload = F.struct((-F.col("market_value_eur")).alias("by_value"), *PAYLOAD).alias("match")
    rows = spread_rows(_key_parts(right, scope, payload)).select(F.explode(F.array(*entries)).alias("e"), "match").select("e.family", "e.key", "match")
    rows = rows.filter(F.col("key").isNotNull())
    once = rows.filter(F.col("family").endswith("_once")).groupBy("family", "key").agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1")
    single = skew_join(rows, once.select("family", "key"), ["family", "key"], "left_anti", spread=["match"], large=True)
    best = single.filter(F.col("match.market_value_eur").isNotNull()).groupBy("family", F.col("match.player_id").alias("player_id"))
    best = best.agg(F.min(F.struct("match", "key")).alias("b"))
    return best.select("family", "b.key", "player_id", F.col("b.match.by_value").alias("by_value"), "b.match")


def resolve_stable(left: DataFrame, right: DataFrame, scope: Sequence[str] = (), scored: DataFrame | None = None) -> DataFrame:
    """Left rows with the right row that a stable one-to-one matching gives them, as ``resolve`` returns them.

    Both sides prefer the earlier step; then left rows prefer the most valuable right row, right rows the lowest ``row_id``.
    ``scored`` holds further candidates (row_id, player_id, score) for rows that no exact step matches; there both sides prefer the
    higher score. An id counts with its most valuable row.
    """
    wanted = materialize(_left_keys(left, scope, False).filter(F.col("key").isNotNull()), "left-keys")
    offered = materialize(_offers(right, scope), "right-keys")
    found = None
    for stage, family, _, label in STAGES:
        open_left = wanted.filter(F.col("stage") == stage).select("row_id", "key")
        open_right = offered.filter(F.col("family") == family).select("key", "player_id", "by_value", "match")
        if found is not None:
            open_left = open_left.join(found.select("row_id").hint("merge"), "row_id", "left_anti")
            open_right = open_right.join(found.select("player_id").hint("merge"), "player_id", "left_anti")
        # only keys that both sides have need numbers
        both = materialize(open_left.select("key").distinct().join(open_right.select("key").distinct().hint("merge"), "key"), "shared-keys")
        if both.isEmpty():
            continue
        left_n = numbered(open_left.join(both.hint("merge"), "key", "left_semi"), ["key"], ["row_id"])
        right_n = numbered(open_right.join(both.hint("merge"), "key", "left_semi"), ["key"], ["by_value", "player_id"])
        pairs = left_n.join(right_n.hint("merge"), ["key", "nth"]).select(
            "row_id", F.lit(stage).alias("stage"), F.lit(label).alias("join_method"), F.lit(None).cast("double").alias("score"), *[F.col(f"match.{c}").alias(c) for c in PAYLOAD]
        )
        found = materialize(pairs if found is None else found.unionByName(pairs), "stable-matches")
    if scored is not None:
        open_pairs = scored.filter(F.col("score").isNotNull()).select("row_id", "player_id", "score")
        if found is not None:
            open_pairs = open_pairs.join(found.select("row_id").hint("merge"), "row_id", "left_anti").join(found.select("player_id").hint("merge"), "player_id", "left_anti")
        value = offered.groupBy("player_id").agg(F.min("match").alias("match"))
        open_pairs = open_pairs.join(value.hint("merge"), "player_id").withColumn("_value", F.col("match.by_value"))
        order = -F.col("score")
        matched = stable_pairs(open_pairs, "row_id", "player_id", [order.alias("_s"), F.col("_value")], [order.alias("_s")])
        best = open_pairs.groupBy("row_id", "player_id").agg(F.max("score").alias("score"), F.min("match").alias("match"))
        pairs = matched.join(best.hint("merge"), ["row_id", "player_id"]).select(
            "row_id", F.lit(SCORED_STAGE).alias("stage"), F.lit("scored").alias("join_method"), "score", *[F.col(f"match.{c}").alias(c) for c in PAYLOAD]
        )
        found = pairs if found is None else found.unionByName(pairs)
    if found is None:
        empty = right.select(*[F.col(c) for c in PAYLOAD]).limit(0)
        found = empty.select(F.lit(None).cast(left.schema["row_id"].dataType).alias("row_id"), F.lit(0).alias("stage"), F.lit("").alias("join_method"), F.lit(0.0).alias("score"), *PAYLOAD)
    return attach(left, found)
