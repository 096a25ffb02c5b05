"""One identity for a player over any number of sources: pairs that matching found are closed over all their chains."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from touchline.operators.skew import skew_join
from touchline.session import materialize


def groups(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id, root``: the least id that each id of the pairs reaches over them.

    Every id points to the least id it has heard of. In each round the pairs are drawn from pointer to pointer, and every
    pointer follows the least of its neighbours and then the pointer's own pointer, which halves the chains; pairs inside a
    group vanish. All steps are aggregations and joins on the id, cut for ids with very many pairs, and each round is written
    to the shared folder. Rounds end when no pair is left.
    """
    links = pairs.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a is not null and b is not null")
    ids = links.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    points = materialize(ids.withColumn("root", F.col("id")), "roots")
    links = materialize(links.filter("a <> b").distinct(), "links")
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # each root's way down: to its least neighbour, if that is smaller
        down = both.groupBy("a").agg(F.min("b").alias("to")).withColumn("to", F.least("a", "to"))
        down = materialize(down, "ways-down")
        while True:  # pointers of pointers, until none moves
            further = down.select(F.col("a").alias("to"), F.col("to").alias("_next"))
            jumped = skew_join(down, further, ["to"], "left", spread=["a"], large=True)
            jumped = jumped.select("a", F.coalesce("_next", "to").alias("_to"), (F.col("_next") < F.col("to")).alias("_moved"))
            jumped = materialize(jumped, "ways-down")
            down = jumped.select("a", F.col("_to").alias("to"))
            if jumped.filter("_moved").isEmpty():
                break
        way = down.select(F.col("a").alias("root"), "to")
        points = materialize(skew_join(points, way, ["root"], "left", spread=["id"], large=True).select("id", F.coalesce("to", "root").alias("root")), "roots")
        from_a = skew_join(links, down, ["a"], "left", spread=["b"], large=True).select(F.coalesce("to", "a").alias("a"), "b")
        by_b = down.select(F.col("a").alias("b"), "to")
        moved = skew_join(from_a, by_b, ["b"], "left", spread=["a"], large=True).select("a", F.coalesce("to", "b").alias("b"))
        links = materialize(moved.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    return points


def _node(source: str, number: str):
    """A source and its id as one text; the separator occurs in no source name."""
    return F.concat(F.col(source).cast("string"), F.lit("\x1f"), F.col(number).cast("string"))


def crosswalk_closure(pairs: DataFrame) -> DataFrame:
    """``player_uuid, source, source_player_id`` for pairs (source_a, id_a, source_b, id_b), whatever the number of sources.

    All ids that chains of pairs connect are one player; its uuid is the hash of the least of them. Pairs with a null are not
    used.
    """
    found = groups(pairs.select(_node("source_a", "id_a").alias("a"), _node("source_b", "id_b").alias("b")))
    parts = F.split("id", "\x1f")
    return found.select(
        F.sha2(F.replace("root", F.lit("\x1f"), F.lit(":")), 256).alias("player_uuid"), parts[0].alias("source"), parts[1].alias("source_player_id")
    )


def contradictions(crosswalk: DataFrame, pairs: DataFrame) -> DataFrame:
    """Players for whom a source has several ids, which cannot all be right: player_uuid, source, n_ids, the least and the
    greatest id, and how many pairs tie the player together."""
    several = crosswalk.groupBy("player_uuid", "source").agg(
        F.count_distinct("source_player_id").alias("n_ids"), F.min("source_player_id").alias("first_id"), F.max("source_player_id").alias("last_id")
    )
    ends = crosswalk.select("player_uuid", F.col("source").alias("source_a"), F.col("source_player_id").alias("id_a"))
    used = pairs.filter("source_b is not null and id_b is not null").select(F.col("source_a"), F.col("id_a").cast("string").alias("id_a"))
    tied = skew_join(used, ends, ["source_a", "id_a"], "inner", large=True).groupBy("player_uuid").agg(F.count(F.lit(1)).alias("n_pairs"))
    return several.filter("n_ids > 1").join(tied.hint("merge"), "player_uuid")
