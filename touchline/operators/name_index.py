"""Name search by stored letter triples: names and postings lie per league and season, and are refreshed with them.

A text is found in the names that hold all its triples; these are read from the postings' buckets alone, intersected by one
aggregation over ids, and verified. Both tables change under one version, so that a reader never sees postings without names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from touchline.operators.serving import search_players
from touchline.sources import snapshots
from touchline.sources.writers import PARTITION

BUCKETS = 16  # folders of each table per league and season


def _triples(text: Column) -> Column:
    """The different runs of three letters; none in shorter texts."""
    places = F.when(F.length(text) > 2, F.sequence(F.lit(1), F.length(text) - 2)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(places, lambda i: F.substr(text, i, F.lit(3))))


def _bucket(value: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(buckets)).cast("int").alias("_bucket")


def index_names(
    view: DataFrame,
    root: str,
    refreshed: DataFrame | None = None,
    partition: Sequence[str] = PARTITION,
    player: str = "player_id",
    name: str = "player_name",
    pos: str = "Pos",
    buckets: int = BUCKETS,
) -> int:
    """Index the names of ``view``, in place of what its partitions (and those of ``refreshed``) held before; returns the version.
    ``buckets`` stays the same over the life of an index."""
    kept = [F.col(player).alias("player_uuid"), F.col(name).alias("full_name"), F.col(pos).alias("primary_position")]
    rows = view.select(*partition, *kept).distinct().withColumn("id", F.xxhash64("player_uuid", "full_name", "primary_position"))
    postings = rows.select(*partition, "id", F.explode(_triples(F.lower("full_name"))).alias("triple"))
    tables = {"names": rows.select("*", _bucket(F.col("id"), buckets)), "postings": postings.select("*", _bucket(F.col("triple"), buckets))}
    parts = (view if refreshed is None else view.select(*partition).unionByName(refreshed.select(*partition))).select(*partition).distinct()
    every = parts.select(*partition, F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("_bucket"))
    return snapshots.commit(root, tables, every, [*partition, "_bucket"])


def search_names(spark: SparkSession, root: str, text: str, limit: int = 10, buckets: int = BUCKETS) -> DataFrame:
    """What ``search_players`` finds in all names. Texts of less than three letters hold no triple: all names are read."""
    own = spark.range(1).select(F.explode(_triples(F.lower(F.lit(text)))).alias("triple"))
    wanted = own.select("triple", _bucket(F.col("triple"), buckets)).collect()  # at most the letters of the text
    names = snapshots.read_table(spark, root, "names")
    if wanted:
        postings = snapshots.read_table(spark, root, "postings").filter(
            F.col("_bucket").isin(sorted({w["_bucket"] for w in wanted})) & F.col("triple").isin([w["triple"] for w in wanted])
        )
        held = postings.groupBy("id").agg(F.count_distinct("triple").alias("n")).filter(F.col("n") == len(wanted))
        names = names.join(held.select("id", _bucket(F.col("id"), buckets)), ["id", "_bucket"], "left_semi")
    return search_players(names, text, limit, "player_uuid", "full_name", "primary_position")
