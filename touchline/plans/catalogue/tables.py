"""The driver tables in the roles they play, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded(c: Column | str, places: int = 4) -> Column:
    return F.round(c, places) + F.lit(0.0)


def season_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as one player's seasons."""
    price = F.col("o_totalprice")
    return read(spark, folder, "orders").select(
        F.col("o_custkey").alias("player_uuid"),
        F.col("o_orderpriority").alias("competition_id"),
        F.year("o_orderdate").cast("long").alias("season_id"),
        F.col("o_orderstatus").alias("team_id"),
        F.floor(price / 100).alias("minutes"),
        (F.col("o_orderkey") % 5).alias("goals"),
        (F.col("o_orderkey") % 3).alias("assists"),
        (price / 100000).alias("xg"),
        (price / 200000).alias("xa"),
        "o_orderkey",
        "o_orderdate",
    )


SEASON_FACTS = """facts AS (
  SELECT o_custkey AS player_uuid, o_orderpriority AS competition_id, CAST(year(o_orderdate) AS BIGINT) AS season_id,
         o_orderstatus AS team_id, CAST(floor(o_totalprice / 100) AS BIGINT) AS minutes, o_orderkey % 5 AS goals,
         o_orderkey % 3 AS assists, o_totalprice / 100000 AS xg, o_totalprice / 200000 AS xa, o_orderkey, o_orderdate
  FROM orders)"""


def consolidated(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Customers as field players and suppliers as goalkeepers, with club, league and season."""
    clubs = (
        read(spark, folder, "nation")
        .join(read(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", F.col("n_name").alias("club"), F.col("r_name").alias("league_name"))
    )
    customer, supplier = read(spark, folder, "customer"), read(spark, folder, "supplier")
    field = customer.join(clubs, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("player_id"),
        F.col("c_name").alias("player_name"),
        "club",
        F.substring("c_mktsegment", 1, 2).alias("Pos"),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("market_value_eur"),
        "league_name",
        (2020 + F.col("c_custkey") % 4).cast("string").alias("season_code"),
        (F.col("c_custkey") % 30).alias("Gls"),
    )
    keepers = supplier.join(clubs, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("player_id"),
        F.col("s_name").alias("player_name"),
        "club",
        F.lit("GK").alias("Pos"),
        F.when(F.col("s_acctbal") > 2000, F.col("s_acctbal")).alias("market_value_eur"),
        "league_name",
        (2020 + F.col("s_suppkey") % 5).cast("string").alias("season_code"),
        (F.col("s_suppkey") % 9).alias("GK_CS"),
    )
    return field, keepers


UNION_VIEW = """both_tables AS (
  SELECT c_custkey AS player_id, c_name AS player_name, n_name AS club, substr(c_mktsegment, 1, 2) AS "Pos",
         CASE WHEN c_acctbal > 0 THEN c_acctbal END AS market_value_eur, r_name AS league_name,
         CAST(2020 + c_custkey % 4 AS VARCHAR) AS season_code, c_custkey % 30 AS "Gls", CAST(NULL AS BIGINT) AS "GK_CS"
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  UNION ALL
  SELECT s_suppkey, s_name, n_name, 'GK', CASE WHEN s_acctbal > 2000 THEN s_acctbal END, r_name,
         CAST(2020 + s_suppkey % 5 AS VARCHAR), NULL, s_suppkey % 9
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
newest AS (
  SELECT player_id, market_value_eur AS latest_mv_eur FROM (
    SELECT *, row_number() OVER (PARTITION BY player_id ORDER BY CAST(season_code AS INTEGER) DESC, market_value_eur DESC) AS place
    FROM both_tables WHERE market_value_eur IS NOT NULL) WHERE place = 1),
player_view AS (SELECT b.*, latest_mv_eur FROM both_tables b LEFT JOIN newest USING (player_id))"""
