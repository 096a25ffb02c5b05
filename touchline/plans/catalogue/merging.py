"""Merging stat tables, derived metrics, backfill, keeper split and cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.operators import consolidate, merge
from touchline.operators.columns import add_prefix
from touchline.operators.skew import keep_unique, top_rows
from touchline.plans.catalogue.tables import read, rounded


def _part_tables(spark, folder):
    """Part facts, sold quantities and an index of odd parts, keyed by part."""
    part = read(spark, folder, "part").select(F.col("p_partkey").alias("Player"), "p_name", "p_brand", "p_size")
    lines = read(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("Player"), F.col("l_quantity").alias("Sh"), F.col("l_linenumber").alias("Gls"), F.col("l_extendedprice").alias("xG")
    )
    orders = read(spark, folder, "orders").select(
        F.col("o_custkey").alias("Player"), F.col("o_totalprice").alias("xG"), F.col("o_orderkey").alias("Gls")
    )
    return part, lines, orders


def outer_merge_wide(spark, folder):
    part, lines, orders = _part_tables(spark, folder)
    tables = {"stats": part, "shooting": add_prefix(lines, "shooting"), "passing": add_prefix(orders, "shooting")}
    order = {
        "stats": ["p_name"], "shooting": ["shooting_xG", "shooting_Sh", "shooting_Gls"], "passing": ["shooting_Gls"],
    }
    return merge.outer_merge(tables, ["Player"], order)


def _supplier_tables(spark, folder):
    """Four landed stat tables per region (league) and segment of the year (season), keyed by supplier name."""
    nation = read(spark, folder, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name"), F.col("n_regionkey"))
    base = (
        read(spark, folder, "supplier")
        .join(nation, "s_nationkey")
        .select("s_suppkey", "s_name", "s_acctbal", "n_name", F.col("n_regionkey").cast("string").alias("league"), F.lit("2024").alias("season"))
    )
    lines = read(spark, folder, "lineitem").join(base, F.col("l_suppkey") == F.col("s_suppkey"))
    key = [F.col("league"), F.col("season"), F.concat(F.lit(" "), F.upper("s_name")).alias("Player")]
    stats = base.select(
        *key, F.lit("ARG").alias("Nation"), F.when(F.col("s_suppkey") % 4 == 0, "GK").otherwise("DF,MF").alias("Pos"),
        F.col("n_name").alias("Squad"), F.concat((F.col("s_suppkey") % 20 + 18).cast("string"), F.lit("-"), F.lpad((F.col("s_suppkey") % 365).cast("string"), 3, "0")).alias("Age"),
        F.lit("1999").alias("Born"), F.col("s_acctbal").cast("string").alias("90s"), F.lit("1,234").alias("Gls"),
    )
    per = lines.groupBy("league", "season", "s_name", "s_suppkey")
    sums = per.agg(F.sum("l_quantity").cast("long").alias("q"), F.count(F.lit(1)).alias("n"), F.sum("l_linenumber").alias("ln"))
    shooting = sums.select(*key, F.col("n").alias("Sh"), (F.col("n") + F.col("s_suppkey") % 3 - 1).alias("SoT"))
    passing = sums.select(*key, F.col("ln").alias("Cmp"), F.col("q").alias("Att"), F.lit("12.5%").alias("Cmp%"))
    keepers = sums.select(*key, F.col("q").alias("Saves"), (F.col("q") * 2).alias("SoTA"), F.col("n").alias("GA"))
    no_player = base.select("league", "season", "n_name")
    return {"stats": stats, "shooting": shooting, "passing": passing, "keepers": keepers, "misc": no_player}


def processed_players(spark, folder):
    done = merge.processed_players(merge.merge_stat_tables(_supplier_tables(spark, folder)))
    return done.select(
        "league", "Player", "player_raw", "Pos", "Squad", "IsGK", "Age", "AgeYears", "MatchesPlayed", "Gls", "Shots", "SoT",
        "PassCmp", "PassAtt", "PassCmpPct", "GK_Saves", "GK_SoTA", "GK_GA", "GK_SavePct",
    )


def merge_two_clubs(spark, folder):
    """Lines as a player's (part's) seasons at two clubs (ship modes), orders sold of it as a table that knows no club."""
    lines = read(spark, folder, "lineitem")
    key = [F.lit("l").alias("league"), F.lit("2024").alias("season"), F.concat(F.lit("Part "), F.col("l_partkey")).alias("Player")]
    club = F.when(F.col("l_linenumber") % 2 == 0, "Even").otherwise("Odd").alias("Squad")
    stats = lines.groupBy(*key, club).agg(F.sum("l_linenumber").alias("Gls"), F.count(F.lit(1)).alias("90s"))
    passing = lines.filter(F.col("l_returnflag") != "N").groupBy(*key, club).agg(F.count(F.lit(1)).alias("Cmp"))
    shooting = lines.groupBy(*key).agg(F.count(F.lit(1)).alias("Sh"))
    others = read(spark, folder, "supplier").select(key[0], key[1], F.concat(F.lit("Only "), F.col("s_suppkey")).alias("Player"), F.lit(1).alias("Sh"))
    tables = {"stats": stats, "shooting": shooting.unionByName(others.withColumn("Sh", F.col("Sh").cast("long"))), "passing": passing}
    raw = merge.merge_stat_tables(tables)
    return raw.select(
        "Player", "Squad", F.col("stats_Gls").alias("goals"), F.col("stats_90s").alias("matches"), F.col("shooting_Sh").alias("shots"), F.col("passing_Cmp").alias("passes")
    )


def gk_left_merge(spark, folder):
    lines = read(spark, folder, "lineitem")
    players = lines.select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", F.col("l_partkey").alias("Player"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("Squad"),
    )
    keepers = lines.select(
        F.col("l_partkey").alias("Player"), F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("Squad"),
        F.col("l_extendedprice").alias("GK_Saves"), F.col("l_quantity").alias("GK_SoTA"),
    )
    return merge.attach_keepers(players, keepers)


def derived_metrics(spark, folder):
    lines = read(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_shipdate", "l_extendedprice",
        F.when(F.col("l_suppkey") % 3 == 0, "GK").when(F.col("l_suppkey") % 3 == 1, "DF").alias("Pos"),
        F.col("l_quantity").alias("PassCmp"), (F.col("l_linenumber").cast("double") * 9 - 9).alias("PassAtt"),
        F.col("l_linenumber").cast("double").alias("Shots"), (F.col("l_quantity") % 9).alias("SoT"),
        F.col("l_quantity").alias("GK_Saves"), (F.col("l_quantity") % 7 * 10).alias("GK_SoTA"),
    )
    return merge.derive_metrics(lines).drop("l_shipdate")


def first_per_key(spark, folder):
    orders = read(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return top_rows(orders, ["o_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey")])


def unique_keys(spark, folder):
    lines = read(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return keep_unique(lines, ["l_orderkey", "l_linenumber"])


def backfill_first(spark, folder):
    talk = read(spark, folder, "conversations").select(
        "conv_id", "turn",
        F.when(F.col("turn") % 3 == 0, "").when(F.col("turn") % 3 == 1, F.lit("NaN")).otherwise(F.concat("role", F.lit(" "), "turn")).alias("player_name"),
        F.when(F.col("turn") == 0, F.lit(None)).otherwise(F.col("role")).alias("club"),
    )
    filled = consolidate.backfill(talk, "conv_id", ["player_name", "club"], ["turn"])
    return filled.select("conv_id", "turn", F.coalesce("player_name", F.lit("-")).alias("player_name"), F.coalesce("club", F.lit("-")).alias("club"))


def split_gk(spark, folder):
    part = read(spark, folder, "part").select(
        "p_partkey",
        F.when(F.col("p_partkey") % 5 == 0, "yes").when(F.col("p_partkey") % 5 == 1, "0").otherwise(" ").alias("IsGK"),
        F.when(F.col("p_type") == "SMALL", "DF, gk").when(F.col("p_type") != "LARGE", F.concat(F.lit("GK"), "p_type")).alias("Pos"),
    )
    keepers, field, undecided = consolidate.split_keepers(part)
    named = [(keepers, "keeper"), (field, "field"), (undecided, "undecided")]
    out = [df.select("p_partkey", F.lit(kind).alias("kind")) for df, kind in named]
    return out[0].unionByName(out[1]).unionByName(out[2])


def clean_players(spark, folder):
    part = read(spark, folder, "part").select(
        F.col("p_partkey").alias("player_id"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_name")).alias("Player"),
        F.col("p_name").alias("player_norm"), F.col("p_brand").alias("Squad"), F.lit("x").alias("join_method"),
        F.when(F.col("p_partkey") % 3 == 0, F.date_format(F.date_add(F.lit("1990-01-01").cast("date"), F.col("p_partkey").cast("int")), "yyyy-MM-dd")).alias("dob"),
        F.col("p_size").cast("string").alias("age"), F.col("p_retailprice").cast("string").alias("market_value_eur"),
    )
    return consolidate.clean_players(part, F.lit("2024-07-01").cast("date"))


def valued_rows(spark, folder):
    part = read(spark, folder, "part").select(
        F.col("p_partkey").alias("player_id"), F.col("p_name").alias("player_norm"), F.col("p_brand").alias("Squad"), F.lit("s").alias("Nation"),
        F.when(F.col("p_partkey") % 4 == 0, "0").when(F.col("p_partkey") % 4 == 1, "n/a").otherwise(F.concat(F.lit("€ "), F.replace(F.col("p_retailprice").cast("string"), F.lit("."), F.lit(",")))).alias("market_value_eur"),
    )
    return consolidate.valued_rows(part).withColumn("market_value_eur", rounded("market_value_eur"))


_SUPPLIERS = """base AS (SELECT s_suppkey, s_name, s_acctbal, n_name, CAST(n_regionkey AS VARCHAR) AS league FROM supplier JOIN nation ON s_nationkey = n_nationkey),
sums AS (SELECT l_suppkey AS s_suppkey, CAST(sum(l_quantity) AS BIGINT) AS q, count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS ln FROM lineitem GROUP BY 1)"""

QUERIES = {
    "outer_merge_wide": (outer_merge_wide, """
WITH s AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_extendedprice, l_quantity, l_linenumber) AS place FROM lineitem) WHERE place = 1),
o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS place FROM orders) WHERE place = 1)
SELECT coalesce(p_partkey, l_partkey, o_custkey) AS "Player", p_name, p_brand, p_size, l_quantity AS "shooting_Sh", l_linenumber AS "shooting_Gls",
       l_extendedprice AS "shooting_xG", o_totalprice AS "shooting_xG__r", o_orderkey AS "shooting_Gls__r"
FROM part FULL JOIN s ON p_partkey = l_partkey FULL JOIN o ON coalesce(p_partkey, l_partkey) = o_custkey"""),
    "processed_players": (processed_players, f"""
WITH {_SUPPLIERS}
SELECT league, lower(s_name) AS "Player", ' ' || upper(s_name) AS player_raw, CASE WHEN s_suppkey % 4 = 0 THEN 'GK' ELSE 'DF,MF' END AS "Pos", n_name AS "Squad",
       s_suppkey % 4 = 0 AS "IsGK", round_even(s_suppkey % 20 + 18 + (s_suppkey % 365) / 365, 2) AS "Age", round_even(s_suppkey % 20 + 18 + (s_suppkey % 365) / 365, 2) AS "AgeYears",
       s_acctbal AS "MatchesPlayed", 1234.0::DOUBLE AS "Gls", CAST(coalesce(n, 0) AS DOUBLE) AS "Shots",
       CAST(coalesce(least(n, n + s_suppkey % 3 - 1), 0) AS DOUBLE) AS "SoT", CAST(coalesce(ln, 0) AS DOUBLE) AS "PassCmp", CAST(coalesce(q, 0) AS DOUBLE) AS "PassAtt",
       coalesce(round_even(CAST(ln AS DOUBLE) / nullif(q, 0) * 100, 2), 0) AS "PassCmpPct",
       CASE WHEN s_suppkey % 4 = 0 THEN CAST(q AS DOUBLE) END AS "GK_Saves", CASE WHEN s_suppkey % 4 = 0 THEN CAST(q * 2 AS DOUBLE) END AS "GK_SoTA",
       CASE WHEN s_suppkey % 4 = 0 THEN CAST(n AS DOUBLE) END AS "GK_GA", CASE WHEN s_suppkey % 4 = 0 THEN coalesce(round_even(q / (q * 2) * 100, 2), 0) END AS "GK_SavePct"
FROM base LEFT JOIN sums USING (s_suppkey)"""),
    "merge_two_clubs": (merge_two_clubs, """
WITH b AS (SELECT 'part ' || l_partkey AS "Player", CASE WHEN l_linenumber % 2 = 0 THEN 'Even' ELSE 'Odd' END AS "Squad", l_linenumber, l_returnflag FROM lineitem),
s AS (SELECT "Player", "Squad", CAST(sum(l_linenumber) AS BIGINT) AS goals, count(*) AS matches, nullif(count(*) FILTER (l_returnflag <> 'N'), 0) AS passes FROM b GROUP BY 1, 2),
t AS (SELECT "Player", count(*) AS shots FROM b GROUP BY 1 UNION ALL SELECT 'only ' || s_suppkey, 1 FROM supplier)
SELECT coalesce(s."Player", t."Player") AS "Player", "Squad", goals, matches, shots, passes FROM s FULL JOIN t ON s."Player" = t."Player" """),
    "gk_left_merge": (gk_left_merge, """
WITH p AS (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_partkey AS "Player", CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS "Squad" FROM lineitem),
k AS (SELECT * FROM (SELECT "Player", "Squad", l_extendedprice AS "GK_Saves", l_quantity AS "GK_SoTA",
  row_number() OVER (PARTITION BY "Player", "Squad" ORDER BY l_extendedprice, l_quantity) AS place FROM p) WHERE place = 1)
SELECT p.*, "GK_Saves", "GK_SoTA" FROM p LEFT JOIN k ON p."Player" = k."Player" AND p."Squad" IS NOT DISTINCT FROM k."Squad" """),
    "derived_metrics": (derived_metrics, """
WITH b AS (SELECT l_orderkey, l_partkey, l_linenumber, l_extendedprice, CASE l_suppkey % 3 WHEN 0 THEN 'GK' WHEN 1 THEN 'DF' END AS "Pos", l_quantity AS "PassCmp",
  CAST(l_linenumber * 9 - 9 AS DOUBLE) AS "PassAtt", CAST(l_linenumber AS DOUBLE) AS "Shots", l_quantity % 9 AS sot, l_quantity AS saves, l_quantity % 7 * 10 AS sota FROM lineitem)
SELECT l_orderkey, l_partkey, l_linenumber, l_extendedprice, "Pos", "PassCmp", "PassAtt", "Shots", least(sot, "Shots") AS "SoT",
       coalesce("Pos" = 'GK', false) AS "IsGK", CASE WHEN "Pos" = 'GK' THEN saves END AS "GK_Saves", CASE WHEN "Pos" = 'GK' THEN sota END AS "GK_SoTA",
       coalesce(round_even("PassCmp" / nullif("PassAtt", 0) * 100, 2), 0.0) AS "PassCmpPct",
       CASE WHEN "Pos" = 'GK' THEN coalesce(round_even(saves / nullif(sota, 0) * 100, 2), 0.0) END AS "GK_SavePct" FROM b"""),
    "first_per_key": (first_per_key, """
SELECT o_custkey, o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders) WHERE place = 1"""),
    "unique_keys": (unique_keys, """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem) WHERE n = 1"""),
    "backfill_first": (backfill_first, """
WITH t AS (SELECT conv_id, turn, CASE WHEN turn % 3 = 2 THEN role || ' ' || turn END AS name, CASE WHEN turn > 0 THEN role END AS club FROM conversations)
SELECT conv_id, turn, coalesce(name, first_value(name IGNORE NULLS) OVER w, '-') AS player_name, coalesce(club, first_value(club IGNORE NULLS) OVER w, '-') AS club
FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"""),
    "split_gk": (split_gk, """
SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 'keeper' WHEN p_partkey % 5 = 1 THEN 'field' WHEN p_type = 'SMALL' THEN 'keeper'
  WHEN p_type = 'LARGE' THEN 'undecided' ELSE 'field' END AS kind FROM part"""),
    "clean_players": (clean_players, """
SELECT p_partkey AS player_id, p_name AS player_name, p_brand AS club, CASE WHEN p_partkey % 3 = 0 THEN strftime(DATE '1990-01-01' + CAST(p_partkey AS INTEGER), '%Y-%m-%d') END AS dob,
       CAST(CASE WHEN p_partkey % 3 <> 0 THEN p_size WHEN DATE '1990-01-01' + CAST(p_partkey AS INTEGER) <= DATE '2024-07-01'
         THEN date_part('year', age(TIMESTAMP '2024-07-01', CAST(DATE '1990-01-01' + CAST(p_partkey AS INTEGER) AS TIMESTAMP)))
         ELSE -1 - date_part('year', age(CAST(DATE '1990-01-01' + CAST(p_partkey AS INTEGER) AS TIMESTAMP) - INTERVAL 1 DAY, TIMESTAMP '2024-07-01')) END AS INTEGER) AS age,
       p_retailprice AS market_value_eur FROM part"""),
    "valued_rows": (valued_rows, """
SELECT p_partkey AS player_id, p_name AS player_name, p_brand AS club, 's' AS "Nation", round(p_retailprice, 4) AS market_value_eur FROM part WHERE p_partkey % 4 > 1"""),
}
