"""Data-quality reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.operators import quality
from touchline.operators.columns import col
from touchline.plans.catalogue.tables import read, rounded
from touchline.session import materialize, scratch_path


def quality_report(spark, folder):
    lines = read(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("SoT"), (F.col("l_linenumber") * 6.0).alias("Shots"),
        F.when(F.col("l_partkey") % 10 != 0, F.col("l_extendedprice")).alias("value"), (F.col("l_suppkey") % 2 == 0).alias("IsGK"),
        F.when(F.col("l_suppkey") % 3 == 0, F.col("l_tax")).alias("GK_A"), F.when(F.col("l_suppkey") % 5 == 0, F.col("l_tax")).alias("GK_B"),
        "l_returnflag", "l_suppkey",
    )
    return quality.quality_report(
        lines, keys=["l_orderkey", "l_linenumber"], at_most=[("SoT", "Shots")], not_null=["value", "l_orderkey"],
        keepers_only=["GK_A", "GK_B"], allowed={"l_returnflag": ["A", "N"]}, distinct=["l_suppkey"],
    )


def duplicate_keys(spark, folder):
    return quality.duplicate_keys(read(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


def fk_orphans(spark, folder):
    parents = read(spark, folder, "customer").filter(F.col("c_acctbal") > 0)
    return quality.orphans(read(spark, folder, "orders"), parents, "o_custkey", "c_custkey")


def describe(spark, folder):
    found = quality.describe(read(spark, folder, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    return found.select("column", "n", "nulls", "n_unique", *[rounded(c).alias(c) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")])


_MEASURES = ["l_quantity", "l_extendedprice", "l_discount"]


def describe_merged(spark, folder):
    """The report from states stored per partition; what sketches answer is held against all values."""
    lines = read(spark, folder, "lineitem")
    merged = materialize(quality.describe_merged(materialize(quality.partition_statistics(lines, ["l_returnflag", "l_linestatus"], _MEASURES), "statistics")), "merged")
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), col(c).cast("double").alias("v")) for c in _MEASURES])
    long = lines.select(F.explode(pairs).alias("p")).select("p.*").join(F.broadcast(merged), "column")  # a row per column
    share = lambda q: F.count_if(F.col("v") < F.col(q)) / F.count("v") - F.lit(quality.RANK_ERROR)
    upper = lambda q: F.count_if(F.col("v") <= F.col(q)) / F.count("v") + F.lit(quality.RANK_ERROR)
    near = [F.lit(at).between(share(q), upper(q)) for q, at in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))]
    held = long.groupBy("column").agg(
        (near[0] & near[1] & near[2]).alias("quartiles_near"),
        (F.abs(F.first("n_unique") / F.count_distinct("v") - 1) <= quality.DISTINCT_ERROR).alias("n_unique_near"),
    )
    return merged.join(held, "column").select("column", "n", "nulls", *[rounded(c).alias(c) for c in ("mean", "std", "min", "max")], "quartiles_near", "n_unique_near")


def quarantined_rows(spark, folder):
    """All orders through the gate: those with a broken rule with their reasons, the others passed."""
    orders = read(spark, folder, "orders").withColumn("paid", F.when(F.col("o_orderkey") % 50 != 7, F.floor(F.col("o_orderkey") % 1000)))
    parents = read(spark, folder, "customer").filter(F.col("c_acctbal") > 0)
    passed, broken = quality.gate(
        orders, scratch_path(spark, "gate"), keys=["o_custkey", "o_orderstatus"], at_most=[("paid", "o_totalprice")], not_null=["paid"],
        allowed={"o_orderstatus": ["F", "O"]}, references={"o_custkey": (parents, "c_custkey")},
    )
    reasons = F.array_join("reasons", "; ").alias("reasons")
    return broken.select("o_orderkey", F.lit(False).alias("passed"), reasons).unionByName(passed.select("o_orderkey", F.lit(True).alias("passed"), F.lit("").alias("reasons")))


def value_counts(spark, folder):
    return quality.value_counts(read(spark, folder, "orders"), "o_custkey")


def top_values(spark, folder):
    return quality.top_values(read(spark, folder, "part"), "p_retailprice", ["p_partkey", "p_name", "p_brand", "p_retailprice"], ties=["p_partkey"])


_DESCRIBED = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS n, count(*) - count({c}) AS nulls, count(DISTINCT {c} + 0.0) AS n_unique, round(avg({c}), 4) + 0.0 AS mean, round(stddev_samp({c}), 4) + 0.0 AS std,
  round(min({c}), 4) + 0.0 AS min, round(quantile_cont({c}, 0.25), 4) + 0.0 AS q25, round(quantile_cont({c}, 0.5), 4) + 0.0 AS q50, round(quantile_cont({c}, 0.75), 4) + 0.0 AS q75, round(max({c}), 4) + 0.0 AS max FROM lineitem"""
    for c in ("l_quantity", "l_extendedprice", "l_discount")
)

QUERIES = {
    "quality_report": (quality_report, """
SELECT count(*) AS n_rows, count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicate_keys, count(*) FILTER (l_quantity > l_linenumber * 6) AS "SoT_above_Shots",
  count(*) FILTER (l_partkey % 10 = 0) AS null_value, count(*) FILTER (l_orderkey IS NULL) AS "null_l_orderkey",
  count(*) FILTER (l_suppkey % 2 = 1 AND l_suppkey % 3 = 0) + count(*) FILTER (l_suppkey % 2 = 1 AND l_suppkey % 5 = 0) AS keeper_values_of_others,
  count(*) FILTER (l_returnflag NOT IN ('A', 'N')) AS bad_l_returnflag, count(DISTINCT l_suppkey) AS distinct_l_suppkey FROM lineitem"""),
    "duplicate_keys": (duplicate_keys, "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1"),
    "fk_orphans": (fk_orphans, """
SELECT o_custkey AS key, count(*) AS n_rows FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) GROUP BY 1"""),
    "describe": (describe, _DESCRIBED),
    "describe_merged": (describe_merged, f"SELECT * EXCLUDE (n_unique, q25, q50, q75), true AS quartiles_near, true AS n_unique_near FROM ({_DESCRIBED})"),
    "quarantined_rows": (quarantined_rows, """
WITH o AS (SELECT *, CASE WHEN o_orderkey % 50 <> 7 THEN o_orderkey % 1000 END AS paid, count(*) OVER (PARTITION BY o_custkey, o_orderstatus) AS copies FROM orders),
r AS (SELECT o_orderkey, concat_ws('; ', CASE WHEN paid > o_totalprice THEN 'paid above o_totalprice' END, CASE WHEN paid IS NULL THEN 'paid is null' END,
  CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 'o_orderstatus outside its domain' END,
  CASE WHEN o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) THEN 'o_custkey without a parent' END,
  CASE WHEN copies > 1 THEN 'repeated o_custkey, o_orderstatus' END) AS reasons FROM o)
SELECT o_orderkey, reasons = '' AS passed, reasons FROM r"""),
    "value_counts": (value_counts, "SELECT o_custkey AS value, count(*) AS n_rows FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"),
    "top_values": (top_values, "SELECT p_partkey, p_name, p_brand, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 10"),
}
