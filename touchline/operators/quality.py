"""Data-quality reports. Each report is one aggregation over the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from touchline.operators.columns import col
from touchline.operators.features import quantiles_at, value_positions
from touchline.operators.skew import skew_join


def key_columns(keys: Sequence[str]) -> Column:
    return F.struct(*[F.coalesce(col(k).cast("string"), F.lit("\x00")).alias(f"k{i}") for i, k in enumerate(keys)])


def quality_report(
    df: DataFrame,
    keys: Sequence[str] = (),
    at_most: Sequence[tuple[str, str]] = (),
    not_null: Sequence[str] = (),
    keepers_only: Sequence[str] = (),
    is_keeper: Column | None = None,
    allowed: dict[str, Sequence[str]] | None = None,
    distinct: Sequence[str] = (),
) -> DataFrame:
    """One row: row count, repeated keys, violations of a <= b, nulls, keeper numbers of others, values outside a domain."""
    checks = [F.count(F.lit(1)).alias("n_rows")]
    if keys:
        checks.append((F.count(F.lit(1)) - F.count_distinct(key_columns(keys))).alias("duplicate_keys"))
    for low, high in at_most:
        checks.append(F.count_if(col(low) > col(high)).alias(f"{low}_above_{high}"))
    for c in not_null:
        checks.append(F.count_if(col(c).isNull()).alias(f"null_{c}"))
    if keepers_only:
        other = ~F.coalesce(is_keeper if is_keeper is not None else col("IsGK"), F.lit(False))
        cells = sum((F.when(other & col(c).isNotNull(), 1).otherwise(0) for c in keepers_only), F.lit(0))
        checks.append(F.sum(cells).cast("long").alias("keeper_values_of_others"))
    for c, domain in (allowed or {}).items():
        checks.append(F.count_if(~col(c).isin(*domain)).alias(f"bad_{c}"))
    for c in distinct:
        checks.append(F.count_distinct(col(c)).alias(f"distinct_{c}"))
    return df.agg(*checks)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Foreign key values without a parent, with the rows that use them; the child is counted per value first."""
    used = child.filter(col(child_key).isNotNull()).groupBy(col(child_key).alias("key")).agg(F.count(F.lit(1)).alias("n_rows"))
    known = parent.select(col(parent_key).alias("key")).distinct()
    return used.join(known, "key", "left_anti")


def gate(
    df: DataFrame,
    path: str,
    keys: Sequence[str] = (),
    at_most: Sequence[tuple[str, str]] = (),
    not_null: Sequence[str] = (),
    allowed: dict[str, Sequence[str]] | None = None,
    references: dict[str, tuple[DataFrame, str]] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Write the rows to ``path`` in one pass and return those that keep all rules, and the others with their ``reasons``.

    ``references`` maps a column to a parent table and its key. All rows of a repeated key go to quarantine, since nothing says
    which of them is right; nulls break no domain, reference or comparison. The rules are those of ``quality_report``.
    """
    own, marked = df.columns, df
    reasons = [F.when(col(low) > col(high), f"{low} above {high}") for low, high in at_most]
    reasons += [F.when(col(c).isNull(), f"{c} is null") for c in not_null]
    reasons += [F.when(~col(c).isin(*domain), f"{c} outside its domain") for c, domain in (allowed or {}).items()]
    for i, (c, (parent, key)) in enumerate((references or {}).items()):
        known = parent.select(col(key).alias(c)).distinct().withColumn(f"_known{i}", F.lit(True))
        marked = skew_join(marked, known, [c], "left")
        reasons.append(F.when(col(c).isNotNull() & F.col(f"_known{i}").isNull(), f"{c} without a parent"))
    if keys:
        counts = df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("_rows"))
        marked = skew_join(marked, counts.filter("_rows > 1").withColumnRenamed("_rows", "_copies"), keys, "left", null_safe=True, counts=counts)
        reasons.append(F.when(F.col("_copies") > 1, f"repeated {', '.join(keys)}"))
    found = F.array_compact(F.array(*reasons)) if reasons else F.array().cast("array<string>")
    marked = marked.select(*[col(c) for c in own], found.alias("reasons")).withColumn("_broken", F.size("reasons") > 0)
    marked.write.partitionBy("_broken").parquet(path)
    stored = df.sparkSession.read.schema(marked.schema).parquet(path)
    passed, broken = stored.filter("not _broken").select(*[col(c) for c in own]), stored.filter("_broken").drop("_broken")
    return passed, broken


# Sizes of the sketches, and what they may be off: four deviations of 2 ** 12 registers (1.6 % each), and twice the rank error
# that k = 200 keeps with a confidence of 99 %.
HLL_LOG2, KLL_K = 12, 200
DISTINCT_ERROR, RANK_ERROR = 0.065, 0.033


def partition_statistics(df: DataFrame, partition: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Mergeable state per partition and numeric column, to be stored beside the data: a refresh replaces the rows of its
    partition alone. One aggregation; the sketches have a bounded size whatever the rows."""
    values = {c: col(c).cast("double") for c in columns}
    states = [
        F.struct(
            F.lit(c).alias("column"), F.count(v).alias("n"), F.count_if(v.isNull()).alias("nulls"), F.sum(v).alias("total"),
            F.coalesce(F.var_pop(v) * F.count(v), F.lit(0.0)).alias("spread"), F.min(v).alias("min"), F.max(v).alias("max"),
            F.hll_sketch_agg(F.when(v.isNotNull(), F.xxhash64(v + 0.0)), F.lit(HLL_LOG2)).alias("distinct_values"),
            F.kll_sketch_agg_double(v, F.lit(KLL_K)).alias("ranks"),
        ).alias(f"c{i}")
        for i, (c, v) in enumerate(values.items())
    ]
    parts = df.groupBy(*[col(p) for p in partition]).agg(*states)
    return parts.select(*[col(p) for p in partition], F.explode(F.array(*[f"c{i}" for i in range(len(values))])).alias("s")).select(*partition, "s.*")


def describe_merged(statistics: DataFrame) -> DataFrame:
    """The columns of ``describe`` from stored states: counts, mean, deviation and ends exact, distinct values within
    ``DISTINCT_ERROR`` of their number and quartiles within ``RANK_ERROR`` of their ranks."""
    mean = F.sum("total") / F.sum("n")
    # spreads around the partitions' means, and of these means around the whole one
    squares = F.sum(F.col("spread") + F.when(F.col("n") > 0, F.col("total") * F.col("total") / F.col("n")).otherwise(0.0))
    merged = statistics.groupBy("column").agg(
        F.sum("n").alias("n"), F.sum("nulls").alias("nulls"), mean.alias("mean"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.sqrt((squares - F.sum("n") * mean * mean) / F.when(F.sum("n") > 1, F.sum("n") - 1)).alias("std"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_values")).alias("n_unique"), F.kll_merge_agg_double("ranks").alias("_ranks"),
    )
    at = lambda q: F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("_ranks", F.lit(q)))
    return merged.select(
        "column", "n", "nulls", "mean", "std", "min", "max", "n_unique", at(0.25).alias("q25"), at(0.5).alias("q50"), at(0.75).alias("q75")
    )


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per numeric column: count, nulls, distinct values, mean, deviation, minimum, exact quartiles, maximum."""
    values = {c: col(c).cast("double") for c in columns}
    one_row = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.count(v).alias("n"),
                F.count_if(v.isNull()).alias("nulls"),
                F.avg(v).alias("mean"),
                F.stddev_samp(v).alias("std"),
                F.min(v).alias("min"),
                F.max(v).alias("max"),
            ).alias(f"c{i}")
            for i, (c, v) in enumerate(values.items())
        ]
    )
    moments = one_row.select(F.explode(F.array(*[f"c{i}" for i in range(len(values))])).alias("m")).select("m.*")
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), v.alias("value")) for c, v in values.items()])
    long = df.select(F.explode(pairs).alias("p")).select("p.column", "p.value")
    places = value_positions(long, ["column"], "value")
    unique = F.max("distinct_below") + 1
    found = places.groupBy("column").agg(unique.alias("n_unique"))
    quartiles = quantiles_at(places, ["column"], "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    # at most one row per described column
    return moments.join(F.broadcast(found.join(quartiles, "column")), "column", "left")


def value_counts(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The n most frequent values; ties by value."""
    counts = df.groupBy(col(column).alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.orderBy(F.col("n_rows").desc(), "value").limit(n)


def top_values(df: DataFrame, order: str, columns: Sequence[str], n: int = 10, ties: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(col(order).desc_nulls_last(), *ties).limit(n).select(*columns)
