"""Pages of a long sorted list: rows stored by ranges of their order, with the count of rows before each range.

A page is found by these counts and reads the ranges that it touches, whether it is the first or the last one. Sorting the
list again for every page would gather all rows before the page in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.window import Window

RANGE_ROWS = 500_000
# monotonically_increasing_id counts a task's rows in its lower 33 bits.
_ROW_BITS = (1 << 33) - 1


def store_ranks(df: DataFrame, order: Sequence[Column], path: str, range_rows: int = RANGE_ROWS) -> None:
    """Write the list to ``path`` in ranges of about ``range_rows`` rows. ``order`` must tell all rows apart: rows that it does
    not tell apart fall in one range, in no fixed order."""
    ranges = max(1, ceil(df.count() / range_rows))
    ordered = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS))
    ranked = ordered.select("*", F.spark_partition_id().alias("_range"), place.alias("_place"))
    ranked.write.partitionBy("_range").parquet(f"{path}/rows")
    # the window and the file see one row per range
    sizes = _stored(df.sparkSession, path, ranked.schema).groupBy("_range").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes.select("_range", "n", before.cast("long").alias("before")).coalesce(1).write.parquet(f"{path}/ranges")


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{path}/rows")


def page_count(spark: SparkSession, path: str, size: int) -> int:
    """Pages of ``size`` rows; an empty list has none."""
    return ceil((spark.read.parquet(f"{path}/ranges").agg(F.sum("n")).first()[0] or 0) / size)


def page_seek(spark: SparkSession, path: str, schema: T.StructType, number: int = 1, size: int = 25) -> DataFrame:
    """One page of a stored list, with ``page``, ``page_size`` and the ``total`` count on every row, in order.

    ``schema`` is that of the list. Pages beyond the end have no rows.
    """
    if number < 1 or size < 1:
        raise ValueError("page and page size start at 1")
    start, end = (number - 1) * size, number * size
    ranges = spark.read.parquet(f"{path}/ranges")
    total = ranges.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # at most one range per row of the page
    touched = ranges.filter((F.col("before") < end) & (F.col("before") + F.col("n") > start)).collect()
    wanted = F.lit(False)
    for r in touched:
        wanted |= (F.col("_range") == r["_range"]) & F.col("_place").between(start - r["before"], end - 1 - r["before"])
    places = T.StructType([*schema.fields, T.StructField("_place", T.LongType()), T.StructField("_range", T.IntegerType())])
    rows = _stored(spark, path, places).filter(F.col("_range").isin([r["_range"] for r in touched]) & wanted).orderBy("_range", "_place")
    return rows.select(*schema.names, F.lit(number).alias("page"), F.lit(size).alias("page_size"), F.lit(total).cast("long").alias("total"))
