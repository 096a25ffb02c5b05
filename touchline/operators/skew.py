"""Joins and row picks that hold when one key owns a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

# Up to this many rows a key is no burden for one task; every key with more is cut.
LIGHT_ROWS = 20_000
# Rows of a task before a step that multiplies them.
TASK_ROWS = 200_000


def heavy_keys(df: DataFrame, on: Sequence[str], light_rows: int = LIGHT_ROWS) -> DataFrame:
    """The largest keys and ``_pieces``, the number of parts each is cut into."""
    return largest(df.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows")), on, light_rows)


def largest(counts: DataFrame, on: Sequence[str], light_rows: int = LIGHT_ROWS) -> DataFrame:
    """``heavy_keys`` from the rows per key, when they are known already as ``_rows``."""
    pieces = F.ceil(F.col("_rows") / light_rows).cast("int")
    return counts.filter(F.col("_rows") > light_rows).select(*on, pieces.alias("_pieces"))


def _join_pieces(df: DataFrame, heavy: DataFrame, on: Sequence[str], count: str) -> DataFrame:
    """Add ``count``, the number of pieces of the row's key; null for keys that are not heavy."""
    # A key is heavy with LIGHT_ROWS rows, so the list is short beside the data; Spark decides how to join it.
    small = heavy.select(*[F.col(k).alias(f"_h_{k}") for k in on], F.col("_pieces").alias(count))
    return df.join(small, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_h_{k}")) for k in on]), "left")


def _own_piece(columns: Sequence[str], count: str) -> Column:
    return F.pmod(F.xxhash64(*[F.col(c) for c in columns]), F.coalesce(F.col(count), F.lit(1))).cast("int")


def _every_piece(count: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.coalesce(F.col(count), F.lit(1)) - 1))


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    spread: Sequence[str] | None = None,
    null_safe: bool = False,
    both: bool = False,
    light_rows: int | None = None,
    counts: DataFrame | None = None,
    large: bool = False,
) -> DataFrame:
    """Equi-join that cuts heavy keys of the left side into pieces.

    Rows of a heavy left key are cut into pieces by a hash of the ``spread`` columns (all columns unless given)
    and the matching right rows are repeated once per piece; all other keys join as usual. With ``both`` (inner
    joins only) heavy right keys are cut the same way. The hash is fixed by the row, so a recomputed task yields
    the same pieces. ``counts`` (keys and ``_rows``) spares counting the left keys where an aggregation that is
    needed anyway has done so. ``large`` says that both sides grow with the data and is merged by a shuffle: Spark judges
    a side by the bytes of its files, and well compressed or exploded rows can be a hundred times that, too many to broadcast.
    """
    on, limit = list(on), LIGHT_ROWS if light_rows is None else light_rows
    own, other = left.columns, [c for c in right.columns if c not in on]
    as_right = [F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in right.columns]
    cut = heavy_keys(left, on, limit) if counts is None else largest(counts, on, limit)
    big = _join_pieces(left, cut, on, "_n").select(*own, _own_piece(spread or own, "_n").alias("_piece"))
    small = _join_pieces(right, cut, on, "_n").select(*right.columns, _every_piece("_n").alias("_piece"))
    keys = [*on, "_piece"]
    if both:
        if how != "inner":
            raise ValueError("both sides can be cut for inner joins only")
        cut_right = heavy_keys(right, on, limit)
        slices = _own_piece(right.columns, "_m").alias("_slice")
        small = _join_pieces(small, cut_right, on, "_m").select(*right.columns, "_piece", slices)
        big = _join_pieces(big, cut_right, on, "_m").select(*own, "_piece", _every_piece("_m").alias("_slice"))
        keys.append("_slice")
    small = small.select(*as_right, *[F.col(c).alias(f"_r_{c}") for c in keys if c not in on])
    pairs = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) if null_safe else F.col(c) == F.col(f"_r_{c}") for c in keys]
    if large:
        big = big.hint("merge")
    joined = big.join(small, reduce(lambda a, b: a & b, pairs), how)
    return joined.select(*own, *(other if how in ("inner", "left") else []))


def spread_rows(df: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """Rows dealt over tasks of ``task_rows``, where a small file may hold millions; for steps that multiply or sort them."""
    tasks = -(-df.count() // task_rows)
    return df.repartition(tasks, *df.columns) if tasks > 1 else df


def top_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows per key. Each task keeps ``n`` rows per key before the shuffle."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") <= n).drop("_place")


def rows_at_max(df: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    """All rows whose ``by`` is the largest of their key; ties stay."""
    best = df.groupBy(*keys).agg(F.max(by).alias("_best"), F.count(F.lit(1)).alias("_rows"))
    joined = skew_join(df, best.select(*keys, "_best"), keys, "inner", counts=best)
    return joined.filter(F.col(by) == F.col("_best")).drop("_best")


def keep_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs once, found by one aggregation instead of a count over each group."""
    others = [c for c in df.columns if c not in keys]
    row = F.any_value(F.struct(*others)).alias("_row") if others else F.lit(None).alias("_row")
    once = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), row).filter(F.col("_rows") == 1)
    return once.select(*keys, *[F.col(f"_row.`{c}`").alias(c) for c in others]).select(*df.columns)
