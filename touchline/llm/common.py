"""Helpers shared by the operators of this subpackage: row keys, prefix sums, connected groups."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from touchline.session import discard_step, materialize

# A word of the contracts: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column | str) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(text, _UPPER, _LOWER)


def text_or_empty(text: Column | str) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def row_key(doc_id: Column | str = "doc_id", text: Column | str = "text") -> Column:
    """A 64-bit key of a row's id and text. Rows that agree in both share it and share every result of their text."""
    return F.xxhash64(doc_id, text)


def count_words(text: Column | str) -> Column:
    """The number of WORD matches; null counts 0."""
    parts = F.split(F.trim(F.regexp_replace(text_or_empty(text), r"[\x20\x09-\x0D]+", " ")), " ")
    return F.when(parts[0] == "", F.lit(0)).otherwise(F.size(parts)).cast("long")


def boxed(docs: DataFrame, **extra: Column) -> DataFrame:
    """All columns of ``docs`` as one, ``_doc``, beside ``extra``, so that no name of theirs can clash."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")
    return docs.select(whole, *[c.alias(n) for n, c in extra.items()])


def unboxed(df: DataFrame, names: Sequence[str], **changed: Column) -> DataFrame:
    """The columns ``names`` of ``_doc``, some of them changed."""
    return df.select(*[changed.get(c, F.col(f"_doc.`{c}`")).alias(c) for c in names])


def bucketed(df: DataFrame, key: Column, rows: int, per_bucket: int = 10_000) -> DataFrame:
    """Adds ``_bucket``, a hash of ``key``, so that a bucket holds about ``per_bucket`` of the ``rows`` rows."""
    return df.withColumn("_bucket", F.pmod(F.xxhash64(key, F.lit(7)), F.lit(max(1, -(-rows // per_bucket)))))


def offsets(
    df: DataFrame, value: str, keys: Sequence[str], chunk: str, order: Sequence[Column], out: str = "start"
) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows before, per ``keys``, in the order of ``chunk`` and then ``order``.

    Sums run inside a chunk first and then over the totals of the chunks, so that no task holds a whole key.
    """
    inside = Window.partitionBy(*keys, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(*keys, chunk).agg(F.sum(value).alias("_total"))
    across = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate([*keys, chunk])],
        F.coalesce(F.sum("_total").over(across), F.lit(0)).alias("_base"),
    )
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate([*keys, chunk])]
    local = df.withColumn("_within", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    joined = local.join(bases, on=_all(same), how="inner")
    return joined.select(*df.columns, (F.col("_base") + F.col("_within")).cast("long").alias(out))


def _all(conditions: Sequence[Column]) -> Column:
    first, *rest = conditions
    for c in rest:
        first = first & c
    return first


def _edges_state(edges: DataFrame) -> tuple:
    hashed = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(hashed)).first())


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """The smallest id that each linked id reaches, as rows (id, component); ids without a link are left out.

    Stars are contracted in turns: every node hands its larger neighbours, then its smaller ones, to the smallest
    neighbour, until each group is one star. A node's minimum is an aggregation that is combined before the
    shuffle, so a node with a third of all links is no burden; the rounds grow with the logarithm of the data and each
    is written to the shared folder.
    """
    pair = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).filter("u <> v")
    now = materialize(
        pair.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges"
    )
    state = _edges_state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("x"), F.least("u", "m").alias("m"))
        large = both.join(least, F.col("u") == F.col("x")).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "x")
        small = large.join(least, F.col("u") == F.col("x")).select("u", "v", "m")
        kept = small.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        last, now = now, materialize(kept.select("e.u", "e.v").filter("u <> v").distinct(), "edges")
        discard_step(last)
        before, state = state, _edges_state(now)
        if before == state:
            break
    members = now.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return members.unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


_PLACES = "array<struct<i: bigint, j: bigint, side: int>>"


def in_blocks(placed: DataFrame, cell: Sequence[str], key: str, task_rows: int) -> DataFrame:
    """Deals the rows of cells into tasks (columns ``cell``, i, j) of at most about ``task_rows`` rows, so that every two own rows
    of a cell, and every own row and guest (``visits``), meet in one task.

    ``side`` is 0 for own rows, 1 for the own rows they meet, 2 for guests; in tasks marked ``within`` the own rows also
    meet each other. A small cell is one task; others are cut by a hash of ``key`` into blocks that meet pairwise.
    """
    block = task_rows // 2
    own = F.sum((~F.col("visits")).cast("long"))
    sizes = placed.groupBy(*cell).agg(own.alias("own"), F.sum(F.col("visits").cast("long")).alias("guests"))
    sizes = sizes.filter("own > 0 and own + guests > 1").select(
        *[F.col(c).alias(f"_{c}") for c in cell],
        (F.col("own") + F.col("guests") <= task_rows).alias("_one"),
        F.ceil(F.col("own") / block).alias("_c"),
        F.ceil(F.col("guests") / block).alias("_g"),
    )
    rows = placed.join(sizes, _all([F.col(c).eqNullSafe(F.col(f"_{c}")) for c in cell]))
    chunk = F.pmod(F.xxhash64(key), F.greatest(F.when(F.col("visits"), F.col("_g")).otherwise(F.col("_c")), F.lit(1)))
    rows = rows.withColumn("_x", chunk)

    def places(first: Column, last: Column, make) -> Column:
        return F.when(first <= last, F.transform(F.sequence(first, last), make)).otherwise(F.array().cast(_PLACES))

    def place(i: Column, j: Column, side: int) -> Column:
        return F.struct(i.cast("long").alias("i"), j.cast("long").alias("j"), F.lit(side).alias("side"))

    x, c, zero = F.col("_x"), F.col("_c"), F.lit(0).cast("long")
    as_own = F.concat(places(x, c + F.col("_g") - 1, lambda j: place(x, j, 0)), places(zero, x - 1, lambda i: place(i, x, 1)))
    as_guest = places(zero, c - 1, lambda i: place(i, c + x, 2))
    blocks = F.when(F.col("visits"), as_guest).otherwise(as_own)
    alone = F.array(F.when(F.col("visits"), place(zero, zero, 2)).otherwise(place(zero, zero, 0)))
    dealt = rows.select(*placed.columns, F.explode(F.when(F.col("_one"), alone).otherwise(blocks)).alias("_p"))
    return dealt.select(*placed.columns, "_p.i", "_p.j", "_p.side", (F.col("_p.i") == F.col("_p.j")).alias("within"))


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that each of 0..n-1 reaches over the links a-b."""
    label = np.arange(n)
    while True:
        before = label.copy()
        np.minimum.at(label, a, label[b])
        np.minimum.at(label, b, label[a])
        label = label[label]
        if (label == before).all():
            return label
