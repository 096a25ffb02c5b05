"""Approximate nearest players by Euclidean distance: a random-projection hash index with several tables and probes.

A table cuts the space by hyperplanes of random direction through the median of a sample, so that each halves the data. The
sides a vector is on, one bit each, name its bucket; there are as many bits as buckets of ``bucket_rows`` vectors ask
for, and a bucket that turns out heavy is named by further bits. A vector looks into its own bucket of every table and into
those that differ in the bits of the nearest planes. Buckets are compared block against block, first the own ones; what the
other buckets offer counts only if it is nearer than the k-th so far.

Buckets that agree in their first bits are a cell, which one task holds: a vector travels once to each cell that it looks into,
not once to each bucket, and its own cell is searched first.

The planes are fitted on a bounded sample; every vector is indexed. ``measured_recall`` compares with brute force.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from touchline.operators.knn import _first_ids, _matrix, _nearest, _offer, _result_schema, _slack, _usable
from touchline.operators.skew import skew_join, top_rows
from touchline.session import bound_batches, materialize

PLANES = 60  # sides kept per table, the first of which name a bucket
DEEPER = 8  # further sides that name the parts of a heavy bucket
CELL_ROWS = 65_536  # members of a cell, on average
MOST_ROWS = 4 * CELL_ROWS  # of a cell that is held whole
VISITS = 131_072  # of a cell that one task compares at a time
CELL = ["table", "depth", "prefix"]


@dataclass(frozen=True)
class Options:
    tables: int = 6
    probes: int = 16
    bucket_rows: int = 256
    sample_rows: int = 20_000
    seed: int = 11


def _probe_order(bits: int, probes: int) -> list[tuple[int, ...]]:
    """Which planes to step over, by their rank in nearness: single ones and pairs, the nearest first."""
    steps = [(i,) for i in range(bits)] + [(i, j) for j in range(1, bits) for i in range(j)]
    return sorted(steps, key=lambda s: (sum((i + 1) ** 2 for i in s), s))[:probes]


def _vectors(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    if len(sizes) and (sizes != sizes[0]).any():
        raise ValueError("vectors of several lengths")
    return column.flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(len(sizes), sizes[0] if len(sizes) else 0)


def _coder(planes: np.ndarray, middle: np.ndarray, bits: int, probes: int, ladder: list[int], heavy: dict[tuple[int, int], np.ndarray], what: str):
    """The rows of a vector, each with its cell: as ``members`` one per table with its ``code``, the sides it is on; ``home`` the
    same with the ``codes`` that it looks for in that cell, its own first; ``others`` one per other cell that it looks into."""
    weights, steps = 1 << np.arange(PLANES - 1, -1, -1, dtype=np.int64), _probe_order(bits, probes)

    def cells(table: int, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        depth, prefix = np.full(codes.shape, ladder[0], dtype="int32"), codes >> (PLANES - ladder[0])
        for now, deeper in zip(ladder, ladder[1:]):
            split = (depth == now) & np.isin(prefix, heavy.get((now, table), []))
            depth[split], prefix[split] = deeper, codes[split] >> (PLANES - deeper)
        return depth, prefix

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _vectors(batch.column("vec"))
            for table in range(len(planes)):
                side = x @ planes[table].T - middle[table]
                own = (side > 0).astype(np.int64) @ weights
                if what == "members":
                    at, (depth, prefix), extra = np.arange(len(x)), cells(table, own), {"code": pa.array(own)}
                else:
                    near = np.abs(side[:, :bits]).argsort(axis=1, kind="stable")
                    codes = np.stack([own] + [own ^ sum(weights[near[:, rank]] for rank in step) for step in steps], axis=1)
                    depth, prefix = cells(table, codes)
                    at_home = (depth == depth[:, :1]) & (prefix == prefix[:, :1])
                    row, place = np.nonzero(at_home if what == "home" else ~at_home)
                    depth, prefix, codes = depth[row, place], prefix[row, place], codes[row, place]
                    order = np.lexsort((place, prefix, depth, row))
                    row, depth, prefix, codes = row[order], depth[order], prefix[order], codes[order]
                    fresh = np.ones(len(row), dtype=bool)
                    fresh[1:] = (row[1:] != row[:-1]) | (depth[1:] != depth[:-1]) | (prefix[1:] != prefix[:-1])
                    starts = np.flatnonzero(fresh)
                    at, depth, prefix = row[starts], depth[starts], prefix[starts]
                    extra = {"codes": pa.ListArray.from_arrays(pa.array(np.append(starts, len(row)).astype("int32")), pa.array(codes))}
                taken = batch.take(pa.array(at))
                cell = {"table": pa.array(np.full(len(at), table, dtype="int32")), "depth": pa.array(depth), "prefix": pa.array(prefix)}
                columns = cell | extra | {name: taken.column(name) for name in batch.schema.names}
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return code


def _buckets(at: np.ndarray, codes: np.ndarray, members: np.ndarray, theirs: np.ndarray, depth: int, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Visitors and members of each bucket; buckets of more than ``most`` members are named by more and more bits."""
    names, wanted = theirs >> (PLANES - depth), codes >> (PLANES - depth)
    order = names.argsort(kind="stable")
    buckets, start, count = np.unique(names[order], return_index=True, return_counts=True)
    slot = np.searchsorted(buckets, wanted)
    there = np.flatnonzero(buckets[np.minimum(slot, len(buckets) - 1)] == wanted) if len(buckets) else np.zeros(0, dtype="int64")
    there = there[slot[there].argsort(kind="stable")]
    bounds = np.searchsorted(slot[there], np.arange(len(buckets) + 1))
    for b in np.flatnonzero(np.diff(bounds)):
        asking, inside = there[bounds[b] : bounds[b + 1]], order[start[b] : start[b] + count[b]]
        if count[b] > most and depth < PLANES - DEEPER:
            yield from _buckets(at[asking], codes[asking], members[inside], theirs[inside], depth + DEEPER, most)
        else:
            yield at[asking], members[inside]


def _compare(k: int, bits: int, most: int, home: bool):
    """The k nearest ids that the members of a cell offer to each of its visitors, bucket by bucket."""

    def step(visitors: pa.Table, members: pa.Table) -> pa.Table:
        x, y = _vectors(visitors["vec"]), _vectors(members["vec"])
        found, id_type = [(np.zeros(0, dtype="int64"),) * 2 + (np.zeros(0),)], members.schema.field("ids").type.value_type
        if len(x) and len(y):
            limit = visitors["limit"].to_pandas().astype("float64").fillna(np.inf).to_numpy().copy()
            best, slack, depth = np.full((len(x), k), np.inf), _slack(x, y), max(bits, visitors["depth"][0].as_py())
            listed = visitors["codes"].combine_chunks()
            sizes, codes = np.diff(listed.offsets.to_numpy()), listed.flatten().to_numpy()
            at, theirs = np.repeat(np.arange(len(x)), sizes), members["code"].to_numpy()
            own = np.zeros(len(at), dtype=bool)
            own[(np.cumsum(sizes) - sizes) if home else []] = True
            for part in (own, ~own):
                for rows, inside in _buckets(at[part], codes[part], np.arange(len(y)), theirs, depth, most):
                    found.extend(_offer(x, y, rows, inside, best, limit, slack))
        at, ids, distance = _first_ids(*(np.concatenate(c) for c in zip(*found)), members["ids"].to_pylist(), k)
        vid = visitors["vid"].to_numpy()[at]
        return pa.table({"vid": pa.array(vid, pa.int64()), "id": pa.array(ids, id_type), "distance": pa.array(distance, pa.float64())})

    return step


def _searched(visitors: DataFrame, members: DataFrame, step, id_type: T.DataType) -> DataFrame:
    """Visitors against the members of their cells: vid, id, distance.

    The members of a cell meet its visitors in blocks; a cell that further bits do not make small is cut as well. Tasks are as many
    as blocks ask for, so that none holds many.
    """
    sizes = visitors.groupBy(*CELL).agg(F.count(F.lit(1)).alias("_v")).join(members.groupBy(*CELL).agg(F.count(F.lit(1)).alias("_m")), CELL)
    sizes = materialize(sizes.select(*CELL, F.ceil(F.col("_m") / MOST_ROWS).alias("_i"), F.ceil(F.col("_v") / VISITS).alias("_j")), "cell-sizes")
    blocks = sizes.agg(F.sum(F.col("_i") * F.col("_j"))).first()[0] or 1

    def block(of: str) -> Column:
        return F.pmod(F.xxhash64("vid", F.lit(5)), F.col(of))

    def every(of: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(of) - 1))

    # a cell stands for tens of thousands of vectors, so their list is short
    asked = visitors.join(F.broadcast(sizes), CELL).select(*CELL, every("_i").alias("i"), block("_j").alias("j"), "vid", "limit", "codes", "vec")
    offered = members.join(F.broadcast(sizes), CELL).select(*CELL, block("_i").alias("i"), every("_j").alias("j"), "code", "vec", "ids")
    asked, offered = (side.repartition(2 * blocks, *CELL, "i", "j") for side in (asked, offered))
    schema = T.StructType([T.StructField("vid", T.LongType()), T.StructField("id", id_type), T.StructField("distance", T.DoubleType())])
    return asked.groupBy(*CELL, "i", "j").cogroup(offered.groupBy(*CELL, "i", "j")).applyInArrow(step, schema)


def _best(found: DataFrame, k: int) -> DataFrame:
    """Each vector's k nearest ids, one found in several buckets once."""
    once = found.groupBy("vid", "id").agg(F.min("distance").alias("distance"))
    best = top_rows(once, ["vid"], [F.col("distance"), F.col("id")], k)
    return best.groupBy("vid").agg(F.sort_array(F.collect_list(F.struct("distance", "id"))).alias("near"))


def _parts(points: DataFrame, features: str) -> Column:
    """The vector as doubles, or as floats where the table has no more."""
    kind = points.select(features).schema[0].dataType
    kind = "float" if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType) else "double"
    return F.transform(F.col(features), lambda v: v.cast(kind) + F.lit(0.0).cast(kind))


def approximate_neighbours(
    points: DataFrame, k: int = 10, options: Options = Options(), player: str = "player_id", features: str = "features", asked: DataFrame | None = None
) -> DataFrame:
    """``player, neighbour, rank, distance`` as ``knn.nearest_neighbours`` gives them, but only as good as the index; a player in
    buckets of few vectors may have fewer than k. Equal vectors are indexed once. With ``asked`` only the players there look for
    neighbours, among all."""
    spark, id_type = points.sparkSession, points.schema[player].dataType
    bound_batches(spark)
    rows = points.select(F.col(player).alias("id"), _parts(points, features).alias("vec"))
    rows = rows.filter(_usable(F.col("vec")))
    ids = top_rows(rows, ["vec"], [F.col("id")], k + 1).groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    vectors = materialize(ids.withColumn("vid", F.monotonically_increasing_id()), "index-vectors")  # numbered once, as written
    sample = vectors.orderBy(F.xxhash64("vec"), "vec").limit(options.sample_rows).select("vec").collect()
    if not sample:
        return spark.createDataFrame([], _result_schema(player, id_type))
    x = _matrix(r.vec for r in sample)
    planes = np.random.default_rng(options.seed).normal(size=(options.tables, PLANES, x.shape[1]))
    middle = np.median(np.einsum("nd,tpd->tpn", x, planes), axis=2)
    count = vectors.count()
    bits = max(0, math.ceil(math.log2(max(1, count / options.bucket_rows))))
    # a cell takes as many buckets as make up its rows; one that turns out heavy is a bucket, or a part of one
    ladder = sorted({max(0, bits - max(0, round(math.log2(CELL_ROWS / options.bucket_rows)))), bits, *range(bits + DEEPER, PLANES, DEEPER)})
    heavy: dict[tuple[int, int], np.ndarray] = {}

    def coded(of: DataFrame, what: str) -> DataFrame:
        extra = T.StructField("code", T.LongType()) if what == "members" else T.StructField("codes", T.ArrayType(T.LongType()))
        cell = [T.StructField("table", T.IntegerType()), T.StructField("depth", T.IntegerType()), T.StructField("prefix", T.LongType())]
        return of.mapInArrow(_coder(planes, middle, bits, options.probes, ladder, dict(heavy), what), T.StructType([*cell, extra, *of.schema.fields]))

    for depth in ladder[:-1] if count > MOST_ROWS else []:
        counts = coded(vectors.select("vid", "vec"), "members").filter(F.col("depth") == depth).groupBy(*CELL).count()
        large = counts.filter(F.col("count") > MOST_ROWS).collect()  # one row per MOST_ROWS vectors at most
        if not large:
            break
        heavy |= {(depth, table): np.array([r.prefix for r in large if r.table == table]) for table in {r.table for r in large}}
    members, seekers = coded(vectors.select("vid", "vec", "ids"), "members"), vectors.select("vid", "vec")
    if asked is not None:
        rows = rows.join(asked.select(F.col(player).alias("id")).distinct(), "id", "left_semi").select("id", "vec")
        seekers = vectors.join(rows.select("vec"), "vec", "left_semi").select("vid", "vec")
    most = 4 * options.bucket_rows
    home = coded(seekers.withColumn("limit", F.lit(None).cast("double")), "home")
    first = materialize(_best(_searched(home, members, _compare(k + 1, bits, most, True), id_type), k + 1), "own-cells")
    limit = F.when(F.size("near") > k, F.element_at("near", -1)["distance"])
    others = coded(materialize(seekers.join(first.select("vid", limit.alias("limit")), "vid"), "seekers"), "others")
    more = _searched(others, members, _compare(k + 1, bits, most, False), id_type)
    near = _best(first.select("vid", F.explode("near").alias("n")).select("vid", "n.id", "n.distance").unionByName(more), k + 1)
    answers = skew_join(rows, vectors.select("vid", "vec").join(near, "vid").select("vec", "near"), ["vec"], "inner", spread=["id"])
    kept = F.slice(F.filter("near", lambda n: n["id"] != F.col("id")), 1, k)
    return answers.select(F.col("id").alias(player), F.posexplode(kept).alias("at", "n")).select(
        player, F.col("n.id").alias("neighbour"), (F.col("at") + 1).alias("rank"), F.col("n.distance").alias("distance")
    )


def brute_force(points: DataFrame, asked: DataFrame, k: int, player: str = "player_id", features: str = "features", block: int = 8192) -> DataFrame:
    """The k nearest other players of those in ``asked``, each block of these against each block of all points."""
    id_type = points.schema[player].dataType
    shape = lambda df: df.select(F.col(player).alias("id"), _parts(df, features).alias("vec")).filter(_usable(F.col("vec")))
    sizes = [max(1, math.ceil(n / m)) for n, m in ((asked.count(), block), (points.count(), 16 * block))]
    numbers = [F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for n in sizes]
    parts = [F.pmod(F.xxhash64("id"), F.lit(n)).cast("int") for n in sizes]
    left = shape(asked).select("id", "vec", parts[0].alias("i"), numbers[1].alias("j"))
    right = shape(points).select(F.col("id").alias("r_id"), F.col("vec").alias("r_vec"), parts[1].alias("r_j"), numbers[0].alias("r_i"))
    schema = T.StructType([T.StructField(player, id_type), T.StructField("neighbour", id_type), T.StructField("distance", T.DoubleType())])

    def step(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return pd.DataFrame({c: [] for c in (player, "neighbour", "distance")})
        at, ids, distance = _nearest(_matrix(a["vec"]), _matrix(b["r_vec"]), [[i] for i in b["r_id"]], k + 1, np.full(len(a), np.inf))
        return pd.DataFrame({player: a["id"].to_numpy()[at], "neighbour": pd.Series(ids, dtype=object), "distance": distance})

    found = left.groupBy("i", "j").cogroup(right.groupBy("r_i", "r_j")).applyInPandas(step, schema).filter(F.col(player) != F.col("neighbour"))
    return top_rows(found, [player], [F.col("distance"), F.col("neighbour")], k)


def measured_recall(found: DataFrame, truth: DataFrame, player: str = "player_id") -> DataFrame:
    """One row: the pairs of the truth, those of them that were found, and their share. Ties beyond the k-th count as misses."""
    both = truth.select(player, "neighbour").join(found.select(player, "neighbour", F.lit(1).alias("_hit")), [player, "neighbour"], "left")
    return both.agg(F.count(F.lit(1)).alias("pairs"), F.count("_hit").alias("hits"), (F.count("_hit") / F.count(F.lit(1))).alias("recall"))


def options_for(
    points: DataFrame, asked: DataFrame, k: int = 10, recall: float = 0.9, options: Options = Options(), player: str = "player_id", features: str = "features",
    truth: DataFrame | None = None,
) -> tuple[Options, DataFrame]:
    """The first options, with twice the tables and probes and four times the rows of a bucket at each step, under which the players
    in ``asked`` get that share of their true neighbours; and what the index finds with them for all players. Options are tried
    for the players in ``asked`` alone. ``truth`` spares the brute force where its result is known."""
    truth = materialize(brute_force(points, asked, k, player, features), "true-neighbours") if truth is None else truth
    for _ in range(6):
        tried = materialize(approximate_neighbours(points, k, options, player, features, asked), "near-neighbours")
        reached = measured_recall(tried, truth, player).first()
        if not reached.pairs or reached.recall >= recall:
            return options, materialize(approximate_neighbours(points, k, options, player, features), "near-neighbours")
        options = replace(options, tables=2 * options.tables, probes=2 * options.probes, bucket_rows=4 * options.bucket_rows)
    raise ValueError(f"no index up to {options} reaches a recall of {recall}; knn.nearest_neighbours is exact")
