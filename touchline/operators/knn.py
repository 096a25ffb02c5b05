"""Exact nearest players by Euclidean distance.

Equal vectors are searched once. Every distinct vector belongs to the nearest of a bounded set of pivots; first the
pivot's own cell is searched, which bounds how far a neighbour can be, and then only the cells that the triangle
inequality and the bisecting plane cannot rule out. Cells are cut into blocks of bounded size, and one task step
compares two blocks. Within a block boxes around ever smaller parts rule out most of its vectors, so that the work of a row
does not grow with the cells.

Where few cells can be ruled out, as in many dimensions, a shuffle would carry every vector once to each open cell. Then blocks
are packed and read from the shared folder by every task that compares them, and a task keeps only the nearest so far.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from touchline.operators.serving import check_similar_count
from touchline.operators.skew import skew_join, top_rows
from touchline.session import bound_batches, discard_step, materialize

BLOCK_ROWS = 8192
HEAVY_BLOCKS = 256
PROBE_ROWS = 512  # of a block whose distances to all pivots are held at a time
BOX_ROWS = 64  # of a block that are compared without looking closer
MATRIX = 1 << 17  # distances held at a time, few enough for the processor's cache
LEAST_ROWS = 64  # compared with a block at a time, however large it is
PARTS_SENT = 1 << 10  # numbers of a vector, all its copies together, that may travel to open cells
SIDE_BYTES = 128 << 20  # of packed blocks that a task holds while others pass by
WAITING = 1 << 21  # pairs that wait to be merged with the nearest so far
_SLACK = 1e-7


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    squares = (-2 * x) @ y.T  # one matrix, changed in place
    squares += (x * x).sum(1)[:, None]
    squares += (y * y).sum(1)[None, :]
    return np.sqrt(np.maximum(squares, 0, out=squares), out=squares)


def _matrix(rows) -> np.ndarray:
    rows = list(rows)
    if len({len(r) for r in rows}) > 1:
        raise ValueError("vectors of several lengths")
    return np.concatenate(rows).astype("float64").reshape(len(rows), len(rows[0])) if rows else np.zeros((0, 0))


def _slack(x: np.ndarray, y: np.ndarray) -> float:
    """More than the rounding of ``_distances``."""
    return _SLACK * (1 + np.abs(x).max(initial=0) + np.abs(y).max(initial=0)) * np.sqrt(x.shape[1])


def _offer(x: np.ndarray, y: np.ndarray, rows: np.ndarray, members: np.ndarray, best: np.ndarray, limit: np.ndarray, slack: float) -> Iterator[tuple]:
    """Pairs of ``rows`` and ``members`` that can be among the nearest: positions in ``x`` and ``y``, distances. ``best`` holds the
    shortest distances of each row so far and ``limit`` the longest that counts; both are kept up. No pair may be offered twice.

    The matrix product picks the pairs, with slack for its rounding; their distances are then taken from the differences.
    """
    k, size = best.shape[1], max(LEAST_ROWS, MATRIX // max(1, len(members)))
    theirs = y[members]
    for part in (rows[i : i + size] for i in range(0, len(rows), size)):
        own = x[part]
        rough = _distances(own, theirs)
        close = rough <= limit[part][:, None] + slack
        if close.sum() > 2 * len(part):
            new = np.partition(rough, k - 1, axis=1)[:, :k] if rough.shape[1] > k else rough
            best[part] = np.partition(np.concatenate([best[part], new], axis=1), k - 1, axis=1)[:, :k]
            limit[part] = np.minimum(limit[part], best[part, k - 1])
            close = rough <= limit[part][:, None] + slack
        at, other = np.nonzero(close)
        yield part[at], members[other], np.sqrt(((own[at] - theirs[other]) ** 2).sum(1))


def _boxes(y: np.ndarray, members: np.ndarray, least: int) -> dict:
    """Vectors halved at the median of their widest side until ``least`` are left, each part with the box around it."""
    low, high = y[members].min(0), y[members].max(0)
    node = {"members": members, "low": low, "high": high}
    if len(members) > 2 * least and (high > low).any():
        side = int((high - low).argmax())
        values = y[members, side]
        value = np.partition(values, len(values) // 2)[len(values) // 2]
        value = value if value > low[side] else values[values > value].min()
        below = values < value
        node |= {"side": side, "value": value, "parts": [_boxes(y, members[below], least), _boxes(y, members[~below], least)]}
    return node


def _near_pairs(x: np.ndarray, y: np.ndarray, k: int, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs that can be among the ``k`` nearest of each row of ``x`` and not farther than ``limit``: positions, distances.

    Boxes within ``y`` are looked into only by the rows that can have near ones there. Where most rows look into both halves,
    as in many dimensions, the halves are compared in one go.
    """
    slack, limit, best = _slack(x, y), np.array(limit, dtype="float64"), np.full((len(x), k), np.inf)
    root, found = _boxes(y, np.arange(len(y)), max(BOX_ROWS, k)), []

    def bound(node: dict, rows: np.ndarray) -> None:
        """The k-th distance within the row's own box bounds what counts."""
        if "parts" in node:
            below = x[rows, node["side"]] < node["value"]
            bound(node["parts"][0], rows[below])
            bound(node["parts"][1], rows[~below])
        elif len(rows) and len(node["members"]) >= k:
            limit[rows] = np.partition(_distances(x[rows], y[node["members"]]), k - 1, axis=1)[:, k - 1] + slack

    def look(node: dict, rows: np.ndarray) -> None:
        if "parts" in node and len(rows):
            gaps = [np.maximum(np.maximum(part["low"] - x[rows], x[rows] - part["high"]), 0) for part in node["parts"]]
            both = [rows[np.sqrt((gap**2).sum(1)) <= limit[rows] + slack] for gap in gaps]
            if sum(map(len, both)) <= 1.5 * len(rows):
                for part, inside in zip(node["parts"], both):
                    look(part, inside)
                return
        found.extend(_offer(x, y, rows, node["members"], best, limit, slack))

    if "parts" in root:
        bound(root, np.flatnonzero(np.isinf(limit)))
    look(root, np.arange(len(x)))
    return tuple(np.concatenate(c) if found else np.zeros(0, dtype=t) for c, t in zip(zip(*found) if found else [()] * 3, ("int64", "int64", "float64")))


def _first_ids(at: np.ndarray, other: np.ndarray, distance: np.ndarray, ids: list, k: int) -> tuple[np.ndarray, list, np.ndarray]:
    """Of pairs with vectors that stand for ``ids``, the ``k`` nearest ids of each row."""
    counts = np.array([len(i) for i in ids], dtype="int64")
    flat = np.array([i for listed in ids for i in listed] or [0], dtype=object)
    spread = np.repeat(np.arange(len(at)), counts[other])
    within = np.arange(len(spread)) - np.repeat(np.cumsum(counts[other]) - counts[other], counts[other])
    place = (np.cumsum(counts) - counts)[other][spread] + within
    found = pd.DataFrame({"at": at[spread], "distance": distance[spread], "id": flat[place]}).infer_objects()
    found = found.sort_values(["at", "distance", "id"], kind="stable")
    found = found[found.groupby("at").cumcount() < k]
    return found["at"].to_numpy(), found["id"].tolist(), found["distance"].to_numpy()


def _nearest(x: np.ndarray, y: np.ndarray, ids: list, k: int, limit: np.ndarray) -> tuple[np.ndarray, list, np.ndarray]:
    """For each row of ``x`` the ``k`` nearest ids among ``y`` not farther than ``limit``: positions, ids, distances."""
    return _first_ids(*_near_pairs(x, y, k, limit), ids, k)


def _compare(k: int):
    """Block against block; in: own place, ``at``, ``x``, ``limit``, ``y``, ``ids``; out: one row per near id."""

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                if len(row.x) == 0 or len(row.y) == 0:
                    continue
                limit = np.asarray(row.limit, dtype="float64") if row.limit is not None else np.full(len(row.x), np.inf)
                at, ids, distance = _nearest(_matrix(row.x), _matrix(row.y), [list(i) for i in row.ids], k, limit)
                yield pd.DataFrame(
                    {"cell": row.cell, "chunk": row.chunk, "at": np.asarray(row.at)[at], "id": pd.Series(ids, dtype=object), "distance": distance}
                )

    return step


def _assign(pivots: np.ndarray):
    """``cell`` and ``radius``: the nearest pivot and the distance to it."""

    @F.pandas_udf("cell int, radius double")
    def udf(vectors: pd.Series) -> pd.DataFrame:
        if len(vectors) == 0:
            return pd.DataFrame({"cell": pd.Series(dtype="int32"), "radius": pd.Series(dtype="float64")})
        far = _distances(_matrix(vectors), pivots)
        cell = far.argmin(1)
        return pd.DataFrame({"cell": cell.astype("int32"), "radius": far[np.arange(len(cell)), cell]})

    return udf


def _probe(pivots: np.ndarray, radius: np.ndarray, packed: bool = False):
    """Which other cells a block must look into, given each row's distance to its k-th neighbour so far; ``packed`` gives one row per
    block, with a bit for each row and cell."""

    def opened(x: np.ndarray, cell: int, limit: np.ndarray) -> np.ndarray:
        far = _distances(x, pivots)
        own = far[:, cell][:, None]
        between = _distances(pivots[cell][None, :], pivots)
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = np.nan_to_num((far**2 - own**2) / (2 * between), nan=0.0, posinf=0.0, neginf=0.0)
        least = np.maximum(far - radius[None, :], plane)
        open_cells = least <= limit[:, None] + _slack(x, pivots)
        open_cells[:, cell] = False
        open_cells[:, radius < 0] = False
        return open_cells

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                x, limits = _matrix(row.x), np.asarray(row.limit, dtype="float64")
                open_cells = np.concatenate([opened(x[i : i + PROBE_ROWS], row.cell, limits[i : i + PROBE_ROWS]) for i in range(0, len(x), PROBE_ROWS)])
                targets = np.nonzero(open_cells.any(0))[0].astype("int32")
                # bits only: the vectors themselves follow by a join, so that a worker never holds them once per cell
                bits = np.packbits(open_cells, axis=1).tobytes()
                yield pd.DataFrame({"cell": [row.cell], "chunk": [row.chunk], "asked": [int(open_cells.sum())], "targets": [targets], "open": [bits]})

    return step if packed else lambda batches: _places(len(pivots))(step(batches))


def _unpacked(bits: bytes, n_cells: int) -> np.ndarray:
    """Rows by cells, as ``_probe`` packed them."""
    width = -(-n_cells // 8)
    return np.unpackbits(np.frombuffer(bits, dtype="uint8").reshape(-1, width), axis=1, count=n_cells).astype(bool)


def _places(n_cells: int):
    """A row per block and open cell with the places of the rows that look into it."""

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                if len(row.targets):
                    open_cells = _unpacked(row.open, n_cells)
                    out = [(row.cell, row.chunk, int(t), np.nonzero(open_cells[:, t])[0].astype("int32")) for t in row.targets]
                    yield pd.DataFrame(out, columns=["cell", "chunk", "target", "at"])

    return step


def _packed(kind: str):
    """The blocks of a pack as one row, vectors as bytes: cells and their sizes, vectors, limits, open cells, ids and their numbers."""

    def step(blocks: pd.DataFrame) -> pd.DataFrame:
        blocks = blocks.sort_values("cell")
        ids = [i for listed in blocks["ids"] for i in listed]
        return pd.DataFrame(
            {
                "pack": [blocks["pack"].iloc[0]], "chunk": [blocks["chunk"].iloc[0]], "cells": [blocks["cell"].to_numpy("int32")],
                "sizes": [np.array([len(x) for x in blocks["x"]], dtype="int32")],
                "x": [np.concatenate([_matrix(x) for x in blocks["x"]]).astype(kind).tobytes()],
                "limit": [np.concatenate([np.asarray(v, dtype="float64") for v in blocks["limit"]]).tobytes()],
                "open": [b"".join(blocks["open"])], "targets": [np.unique(np.concatenate(list(blocks["targets"]))).astype("int32")],
                "ids": [[i for listed in ids for i in listed]], "counts": [np.array([len(listed) for listed in ids], dtype="int32").tobytes()],
            }
        )

    return step


class _Nearest:
    """The nearest ids of a pack's rows so far, beside those of their own cells."""

    def __init__(self, row, k: int, kind: str, n_cells: int) -> None:
        self.key, self.k, self.cells, self.sizes = (row.pack, row.chunk), k, np.asarray(row.cells), np.asarray(row.sizes)
        self.x = np.frombuffer(row.x, dtype=kind).reshape(self.sizes.sum(), -1).astype("float64")
        self.limit, self.best = np.frombuffer(row.limit).copy(), np.full((len(self.x), k), np.inf)
        self.open, self.chunk = _unpacked(row.open, n_cells), row.chunk
        self.waiting, self.n_waiting = [], 0

    def look(self, row, kind: str) -> None:
        sizes, counts = np.asarray(row.y_sizes), np.frombuffer(row.y_counts, dtype="int32")
        y, ends = np.frombuffer(row.y, dtype=kind).reshape(sizes.sum(), -1).astype("float64"), np.cumsum(sizes)
        slack, first, ids = _slack(self.x, y), np.cumsum(counts) - counts, np.asarray(row.y_ids)
        for cell, size, end in zip(row.y_cells, sizes, ends):
            rows = np.flatnonzero(self.open[:, cell])
            for at, other, distance in _offer(self.x, y, rows, np.arange(end - size, end), self.best, self.limit, slack):
                spread = np.repeat(np.arange(len(at)), counts[other])
                within = np.arange(len(spread)) - np.repeat(np.cumsum(counts[other]) - counts[other], counts[other])
                self.waiting.append((at[spread], distance[spread], ids[first[other][spread] + within]))
                self.n_waiting += len(spread)
            if self.n_waiting > WAITING:
                self.merge()

    def merge(self) -> None:
        at, distance, ids = (np.concatenate(c) for c in zip(*self.waiting))
        # not farther than the k-th that is known by now, before the rest is sorted
        near = distance <= self.limit[at] + _slack(self.x, self.x)
        order = pd.DataFrame({"at": at[near], "distance": distance[near], "id": ids[near]}).infer_objects()
        order = order.sort_values(["at", "distance", "id"], kind="stable")
        order = order[order.groupby("at").cumcount() < self.k]
        self.waiting = [(order["at"].to_numpy(), order["distance"].to_numpy(), order["id"].to_numpy())]
        self.n_waiting = 0

    def rows(self) -> Iterator[pd.DataFrame]:
        if self.waiting:
            self.merge()
            at, distance, ids = self.waiting[0]
            block = np.repeat(np.arange(len(self.sizes)), self.sizes)[at]
            begin = np.cumsum(self.sizes) - self.sizes
            found = pd.DataFrame({"cell": self.cells[block], "chunk": self.chunk, "at": at - begin[block], "id": pd.Series(list(ids), dtype=object), "distance": distance})
            for i in range(0, len(found), 100_000):
                yield found.iloc[i : i + 100_000]


def _pass_by(k: int, kind: str, n_cells: int):
    """Packs against packs; a pack that meets several in a row gives its nearest once."""

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now = None
        for batch in batches:
            for row in batch.itertuples(index=False):
                if now is None or now.key != (row.pack, row.chunk):
                    if now is not None:
                        yield from now.rows()
                    now = _Nearest(row, k, kind, n_cells)
                now.look(row, kind)
        if now is not None:
            yield from now.rows()

    return step


def _usable(vector: Column) -> Column:
    return F.coalesce(F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v)), F.lit(False))


def unusable(points: DataFrame, features: str = "features") -> DataFrame:
    """Points that no distance can be told for: no vector, or one with null or NaN parts."""
    return points.filter(~_usable(F.transform(F.col(features), lambda v: v.cast("double"))))


def nearest_neighbours(points: DataFrame, k: int = 10, player: str = "player_id", features: str = "features") -> DataFrame:
    """``player, neighbour, rank, distance``: the k nearest other players of every player; ties go to the lower id.

    ``points`` has one row per player (``one_row_per_player``). The player itself is left out by id, so another
    player with the same numbers is a neighbour at distance 0. Points without a number in every place have no distance
    and are left out on both sides; ``unusable`` lists them.
    """
    spark = points.sparkSession
    bound_batches(spark)
    id_type = points.schema[player].dataType
    # floats stay floats where they are stored and sent
    kind = "float" if isinstance(getattr(points.schema[features].dataType, "elementType", None), T.FloatType) else "double"
    rows = points.select(F.col(player).alias("id"), F.transform(F.col(features), lambda v: (v.cast("double") + F.lit(0.0)).cast(kind)).alias("vec"))
    # the k + 1 lowest ids stand for all players with the same vector: one of them may be the player itself
    ids = top_rows(rows.filter(_usable(F.col("vec"))), ["vec"], [F.col("id")], k + 1)
    listed = [F.sort_array(F.collect_list("id")).alias("ids"), (F.count(F.lit(1)) <= k).alias("whole")]
    vectors = materialize(ids.groupBy("vec").agg(*listed), "knn-vectors")
    # pivots by hash; they and the cells grow with the root of the vectors
    n_vectors = vectors.count()
    n_pivots = int(np.ceil(np.sqrt(max(n_vectors, 1)) / 2))
    chosen = vectors.orderBy(F.xxhash64("vec"), "vec").limit(n_pivots).select("vec").collect()
    if not chosen:
        return spark.createDataFrame([], _result_schema(player, id_type))
    pivots = _matrix(r.vec for r in chosen)

    placed = vectors.withColumn("p", _assign(pivots)("vec")).select("vec", "ids", "whole", "p.cell", "p.radius")
    cells = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("radius").alias("radius"))
    sizes = {r.cell: r for r in cells.collect()}  # one row per pivot
    radius = np.array([sizes[c].radius if c in sizes else -1.0 for c in range(len(pivots))])
    chunks = F.broadcast(
        spark.createDataFrame([(c, int(np.ceil(r.n / BLOCK_ROWS))) for c, r in sizes.items()], "target int, chunks int")
    )

    member = F.struct("vec", "ids", "whole")
    blocks = materialize(
        placed.join(chunks.withColumnRenamed("target", "cell"), "cell")
        .withColumn("chunk", F.pmod(F.xxhash64("vec"), F.col("chunks")).cast("int"))
        .groupBy("cell", "chunk")
        .agg(F.sort_array(F.collect_list(member)).alias("members"))
        .select("cell", "chunk", *[F.col(f"members.{c}").alias(a) for c, a in (("vec", "x"), ("ids", "ids"), ("whole", "whole"))]),
        "knn-blocks",
    )
    discard_step(vectors)
    offered = blocks.select(F.col("cell").alias("target"), F.col("chunk").alias("part"), F.col("x").alias("y"), "ids")
    parts = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("part")
    asked = ["cell", "chunk", "at", "x", "limit", "y", "ids"]
    near_schema = T.StructType(
        [T.StructField(c, T.IntegerType()) for c in ("cell", "chunk", "at")]
        + [T.StructField("id", id_type), T.StructField("distance", T.DoubleType())]
    )

    own = blocks.select(
        "cell", "chunk", F.col("cell").alias("target"),
        F.sequence(F.lit(0), F.size("x") - 1).alias("at"), "x", F.lit(None).cast("array<double>").alias("limit"),
    )

    def searched(questions: DataFrame) -> DataFrame:
        by_part = questions.join(chunks, "target").select(*questions.columns, parts)
        # one row is a whole block, so a key with few hundred rows is heavy already
        pairs = skew_join(by_part, offered, ["target", "part"], "inner", spread=["cell", "chunk"], light_rows=HEAVY_BLOCKS)
        return pairs.select(*asked).mapInPandas(_compare(k + 1), near_schema)

    def nearest(found: DataFrame) -> DataFrame:
        best = top_rows(found, ["cell", "chunk", "at"], [F.col("distance"), F.col("id")], k + 1)
        return best.groupBy("cell", "chunk", "at").agg(
            F.sort_array(F.collect_list(F.struct("distance", "id"))).alias("near")
        )

    first = materialize(nearest(searched(own)), "knn-first")
    limit = F.when(F.size("near") > k, F.element_at("near", -1)["distance"]).otherwise(F.lit(float("inf")))
    limits = first.groupBy("cell", "chunk").agg(F.sort_array(F.collect_list(F.struct("at", limit.alias("limit")))).alias("l"))
    known = blocks.join(limits, ["cell", "chunk"]).select("cell", "chunk", "x", F.col("l.limit").alias("limit"))
    probes = known.mapInPandas(_probe(pivots, radius, packed=True), "cell int, chunk int, asked long, targets array<int>, open binary")
    probes = materialize(probes, "knn-probes")
    asking = blocks.join(limits, ["cell", "chunk"]).withColumn("limit", F.col("l.limit"))
    found = first.select("cell", "chunk", "at", F.explode("near").alias("n")).select("cell", "chunk", "at", "n.id", "n.distance")
    packs, n_asked = None, probes.agg(F.coalesce(F.sum("asked"), F.lit(0))).first()[0]
    if n_asked * pivots.shape[1] <= PARTS_SENT * n_vectors:
        at_places = lambda c: F.transform("at", lambda i: F.get(F.col(c), i)).alias(c)
        more = probes.mapInPandas(_places(len(pivots)), "cell int, chunk int, target int, at array<int>")
        more = more.join(asking.select("cell", "chunk", "x", "limit"), ["cell", "chunk"])
        further = searched(more.select("cell", "chunk", "target", "at", at_places("x"), at_places("limit")))
    else:
        pack_of, filled = {}, 0
        for c in sorted(sizes):
            pack_of[c] = filled // BLOCK_ROWS
            filled += int(sizes[c].n)
        numbers = F.broadcast(spark.createDataFrame(list(pack_of.items()), "cell int, pack int"))
        n_packs = sum(int(np.ceil(r.n / BLOCK_ROWS)) for r in sizes.values() if r.n > BLOCK_ROWS) + len(set(pack_of.values()))
        stored = "<f4" if kind == "float" else "<f8"
        kept = "pack int, chunk int, cells array<int>, sizes array<int>, x binary, limit binary, open binary, targets array<int>, counts binary"
        pack_schema = T.StructType([*T.DataType.fromDDL(kept).fields, T.StructField("ids", T.ArrayType(id_type))])
        packs = materialize(
            asking.join(probes, ["cell", "chunk"]).join(numbers, "cell").select("pack", "cell", "chunk", "x", "limit", "ids", "open", "targets")
            .repartition(n_packs, "pack", "chunk").groupBy("pack", "chunk").applyInPandas(_packed(stored), pack_schema),
            "knn-packs",
        )
        discard_step(probes)
        sides = max(1, -(-n_vectors * (pivots.shape[1] * np.dtype(stored).itemsize + 16) // SIDE_BYTES))
        offers = packs.select(*[F.col(c).alias("y" if c == "x" else f"y_{c}") for c in ("cells", "sizes", "x", "ids", "counts")]).coalesce(sides)
        # a product of partitions, each read where it is needed: nothing is shuffled
        pairs = packs.drop("ids", "counts").hint("shuffle_replicate_nl").join(offers, F.arrays_overlap("targets", "y_cells"))
        further = pairs.mapInPandas(_pass_by(k + 1, stored, len(pivots)), near_schema)
    final = materialize(nearest(found.unionByName(further)), "knn-nearest")
    discard_step(first)
    discard_step(probes if packs is None else packs)
    # players by the ids of their vector; only where it stands for more than are listed by the vector itself
    member = F.posexplode(F.arrays_zip("ids", "whole")).alias("at", "m")
    answers = blocks.select("cell", "chunk", member).join(final, ["cell", "chunk", "at"]).filter("m.whole")
    answers = answers.select(F.explode("m.ids").alias("id"), "near")
    if not blocks.filter(~F.forall("whole", lambda w: w)).isEmpty():
        many = blocks.select("cell", "chunk", F.posexplode(F.arrays_zip("x", "whole")).alias("at", "m")).filter("not m.whole")
        by_vector = many.join(final, ["cell", "chunk", "at"]).select(F.col("m.x").alias("vec"), "near")
        answers = answers.unionByName(skew_join(rows, by_vector, ["vec"], "inner", spread=["id"]).select("id", "near"))
    others = F.slice(F.filter("near", lambda n: n["id"] != F.col("id")), 1, k)
    return answers.select(F.col("id").alias(player), F.posexplode(others).alias("at", "n")).select(
        player, F.col("n.id").alias("neighbour"), (F.col("at") + 1).alias("rank"), F.col("n.distance").alias("distance")
    )


def _result_schema(player: str, id_type: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField(player, id_type), T.StructField("neighbour", id_type),
            T.StructField("rank", T.IntegerType()), T.StructField("distance", T.DoubleType()),
        ]
    )


def one_row_per_player(df: DataFrame, player: str = "player_id", newest: list[Column] | None = None) -> DataFrame:
    """The newest row of each player, so that a player is one point."""
    return top_rows(df, [player], newest or [F.col(c) for c in df.columns if c != player])


def similar_players(neighbours: DataFrame, player_id, n: int = 5, player: str = "player_id") -> DataFrame:
    """The stored neighbours of one player; more than 20 is an error."""
    check_similar_count(n)
    return neighbours.filter((F.col(player) == F.lit(player_id)) & (F.col("rank") <= n)).orderBy("rank")


def nearest_to(points: DataFrame, player_id, n: int = 5, player: str = "player_id", features: str = "features") -> DataFrame:
    """The n nearest players to one player straight from the feature table, in one scan."""
    check_similar_count(n)
    target = points.filter(F.col(player) == F.lit(player_id)).agg(F.min(features)).scalar()
    squares = F.zip_with(F.col(features), F.col("_target"), lambda a, b: F.pow(a.cast("double") - b.cast("double"), F.lit(2)))
    distance = F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, s: total + s))
    return (
        points.filter(F.col(player) != F.lit(player_id))
        .withColumn("_target", target)
        .select(F.col(player).alias("neighbour"), distance.alias("distance"))
        .filter(F.col("distance").isNotNull())
        .orderBy("distance", "neighbour")
        .limit(n)
    )


def with_details(neighbours: DataFrame, view: DataFrame, player: str = "player_id", columns: dict[str, str] | None = None) -> DataFrame:
    """Facts of each neighbour, all seasons, keeping rank and distance, for any number of neighbours."""
    wanted = columns or {c: c for c in view.columns if c != player}
    facts = view.select(F.col(player).alias("neighbour"), *[F.col(c).alias(a) for c, a in wanted.items()])
    return facts.join(neighbours, "neighbour").select(*neighbours.columns, *wanted.values())
