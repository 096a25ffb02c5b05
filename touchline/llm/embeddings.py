"""Near-duplicate vectors by an exact metric range join.

Vectors are compared within a label by cosine; on unit vectors a cosine of at least t is a distance of at most
sqrt(2 - 2 t). Pivots, a pseudorandom choice of a label's vectors, cut its vectors into cells: each belongs to its nearest
pivot. By the triangle inequality a vector can be in range of another cell's vectors only if that cell's pivot is at most
two ranges farther than its own, and no farther beyond the plane between the pivots than the range; to such cells it is
copied, of two cells always to the one that their numbers' parity names. Cells are joined independently, block by block,
so that a crowded cell is many tasks. A task returns counts of links and a spanning forest of them, never all pairs.

Equal vectors are joined once and count as often as they occur.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, and rows whose label or id is
null, link with nothing and are kept; vectors of different lengths do not link; rows with equal ids are separate vectors; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from touchline.llm.common import components, forest, in_blocks
from touchline.session import materialize

CELL_ROWS = 1024  # wanted at least; cells grow with the root of a label's vectors, as do the pivots
TASK_ROWS = 8192
SALT_ROWS = 20_000
_TILE = 1024


def _valid() -> Column:
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists("embedding", lambda x: x != 0) & F.col("label").isNotNull() & F.col("vec_id").isNotNull(), F.lit(False))


def _unit(vectors: pd.Series) -> np.ndarray:
    """Unit vectors in double precision."""
    rows = np.array(vectors.tolist(), np.float64)
    rows /= np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _assign(reach: float):
    """Cogrouped: vectors and pivots of a label to the cells of the vectors, home first."""

    def cells(rows: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame({"cid": [], "cell": [], "visits": []})
        if len(pivots) < 2:
            return pd.DataFrame({"cid": rows.cid, "cell": 0, "visits": False})
        pivots = pivots.sort_values("p_cid")
        own, centres = _unit(rows.embedding), _unit(pivots.p_embedding)
        between = np.sqrt(np.maximum(0, 2 - 2 * centres @ centres.T))
        parts = []
        for at in range(0, len(own), _TILE):
            squared = np.maximum(0, 2 - 2 * own[at : at + _TILE] @ centres.T)
            home = squared.argmin(axis=1)
            nearest = squared[np.arange(len(home)), home][:, None]
            away = between[home]
            with np.errstate(divide="ignore", invalid="ignore"):
                beyond_plane = (squared - nearest) / (2 * away)
            near = (np.sqrt(squared) <= np.sqrt(nearest) + 2 * reach) & ((beyond_plane <= reach) | (away < 1e-9))
            number = np.arange(len(centres))[None, :]
            near &= (number != home[:, None]) & ((number < home[:, None]) == ((number + home[:, None]) % 2 == 0))
            i, j = np.nonzero(near)
            ids = rows.cid.to_numpy()[at : at + _TILE]
            parts.append(pd.DataFrame({"cid": ids, "cell": home, "visits": False}))
            parts.append(pd.DataFrame({"cid": ids[i], "cell": j, "visits": True}))
        return pd.concat(parts)

    return cells


def _compare(least: float):
    """Links inside a task: counts as rows (a, null, n) and a spanning forest as rows (a, b, 0)."""

    def links(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["side", "cid"])
        ids, times, unit = rows.cid.to_numpy(), rows.times.to_numpy(np.int64), _unit(rows.embedding)
        n_own, within = int((rows.side == 0).sum()), bool(rows.within.iloc[0])
        counts, label, ends = np.zeros(len(ids), np.int64), np.arange(len(ids)), ([], [])
        for at in range(0, n_own, _TILE):
            stop = min(at + _TILE, n_own)
            for first in range(at if within else n_own, len(ids), _TILE):
                last = min(first + _TILE, len(ids))
                if not within and first < n_own:
                    continue
                close = unit[at:stop] @ unit[first:last].T >= least
                if first < n_own and within:
                    close &= np.arange(at, stop)[:, None] < np.arange(first, last)[None, :]
                i, j = np.nonzero(close)
                np.add.at(counts, at + i, times[first + j])
                np.add.at(counts, first + j, times[at + i])
                ends[0].append(at + i), ends[1].append(first + j)
                if sum(map(len, ends[0])) > 1_000_000:
                    label = forest(len(ids), np.concatenate([np.arange(len(ids)), *ends[0]]), np.concatenate([label, *ends[1]]))
                    ends = ([], [])
        label = forest(len(ids), np.concatenate([np.arange(len(ids)), *ends[0]]), np.concatenate([label, *ends[1]]))
        some, linked = np.flatnonzero(counts), np.flatnonzero(label != np.arange(len(ids)))
        return pd.DataFrame(
            {
                "a": np.concatenate([ids[some], ids[linked]]),
                "b": pd.Series([None] * len(some) + ids[label[linked]].tolist(), dtype=object),
                "n": np.concatenate([counts[some], np.zeros(len(linked), np.int64)]),
            }
        )

    return links


def near_duplicates(vectors: DataFrame, least: float = 0.93, cell_rows: int | None = None) -> DataFrame:
    """Per row of ``vectors`` (vec_id, embedding, label): vec_id, n_links, component_id, kept."""
    rows = vectors.select("vec_id", "label", "embedding").withColumn("_valid", _valid())
    cid = F.xxhash64("label", "embedding")
    classes = materialize(
        rows.filter("_valid").groupBy("label", "embedding").agg(F.min("vec_id").alias("least_id"), F.count(F.lit(1)).alias("times"))
        .select(cid.alias("cid"), "label", F.size("embedding").alias("dim"), "embedding", "least_id", "times"),
        "vector-classes",
    )
    sizes = classes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("_n"))
    cell = F.greatest(F.lit(float(cell_rows or CELL_ROWS)), (1 if cell_rows else 16) * F.sqrt("_n"))
    sizes = sizes.withColumn("_pivots", F.ceil(F.col("_n") / cell)).withColumn("_salts", F.ceil(F.col("_n") / SALT_ROWS))
    sized = classes.join(sizes, ["label", "dim"])
    chosen = F.pmod(F.xxhash64("cid", F.lit(3)), F.col("_n")) < F.col("_pivots")
    pivots = sized.filter((F.col("_pivots") > 1) & chosen)
    pivots = pivots.select(
        F.col("label").alias("p_label"), F.col("dim").alias("p_dim"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("_salts") - 1)).alias("p_salt"),
        F.col("cid").alias("p_cid"), F.col("embedding").alias("p_embedding"),
    )
    salted = sized.select("label", "dim", F.pmod(F.xxhash64("cid"), F.col("_salts")).alias("salt"), "cid", "embedding")
    by_label = salted.groupBy("label", "dim", "salt").cogroup(pivots.groupBy("p_label", "p_dim", "p_salt"))
    reach = float(np.sqrt(2 - 2 * least)) + 1e-9
    cells = by_label.applyInPandas(_assign(reach), "cid long, cell long, visits boolean")
    placed = materialize(cells, "cells").join(classes.select("cid", "label", "dim"), "cid")
    tasks = in_blocks(placed, ["label", "dim", "cell"], "cid", TASK_ROWS)
    full = tasks.join(classes.select("cid", "embedding", "times"), "cid")
    found = materialize(
        full.groupBy("label", "dim", "cell", "i", "j").applyInPandas(_compare(least), "a long, b long, n long"), "vector-links"
    )
    counts = found.groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("_links"))
    groups = components(found.filter(F.col("b").isNotNull())).select(F.col("id").alias("cid"), F.col("component").alias("_group"))
    named = classes.select("cid", "least_id", "times").join(counts, "cid", "left").join(groups, "cid", "left")
    named = named.withColumn("_group", F.coalesce("_group", "cid"))
    least_ids = named.groupBy(F.col("_group").alias("_g")).agg(F.min("least_id").alias("component_id"))
    result = named.join(least_ids, F.col("_group") == F.col("_g")).select(
        F.col("cid").alias("_cid"), (F.coalesce("_links", F.lit(0)) + F.col("times") - 1).alias("n_links"), "component_id"
    )
    result = materialize(result, "vector-groups")
    keyed = rows.select("vec_id", F.when(F.col("_valid"), cid).alias("cid"))
    joined = keyed.join(result, F.col("cid") == F.col("_cid"), "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
