"""Near-duplicate documents by SimHash: a self-join of the binary trie of all fingerprints.

Fingerprints are 64-bit majority votes over the XXH64 hashes of a text's shingles. Two fingerprints are linked when at
most three bits differ, and then at most one differs in the upper or in the lower half. So the trie is joined with
itself twice, once with the halves swapped: pairs of nodes are walked down together, differing bits are added up, and
a pair is dropped as soon as it has more than one in the first half or more than three at all. The top of the trie is
walked on Spark: nodes of a depth that grows with the data are the cells, and every fingerprint visits the cells whose
prefix differs in one bit. Below, each cell is walked by itself; cells with many fingerprints are cut into blocks that
are walked against each other. A cell returns a spanning forest of its links, never all pairs of a group.

Defined cases: null and empty texts have fingerprint zero and are linked to each other; repeated rows share a
fingerprint; rows with null ids take part, and a group's id is its smallest id that is not null; an empty table gives no
rows; columns other than the two named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from touchline.llm.common import boxed, components, forest, in_blocks, row_key, unboxed
from touchline.session import materialize

CELL_ROWS = 256  # fingerprints wanted per cell
TASK_ROWS = 8192  # a cell with more, visitors included, is cut into blocks of half this size
_STATES = 200_000
_LEAF = 16


def fingerprint_of(text: str | None, shingle: int = 3) -> int:
    """The fingerprint of one text as an unsigned number."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    if len(words) < shingle:
        starts, ends = starts[:1], ends[-1:]
    else:
        starts, ends = starts[: len(words) - shingle + 1], ends[shingle - 1 :]
    digest, votes = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(starts), 1 << 16):
        spans = zip(starts[at : at + (1 << 16)].tolist(), ends[at : at + (1 << 16)].tolist())
        hashes = np.array([digest(joined[s:e], 42) for s, e in spans], np.uint64)
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(starts), bitorder="little").view(np.uint64)[0])


def fingerprint(text: Column | str, shingle: int = 3) -> Column:
    """The fingerprint as a signed 64-bit number."""

    @F.pandas_udf("long")
    def hashed(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            found = np.array([fingerprint_of(t, shingle) for t in batch], np.uint64)
            yield pd.Series(found.view(np.int64))

    return hashed(text)


def as_hex(number: Column | str) -> Column:
    return F.lpad(F.lower(F.hex(number)), 16, "0")


def _differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def _split(sorted_keys: np.ndarray, low: np.ndarray, high: np.ndarray, bit: int) -> np.ndarray:
    """Where the right child of each node begins; a node is a range of keys that agree above ``bit``."""
    first_one = (sorted_keys[low] >> np.uint64(bit) | np.uint64(1)) << np.uint64(bit)
    return np.clip(np.searchsorted(sorted_keys, first_one), low, high)


def _pairs_below(left: np.ndarray, right: np.ndarray, itself: bool, half: int, total: int) -> Iterator[tuple]:
    """Index pairs of keys with at most ``half`` differing bits in the upper half and ``total`` at all.

    ``left`` and ``right`` are sorted and without repeats. States are pairs of nodes: two ranges and the bits that
    differed so far. Small pairs of ranges are compared key by key; large sets of states wait on a stack.
    """
    whole = np.array([[0], [len(left)], [0], [len(right)], [0]], np.int64)
    stack = [(63, whole)] if len(left) and len(right) else []
    while stack:
        bit, state = stack.pop()
        l0, l1, r0, r1, _ = state
        small = ((l1 - l0) * (r1 - r0) <= _LEAF) | (bit < 0)
        if small.any():
            s = state[:, small]
            wide = s[3] - s[2]
            count = (s[1] - s[0]) * wide
            which = np.repeat(np.arange(len(count)), count)
            step = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
            i, j = s[0][which] + step // wide[which], s[2][which] + step % wide[which]
            if itself:
                i, j = i[i < j], j[i < j]
            near = (_differing(left[i], right[j]) <= total) & (_differing(left[i] >> np.uint64(32), right[j] >> np.uint64(32)) <= half)
            yield i[near], j[near]
            state = state[:, ~small]
        if not state.shape[1]:
            continue
        if state.shape[1] > _STATES:
            cut = state.shape[1] // 2
            stack += [(bit, state[:, :cut]), (bit, state[:, cut:])]
            continue
        l0, l1, r0, r1, bits = state
        lm, rm = _split(left, l0, l1, bit), _split(right, r0, r1, bit)
        one_node = (l0 == r0) & (l1 == r1) if itself else np.zeros(len(l0), bool)
        both = [(l0, lm, r0, rm, bits, None), (lm, l1, rm, r1, bits, None), (l0, lm, rm, r1, bits + 1, None), (lm, l1, r0, rm, bits + 1, ~one_node)]
        budget, following = half if bit >= 32 else total, []
        for a0, a1, b0, b1, e, also in both:
            alive = (a0 < a1) & (b0 < b1) & (e <= budget)
            alive = alive if also is None else alive & also
            following.append(np.stack([a0, a1, b0, b1, e])[:, alive])
        stack.append((bit - 1, np.concatenate(following, axis=1)))


def _walk_cell(rows: pd.DataFrame) -> pd.DataFrame:
    """Links within the left block, if it is there as both sides, and between the left and the right block."""
    keys = {side: np.unique(rows.key[rows.side == side].to_numpy(np.int64).view(np.uint64)) for side in (0, 1, 2)}
    own, half, total = keys[0], int(rows.half.iloc[0]), int(rows.total.iloc[0])
    every = np.unique(np.concatenate([own, keys[1], keys[2]]))
    label, kept_a, kept_b, waiting = np.arange(len(every)), [], [], 0
    turns = [(own, own, True)] if rows.within.iloc[0] else []
    turns += [(own, keys[side], False) for side in (1, 2) if len(keys[side])]
    for left, right, itself in turns:
        at_left, at_right = np.searchsorted(every, left), np.searchsorted(every, right)
        for i, j in _pairs_below(left, right, itself, half, total):
            kept_a.append(at_left[i]), kept_b.append(at_right[j])
            waiting += len(i)
            if waiting > 1_000_000:
                label, kept_a, kept_b, waiting = forest(len(every), np.concatenate([np.arange(len(every)), *kept_a]), np.concatenate([label, *kept_b])), [], [], 0
    label = forest(len(every), np.concatenate([np.arange(len(every)), *kept_a]), np.concatenate([label, *kept_b]))
    linked = np.flatnonzero(label != np.arange(len(every)))
    swapped = bool(rows.swapped.iloc[0])
    back = (lambda k: k << np.uint64(32) | k >> np.uint64(32)) if swapped else (lambda k: k)
    return pd.DataFrame({"a": back(every[linked]).view(np.int64), "b": back(every[label[linked]]).view(np.int64)})


def links(prints: DataFrame, max_bits: int = 3, cell_rows: int | None = None) -> DataFrame:
    """A spanning set of links (a, b) between the distinct fingerprints of column ``key`` that differ in ``max_bits`` bits or fewer."""
    distinct = materialize(prints.select("key").distinct(), "fingerprints")
    depth = max(1, min(32, (max(1, distinct.count()) // (cell_rows or CELL_ROWS)).bit_length()))
    half = max_bits // 2
    swap = F.shiftleft("key", 32).bitwiseOR(F.shiftrightunsigned("key", 32))
    turned = distinct.select(F.explode(F.array(F.struct(F.lit(False).alias("swapped"), "key"), F.struct(F.lit(True).alias("swapped"), swap.alias("key")))).alias("r"))
    prefix = F.shiftrightunsigned("key", 64 - depth)
    homes = turned.select("r.swapped", "r.key").withColumn("home", prefix)
    flips = _flips(depth, half)
    # Each pair of cells meets in the smaller one.
    reached = F.filter(F.transform(F.lit(flips) if flips else F.array().cast("array<long>"), lambda f: F.col("home").bitwiseXOR(f)), lambda q: q < F.col("home"))
    cells = F.concat(F.array(F.struct(F.col("home").alias("cell"), F.lit(False).alias("visits"))), F.transform(reached, lambda q: F.struct(q.alias("cell"), F.lit(True).alias("visits"))))
    placed = homes.select("swapped", "key", F.explode(cells).alias("c")).select("swapped", "key", "c.cell", "c.visits")
    dealt = in_blocks(placed, ["swapped", "cell"], "key", TASK_ROWS).withColumns({"half": F.lit(half), "total": F.lit(max_bits)})
    return dealt.groupBy("swapped", "cell", "i", "j").applyInPandas(_walk_cell, "a long, b long")


def _flips(depth: int, half: int) -> list[int]:
    """All changes of 1 to ``half`` of ``depth`` bits."""
    from itertools import combinations

    return [sum(1 << b for b in bits) for n in range(1, half + 1) for bits in combinations(range(depth), n)]


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: its id, ``key`` (the fingerprint, signed) and ``component_id``, the smallest id that links reach."""
    prints = materialize(docs.select(F.col(doc_id).alias(doc_id), fingerprint(F.col(text), shingle).alias("key")), "prints")
    groups = components(links(prints, max_bits)).select(F.col("id").alias("_id"), F.col("component").alias("_group"))
    per_print = prints.groupBy("key").agg(F.min(doc_id).alias("_least"))
    grouped = per_print.join(groups, F.col("key") == F.col("_id"), "left").withColumn("_group", F.coalesce("_group", "key"))
    named = materialize(
        grouped.join(
            grouped.groupBy(F.col("_group").alias("_g")).agg(F.min("_least").alias("component_id")), F.col("_group") == F.col("_g")
        ).select(F.col("key").alias("_key"), "component_id"),
        "groups",
    )
    return prints.join(named, F.col("key") == F.col("_key")).select(doc_id, "key", "component_id")


def one_per_group(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """``docs`` with one document of each group, the one with the smallest id; all columns stay. Of rows that agree in id
    and text one stays; of rows that agree in the id only, each counts as a document."""
    own = F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("doc_id", "text"))
    found = near_duplicates(docs.select(F.struct(own.alias("id"), row_key().alias("row")).alias("_own"), "text"), shingle, max_bits, "_own")
    kept = found.filter(F.col("_own") == F.col("component_id")).groupBy(F.col("_own.row").alias("_kept")).agg(F.count(F.lit(1)).alias("_rows"))
    kept = materialize(kept, "kept")
    chosen = boxed(docs, _row=row_key()).join(kept, F.col("_row") == F.col("_kept"))
    once = unboxed(chosen.filter("_rows = 1"), docs.columns)
    if kept.filter("_rows > 1").isEmpty():
        return once
    # Only columns other than id and text can differ.
    single = chosen.filter("_rows > 1").groupBy("_row").agg(F.first("_doc").alias("_doc"))
    return once.unionByName(unboxed(single, docs.columns))
