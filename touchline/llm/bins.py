"""Packing documents into as few sequences as possible, by bin completion.

Documents become pieces of at most ``length`` ids; only longer ones are cut, into full pieces after a first one that may be
shorter. What fits together depends on the pieces' lengths alone, of which there are at most ``length`` different ones, so
the search runs on the number of pieces of each length, a table of fixed size whatever the corpus. Its result is a list of
fillings, each with the number of sequences that get it; ranks of the pieces within their length, from sums over buckets of
pieces, then say which sequence and place a piece has.

Search: around the largest length left, the undominated fillings of the rest of a sequence are tried, the fullest first and
among these those with the largest companions. A filling is dominated if one of its pieces, or several together, could make way
for a larger piece that is left. A filling is used as often as the pieces allow. A branch ends where its waste exceeds
what a better solution may waste, or where a lower bound on the sequences of the rest leaves no gain. The solution of
best-fit decreasing is the first incumbent. The search ends at the lower bound, or after ``NODES`` fillings with the best
solution so far; no piece is left out either way.

Defined cases: null and empty texts have their end id only; rows that agree in everything are pieces of their own; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from touchline.llm.common import offsets
from touchline.llm.packing import Encoder
from touchline.session import materialize

LENGTH = 1024
END_ID = 2
NODES = 2_000
BUCKET_ROWS = 20_000
BATCH_IDS = 1 << 20
_RANKS = 1 << 45  # more than the pieces of a length

Filling = tuple[int, tuple[tuple[int, int], ...]]  # sequences that get it; (length, how often), the longest first


def lower_bound(counts: np.ndarray, length: int) -> int:
    """Sequences that pieces in these numbers by length need at least. For every least size a: a piece above length - a
    shares with none of size a or more, two pieces above half never share, and what the latter leave free holds only a part of
    the others of size a or more."""
    sizes = np.arange(length + 1)
    total = np.concatenate([[0], np.cumsum(counts)])  # of sizes below i
    ids = np.concatenate([[0], np.cumsum(counts * sizes)])
    half = length // 2
    a = np.arange(half + 1)
    alone = total[length + 1] - total[length - a + 1]
    paired = total[length - a + 1] - total[half + 1]
    free = paired * length - (ids[length - a + 1] - ids[half + 1])
    small = ids[half + 1] - ids[a]
    return int((alone + paired + np.maximum(0, -(-(small - free) // length))).max())


def best_fit(counts: np.ndarray, length: int) -> list[Filling]:
    """Best-fit decreasing. Equal sequences are handled together, so that the work depends on the lengths, not the pieces."""
    left: dict[int, list[tuple[int, tuple]]] = {}  # free ids -> (sequences, filling)

    def put(free: int, many: int, filling: tuple) -> None:
        if many:
            left.setdefault(free, []).append((many, filling))

    for size in np.flatnonzero(counts)[::-1].tolist():
        wanted = int(counts[size])
        for free in sorted(f for f in left if f >= size):
            fits, waiting = free // size, left.pop(free)
            for n, (many, filling) in enumerate(waiting):
                full, more = divmod(wanted, fits)
                used = min(many, full)
                put(free - fits * size, used, (*filling, (size, fits)))
                wanted -= used * fits
                if used < many and wanted:  # fewer than a whole filling is left
                    put(free - wanted * size, 1, (*filling, (size, wanted)))
                    used, wanted = used + 1, 0
                put(free, many - used, filling)
                if not wanted:
                    left.setdefault(free, []).extend(waiting[n + 1 :])
                    break
            if not wanted:
                break
        fits = length // size
        full, more = divmod(wanted, fits)
        put(length - fits * size, full, ((size, fits),))
        put(length - more * size, 1 if more else 0, ((size, more),))
    return [(many, filling) for found in left.values() for many, filling in found if many]


def _bits(mask: int) -> list[int]:
    return [i for i, b in enumerate(bin(mask)[:1:-1]) if b == "1"]


def _spread(mask: int, width: int) -> int:
    """The mask with every bit also at the next ``width`` places."""
    done = 0
    while done < width:
        step = min(done + 1, width - done)
        mask |= mask << step
        done += step
    return mask


def _dominated(filling: tuple[tuple[int, int], ...], waste: int, free: int) -> bool:
    """Whether a piece among the lengths ``free`` fits as well, or could stand for a smaller piece or for several together."""
    none, one, several = 1, 0, 0
    for size, times in filling:
        for _ in range(times):
            several |= several << size | one << size
            one |= none << size
    larger = _spread((none | one) << 1, waste - 1) if waste else 0
    return bool((_spread(several, waste) | larger) & free)


def fillings(counts: np.ndarray, room: int) -> Iterator[tuple[int, tuple[tuple[int, int], ...]]]:
    """Waste and pieces of the undominated ways to fill ``room``, the least waste and then the largest pieces first."""
    if room > 0 and counts[room]:
        yield 0, ((room, 1),)  # dominates all others
        return
    sizes = np.flatnonzero(counts[: room + 1]).tolist()
    within, reach = (1 << room + 1) - 1, [1]
    for size in sizes:
        sums, times, step = reach[-1], min(int(counts[size]), room // size), 1
        while times:
            step = min(step, times)
            sums |= sums << step * size
            times -= step
            step *= 2
        reach.append(sums & within)
    everything = sum(1 << s for s in sizes)

    def ways(at: int, target: int) -> Iterator[tuple[tuple[int, int], ...]]:
        while at and sizes[at - 1] > target:
            at -= 1
        if not target:
            yield ()
            return
        if not at or not reach[at] >> target & 1:
            return
        size = sizes[at - 1]
        for times in range(min(int(counts[size]), target // size), -1, -1):
            if reach[at - 1] >> (target - times * size) & 1:
                for rest in ways(at - 1, target - times * size):
                    yield ((size, times), *rest) if times else rest

    for target in reversed(_bits(reach[-1])):
        if target == 0 and sizes:
            return  # an empty filling where something fits
        for found in ways(len(sizes), target):
            free = everything
            for size, times in found:
                if counts[size] == times:
                    free &= ~(1 << size)
            if not _dominated(found, room - target, free):
                yield room - target, found


def complete(counts: np.ndarray, length: int, nodes: int = NODES) -> list[Filling]:
    """Fillings for all pieces, ``counts`` of them by length (index 0 to ``length``), in few sequences."""
    counts = counts.astype(np.int64).copy()
    best, bound = best_fit(counts, length), lower_bound(counts, length)
    fewest, ids = sum(many for many, _ in best), int((counts * np.arange(length + 1)).sum())
    path: list[tuple[int, tuple, int]] = []
    used = waste = 0

    def open_branch():
        largest = int(np.flatnonzero(counts)[-1])
        counts[largest] -= 1
        found = fillings(counts.copy(), length - largest)
        counts[largest] += 1
        return largest, found

    branches = [open_branch()] if fewest > bound else []
    while branches and nodes:
        largest, found = branches[-1]
        lost, filling = next(found, (None, ()))
        whole = _joined(largest, filling)
        may_lose = (fewest - 1) * length - ids - waste
        if lost is None or lost > may_lose:  # those that follow lose no less
            branches.pop()
            if path:
                many, undone, before = path.pop()
                for size, times in undone:
                    counts[size] += many * times
                used, waste = used - many, before
            continue
        nodes -= 1
        many = min(int(counts[size]) // times for size, times in whole)
        many = min(many, may_lose // lost) if lost else many
        path.append((many, whole, waste))
        for size, times in whole:
            counts[size] -= many * times
        used, waste = used + many, waste + many * lost
        if not counts.any():
            best, fewest = [(m, f) for m, f, _ in path], used
            if fewest == bound:
                break
        elif used + lower_bound(counts, length) < fewest:
            branches.append(open_branch())
            continue
        many, undone, before = path.pop()
        for size, times in undone:
            counts[size] += many * times
        used, waste = used - many, before
    return best


def _joined(largest: int, filling: tuple[tuple[int, int], ...]) -> tuple[tuple[int, int], ...]:
    """The filling with the largest piece; lengths fall."""
    if filling and filling[0][0] == largest:
        return ((largest, filling[0][1] + 1), *filling[1:])
    return ((largest, 1), *filling)


def _slots(found: list[Filling]) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ranks of a length that go to a filling: their keys, length and first rank in one number, in rising order; and
    length, first rank, first sequence, times, first offset."""
    ranks: dict[int, int] = {}
    runs, sequence = [], 0
    for many, filling in found:
        offset = 0
        for size, times in filling:
            first = ranks.get(size, 0)
            runs.append((size, first, sequence, times, offset))
            ranks[size] = first + many * times
            offset += size * times
        sequence += many
    table = np.array(sorted(runs), np.int64).reshape(-1, 5)
    return table[:, 0] * _RANKS + table[:, 1], table


def assign(pieces: DataFrame, length: int = LENGTH, nodes: int = NODES) -> DataFrame:
    """The rows of a written table of pieces (doc_id, start, length and any others) with sequence_id and offset."""
    sizes = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most ``length`` rows
    counts = np.zeros(length + 1, np.int64)
    for size, many in sizes.items():
        counts[size] = many
    keys, table = _slots(complete(counts, length, nodes))
    buckets = F.array(*[F.lit(max(1, math.ceil(int(c) / BUCKET_ROWS))) for c in counts])
    whole = F.xxhash64(*[F.col(c) for c in pieces.columns])
    dealt = pieces.withColumn("_hash", whole).withColumn("_one", F.lit(1))
    dealt = dealt.withColumn("_bucket", F.pmod("_hash", F.get(buckets, F.col("length").cast("int"))))
    ranked = offsets(dealt, "_one", ["length"], "_bucket", [F.col("doc_id"), F.col("start"), F.col("_hash")], out="_rank")

    @F.pandas_udf("sequence_id long, offset long")
    def place(size: pd.Series, rank: pd.Series) -> pd.DataFrame:
        run = table[np.searchsorted(keys, size.to_numpy() * _RANKS + rank.to_numpy(), side="right") - 1]
        nth = rank.to_numpy() - run[:, 1]
        return pd.DataFrame({"sequence_id": run[:, 2] + nth // run[:, 3], "offset": run[:, 4] + nth % run[:, 3] * size.to_numpy()})

    placed = ranked.withColumn("_place", place("length", "_rank"))
    return placed.select(*pieces.columns, "_place.sequence_id", "_place.offset")


def cut(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """A row per piece: doc_id, piece from 0, start, length, ids (packed unsigned 32-bit numbers). ``tokenizer`` is the
    path of a ``tokenizers`` file that the driver can read."""
    with open(tokenizer, encoding="utf-8") as file:
        shipped = docs.sparkSession.sparkContext.broadcast(file.read())
    names = ["doc_id", "piece", "start", "length", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shipped.value)
        for batch in batches:
            rows, waiting = [], 0
            id_type = batch.schema.field("doc_id").type
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = np.array([*encoder.ids(text or ""), end_id], "<u4")
                first = len(ids) % length or length
                for piece, end in enumerate(range(first, len(ids) + 1, length)):
                    start = max(0, end - length) if piece else 0
                    rows.append((doc_id, piece, start, end - start, ids[start:end].tobytes()))
                waiting += len(ids)
                if waiting >= BATCH_IDS:
                    yield _batch(rows, names, id_type)
                    rows, waiting = [], 0
            if rows:
                yield _batch(rows, names, id_type)

    id_type = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, piece int, start long, length long, ids binary")


def _batch(rows: list[tuple], names: list[str], id_type: pa.DataType) -> pa.RecordBatch:
    types = [id_type, pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """The pieces of all documents with their ids, sequence_id and offset."""
    return assign(materialize(cut(docs, tokenizer, length, end_id), "pieces"), length)


def pack_digest(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """``pack`` with the crc32 of a piece's ids in place of the ids, which are then never written."""
    pieces = cut(docs, tokenizer, length, end_id)
    return assign(materialize(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "pieces"), length)
