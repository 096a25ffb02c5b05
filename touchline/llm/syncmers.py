"""Document fingerprints from closed syncmers.

A k-mer is an anchor if the smallest hash of its s-mers stands at its first or its last place. Whether a k-mer is one
depends on nothing but itself, so equal passages have equal anchors wherever they stand. A fingerprint holds all anchors of
a text in their order, so it grows with the text; two fingerprints are alike in the share of the anchors of both that occur
in both at one common shift.

Among any K - S + 1 windows in a row one is an anchor, so each anchor's distance from the one before fits one byte.

Defined cases: null counts as empty, an empty text has an empty fingerprint, and a text without an anchor is one anchor as a
whole; equal fingerprints, empty ones too, have likeness 1; rows with equal ids follow each other in the order of their
texts' hash, null ids come first; a single row is its own next one; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from touchline.llm.common import text_or_empty
from touchline.session import bound_batches

K, S = 16, 8
PART_BYTES = 16 << 20
_ENTRY = np.dtype([("gap", "u1"), ("hash", ">u4")])
_PAIRS = 1 << 20  # pairs of equal anchors that are formed at a time


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers (xor, shift and multiply rounds)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _grams(points: np.ndarray, size: int) -> np.ndarray:
    """Polynomial hashes of all windows of ``size`` code points; ``size`` is a power of two."""
    hashes, factor, width = points.astype(np.uint64) + np.uint64(1), np.uint64(0x9E3779B97F4A7C15), 1
    with np.errstate(over="ignore"):
        while width < size:
            hashes = hashes[:-width] * factor + hashes[width:] if len(hashes) > width else hashes[:0]
            factor, width = factor * factor, 2 * width
    return hashes


def anchors_of(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of a text's anchors."""
    if len(points) >= K:
        small = _mixed(_grams(points, S))
        places = K - S + 1
        least, width = small, 1
        while width * 2 <= places:
            least = np.minimum(least[: len(least) - width], least[width:])
            width *= 2
        if width < places:
            least = np.minimum(least[: len(small) - places + 1], least[places - width : places - width + len(small) - places + 1])
        where = np.flatnonzero((least == small[: len(least)]) | (least == small[places - 1 :]))
        if len(where):
            with np.errstate(over="ignore"):
                pair = small[where] * np.uint64(3) + small[where + K - S]
            return where, _mixed(pair)
    if not len(points):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    whole = hashlib.sha256(points.astype("<u4").tobytes()).digest()[:8]
    return np.zeros(1, np.int64), np.frombuffer(whole, np.uint64)


def fingerprint_of(points: np.ndarray) -> str:
    """All anchors in their order as hex: the distance from the one before and 32 bits of the hash each."""
    where, hashes = anchors_of(points)
    entries = np.empty(len(where), _ENTRY)
    entries["gap"], entries["hash"] = np.diff(where, prepend=0), hashes >> np.uint64(32)
    return entries.tobytes().hex()


def _entries(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and positions, sorted by both."""
    entries = np.frombuffer(bytes.fromhex(fingerprint), _ENTRY)
    hashes, where = entries["hash"].astype(np.int64), np.cumsum(entries["gap"], dtype=np.int64)
    order = np.argsort(hashes, kind="stable")
    return hashes[order], where[order]


def _runs(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different hashes, where each begins, and how often it occurs."""
    return np.unique(hashes, return_index=True, return_counts=True)


def likeness(a: str, b: str) -> float:
    """The share of the anchors of both that are in both at the most common shift."""
    if a == b:
        return 1.0
    (left, left_at), (right, right_at) = _entries(a), _entries(b)
    if not len(left) or not len(right):
        return 0.0
    (l_kinds, l_begin, l_n), (r_kinds, r_begin, r_n) = _runs(left), _runs(right)
    _, i, j = np.intersect1d(l_kinds, r_kinds, assume_unique=True, return_indices=True)
    l_begin, l_n, r_begin, r_n = l_begin[i], l_n[i], r_begin[j], r_n[j]
    union = len(left) + len(right) - int(np.minimum(l_n, r_n).sum())
    # Matches per shift, counted from the least one. An anchor that repeats in both is summed by a transform of all places.
    l_size, r_size = int(left_at.max()) + 1, int(right_at.max()) + 1
    shifts = np.zeros(l_size + r_size - 1, np.int64)
    points = 1 << (len(shifts) - 1).bit_length()
    many = l_n * r_n > 8 * points
    for k in np.flatnonzero(many):
        own, other = np.zeros(l_size), np.zeros(r_size)
        own[l_size - 1 - left_at[l_begin[k] : l_begin[k] + l_n[k]]] = 1
        other[right_at[r_begin[k] : r_begin[k] + r_n[k]]] = 1
        product = np.fft.irfft(np.fft.rfft(own, points) * np.fft.rfft(other, points), points)
        shifts += np.rint(product[: len(shifts)]).astype(np.int64)
    # All others pair by pair: each place on the left with the run on the right.
    wide = np.repeat(r_n[~many], l_n[~many])
    mine = np.repeat(l_begin[~many] - (np.cumsum(l_n[~many]) - l_n[~many]), l_n[~many]) + np.arange(len(wide))
    theirs = np.repeat(r_begin[~many], l_n[~many])
    ends = np.cumsum(wide)
    low = 0
    while low < len(wide):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + _PAIRS, "right")))
        n = wide[low:high]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        found = right_at[np.repeat(theirs[low:high], n) + step] - np.repeat(left_at[mine[low:high]], n) + l_size - 1
        seen, times = np.unique(found, return_counts=True)
        shifts[seen] += times
        low = high
    return int(shifts.max()) / union


def _points(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)


_NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _compare(doc_id, text: str, print_: str, next_text: str, next_print: str) -> tuple:
    """One row of the result for a document and the one after it."""
    n = len(text)
    q = n // 4
    edited = text[: n - q] + next_text[:q]
    own = fingerprint_of(_points(edited))
    return doc_id, n, hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), print_, own, likeness(print_, own), likeness(print_, next_print)


def _walk():
    """Compares the rows of sorted parts with their next ones. A part ends with the first row of the part after it."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, rows = None, []
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for part, doc_id, text, guest in zip(*(c.to_pylist() for c in batch.columns)):
                own = fingerprint_of(_points(text))
                if before is not None:
                    rows.append(_compare(*before, text, own))
                before = None if guest else (doc_id, text, own)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, kind if n == "doc_id" else None) for n, c in zip(_NAMES, zip(*rows))], _NAMES)
                rows = []

    return walk


def _part_of(first: list[tuple]):
    """The part of a row by its key, the last one whose first row has no larger key, and whether the row is that first one.
    Null ids, as zeros that are not known, come before all others."""

    @F.pandas_udf("part int, leads boolean")
    def udf(known: pd.Series, ids: pd.Series, order: pd.Series) -> pd.DataFrame:
        keys = list(zip(known, ids, order))
        parts = [max(0, bisect_right(first, key) - 1) for key in keys]
        return pd.DataFrame({"part": pd.Series(parts, dtype="int32"), "leads": pd.Series([first[p] == key for p, key in zip(parts, keys)], dtype=bool)})

    return udf


def fingerprints(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Per row, in the order of ids: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The keys of all rows, id and hash of the text, are sorted into parts; the first key of each part, one for some
    megabytes of text, settles the parts of the texts. A part gets the first row of the part after it as a guest, so that
    every row meets its next one while its part streams by, and the texts are shuffled once and no fingerprint is kept.
    """
    bound_batches(docs.sparkSession)
    kind = dict(docs.dtypes)["doc_id"]
    texts = docs.select("doc_id", text_or_empty("text").alias("text")).withColumn("order", F.xxhash64("text"))
    if parts is None:
        size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        parts = max(1, -(-size // PART_BYTES))
    known, number = F.col("doc_id").isNotNull().alias("known"), F.coalesce("doc_id", F.lit(0).cast(kind)).alias("number")
    least = F.min(F.struct(known, number, "order"))
    ranged = texts.select("doc_id", "order").repartitionByRange(int(parts), "doc_id", "order")
    found = ranged.groupBy(F.spark_partition_id()).agg(least.alias("least")).collect()
    first = sorted(tuple(r.least) for r in found)
    dealt = texts.withColumn("_p", _part_of(first)(known, number, "order"))

    def place(part: Column, guest: bool) -> Column:
        return F.struct(part.cast("int").alias("part"), F.lit(guest).alias("guest"))

    own, before = place(F.col("_p.part"), False), place(F.pmod(F.col("_p.part") - 1, F.lit(max(1, len(first)))), True)
    places = F.explode(F.when(F.col("_p.leads"), F.array(own, before)).otherwise(F.array(own))).alias("_at")
    both = dealt.select("doc_id", "text", "order", places).select("doc_id", "text", "order", "_at.part", "_at.guest")
    ordered = both.repartition(max(1, len(first)), "part").sortWithinPartitions("part", "guest", "doc_id", "order")
    schema = f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return ordered.select("part", "doc_id", "text", "guest").mapInArrow(_walk(), schema)


def anchors(docs: DataFrame) -> DataFrame:
    """All anchors of all texts for positional matching: doc_id, position, anchor."""
    kind = dict(docs.dtypes)["doc_id"]

    def find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for doc_id, text in zip(frame["doc_id"].astype(object).where(frame["doc_id"].notna(), None), frame["text"]):
                where, hashes = anchors_of(_points(text))
                yield pd.DataFrame({"doc_id": pd.Series([doc_id] * len(where), dtype=object), "position": where, "anchor": hashes.view(np.int64)})

    return docs.select("doc_id", "text").mapInPandas(find, f"doc_id {kind}, position long, anchor long")
