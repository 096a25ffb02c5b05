"""Packing documents into sequences of a fixed length, in their order, by dynamic programming.

The documents' ids form one stream. Windows are cut from it where a document or a sentence ends, or, inside a sentence
longer than ``STRETCH`` ids, at every such stretch. A window of at most ``length`` ids is padded to ``length``, unless its own
length is a power of two. The cost of a cut is the padding of the window that ends there, plus a penalty if it cuts a
document; the cheapest chain of cuts is found over all positions. Between cuts i and j the padding is length - (j - i),
so the best i for j is the smallest of cost(i) + i over a sliding window, which a monotone queue gives in constant time;
power-of-two windows are twelve further transitions.

The stream is dealt by ranges of document ids; each part is packed by itself in one pass with bounded memory: once
``HORIZON`` ids wait, the windows found for them are final, but for the last one, which stays open.

Defined cases: null and empty texts give their end id only; rows with null ids come first and rows with equal ids are packed one
after the other in the order of their texts' hash; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

LENGTH = 2048
END_ID = 1
SENTENCE_PENALTY, STRETCH_PENALTY, SEQUENCE_COST = 6.0, 24.0, 4.0
STRETCH = 64
HORIZON = 262_144
PART_BYTES = 16 << 20
BLANK_RUN = 100_000
_BLANKS = re.compile(rf"\s{{{BLANK_RUN}}}")
_SEQUENCES = 1 << 40  # sequence numbers per part
# The special token of the vocabulary and the ends of sentences.
SPECIAL = "<|endoftext|>"
SENTENCE_ENDS = (".", "!", "?", "\n", "。", "！", "？", '."', '!"', '?"', ".)", "…")


class Encoder:
    """Byte-level BPE from the text of a ``tokenizers`` file. The merges run in tiktoken, which gives the same ids faster;
    texts with the special token or a run of very many blanks, for which its pattern matcher has no stack, go through ``tokenizers`` itself."""

    def __init__(self, file_text: str):
        import json

        import tiktoken

        self._file_text, self._whole = file_text, None
        vocabulary = json.loads(file_text)["model"]["vocab"]
        as_byte = {c: b for b, c in _byte_letters().items()}
        ranks = {bytes(as_byte[c] for c in token): i for token, i in vocabulary.items() if token != SPECIAL}
        self._fast = tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        ends = tuple(e.encode() for e in SENTENCE_ENDS)
        self.ends_sentence = np.zeros(max(vocabulary.values()) + 2, bool)
        for token, i in ranks.items():
            self.ends_sentence[i] = token.endswith(ends)

    def ids(self, text: str) -> list[int]:
        if SPECIAL not in text and not (len(text) > BLANK_RUN and _BLANKS.search(text)):
            return self._fast.encode_ordinary(text)
        if self._whole is None:
            from tokenizers import Tokenizer

            self._whole = Tokenizer.from_str(self._file_text)
        return self._whole.encode(text, add_special_tokens=False).ids


# Fixed value: the pattern that byte-level BPE of this kind splits text with before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_letters() -> dict[int, str]:
    """The letters that stand for bytes in a byte-level vocabulary: visible Latin-1 for itself, the others from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def best_cuts(positions: np.ndarray, penalties: np.ndarray, length: int = LENGTH) -> list[int]:
    """Indexes into ``positions`` of the cheapest cuts. ``positions`` rise from 0, no gap is above ``length``; the last is
    always cut."""
    n = len(positions)
    powers = [1 << k for k in range(length.bit_length()) if 1 << k <= length]
    found = np.searchsorted(positions, positions[None, :] - np.array(powers)[:, None])
    exact = (found < n) & (positions[np.minimum(found, n - 1)] == positions[None, :] - np.array(powers)[:, None])
    row, column = np.nonzero(exact.T)
    sources = found.T[row, column].tolist()
    bounds = np.searchsorted(row, np.arange(n + 1)).tolist()
    at, extra = positions.tolist(), (penalties + SEQUENCE_COST).tolist()
    cost, back = [0.0] * n, [0] * n
    queue: deque[tuple[float, int]] = deque([(0.0, 0)])
    for j in range(1, n):
        here = at[j]
        while at[queue[0][1]] < here - length:
            queue.popleft()
        key, best = queue[0]
        least = key + length - here
        for k in range(bounds[j], bounds[j + 1]):
            if cost[sources[k]] < least:
                least, best = cost[sources[k]], sources[k]
        cost[j], back[j] = least + extra[j], best
        key = cost[j] + here
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j))
    cuts, j = [], n - 1
    while j:
        cuts.append(j)
        j = back[j]
    return cuts[::-1]


def _cut_places(ids: np.ndarray, document_ends: np.ndarray, ends_sentence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a stream may be cut and what a cut costs there, 0 and the end included."""
    n = len(ids)
    price = np.full(n + 1, np.inf)
    price[1:][ends_sentence[ids]] = SENTENCE_PENALTY
    price[document_ends] = 0.0
    price[[0, n]] = 0.0
    marks = np.flatnonzero(price < np.inf)
    gaps = np.diff(marks)
    for start, gap in zip(marks[:-1][gaps > STRETCH].tolist(), gaps[gaps > STRETCH].tolist()):
        price[start + STRETCH : start + gap : STRETCH] = STRETCH_PENALTY
    places = np.flatnonzero(price < np.inf)
    return places, price[places]


class Packer:
    """Takes documents one after the other and gives finished sequences as pieces."""

    def __init__(self, encoder: Encoder, length: int, first_sequence: int):
        self.encoder, self.length, self.sequence = encoder, length, first_sequence
        self.chunks: list[tuple] = []  # doc_id, start, ids, doc_tokens
        self.waiting = 0

    def add(self, doc_id, text: str | None) -> Iterator[tuple]:
        ids = np.array([*self.encoder.ids(text or ""), END_ID], np.uint32)
        for start in range(0, len(ids), HORIZON):
            part = ids[start : start + HORIZON]
            self.chunks.append((doc_id, start, part, len(ids)))
            self.waiting += len(part)
            if self.waiting >= HORIZON:
                yield from self.pack(last=False)

    def pack(self, last: bool) -> Iterator[tuple]:
        if not self.chunks:
            return
        stream = np.concatenate([c[2] for c in self.chunks])
        bounds = np.cumsum([len(c[2]) for c in self.chunks])
        whole = np.array([c[1] + len(c[2]) == c[3] for c in self.chunks])
        places, prices = _cut_places(stream, bounds[whole], self.encoder.ends_sentence)
        cuts = places[best_cuts(places, prices, self.length)].tolist()
        if not last and len(cuts) > 1:
            cuts.pop()
        chunk, begin = 0, 0
        for cut in cuts:
            offset = 0
            while begin < cut:
                doc_id, start, ids, total = self.chunks[chunk]
                chunk_start = int(bounds[chunk]) - len(ids)
                end = min(cut, int(bounds[chunk]))
                piece = stream[begin:end]
                yield doc_id, start + begin - chunk_start, len(piece), piece.astype("<u4").tobytes(), total, self.sequence, offset
                offset += len(piece)
                begin = end
                chunk += end == bounds[chunk]
            self.sequence += 1
        rest = self.chunks[chunk:]
        if rest:
            doc_id, start, ids, total = rest[0]
            done = begin - (int(bounds[chunk]) - len(ids))
            rest[0] = (doc_id, start + done, ids[done:], total)
        self.chunks, self.waiting = rest, len(stream) - begin


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, parts: int | None = None) -> DataFrame:
    """A row per piece of a document: doc_id, start, length, ids (packed unsigned 32-bit numbers), doc_tokens,
    sequence_id, offset. ``tokenizer`` is the path of a ``tokenizers`` file that the driver can read."""
    with open(tokenizer, encoding="utf-8") as file:
        shipped = docs.sparkSession.sparkContext.broadcast(file.read())
    texts = docs.select("doc_id", "text")
    if parts is None:
        size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        parts = max(1, -(-size // PART_BYTES))
    order = F.xxhash64("text").alias("_order")
    ranged = texts.select("doc_id", "text", order).repartitionByRange(int(parts), "doc_id", "_order").sortWithinPartitions("doc_id", "_order")
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    id_type = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        packer = Packer(Encoder(shipped.value), length, TaskContext.get().partitionId() * _SEQUENCES)
        rows: list[tuple] = []
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].astype(object).where(batch["doc_id"].notna(), None), batch["text"]):
                rows.extend(packer.add(doc_id, text))
                if len(rows) >= 2000:
                    yield _frame(rows, names)
                    rows = []
        rows.extend(packer.pack(last=True))
        yield _frame(rows, names)

    return ranged.select("doc_id", "text").mapInPandas(
        run, f"doc_id {id_type}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    )


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame({n: pd.Series([r[i] for r in rows], dtype=object) for i, n in enumerate(names)})
    return frame.astype({n: "int64" for n in names if n not in ("doc_id", "ids")})


def digest(pieces: DataFrame) -> DataFrame:
    """The pieces with the crc32 of their ids instead of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
