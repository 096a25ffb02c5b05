"""Packing: exact round trip, and the cuts against trying all of them."""

import zlib
from collections import defaultdict

import numpy as np
import pytest

from touchline.llm import packing

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string"


def encoder():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def check(rows, pieces, length=2048):
    own = encoder()
    wanted = sorted(str((i, [*own.encode(t or "", add_special_tokens=False).ids, 1])) for i, t in rows)
    by_document, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_sequence[p.sequence_id].append((p.offset, p.length))
        by_document[p.doc_id, p.doc_tokens].append((p.sequence_id, p.offset, p.start, np.frombuffer(p.ids, "<u4").tolist()))
    whole = []
    for (doc_id, total), parts in by_document.items():
        ids = []
        for _, _, start, piece in sorted(parts):
            assert start == len(ids) % total
            ids += piece
        assert len(ids) % total == 0
        whole += [str((doc_id, ids[k : k + total])) for k in range(0, len(ids), total)]
    assert sorted(whole) == wanted
    for parts in by_sequence.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at and size > 0
            at += size
        assert at <= length


def test_round_trip(make, documents):
    rows = list(zip(documents.doc_id.tolist(), documents.text))[:80]
    rows += [(None, None), (1000, ""), (1001, "a <|endoftext|> b"), (1002, "no sentence end " * 3000), (1003, "same"), (1003, "same"), (1004, "日本語。テキスト！ üñí 😀")]
    pieces = packing.pack(make(rows, SCHEMA), PATH, parts=3).collect()
    check(rows, pieces)
    lengths = defaultdict(int)
    for p in pieces:
        lengths[p.sequence_id] += p.length
    padding = sum(0 if n & (n - 1) == 0 else 2048 - n for n in lengths.values())
    assert padding < 0.02 * sum(lengths.values())


def test_short_horizon_and_digest(make, monkeypatch, documents):
    monkeypatch.setattr(packing, "HORIZON", 3000)
    rows = list(zip(documents.doc_id.tolist(), documents.text))[:20]
    pieces = packing.pack(make(rows, SCHEMA), PATH, parts=1)
    found = pieces.collect()
    check(rows, found)
    digests = {(r.doc_id, r.start): r.ids_crc32 for r in packing.digest(pieces).collect()}
    assert all(digests[p.doc_id, p.start] == zlib.crc32(p.ids) for p in found)


def test_cheapest_cuts():
    rng = np.random.default_rng(0)
    for _ in range(150):
        at = np.concatenate([[0], np.cumsum(rng.integers(1, 9, rng.integers(1, 40)))])
        penalty = rng.integers(0, 7, len(at)).astype(float)

        def price(i, j):
            n = at[j] - at[i]
            return np.inf if n > 16 else penalty[j] + packing.SEQUENCE_COST + (0 if n & (n - 1) == 0 else 16 - n)

        best = [0.0]
        for j in range(1, len(at)):
            best.append(min(best[i] + price(i, j) for i in range(j)))
        cuts = [0, *packing.best_cuts(at, penalty, 16)]
        assert sum(price(a, b) for a, b in zip(cuts, cuts[1:])) == pytest.approx(best[-1])


def test_ids_are_those_of_the_tokenizer():
    own, other = packing.Encoder(open(PATH, encoding="utf-8").read()), encoder()
    for c in [*range(1, 0x3000, 7), 0x1F600, 0x2028, 0xFEFF]:
        text = f"a{chr(c)}b 1{chr(c)}2 {chr(c)}{chr(c)}! {chr(c)} x"
        assert own.ids(text) == other.encode(text, add_special_tokens=False).ids


def test_long_runs_of_blanks(make):
    rows = [(1, " " * 3_000_000), (2, "a" + "\n" * 600_000 + "b"), (3, "x " * 100_000)]
    check(rows, packing.pack(make(rows, SCHEMA), PATH, parts=2).collect())


def test_empty_table(make):
    assert packing.pack(make([], SCHEMA), PATH).count() == 0
