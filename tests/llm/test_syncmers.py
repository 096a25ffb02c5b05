"""Fingerprints against plain Python."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from touchline.llm import syncmers

SCHEMA = "doc_id long, text string"


def points(text):
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def test_anchors_are_closed_syncmers():
    text = np.random.default_rng(0).integers(97, 110, 500).astype(np.uint32)
    small, places = syncmers._mixed(syncmers._grams(text, syncmers.S)), syncmers.K - syncmers.S + 1
    wanted = [i for i in range(len(text) - syncmers.K + 1) if min(small[i : i + places]) in (small[i], small[i + places - 1])]
    assert syncmers.anchors_of(text)[0].tolist() == wanted
    inner, hashes = syncmers.anchors_of(text[100:300])
    whole = dict(zip(*map(np.ndarray.tolist, syncmers.anchors_of(text))))
    assert [whole[p + 100] for p in inner.tolist()] == hashes.tolist()


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_rows(make, documents, parts):
    rows = list(zip(documents.doc_id.tolist(), documents.text))[:50]
    rows += [(1000, None), (1001, ""), (1002, "x" * 100), (1003, "short"), (1004, "héllo 😀 wörld " * 20), (1005, "long " * 50_000)]
    got = {r.doc_id: r for r in syncmers.fingerprints(make(rows, SCHEMA), parts).collect()}
    texts = [t or "" for _, t in rows]
    for n, ((i, _), text) in enumerate(zip(rows, texts)):
        after = texts[(n + 1) % len(texts)]
        q = len(text) // 4
        edited, r = text[: len(text) - q] + after[:q], got[i]
        own, other = syncmers.fingerprint_of(points(text)), syncmers.fingerprint_of(points(edited))
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint, r.near_edited) == (own, other, syncmers.likeness(own, other))
        assert r.near_next == syncmers.likeness(own, syncmers.fingerprint_of(points(after)))


def test_likeness():
    rng = np.random.default_rng(1)
    text = "".join(map(chr, rng.integers(97, 123, 4000)))
    other = "".join(map(chr, rng.integers(97, 123, 4000)))
    own = syncmers.fingerprint_of(points(text))
    assert syncmers.likeness(own, own) == 1
    assert syncmers.likeness(own, syncmers.fingerprint_of(points("a line before\n" + text))) > 0.9
    assert syncmers.likeness(own, syncmers.fingerprint_of(points(other))) < 0.1


def test_ties_one_row_and_empty_table(make):
    rows = [(None, "first of all, without an id"), (1, "same text twice over"), (1, "same text twice over"), (2, "end")]
    got = syncmers.fingerprints(make(rows, SCHEMA), 2).collect()
    assert len(got) == 4 and len({r.fingerprint for r in got if r.doc_id == 1}) == 1
    single = syncmers.fingerprints(make(rows[:1], SCHEMA)).collect()
    assert single[0].near_next == 1
    assert syncmers.fingerprints(make([], SCHEMA)).count() == 0


def test_anchor_table(make):
    text = "some words that are long enough to have a few anchors in them, surely"
    rows = syncmers.anchors(make([(7, text), (8, None)], SCHEMA)).collect()
    where, hashes = syncmers.anchors_of(points(text))
    assert sorted((r.doc_id, r.position, r.anchor) for r in rows) == sorted(zip([7] * len(where), where.tolist(), hashes.view(np.int64).tolist()))


def test_a_passage_shared_by_long_texts_is_found():
    rng = np.random.default_rng(2)
    passage, *parts = ("".join(map(chr, rng.integers(97, 123, n))) for n in (400, 60_000, 30_000, 50_000, 20_000))
    one, other = parts[0] + passage + parts[1], parts[2] + passage + parts[3]
    shared = len(syncmers.anchors_of(points(passage))[0])
    sizes = [len(syncmers.anchors_of(points(t))[0]) for t in (one, other)]
    a, b = syncmers.fingerprint_of(points(one)), syncmers.fingerprint_of(points(other))
    assert len(a) == 10 * sizes[0]
    assert syncmers.likeness(a, b) == pytest.approx(shared / (sum(sizes) - shared), rel=0.02)


@pytest.mark.parametrize("unit", ["long ", "some words that stand twice, ", "ab"])
def test_likeness_of_repeated_passages_counts_every_shift(unit):
    rng = np.random.default_rng(5)
    noise = ["".join(map(chr, rng.integers(97, 123, 300))) for _ in range(3)]
    one, other = noise[0] + unit * 400 + noise[1], noise[2] + unit * 300 + noise[1]
    places = [list(zip(h.tolist(), w.tolist())) for w, h in (syncmers.anchors_of(points(t)) for t in (one, other))]
    shifts, kinds = Counter(q - p for h, p in places[0] for g, q in places[1] if h == g), [Counter(h for h, _ in own) for own in places]
    wanted = max(shifts.values()) / (kinds[0] | kinds[1]).total()
    assert syncmers.likeness(*(syncmers.fingerprint_of(points(t)) for t in (one, other))) == wanted
