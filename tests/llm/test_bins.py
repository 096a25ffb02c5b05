"""Bin completion: fillings, bounds and solutions against trying everything; pieces by exact round trip."""

import random
import zlib
from collections import Counter, defaultdict
from functools import cache
from itertools import combinations

import numpy as np
import pytest

from touchline.llm import bins

SCHEMA = "doc_id long, text string"


def histogram(sizes, length):
    return np.bincount(sizes, minlength=length + 1)


def fewest(sizes, length):
    """The least number of sequences, by trying every set of pieces beside the largest one."""

    @cache
    def least(rest):
        if not rest:
            return 0
        largest, others = rest[0], rest[1:]
        found, seen = len(rest), set()
        for n in range(len(others) + 1):
            for chosen in combinations(range(len(others)), n):
                picked = tuple(others[i] for i in chosen)
                if largest + sum(picked) <= length and picked not in seen:
                    seen.add(picked)
                    left = list(others)
                    for p in picked:
                        left.remove(p)
                    found = min(found, 1 + least(tuple(left)))
        return found

    return least(tuple(sorted(sizes, reverse=True)))


def check_solution(found, counts, length):
    got = np.zeros(length + 1, int)
    for many, filling in found:
        assert many > 0 and sum(s * t for s, t in filling) <= length
        for size, times in filling:
            got[size] += many * times
    assert (got == counts).all()
    return sum(many for many, _ in found)


def test_fewest_sequences():
    rng, better = random.Random(2), 0
    for _ in range(120):
        length = rng.choice([10, 20, 37])
        sizes = [rng.randint(1, length) if rng.random() < 0.5 else rng.randint(length // 5, length // 2) for _ in range(rng.randint(1, 9))]
        counts, least = histogram(sizes, length), fewest(sizes, length)
        assert bins.lower_bound(counts, length) <= least
        by_fit = check_solution(bins.best_fit(counts, length), counts, length)
        found = check_solution(bins.complete(counts, length), counts, length)
        assert least <= found <= by_fit and found <= least + (by_fit > least)
        better += found < by_fit
    assert bins.complete(np.zeros(11, int), 10) == []
    # Best-fit decreasing needs three sequences here.
    assert check_solution(bins.complete(histogram([6, 5, 5, 4, 4, 4, 4, 4, 4], 20), 20), histogram([6, 5, 5, 4, 4, 4, 4, 4, 4], 20), 20) == 2


def test_undominated_fillings():
    rng = random.Random(3)

    def replaceable(filling, counts, room):
        """Whether a piece that is left could stand for some of the filling's, one or more, and not be smaller in sum than they
        are, unless it is the same piece."""
        items = [s for s, t in filling for _ in range(t)]
        left = Counter({s: int(c) for s, c in enumerate(counts) if c})
        left.subtract(items)
        for n in range(1, len(items) + 1):
            for part in set(combinations(items, n)):
                if any(c > 0 and sum(part) <= s <= room - sum(items) + sum(part) and (n > 1 or s > part[0]) for s, c in left.items()):
                    return True
        return False

    for _ in range(200):
        room = rng.randint(1, 16)
        counts = histogram([rng.randint(1, 9) for _ in range(rng.randint(0, 7))], 16)
        found = list(bins.fillings(counts, room))
        every = {()}
        for size in np.flatnonzero(counts)[::-1].tolist():
            every = {(*e, (size, t)) if t else e for e in every for t in range(counts[size] + 1) if sum(s * n for s, n in e) + size * t <= room}
        if room <= 16 and counts[room]:
            assert found == [(0, ((room, 1),))]
            continue
        fits = [e for e in every if e or not any(counts[1 : room + 1])]
        wanted = {e for e in fits if not replaceable(e, counts, room) and not any(c > 0 for c in _addable(e, counts, room))}
        assert {f for _, f in found} == {e for e in wanted}
        assert [w for w, _ in found] == sorted(room - sum(s * t for s, t in f) for _, f in found)


def _addable(filling, counts, room):
    """Left pieces that still fit beside the filling."""
    spare = room - sum(s * t for s, t in filling)
    used = dict(filling)
    return [int(counts[s]) - used.get(s, 0) for s in range(1, spare + 1)]


def test_many_pieces_near_the_bound():
    rng = np.random.default_rng(4)
    for n, low, high in ((3000, 1, 1024), (200_000, 1, 1024), (50_000, 100, 900)):
        counts = histogram(rng.integers(low, high + 1, n), 1024)
        found = check_solution(bins.complete(counts, 1024, nodes=1500), counts, 1024)
        assert found <= 1.002 * bins.lower_bound(counts, 1024) + 1


def check(rows, pieces, length, end_id, own):
    wanted = sorted(str((i, [*own.encode(t or "", add_special_tokens=False).ids, end_id])) for i, t in rows)
    by_sequence, by_piece = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p.length * 4 == len(p.ids)
        by_sequence[p.sequence_id].append((p.offset, p.length))
        by_piece[p.doc_id].append(p)
    for parts in by_sequence.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at and size > 0
            at += size
        assert at <= length
    assert len({(p.sequence_id, p.offset) for p in pieces}) == len(pieces)
    found = []
    for doc_id, parts in by_piece.items():
        if len({(p.piece, p.start) for p in parts}) < len(parts):  # repeated ids: only their pieces' number is checked
            assert sum(p.piece == 0 for p in parts) == sum(i == doc_id for i, _ in rows)
            found += [w for w in wanted if w.startswith(f"({doc_id},")]
            continue
        ids = []
        for p in sorted(parts, key=lambda p: p.piece):
            assert p.start == len(ids) and (p.length == length or p.piece == 0)
            ids += np.frombuffer(p.ids, "<u4").tolist()
        found.append(str((doc_id, ids)))
    assert sorted(found) == wanted
    return len(by_sequence)


@pytest.fixture(scope="module")
def path():
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


def test_round_trip(make, documents, path, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(bins, "BUCKET_ROWS", 7)  # a frequent length is ranked in many buckets
    rows = list(zip(documents.doc_id.tolist(), documents.text))
    rows += [(None, None), (1000, ""), (1001, "a <|endoftext|> b"), (1002, "no sentence end " * 3000), (1003, "same"), (1003, "same")]
    rows += [(1004, "日本語。 üñí 😀"), *((2000 + i, "copy of one text") for i in range(300))]
    table = make(rows, SCHEMA, ("piece", "_rank", "length", "_bucket", "ids"))
    found = bins.pack(table, path).collect()
    sequences = check(rows, found, 1024, 2, Tokenizer.from_file(path))
    counts = histogram([p.length for p in found], 1024)
    assert sequences <= bins.lower_bound(counts, 1024) + 1
    digests = bins.pack_digest(table, path)
    assert digests.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    key = lambda r: (str(r[0]), *r[1:])
    assert sorted(((p.doc_id, p.piece, p.start, p.length, zlib.crc32(p.ids)) for p in found), key=key) == sorted((tuple(r)[:5] for r in digests.collect()), key=key)


def test_empty_table(make, path):
    assert bins.pack(make([], SCHEMA), path).count() == 0
