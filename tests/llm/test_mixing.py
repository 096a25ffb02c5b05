"""Mixing against plain Python."""

import re
from collections import Counter

import pytest

from touchline.llm import mixing

ROWS = [
    (1, "a b c d e f g", "s1"), (2, "x " * 300, "s1"), (3, None, "s2"), (4, "", "s2"), (5, "q w  e\tr\n t " * 40, "s2"),
    (6, "lone words", None), (7, "z " * 50, None), (8, "same text", "s3"), (8, "same text", "s3"), (None, "no id " * 30, "s3"),
]
SCHEMA = "doc_id long, text string, source string"


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def shared_out(sizes, weights, total, most):
    """Targets by sharing the excess again until none is above its stop."""
    target, capped = {}, {}
    while True:
        free = [s for s in sizes if s not in capped]
        left = total - sum(capped.values())
        target = {s: left * weights[s] / sum(weights[t] for t in free) for s in free}
        over = [s for s in free if target[s] > most * sizes[s]]
        if not over:
            return capped | target
        capped |= {s: most * sizes[s] for s in over}


def expected(rows):
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += size(text)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    return sizes, shared_out(sizes, weights, 1.5 * sum(sizes.values()), 2)


def test_targets_and_words(make):
    docs = make(ROWS, SCHEMA)
    result = mixing.taken_words(mixing.mix(docs, mixing.cyclic_weights((5, 2, 1)), 1.5, 2, block_words=4)).collect()
    sizes, targets = expected(ROWS)
    assert sorted((r.doc_id or 0, r.size) for r in result) == sorted((i or 0, size(t)) for i, t, _ in ROWS)
    source_of = {i: s for i, _, s in ROWS}
    taken = Counter()
    for r in result:
        source = source_of[r.doc_id]
        assert r.source_size == sizes[source] and r.target == pytest.approx(targets[source])
        assert 0 <= r.taken <= 2 * r.size
        taken[source] += r.taken
    assert all(abs(taken[s] - targets[s]) <= 8 for s in sizes)


def test_reruns_agree_for_other_partitions(make):
    docs = make(ROWS, SCHEMA)
    once = sorted(map(str, mixing.taken_words(mixing.mix(docs, mixing.cyclic_weights((5, 2, 1)), 1.5, 2, 4)).collect()))
    again = sorted(map(str, mixing.taken_words(mixing.mix(docs.repartition(5, "text"), mixing.cyclic_weights((5, 2, 1)), 1.5, 2, 4)).collect()))
    assert once == again


def test_pieces_are_whole_blocks(make):
    result = mixing.mix(make(ROWS, SCHEMA), mixing.cyclic_weights((1,)), 1.5, 2, block_words=4, per_shard=16)
    slots = result.slots.collect()
    assert len({(s.source_no, s["pass_no"], s.block) for s in slots}) == len(slots)
    words = Counter()
    for p in result.pieces().collect():
        words[p.shard, p.slot] += p.n_words
    assert len(words) == len(slots) and max(words.values()) == 4
    drawn = Counter(s.source_no for s in slots)
    assert all(drawn[s.source_no] == s.quota for s in result.sources.collect())


def test_mixed_documents_hold_the_words_taken(make):
    docs = make(ROWS, SCHEMA)
    result = mixing.mix(docs, mixing.cyclic_weights((5, 2, 1)), 1.5, 2, block_words=4)
    mixed = mixing.mixed_documents(docs, result)
    assert mixed.columns == docs.columns
    per_id = Counter()
    for r in mixed.collect():
        per_id[r.doc_id] += size(r.text)
    wanted = Counter()
    for r in mixing.taken_words(result).collect():
        wanted[r.doc_id] += r.taken
    assert +per_id == +wanted


def test_empty_table(make):
    docs = make([], SCHEMA)
    assert mixing.taken_words(mixing.mix(docs, mixing.cyclic_weights((5, 2, 1)), 1.5, 2)).count() == 0


def test_slots_and_documents_are_not_broadcast(make):
    docs = make([*ROWS, *[(10 + i, f"some words of {i} " * 9, f"s{i % 3}") for i in range(40)]], SCHEMA)
    result = mixing.mix(docs, mixing.cyclic_weights((5, 2, 1)), 1.5, 2, 4)
    for found, keys in ((mixing.taken_words(result), ("block", "start")), (mixing.mixed_documents(docs, result), ("block", "start", "_key"))):
        found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        joins = re.findall(r"(\w+Join) \[([^]]*)\]", plan)
        for key in keys:
            assert {kind for kind, on in joins if re.search(rf"\b{key}#", on)} == {"SortMergeJoin"}, (key, joins)
