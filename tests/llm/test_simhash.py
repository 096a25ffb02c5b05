"""SimHash near-duplicates against plain Python."""

import random
import re

import xxhash

from touchline.llm import common, queries, simhash

SCHEMA = "doc_id long, text string"


def fingerprint(text, shingle=3):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    parts = [" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p, seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(keys, bits=3):
    """Smallest reachable fingerprint by comparing all pairs."""
    keys, seen = sorted(set(keys)), {}
    for k in keys:
        if k in seen:
            continue
        queue, seen[k] = [k], k
        while queue:
            here = queue.pop()
            for other in keys:
                if other not in seen and (here ^ other).bit_count() <= bits:
                    seen[other] = k
                    queue.append(other)
    return seen


def check_links(spark, keys, cell_rows):
    signed = [(k - (1 << 64) if k >> 63 else k,) for k in keys]
    edges = simhash.links(spark.createDataFrame(signed, "key long"), 3, cell_rows)
    found = {r.id % (1 << 64): r.component % (1 << 64) for r in common.components(edges).collect()}
    wanted = groups(keys)
    by_group = {}
    for k, g in wanted.items():
        by_group.setdefault(g, set()).add(k)
    got = {}
    for k in wanted:
        got.setdefault(found.get(k, k), set()).add(k)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, by_group.values()))


def test_trie_join_finds_all_links(spark, monkeypatch):
    rng = random.Random(4)
    keys = [rng.getrandbits(64) for _ in range(60)]
    keys += [k ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))) for k in keys[:30] for _ in range(6)]
    keys += [keys[0] ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6))) for _ in range(200)] + [0, 1 << 63, (1 << 64) - 1]
    check_links(spark, keys, 8)
    monkeypatch.setattr(simhash, "TASK_ROWS", 40)
    monkeypatch.setattr(simhash, "_STATES", 50)
    check_links(spark, keys, 64)


def test_documents(spark, make, documents):
    rows = [(i, t) for i, t in zip(documents.doc_id.tolist(), documents.text)][:60]
    rows += [(900, None), (901, ""), (902, " \n"), (903, "one"), (904, "ONE two"), (905, "one two"), (None, "one two"), (905, "one two")]
    found = simhash.near_duplicates(make(rows, SCHEMA)).collect()
    wanted = groups([fingerprint(t) for _, t in rows])
    least = {}
    for i, t in rows:
        group = wanted[fingerprint(t)]
        least[group] = min(i if i is not None else 1 << 60, least.get(group, 1 << 60))
    assert sorted(str((r.doc_id, r.key % (1 << 64), r.component_id)) for r in found) == sorted(
        str((i, fingerprint(t), least[wanted[fingerprint(t)]])) for i, t in rows
    )


def test_query(spark):
    rows = queries.op3_simhash_duplicates(spark, "/root/testdata/sf0.001").collect()
    assert all(re.fullmatch("[0-9a-f]{16}", r.fingerprint) and r.component_id <= r.doc_id for r in rows)


def test_one_of_each_group_stays(make):
    rows = [(5, "a b c d"), (3, "A b c  d"), (3, "A b c  d"), (7, None), (8, ""), (None, "something else entirely"), (9, "more words here now")]
    docs = make(rows, SCHEMA)
    kept = simhash.one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["3", "7", "9", "None"]


def test_empty_table(make):
    docs = make([], SCHEMA)
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.one_per_group(docs).count() == 0


def test_documents_that_share_an_id_each_count(make):
    rows = [(1, "alpha beta gamma delta"), (1, "quite another text of some words"), (2, "Alpha beta  gamma delta"), (0, "Quite another text of some words")]
    kept = sorted((r.doc_id, r.text) for r in simhash.one_per_group(make(rows, SCHEMA)).collect())
    assert kept == [(0, rows[3][1]), (1, rows[0][1])]
    kept = sorted((r.doc_id, r.text) for r in simhash.one_per_group(make(rows[:3], SCHEMA)).collect())
    assert kept == [(1, rows[0][1]), (1, rows[1][1])]
