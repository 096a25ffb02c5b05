"""The range join against comparing all pairs."""

import numpy as np
import pytest

from touchline.llm import embeddings

SCHEMA = "vec_id long, embedding array<float>, label int"


def expected(rows, least=0.93):
    unit = []
    for i, e, label in rows:
        good = None not in (i, e, label) and len(e) and all(x is not None and np.isfinite(x) for x in e) and any(e)
        v = np.array(e, np.float32).astype(float) if good else None
        unit.append(v / np.linalg.norm(v) if good else None)
    group, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = unit[a] is not None and unit[b] is not None
            if both and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= least:
                links[a] += 1
                links[b] += 1
                group[find(a)] = find(b)
    least_id = {}
    for x, (i, _, _) in enumerate(rows):
        if i is not None:
            least_id[find(x)] = min(i, least_id.get(find(x), i))
    return [(i, links[x], c := least_id.get(find(x)) if i is not None else None, i == c) for x, (i, _, _) in enumerate(rows)]


def table():
    rng = np.random.default_rng(3)
    base, rows = rng.normal(size=(60, 8)), []
    for i in range(500):
        v = (base[rng.integers(60)] + rng.normal(size=8) * rng.choice([0, 0.1, 0.3])).astype(np.float32).tolist()
        rows.append((i, v, int(rng.integers(3)) if i % 50 else None))
    odd = [None, [], [0.0] * 8, [float("nan")] + [1.0] * 7, [None] + [1.0] * 7, [1.0, 2.0], [2.0, 4.0], [float("inf")] + [1.0] * 7]
    rows += [(600 + i, v, 1) for i, v in enumerate(odd)] + [(700 + i, [1.0] * 8, 2) for i in range(100)]
    return rows + [(None, [1.0] * 8, 2), (5, [1.0] * 8, 2)]


@pytest.mark.parametrize(("task_rows", "cell_rows"), [(8192, None), (64, 20), (8192, 20)])
def test_all_links_are_found(make, monkeypatch, task_rows, cell_rows):
    monkeypatch.setattr(embeddings, "TASK_ROWS", task_rows)
    monkeypatch.setattr(embeddings, "SALT_ROWS", 50)
    rows = table()
    got = embeddings.near_duplicates(make(rows, SCHEMA), 0.93, cell_rows).collect()
    assert sorted(str(tuple(r)) for r in got) == sorted(map(str, expected(rows)))


def test_empty_table(make):
    assert embeddings.near_duplicates(make([], SCHEMA)).count() == 0
